"""Every operator on small tables: against plain versions, and on nulls, empty texts, ties, repeats and clashing names."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from postlark.llm import (common, components, fingerprints, html, licenses, lines, minhash, mixing, packing, quality, queries, sharding,
                          warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, target string"
PROSE = ("the cat of the house sat on the mat and it was in that place for a long time with a dog by this door as they are at rest "
         "from the work of the day and he was not a man to have his tea alone but you or they would be there ") * 3


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 9, "x") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns that clash with results."""
    words = [f"w{i}" for i in range(60)]
    near = [*words[:59], "changed"]
    rows = [
        (1, " ".join(words), "en", "a"), (2, " ".join(near), "en", "b"), (3, " ".join(words), "de", None), (3, " ".join(words), "de", None),
        (4, None, None, None), (5, "", "en", "a"), (6, " \n\t ", "xx", "b"), (7, PROSE, "en", "a"), (8, "short text", None, "c"),
        (None, "a text without an id", "fr", "a"), (9, "x " * 30_000, "en", "d"), (10, "été \U0001F600 café", "fr", "c"),
        (20, PROSE + " and more", "en", "d"), (40, " ".join(reversed(words)), "en", "a"),
    ]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def text_words(text):
    return (text or "").replace("\x0b", " ").encode().split()


# -- sharding ---------------------------------------------------------------------------------


def test_shards_match_the_mixture(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    got = sharding.interleave(rows, 8).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    counts = [len(x) for x in by_shard.values()]
    assert sorted(by_shard) == list(range(8)) and max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by_shard.values())
    whole = Counter(r.source for r in got)
    for x in by_shard.values():
        for source, n in Counter(r.source for r in x).items():
            assert abs(n - whole[source] / 8) <= 2
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.interleave(rows.repartition(5), 8).collect()))


def test_sharding_of_odd_rows(odd, empty):
    got = sharding.interleave(odd, 4)
    assert got.count() == odd.count() and Counter(got.columns) == Counter(odd.columns + ["slot"])
    assert max(r.shard for r in got.collect()) <= 3
    assert sharding.interleave(empty, 4).count() == 0


def test_shards_against_a_plain_ranking(spark):
    rows = spark.createDataFrame([(i, None if i % 11 == 0 else "abc"[i % 3] if i % 5 else "hot", i, i) for i in range(600)],
                                 "_key long, source string, _slice long, _one long")
    keyed = rows.select("_key", "source", common.tie_breaker(rows, rows.columns, 11).alias("k"),
                        (F.shiftrightunsigned(F.xxhash64(F.lit(12), "source"), 11) / F.lit(float(2**53))).alias("start")).collect()
    groups = {}
    for r in sorted(keyed, key=lambda r: r.k):
        groups.setdefault(r.source, []).append(r)
    line = sorted(((at + r.start) / len(g), r.source is None, r.source or "", r.k, r["_key"]) for g in groups.values() for at, r in enumerate(g))
    want, filled = {}, [0] * 7
    for place, x in enumerate(line):
        shard = place * 7 // len(line)
        want[x[-1]] = (shard, filled[shard])
        filled[shard] += 1
    got = sharding.interleave(rows, 7)
    assert got.columns == ["_key", "source", "_slice", "_one", "shard", "slot"]
    assert {r["_key"]: (r.shard, r.slot) for r in got.collect()} == want


# -- licences ---------------------------------------------------------------------------------


def test_licences_of_files_and_directories(spark):
    mit = licenses.TEMPLATES[0][1]
    files = spark.createDataFrame([
        ("p/LICENSE", mit, "kept"), ("p/a/x.py", "# Licensed under CC BY-NC 4.0.\ncode here", "kept"), ("p/a/b/y.py", "plain", None),
        ("q/COPYING", "This work is licensed under the GNU General Public License, version 3.", "z"), ("q/a/z.txt", None, "z"), ("r.txt", "", "z"),
        (None, "We have a license to talk about our garden and about the weather in the north.", "z"), ("p/a/b/y.py", "plain", None),
    ], "path string, text string, score string")
    got = sorted((r.path or "", r.license or "", r.found) for r in licenses.scan_files(files).collect())
    assert got == sorted([
        ("p/LICENSE", "MIT", "file"), ("p/a/x.py", "CC-BY-NC-4.0", "file"), ("p/a/b/y.py", "MIT", "directory"), ("p/a/b/y.py", "MIT", "directory"),
        ("q/COPYING", "GPL-3.0", "file"), ("q/a/z.txt", "GPL-3.0", "directory"), ("r.txt", "", "none"), ("", "", "none")])
    assert licenses.scan_files(files.limit(0)).count() == 0


def test_each_template_finds_its_licence(spark):
    files = spark.createDataFrame([(f"d{i}/f.txt", f"first line\n// {t}\nlast") for i, (_, t) in enumerate(licenses.TEMPLATES)],
                                  "path string, text string")
    got = {r.path: r.license for r in licenses.scan_files(files).collect()}
    for i, (name, wording) in enumerate(licenses.TEMPLATES):
        if "\n" not in wording and wording.count(". ") == 0 and ":" not in wording[:-1]:
            assert got[f"d{i}/f.txt"] == name


def test_notices_whole_split_and_wrapped(spark):
    import re
    import textwrap

    rows, want = [], {}

    def put(text, name):
        rows.append((f"d{len(rows)}/f{len(rows)}.c", text))
        want[rows[-1][0]] = name

    for name, wording in licenses.TEMPLATES:
        put(f"x = 1\n\n// {wording}\n\ny = 2", name)
        put("x = 1\n\n" + "\n".join(textwrap.wrap(wording, 72)) + "\n\ny = 2", name)
        put("/*\n" + "\n".join(f" * {t}" for t in textwrap.wrap(wording, 72)) + "\n */\ny = 2", name)
        put("x = 1\n" + "\n".join(f"# {t}" for t in re.split(licenses.SENTENCE_BREAK.replace("\\p{Lu}", "[A-Z]"), wording)) + "\n\ny = 2", name)
    for name in sorted({n for n, _ in licenses.TEMPLATES}):
        put(f"// SPDX-License-Identifier: {name}\ncode", name)
    put("# SPDX-License-Identifier: GPL-2.0-or-later\ncode", "GPL-2.0")
    put("# SPDX-License-Identifier: Zlib\ncode", "Zlib")
    put("Prose of some length.\nAll rights reserved.", "Proprietary")
    put("Copyright (c) 2012, A. Writer. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
        "modification, are permitted provided that the following conditions\nare met:", "BSD-3-Clause")
    put("License\n\nSee elsewhere.", None)
    rows += [("e/LICENSE", licenses.TEMPLATES[0][1]), ("e/own.txt", "A tale.\nAll rights reserved.")]
    want["e/own.txt"] = "Proprietary"
    got = {r.path: r.license for r in licenses.scan_files(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: got[p] for p in want} == want


GNU = ("{0} is free software{1} you can redistribute it and/or modify\nit under the terms of the GNU {2}General Public License as published by\n"
       "the Free Software Foundation{3} either version {4} of the License, or\n(at your option) any later version.\n")
BSD = ("Copyright (c) 2015, A. Writer\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
       "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice,\n   this list of conditions.\n"
       "2. Redistributions in binary form must reproduce the above copyright\n   notice in the documentation.\n")
THIRD = "Neither the name of the author nor the names of its contributors may be\n * used to endorse or promote products derived from this software.\n"
FOURTH = "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement.\n"


def test_versions_and_clauses_tell_licences_apart(spark):
    from collections import Counter

    want = [
        (BSD, "BSD-2-Clause"), (BSD + THIRD, "BSD-3-Clause"), (BSD + FOURTH + THIRD, "BSD-4-Clause"), ("BSD 2-Clause License\n\n" + BSD, "BSD-2-Clause"),
        (GNU.format("This library", ";", "Lesser ", ";", "2.1"), "LGPL-2.1"), (GNU.format("This library", ":", "Lesser ", ",", "3"), "LGPL-3.0"),
        (GNU.format("This library", ";", "Library ", ";", "2"), "LGPL-2.0"), (GNU.format("This program", ";", "", ";", "2"), "GPL-2.0"),
        (GNU.format("This program", ":", "", ",", "3"), "GPL-3.0"), (GNU.format("This library", ";", "", ";", "2"), "GPL-2.0"),
        (GNU.format("This program", ";", "", ";", "1"), "GPL-1.0"), (GNU.format("This program", ":", "Affero ", ",", "3"), "AGPL-3.0"),
        ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("Licensed under the GNU Lesser General Public License, version 9.", None),
        ("Licensed under the GNU General Public License, version 4.", None), ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
        ("The Apache Software License, Version 1.1\n\n" + BSD, "Apache-1.1"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Licensed under the Apache License, Version 2.", "Apache-2.0"), ("Licensed under the Apache License, Version 3.0.", None),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "GPL-3.0"), ("GNU GENERAL PUBLIC LICENSE\n Version 1, February 1989", "GPL-1.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999", "LGPL-2.1"), ("Released under the BSD 4-Clause License.", "BSD-4-Clause"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
        ("Licensed under CC BY-SA 2.0.", None), ("Licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
        ("This work is licensed under the Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("# SPDX-License-Identifier: MIT OR Apache-2.0", "MIT OR Apache-2.0"), ("/* SPDX-License-Identifier: (gpl-2.0-only or mit) */", "(GPL-2.0 OR MIT)"),
        ("// SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", "GPL-2.0 WITH Classpath-exception-2.0"),
        ("(SPDX-License-Identifier: MIT)", "MIT"), ("// SPDX-License-Identifier: (MIT)", "MIT"),
    ]
    rows = [(f"d{i}/{kind}", text, i) for i, (text, _) in enumerate(want) for kind in ("a.c", "LICENSE")]
    got = {r.path: r.license for r in licenses.scan_files(spark.createDataFrame(rows, "path string, text string, file int")).collect()}
    assert {(p, got[p]) for p, _, i in rows if got[p] != want[i][1]} == set()

    notice = "# Licensed under the MIT License. See the LICENSE file for more"
    copies = [("x/a.py", notice, 0)] * 50 + [(f"y{i}/a.py", notice, 0) for i in range(50)]
    clash = "_own string, _path string, _above string, path string, text string, file int, directory int"
    rows = spark.createDataFrame([("a", "b", "c", p, t, 1, 2) for p, t, _ in copies], clash)
    scored = licenses.scan_files(rows)
    assert scored.columns[:6] == ["_own", "_path", "_above", "path", "file", "directory"]
    out = scored.collect()
    assert len(out) == 100 and len({(r.license, r.score, r._own, r.file, r.directory) for r in out}) == 1
    assert Counter(r.path for r in out)["x/a.py"] == 50


def test_licence_scores_against_a_plain_cosine(spark):
    import math
    import re
    from collections import Counter

    texts = ["Released under the MIT License by its author", "Licensed under the Apache License version 2.0 or what you like", "MIT License", "No word of it",
             "Licensed under the GNU General Public License version 2 and no later one", "a tale of permission", "Licensed under CC BY 4.0 at the mill"] * 2

    def terms(text):
        return Counter(re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower()))

    vocabulary = {t for _, w in licenses.TEMPLATES for t in terms(w)}
    held = Counter(t for x in texts for t in terms(x) if t in vocabulary)
    weigh = lambda tf: {t: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + held[t])) + 1) for t, n in tf.items()}
    norm = lambda w: math.sqrt(sum(x * x for x in w.values()))

    def best(text):
        passage, found = weigh(terms(text)), []
        for name, wording in licenses.TEMPLATES:
            other = weigh(terms(wording))
            shared = passage.keys() & other.keys()
            if shared and (len(other) > 3 or len(shared) == len(other)):
                found.append((sum(passage[t] * other[t] for t in shared) / norm(passage) / norm(other), name))
        return max(found, default=(0, None))

    files = spark.createDataFrame([(f"{i}/f.txt", t) for i, t in enumerate(texts)], "path string, text string")
    for r in licenses.scan_files(files).collect():
        score, name = best(texts[int(r.path.split("/")[0])])
        assert (r.license, r.score) == ((name, pytest.approx(score, abs=1e-8)) if score >= licenses.THRESHOLD else (None, None))


# -- fingerprints -----------------------------------------------------------------------------


def test_fingerprints_against_a_plain_version(spark, odd):
    got = fingerprints.fingerprint_documents(odd).collect()
    assert len(got) == odd.count()
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    by_text = defaultdict(set)
    for r in got:
        by_text[r.doc_id].add(r.fingerprint)
    own = {r.doc_id: r.text or "" for r in rows}
    assert by_text[1] == by_text[3] and by_text[4] == by_text[5] == by_text[6] == {"0" * 16}
    following = {a.doc_id: b.text or "" for a, b in zip(rows, [*rows[1:], rows[0]], strict=True)}
    for r in got:
        assert r.n_chars == len(own[r.doc_id])
        if r.doc_id != 3:
            third = len(own[r.doc_id]) // 3
            edited = own[r.doc_id][: len(own[r.doc_id]) - third] + following[r.doc_id][:third]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        bits = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert r.near_edited == pytest.approx(1 - bits / 64) and 0 <= r.near_next <= 1
        assert (r.n_within is None) == (r.doc_id is None or r.doc_id % 20 != 0)


def test_found_classes_hold_copies_and_near_ones(spark, odd):
    long = [f"w{i}" for i in range(4000)]
    rows = [(60, "one text of its own", "en", "a"), (61, "one text of its own", "en", "b"), (62, "one text of its own", "en", "c"),
            (80, " ".join(long), "en", "a"), (81, " ".join([*long[:-1], "z"]), "en", "a"), (100, "nothing like it here at all", "en", "a"),
            (None, "nothing like it there at all", "en", "a"), (None, "one text of its own", "en", "a")]
    got = fingerprints.fingerprint_documents(documents(spark, rows).unionByName(odd)).collect()
    ids = defaultdict(list)
    for r in got:
        ids[r.fingerprint].append(r.doc_id)
    class_of = {f: min((i for i in x if i is not None), default=None) for f, x in ids.items()}
    for r in got:
        assert r.class_id == class_of[r.fingerprint]
        if r.doc_id is None or r.doc_id % 20:
            assert r.found is None
        else:
            near = [f for f in ids if f != r.fingerprint and bin(int(f, 16) ^ int(r.fingerprint, 16)).count("1") <= 3]
            want = [class_of[f] for f in near if class_of[f] is not None] + [class_of[r.fingerprint]] * (len(ids[r.fingerprint]) > 1)
            assert r.found == sorted(want) and r.n_within == len(near)
    found = {r.doc_id: r.found for r in got}
    assert found[60] == [60] and found[100] == [] and found[80]


def test_single_and_no_rows_have_fingerprints(spark, empty):
    one = fingerprints.fingerprint_documents(documents(spark, [(5, "a b c d e f", "en", "a")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest()
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_block_tables_find_all_within_the_radius(spark):
    import random

    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(30)]
    prints = {b for b in base} | {b ^ sum(1 << i for i in draw.sample(range(64), k)) for b in base for k in (1, 2, 3, 4, 5)}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame([(x,) for x in [*signed, signed[0], None]], "fingerprint long")
    got = {(r.query, r.found) for r in fingerprints.within_radius(df, df).collect()}
    assert got == {(a, b) for a in signed for b in signed if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}


# -- quality ----------------------------------------------------------------------------------


def plain_counts(text):
    words = [w.decode() for w in text_words(text)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lined = [x for x in (text or "").split("\n") if text_words(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lined) - len(set(lined)), len(covered))


def test_quality_counts_and_verdicts(spark, odd, empty):
    more = [(100, "a b c d e f a b c d e f g h", "en", "a"), (101, "l1 x\nl1 x\n \nl2", "en", "a"), (102, PROSE.replace(" ", "%%% "), "en", "a"),
            *((200 + i, PROSE + f"item {i}", "en", "a") for i in range(30))]
    docs = odd.unionByName(documents(spark, more))
    got = quality.assess(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        plain = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain
        assert r.base_failed == (plain[0] < 10 or 100 * plain[4] > 20 * plain[0]) and not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in got}
    assert not kept[102] and not kept[9] and not kept[4] and kept[1]
    assert quality.assess(empty).count() == 0


# -- lines ------------------------------------------------------------------------------------


def test_spread_lines_go_and_copies_stay(spark, odd, empty):
    body = [" ".join(f"d{i}k{k}" for k in range(12)) for i in range(14)]
    rows = [(300 + i, f"{body[i]}\n  Click here now \nmore {body[i]}", "en", f"site{i % 12}") for i in range(14)]
    rows += [(50 + i, "copied line one\ncopied line two", "en", f"site{i}") for i in range(12)]
    rows += [(80, "Click here now\nrare words", "en", "site1"), (81, f"rare line\n{body[3]}", "en", "site2")]
    near = [" ".join(f"n{k}w{j}" for j in range(9)) for k in range(8)]  # near copies: each with another line changed
    rows += [(100 + i, "\n".join([*near[:i % 8], near[i % 8] + f" edit{i}", *near[i % 8 + 1:], "Click here now"]), "en", f"site{i}") for i in range(40)]
    docs = documents(spark, rows).unionByName(odd)
    got = {r.doc_id: r for r in lines.remove_spread_lines(docs).collect()}
    assert all(got[300 + i].text == f"{body[i]}\nmore {body[i]}" and got[300 + i].n_removed == 1 for i in range(14))
    assert all(got[50 + i].n_removed == 0 for i in range(12))
    assert got[80].text == "rare words" and got[80].n_removed == 1 and got[81].n_removed == 0
    assert all(got[100 + i].n_removed == 1 and near[(i + 1) % 8] in got[100 + i].text and f"edit{i}" in got[100 + i].text for i in range(40))
    clashing = docs.select("doc_id", "text", "source", F.lit(1).alias("gone"), F.lit(2).alias("h"), F.lit(3).alias("row"), F.lit(4).alias("_t1"))
    odd_names = lines.remove_spread_lines(clashing)
    assert odd_names.columns == [*clashing.columns, "n_lines", "n_removed"]
    assert odd_names.filter("doc_id = 80").first()[:7] == (80, "rare words", "site1", 1, 2, 3, 4)
    assert got[4].text is None and got[4].n_lines == 0 and got[5].text == ""
    assert lines.remove_spread_lines(docs).count() == docs.count() and lines.remove_spread_lines(empty).count() == 0


# -- WARC -------------------------------------------------------------------------------------


def test_bundles_come_back_whole(spark):
    big = "<p>" + "long " * 200_000 + "</p>"
    rows = [(3, "http://a/\r\nx", "<p>one</p>"), (1, None, "<p>one</p>"), (2, "u", None), (5, "u", ""), (7, "v", big), (None, "w", "<p>one</p>"),
            (9, "é", "café"), (9, "é", "café")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_bundles(pages.repartition(3), warc.bundle_folder(spark))
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    payload = {i: (h or "").encode() for i, _, h in rows}
    first = {}
    for i, p in sorted((i, p) for i, p in payload.items() if i is not None):
        first.setdefault(p, i)
    for r in got:
        p = payload[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode())
        if r.page_id is not None and first[p] == r.page_id:
            assert r.record_type == "response" and r.refers_to is None and bytes(r.payload) == p
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", first[p], None)
    one = warc.read_records(index.filter("page_id = 7")).first()
    assert bytes(one.payload) == big.encode()
    assert warc.read_records(warc.write_bundles(pages.limit(0), warc.bundle_folder(spark))).count() == 0


# -- HTML -------------------------------------------------------------------------------------


def test_main_text(spark):
    page = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><a href=x>Menu</a></nav><!-- <p>no</p> -->
<header>Site</header><div class="cookie-banner"><p>We use cookies here.</p></div><article><h1>Title &amp; more</h1><p>One<b>two</b>  three&nbsp;four
five</p><p>Short.</p><div class="ad">Buy this now.</div><p>Last<br>line &lt;b&gt; &copy</p></article><section id="comments"><article><p>A long comment of a
reader that has many words in it and no links at all, as comments do.</p></article></section><footer>Foot</footer>"""
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<article><p>Cut off &amp; open <a hre"), (4, "u", "<article><p>Cut off &amp; open <a hre")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "Title & more\nOnetwo three four five\nShort.\nLast line <b> ©"
    assert got[1].n_chars == len(got[1].text) and got[2].text == got[3].text == "" and got[4].text == "Cut off & open"


def test_tree_learns_its_table(spark):
    tree = html.trained_tree(spark)
    for page, article in html.LABELLED_PAGES:
        assert {x for x in html.main_text(page, tree).split("\n") if x} == article


def test_empty_and_nested_drawings():
    def texts(page):
        return [b[0] for b in html.blocks(page)]

    assert texts("<p>one <svg class='x'/>two</p><p>three <math/>four</p>") == ["one two", "three four"]
    assert texts("<p>a<svg><svg><text>no</text></svg><text>no</text><svg viewBox='0 > 1'/></svg>b</p><p>c</p>") == ["ab", "c"]
    assert texts("<p>a<SVG><svg><text>no</text></svg>b</p>") == ["ab"] and texts("<p>a</p><svg><p>no") == ["a"]


def test_classes_of_blog_engines(spark):
    text = "The well was dug by hand in a single dry summer and has never failed since.\nIt is deep."
    body = "".join(f"<p>{t}</p>" for t in text.split("\n"))
    inside = ["<article class='post category-legal'>{}</article>", "<article class='post hentry tag-social-media'>{}</article>",
              "<article class='post tag-search-engines'>{}</article>", "<main class='no-sidebar'>{}</main>", "<div class='content with-sidebar'>{}</div>",
              "<article class='post comments-open'>{}</article>", "<article class='legal'><div class='entry-content'>{}</div></article>",
              "<div class='has-comments'><div class='post-content'>{}</div></div>", "<form class='search'><div class='entry-content'>{}</div></form>"]
    aside = ["<article class='comment-body'>{}</article>", "<article class='post related-post'>{}</article>", "<article class='ad'>{}</article>",
             "<div class='content-ad'>{}</div>", "<div style='display:none'><div class='entry-content'>{}</div></div>",
             "<div class='sidebar'><div class='content'>{}</div></div>", "<aside><div class='entry-content'>{}</div></aside>"]
    tree = html.trained_tree(spark)
    page = "<body><nav><a href=/>Home</a></nav>{}<footer>Foot</footer></body>"
    assert [x for x in inside if html.main_text(page.format(x.format(body)), tree) != text] == []
    assert [x for x in aside if html.main_text(page.format(x.format(body)), tree) != ""] == []


def test_anchors_headings_and_inline_hints_stay(spark):
    tree = html.trained_tree(spark)
    long = "The well was dug by hand in a single dry summer and has never failed since."
    page = "<body><nav><a href=/>Home</a></nav>{}<footer>Foot</footer></body>"
    cases = [(f"<{outer}><h1 class='header'>Wells</h1><{t} id='{i}'><h2>{h}</h2><p>{long}</p><p>It is deep.</p></{t}></{outer}>", f"Wells\n{h}\n{long}\nIt is deep.")
             for outer in ("article", "main") for t in ("section", "div")
             for i, h in (("related-work", "Related work"), ("login", "Login"), ("search-algorithms", "Search algorithms"), ("menu", "Menu"))]
    cases += [
        ("<article><p>The word <span class='notice'>beware</span> stood over the <b class='ad'>gate <b>of</b></b> iron.</p></article>",
         "The word beware stood over the gate of iron."),
        (f"<article><p>{long}</p><span class='ad'>Buy lamps <span>now</span> or never</span><p>It is <i hidden>not</i> deep.</p></article>", f"{long}\nIt is deep."),
        (f"<div class='recommended-reading'><article><p>{long}</p></article></div>", long),
        (f"<article><p>{long}</p></article><div class='related'><article><p>{long} Or so.</p></article></div>", long),
        (f"<article><p>{long}</p><div id='comments'><h2>Comments</h2><p>{long}</p></div><div id='newsletter'><p>{long}</p></div></article>", long),
        (f"<section id='search-algorithms'><h2>Search algorithms</h2><p>{long}</p><p>It is deep.</p></section>", f"Search algorithms\n{long}\nIt is deep."),
    ]
    assert [x for x, want in cases if html.main_text(page.format(x), tree) != want] == []


def test_neighbours_decide_without_places(spark):
    tree = html.trained_tree(spark)
    used = set()

    def walk(node):
        if len(node) > 1:
            used.add(html.FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(tree)
    assert used & {"words_before", "links_before", "words_after", "links_after"}
    long = "The well was dug by hand in a single dry summer and has never failed since, whatever the almanac said of it."
    page = f"<body><p><a href=/>Home</a> <a href=/w>Wells</a></p><p>{long}</p><p>It is deep.</p><p>{long}</p><p>Nobody fell in.</p><p><a href=/n>Next</a></p></body>"
    assert html.main_text(page, tree) == f"{long}\nIt is deep.\n{long}\nNobody fell in."


def test_deep_and_broken_pages_take_linear_time():
    import time

    n = 200_000
    for page in ("<div>x" * n, "<div>x" * n + "</p>" * n, "<div><head><body>x" * (n // 4), "<svg><svg></svg>x" * (n // 4), "<span class=ad>x" * n + "<p>y" * n,
                 "<textarea>" + "</textarea" * n, "<li><p>x" * n, "<b><i>x</b>" * n):
        start = time.monotonic()
        html.blocks(page)
        assert time.monotonic() - start < 20, page[:30]


# -- packing ----------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 6))
def test_best_fit_fills_bins_without_gaps(lengths, open_bins):
    placed, filled = packing.best_fit(lengths, 20, open_bins), Counter()
    for n, (b, at) in zip(lengths, placed, strict=True):
        assert at == filled[b]
        filled[b] += n
    assert all(v <= 20 for v in filled.values()) and (not lengths or sorted(filled) == list(range(len(filled))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 9))
def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest(lengths, open_bins):
    free = []  # of the open bins
    for n, (_, offset) in zip(lengths, packing.best_fit(lengths, 64, open_bins), strict=True):
        fitting = sorted(x for x in free if x >= n)
        if fitting:
            assert 64 - offset == fitting[0]
            free.remove(fitting[0])
        else:
            assert offset == 0
            if len(free) >= open_bins and n < 64:
                free.remove(min(free))
        if 64 - offset > n:
            free.append(64 - offset - n)
        assert len(free) <= open_bins


def test_internal_names_may_be_the_inputs(spark):
    pieces = spark.createDataFrame([(1, 2, 3, 5), (2, 2, 3, 6)], "_key long, _group long, given_key long, length long")
    got = packing.pack(pieces)
    assert got.columns == ["_key", "_group", "given_key", "length", "sequence_id", "offset"]
    assert sorted((r["_key"], r.offset + r.length <= 2048) for r in got.collect()) == [(1, True), (2, True)]


def test_packed_ids_are_the_tokenizers(spark, odd, empty):
    from tokenizers import Tokenizer

    path = queries.word_tokenizer()
    plain = Tokenizer.from_file(path)
    got = packing.packed_documents(odd, path).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for doc_id, text in texts.items():
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        for r in pieces[doc_id]:
            part = ids[r.start : r.start + r.length]
            assert r.start == 2048 * r.piece and r.length == min(2048, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed_documents(empty, path).count() == 0


# -- mixing -----------------------------------------------------------------------------------


def test_targets_and_taken_words(spark, odd, empty):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 11) % 5).alias("source"), (F.col("id") % 90).alias("size"))
    plan = mixing.curriculum_plan(rows)
    got = mixing.assign_positions(rows, plan).collect()
    sizes, targets, taken = Counter(), {}, Counter()
    for r in got:
        sizes[r.source] += r["size"]
        targets[r.source] = r.target
        taken[r.source] += r["size"] * r.repeats
        assert r.repeats == len(r.positions) <= 3 and r.positions == sorted(r.positions) and all(0 <= p <= 1 for p in r.positions)
    names, left, want = sorted(sizes), set(sizes), {}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    while True:
        rest = sum(sizes.values()) - sum(want.values())
        level = rest / sum(weight[s] for s in left)
        capped = {s for s in left if weight[s] * level > 3 * sizes[s]}
        if not capped:
            break
        want |= {s: 3 * sizes[s] for s in capped}
        left -= capped
    want |= {s: weight[s] * level for s in left}
    for s in names:
        assert targets[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 90
    again = mixing.assign_positions(rows.repartition(3), mixing.curriculum_plan(rows.repartition(3))).collect()
    assert sorted((r.doc_id, r.repeats, r.positions) for r in got) == sorted((r.doc_id, r.repeats, r.positions) for r in again)


def test_positions_against_plain_integration(spark):
    rows = spark.createDataFrame([("ab"[i % 3 == 0] if i % 7 else None, i % 13, i, i) for i in range(200)], "source string, size long, _rows long, _total long")
    plan = mixing.curriculum_plan(rows)
    plans = {r.source: r for r in plan.collect()}
    keyed = rows.select("*", common.tie_breaker(rows, rows.columns, 23).alias("k")).collect()
    got = {r["_rows"]: r for r in mixing.assign_positions(rows, plan).collect()}
    assert got.keys() == set(range(200)) and set(next(iter(got.values())).asDict()) >= {"_rows", "_total"}

    def demand(spans, t):
        """The part of the whole weight that lies before t."""
        def area(s, to):
            to = min(max(to, s.t0), s.t1)
            w = s.w0 + (s.w1 - s.w0) * (to - s.t0) / (s.t1 - s.t0)
            return (s.w0 + w) / 2 * (to - s.t0)
        return sum(area(s, t) for s in spans) / sum(area(s, s.t1) for s in spans)

    for source, plan_row in plans.items():
        own = sorted((r for r in keyed if r.source == source), key=lambda r: r.k)
        total, before = sum(r["size"] for r in own), 0
        for r in own:
            middles = [m for m in (e * total + before + r["size"] / 2 for e in range(3)) if m < plan_row.target]
            out = got[r["_rows"]]
            assert (out.source_size, out.target, out.repeats) == (total, plan_row.target, len(middles))
            assert [demand(plan_row.schedule, t) for t in out.positions] == [pytest.approx(m / plan_row.target, abs=1e-9) for m in middles]
            before += r["size"]


def test_mixing_odd_rows(odd, empty):
    sized = odd.withColumn("size", F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("long"))
    got = mixing.assign_positions(sized, mixing.curriculum_plan(sized))
    assert got.count() == odd.count() and got.filter("target > 3 * source_size").count() == 0
    none = empty.withColumn("size", F.lit(0).cast("long"))
    assert mixing.assign_positions(none, mixing.curriculum_plan(none)).count() == 0
    zero = sized.withColumn("size", F.lit(0).cast("long"))
    assert mixing.assign_positions(zero, mixing.curriculum_plan(zero)).count() == odd.count()


# -- near-duplicates --------------------------------------------------------------------------


def plain_sets(text):
    words = [w.lower() for w in text_words(text)]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows, percent):
    sets = {i: plain_sets(t) for i, t in rows}
    name = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            name[a] = name[b] = min(name[a], name[b])
    return name


def test_near_duplicates_against_all_pairs(spark, odd, empty):
    words = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(w if (j * 7 + i) % 60 else f"e{i}" for j, w in enumerate(words)).upper() if i % 2 else
             " ".join(w if (j * 5 + i) % 41 else f"f{i}" for j, w in enumerate(words))) for i in range(60)]
    rows += [(100 + i, "a few words") for i in range(3)] + [(110, ""), (111, None), (112, None), (120, "A FEW  words")]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    for percent in (80, 85):
        got = {r.doc_id: r for r in minhash.near_duplicates(docs, percent=percent).collect()}
        assert {i: r.component_id for i, r in got.items()} == plain_components(rows, percent)
        assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(plain_sets(dict(rows)[i])) for i, r in got.items())
    assert minhash.near_duplicates(odd).count() == odd.count() and minhash.near_duplicates(empty).count() == 0


def test_blocks_of_a_group_lose_no_link(spark, monkeypatch):
    rows = [(i, list(range(i * 3, i * 3 + 60))) for i in range(40)]
    members = spark.createDataFrame([(i, 0, 60, x) for i, x in rows], "node long, component long, n_shingles long, numbers array<long>")
    whole = components.components(minhash.confirmed_links(members)).collect()
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    assert sorted(map(tuple, components.components(minhash.confirmed_links(members)).collect())) == sorted(map(tuple, whole))
    assert {r.component for r in whole} == {0} and len(whole) == 39


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 200)]
    got = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 9)}


# -- pipeline ---------------------------------------------------------------------------------


def test_pipeline_stages(spark, odd, empty, tmp_path):
    prose = [" ".join(f"{w}{i}" if j % 4 == 0 else w for j, w in enumerate(PROSE.split())) for i in range(30)]
    rows = [(1000 + i, f"{prose[i]}\nPlease share this page", "en", f"s{i % 12}") for i in range(30)]
    rows += [(2000, f"{prose[0]}\nPlease share this page", "en", "s0")]
    docs = documents(spark, rows).unionByName(odd)
    for name, table in (("odd", docs), ("empty", empty)):
        now = table
        for k, (stage_name, step) in enumerate(corpus_pipeline.STAGES):
            step(spark, now, "").write.parquet(str(tmp_path / f"{name}{k}"))
            now = spark.read.parquet(str(tmp_path / f"{name}{k}"))
            if k < 4:
                assert set(now.columns) == {"doc_id", "text", "lang", "source", "n_chars"}, stage_name
            if name == "odd" and k == 0:
                verdict = quality.assess(docs)
                assert now.count() == verdict.filter("kept").count()
            if name == "odd" and k == 1:
                assert now.filter("text like '%Please share%'").count() == 0
            if name == "odd" and k == 2:
                ids = [r.doc_id for r in now.collect()]
                assert 2000 not in ids and len(ids) == len(set(ids))
        assert (now.count() > 0) == (name == "odd")


def test_near_duplicates_of_null_and_repeated_ids(spark):
    text = [" ".join(f"u{k}w{i}" for i in range(40)) for k in range(6)]
    near = text[0].rsplit(" ", 1)[0] + " changed"
    rows = [(None, text[0], "en", "a"), (None, text[1], "en", "a"), (None, text[1], "en", "b"), (7, text[2], "en", "a"), (7, text[3], "en", "b"),
            (7, near, "en", "c"), (8, text[4], "en", "a"), (8, text[4], "en", "a"), (9, text[5], "en", "a"), (2, text[2], "en", "d"),
            (None, None, "en", "a"), (None, None, "en", "a"), (5, " ", "en", "a"), (5, " ", "en", "a")]
    got = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([
        (None, text[1]), (2, text[2]), (7, text[3]), (7, near), (8, text[4]), (9, text[5]), (None, None), (None, None), (5, " "), (5, " ")])
