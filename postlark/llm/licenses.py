"""License scans: notices by sparse TF-IDF cosine to templates, and inheritance from the nearest directory above."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.functions.text import term_counts
from postlark.session import stage

BARE = "All rights reserved."  # names no terms, so it counts only in a file without any other notice
# What all BSD licences begin with; which one it is follows from the clauses of the file.
SHARED = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
# Notices by which licences are named, one row for each wording, each sentence that names one apart.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Licensed under the MIT License. See the LICENSE file in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License 2.0"),
    ("Apache-2.0", "Apache License, Version 2.0, January 2004"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License, version 3, 29 June 2007"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "GNU General Public License, version 2, June 1991"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3, 29 June 2007"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                 "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "GNU Affero General Public License, version 3, 19 November 2007"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1, February 1999"),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public "
                 "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "GNU Library General Public License, version 2, June 1991"),
    ("GPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-1.0", "Licensed under the GNU General Public License, version 1."),
    ("GPL-1.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation; either version 1, or (at your option) any later version."),
    ("GPL-1.0", "GNU General Public License, version 1, February 1989"),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."),
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except "
                "in compliance with the License."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", SHARED),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-4-Clause", "Released under the BSD 4-Clause License."),
    ("BSD-4-Clause", "BSD 4-Clause License"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "ISC License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    *((f"CC-{kind}-{version}", f"{words} {version}") for version in ("4.0", "3.0") for kind, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
      for words in (f"Licensed under the Creative Commons {name} License", f"Licensed under a Creative Commons {name}")),
    *((f"CC-{kind}-3.0", f"Licensed under CC {kind} 3.0.") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced without written permission."),
    ("Proprietary", "No part of this work may be reproduced without written permission."),
    ("Proprietary", BARE),
)
# Fixed value: words of which a notice has at least one.
ANCHORS = "licen[sc]|copyright|permission|permitted|redistribut|public domain|all rights reserved|free software|waived|spdx|unencumbered"
# A notice of a licence with such a term must hold the term, or another form of it: versions, clauses and variants tell licences
# apart, and weigh little in a cosine.
TELLING = re.compile(r"\d+(?:\.\d+)+|\d-clause|by(?:-[a-z]+)*|attribution(?:-[a-z]+)*|cc0|lesser|library|affero|apache|mozilla|mit|isc|provided")
AFTER_VERSION = re.compile(r"\b(?:version|v\.?)\s+(\d+)(?!\.?\d)", re.I)
# Words that make another licence of one whose template holds the first but not the second.
OTHERWISE = (("general", "lesser"), ("general", "affero"))
ADVERTISING, ENDORSING, BINARY = "all\\W+advertising\\W+materials", "to\\W+endorse\\W+or\\W+promote", "redistributions\\W+in\\W+binary\\W+form"
LICENSE_FILES = "(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"
THRESHOLD = 0.6
WHOLE_TERMS = 3  # a template of no more terms than these counts only where all of them stand
SENTENCE_BREAK = "(?<=[.;!?:])\\s+(?=\\p{Lu}|\\W)"
PASSAGE_BREAK = f"\\n|{SENTENCE_BREAK}"
RUN_BREAK = "\\n(?:[^\\p{L}\\p{N}\\n]*\\n)+"  # lines without a letter or digit, comment marks among them
LINE_START = "\\n[^\\p{L}\\p{N}\\n(\"']*(?:(?i:rem|dnl)\\b[ \\t]*)?"
SPDX_NAME = "\\(*[A-Z0-9][A-Z0-9.+:-]*\\)*"
SPDX = f"(?i)\\bSPDX-License-Identifier:[ \\t]*({SPDX_NAME}(?:[ \\t]+(?:AND|OR|WITH)[ \\t]+{SPDX_NAME})*)"
SPDX_PARTS = "(?<=[ ()])|(?=[ ()])"
SPDX_FORM = "(?i)(-only|-or-later|\\+)$"
TERM = "[\\p{L}\\p{N}]+(?:[.-][\\p{L}\\p{N}]+)*"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _counted(passages: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """The term frequencies of each passage. Rows that repeat hold the same passage, whose terms count once."""
    rows = passages.select(*keys, F.explode(term_counts(_terms(F.col(text)))).alias("_t")).select(*keys, "_t.term", "_t.tf")
    return rows.groupBy(*keys, "term").agg(F.max("tf").alias("tf"))


def _forms(term: str) -> set[str]:
    """A version as notices write it: with or without a zero at its end and a v before it."""
    if not term[0].isdigit() or "clause" in term:
        return {term}
    short = term.removesuffix(".0")
    plain = {short, f"{short}.0"} if "." not in short else {short}
    return plain | {f"v{x}" for x in plain}


def _rules(wording: str) -> list[tuple[str, int, bool]]:
    """What a passage must hold to match a template, as (term, need, barred): of each need one form at least, of the barred
    terms none."""
    terms = re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", wording.lower())
    telling = sorted({x for x in terms if TELLING.fullmatch(x)} | {m[1] for m in AFTER_VERSION.finditer(wording)})
    needs = [(form, 1 << n, False) for n, x in enumerate(telling) for form in sorted(_forms(x))]
    return needs + [(other, 0, True) for holds, other in OTHERWISE if holds in terms and other not in terms]


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(i, *x) for i, x in enumerate(templates)], "template int, license string, wording string")


def _anchored(text: Column) -> Column:
    return text.rlike(f"(?i){ANCHORS}")


def _passages(files: DataFrame) -> DataFrame:
    """``file``, ``part``, ``passage`` and ``words`` of all that is compared: from each run of adjacent lines with an anchor,
    its lines, the sentences in them, the sentences of the run with its line ends and comment marks undone, each two of these
    that stand together, and the run as a whole; a licence file (by its name) also as a whole."""
    whole = F.coalesce("text", F.lit(""))
    runs = files.select("file", F.posexplode(F.filter(F.split(whole, RUN_BREAK), _anchored)).alias("part", "run"))
    hyphened = F.regexp_replace("run", "(?<=[\\p{L}\\p{N}])-\\n[^\\p{L}\\p{N}\\n]*", "-")
    undone = runs.select("file", "part", "run", F.explode(F.array(F.regexp_replace(hyphened, LINE_START, " "))).alias("flat"))
    sentences = F.split("flat", SENTENCE_BREAK)
    pairs = F.zip_with(sentences, F.slice(sentences, 2, F.size(sentences)), lambda x, y: F.when(_anchored(x) & _anchored(y), F.concat_ws(" ", x, y)))
    every = F.concat(F.split("run", PASSAGE_BREAK), F.split("run", "\n"), sentences, pairs, F.array("flat"))
    found = undone.select("file", "part", F.posexplode(F.array_distinct(F.filter(every, _anchored))).alias("passage", "words"))
    is_license = F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENSE_FILES)
    return found.unionByName(files.filter(is_license & _anchored(whole)).select("file", F.lit(-1).alias("part"), F.lit(0).alias("passage"), whole.alias("words")))


def tagged(files: DataFrame, templates: DataFrame) -> DataFrame:
    """For each file with an SPDX tag the licence that it names first: by the templates' name where they have it, with or
    without its -only or -or-later, else as written. An expression stays one, with each of its names so written."""
    known = {r["license"].lower(): r["license"] for r in templates.select("license").distinct().collect()}
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.create_map().cast("map<string,string>")
    found = F.trim(F.regexp_replace(F.regexp_extract(F.coalesce("text", F.lit("")), SPDX, 1), "[ \\t]+", " "))
    uneven = F.length(F.translate(found, "(", "")) != F.length(F.translate(found, ")", ""))
    tag = F.when(uneven | ~found.contains(" "), F.translate(found, "()", "")).otherwise(found)

    def named(part: Column) -> Column:
        plain = F.lower(F.regexp_replace(part, SPDX_FORM, ""))
        return F.coalesce(F.try_element_at(names, plain), F.when(F.upper(part).isin("AND", "OR", "WITH"), F.upper(part)).otherwise(part))

    return files.select("file", tag.alias("_tag")).filter(~F.upper("_tag").isin("", "NONE", "NOASSERTION")).select(
        "file", F.concat_ws("", F.transform(F.split("_tag", SPDX_PARTS), named)).alias("license"))


def bsd_clauses(files: DataFrame) -> DataFrame:
    """For each file with the second clause of a BSD licence the one of them that its clauses make."""
    has = lambda clause: F.col("text").rlike(f"(?i){clause}")
    kind = F.when(has(ADVERTISING), "BSD-4-Clause").when(has(ENDORSING), "BSD-3-Clause").otherwise("BSD-2-Clause")
    return files.filter(has(BINARY)).select("file", kind.alias("kind")).groupBy("file").agg(F.first("kind").alias("_clauses"))


def scan_notices(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """For each file (``file``, ``path``, ``text``) with a notice its ``license`` and ``score``, the best cosine.

    An SPDX tag says it outright, with score 1. Else passages are the lines, the sentences, wrapped ones among them, the
    pairs of sentences and the runs of adjacent lines; those with an anchor word are compared with
    every template, and a licence file (by its name) also as a whole. Terms weigh 1 + log tf times an inverse document
    frequency over all files; a term that no template has counts in the norms with the weight of one that no file has. The
    product runs over shared terms only: passages meet templates by a join on the term. A passage whose best cosine is
    below the threshold has no licence; of equal ones the first template wins, and one that names a licence wins over the
    beginning that BSD licences share. A template of three terms or fewer needs them all, any template needs its version,
    clause count or variant (``TELLING``) in some form, so a version that no template has gets no name, and a bare "All rights
    reserved." gives way to any other notice of the file. Where the shared beginning wins, the file's clauses say which BSD
    licence it is; without any clause it is the one with three, the stricter. Rows that repeat a file count once.
    """
    vocabulary = [r["term"] for r in templates.select(F.explode(_terms(F.col("wording"))).alias("term")).distinct().orderBy("term").collect()]
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), "[^\\p{L}\\p{N}.-]+")
    bare = F.transform(words, lambda x: F.trim(x, F.lit(".-")))
    met = F.array_distinct(F.filter(bare, lambda x: x.isin(*vocabulary)))
    frequencies = stage(files.select(F.explode(met).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term_files")
    total = files.count()
    rare = math.log((1 + total) / 1) + 1
    weight = lambda: (1 + F.log("tf")) * F.coalesce("idf", F.lit(rare))
    idf = frequencies.select("term", (F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1).alias("idf"))  # a row for each template term

    keys = ["file", "part", "passage"]
    weighed = stage(
        _counted(_passages(files), keys, "words").join(F.broadcast(idf), "term", "left").select(*keys, "term", weight().alias("w")),
        "notice_terms")
    rules = files.sparkSession.createDataFrame(
        [(r["template"], *rule) for r in templates.select("template", "wording").collect() for rule in _rules(r["wording"])],
        "template int, term string, need long, barred boolean")
    about = templates.select("template", "license", (F.col("wording") != BARE).alias("strong"), (F.col("wording") != SHARED).alias("names"),
                             (F.col("wording") == SHARED).alias("shared"))
    weights = _counted(templates, ["template"], "wording").join(F.broadcast(idf), "term", "left").select("template", "term", weight().alias("v"))
    sizes = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("size"), F.count(F.lit(1)).alias("terms"))
    all_needs = rules.groupBy("template").agg(F.bit_or("need").alias("needs"))
    model = weights.join(rules, ["template", "term"], "full").join(about, "template").join(sizes, "template").join(all_needs, "template", "left").select(
        "template", "license", "strong", "names", "shared", "term", "v", "size", "terms", F.coalesce("need", F.lit(0)).alias("need"),
        F.coalesce("barred", F.lit(False)).alias("barred"), F.coalesce("needs", F.lit(0)).alias("needs"))
    norms = weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    kinds = ["template", "license", "strong", "names", "shared"]
    products = weighed.join(F.broadcast(model), "term").groupBy(*keys, *kinds).agg(  # as many rows as the templates have terms
        (F.sum(F.col("w") * F.col("v")) / F.first("size")).alias("dot"),
        ((F.first("terms") > WHOLE_TERMS) | (F.count("v") == F.first("terms"))).alias("whole"),
        ((F.bit_or("need") == F.first("needs")) & ~F.bool_or("barred")).alias("fits"))
    scored = products.filter("whole and fits").join(norms, keys).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("score") >= threshold)
    best = scored.groupBy("file").agg(F.max(F.struct("strong", "score", "names", (-F.col("template")).alias("first"), "license", "shared")).alias("best"))
    tags = tagged(files, templates).groupBy("file").agg(F.first("license").alias("_tag"))
    by_clauses = F.when(F.col("best.shared"), F.col("_clauses"))
    return best.join(bsd_clauses(files), "file", "left").join(tags, "file", "full").select(
        "file", F.coalesce("_tag", by_clauses, "best.license").alias("license"),
        F.when(F.col("_tag").isNotNull(), 1.0).otherwise(F.col("best.score")).alias("score"))


def directory_of(path: Column) -> Column:
    """The path up to its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each of the ``directories`` the nearest directory, itself or above, that has a licence file, by joining the
    ancestors of each with ``licensed`` (``directory``, ``license``, a row for each directory). Directories without such are
    left out. The top, which all have above them, is one row and is looked up apart."""
    top = licensed.filter("directory = ''").head()
    parts = F.split("directory", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = directories.select("directory", F.explode(depths).alias("depth")).select(
        "directory", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("above")).filter("above != ''").distinct()
    given = licensed.select(F.col("directory").alias("above"), "license")
    near = above.join(given, "above").groupBy("directory").agg(F.max(F.struct("depth", "license", "above")).alias("near")).select(
        "directory", F.col("near.license").alias("license"), F.col("near.above").alias("from_directory"))
    if top is None:
        return near
    return directories.distinct().join(near, "directory", "left").select(
        "directory", F.coalesce("license", F.lit(top["license"])).alias("license"),
        F.when(F.col("license").isNotNull(), F.col("from_directory")).otherwise("").alias("from_directory"))


def scan_files(files: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """For each file ``path``, ``license``, ``score``, ``found`` (``file``: a notice of its own; ``directory``: from the nearest
    licence file in its directory or above; ``none``) and ``from_directory``, with the columns of ``files`` but its text.

    ``files`` has ``path`` and ``text``. Null text is empty; a null path is the top directory's and inherits like any file
    there. Files that repeat each get the result of one. Texts of any length are read whole. Of several licence files in a directory the best score counts,
    then the licence's name. No rows give no rows. Columns called like the results are replaced; any other name may be used.
    """
    templates = template_table(files.sparkSession) if templates is None else templates
    results = {"license", "score", "found", "from_directory", "text"}
    keep = [c for c in files.columns if c.lower() not in results | {"path"}]
    held = F.struct(*[F.col(c) for c in keep]).alias("_held") if keep else F.lit(None).cast("int").alias("_held")
    place = F.coalesce("path", F.lit(""))
    keyed = files.select(held, F.col("path").alias("_path"), place.alias("path"), "text",
                         F.unhex(F.md5(F.concat(F.sha1(place.cast("binary")), F.coalesce("text", F.lit(""))).cast("binary"))).alias("file"))
    notices = stage(scan_notices(keyed.select("file", "path", "text"), templates, threshold), "notices")
    marked = stage(keyed.drop("text").join(notices, "file", "left").withColumn("directory", directory_of(F.col("path"))), "files")
    named = F.regexp_extract("path", "([^/]*)$", 1).rlike(LICENSE_FILES)
    licensed = marked.filter(named & F.col("license").isNotNull()).groupBy("directory").agg(
        F.max(F.struct("score", "license")).alias("best")).select("directory", "best.license")
    near = inherited(marked.select("directory").distinct(), licensed)
    from_above = marked.select("_held", "_path", "directory", F.col("license").alias("own"), "score").join(
        near.withColumnRenamed("license", "above"), "directory", "left")
    has = F.col("own").isNotNull()
    order = [c for c in files.columns if c.lower() not in results]
    return from_above.select(
        *[F.col("_path").alias(c) if c.lower() == "path" else F.col("_held").getField(c).alias(c) for c in order],
        F.coalesce("own", "above").alias("license"), F.when(has, F.col("score")).alias("score"),
        F.when(has, "file").when(F.col("above").isNotNull(), "directory").otherwise("none").alias("found"),
        F.when(~has, F.col("from_directory")).alias("from_directory"))
