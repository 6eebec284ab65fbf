"""The toxicity lexicon, its automata and scores against plain versions and on planted texts."""

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.llm import toxicity
from postlark.llm.toxicity import Lexicon, Term

FILLER = [a + b for a in ("bal", "dor", "fen", "gim", "hul", "kas", "lom", "nir", "pov", "rut") for b in ("", "a", "em", "ist", "on", "ux")]
INSULTS = ["zarquod", "blithermug", "snotface"]


def prose(rng, n=60, insults=()):
    words = [rng.choice(FILLER) for _ in range(n)]
    for word in insults:
        words.insert(rng.randrange(len(words)), word)
    return " ".join(words)


def corpus():
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        docs.append((i, prose(rng, insults=rng.choices(INSULTS, k=2) if toxic else ())))
        labels.append((i, int(toxic)))
    return docs, labels


def tables(spark, docs, labels):
    return (spark.createDataFrame([(i, t, 9.0, "x") for i, t in docs], "doc_id long, text string, score double, term string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(*tables(spark, *corpus()))


def edits(a, b):
    """Least insertions, deletions, substitutions and swaps of neighbours, no place being touched twice."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


LETTERS = st.text("abc", min_size=1, max_size=11)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(LETTERS, st.booleans()), min_size=1, max_size=6, unique=True), st.lists(LETTERS, min_size=1, max_size=8))
def test_automata_find_what_edit_distances_say(keys, words):
    lexicon = Lexicon([Term(text, whole, 3.0 + i) for i, (text, whole) in enumerate(keys)], every=True)
    for word in words:
        begun = [t for t in lexicon.terms if t.text == word or (not t.whole and word.startswith(t.text))]
        near = []
        for i, t in enumerate(lexicon.terms):
            least = min(edits(t.text, w) for w in ([word] if t.whole else [word[:k] for k in range(1, len(word) + 1)]))
            if least <= t.edits:
                near.append((least, -t.weight, i))
        if begun:
            term, spent = lexicon.find(word)
            longest = max(len(t.text) for t in begun)
            assert spent == 0 and lexicon.terms[term] in begun and len(lexicon.terms[term].text) == longest
        elif near:
            assert lexicon.find(word) == (min(near)[2], min(near)[0])
        else:
            assert lexicon.find(word) is None


def test_forgetting_changes_nothing(monkeypatch):
    terms = [Term(w, True, 4.0) for w in INSULTS] + [Term("bom", False, 3.0)]
    words = ["zarqod", "blihtermug", "snotfaces", "bomber", "none", "snotafce", "bonber"] * 2
    expected = [Lexicon(terms, every=True).find(w) for w in words]
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    lexicon = Lexicon(terms, every=True)
    assert [lexicon.find(w) for w in words] == expected and expected[0] == (0, 1) and expected[4] is None
    assert lexicon.find("zarqod") and not Lexicon(terms).find("zarqod") and Lexicon(terms).find("zarquod") == (0, 0)  # weighs nothing


def test_the_learned_terms_and_scores(spark, model):
    assert {t.text for t in model.terms if t.weight >= toxicity.TERM_ODDS} == set(INSULTS)
    rng = random.Random(8)
    clean = prose(rng)
    long = clean + " " + prose(rng, 30_000)
    texts = {
        1: prose(rng, insults=INSULTS), 2: clean, 3: prose(rng, insults=["zarqoud", "blithrmug", "sn*tface"]), 4: None, 5: "",
        6: f'{clean}. He said "you are a zarquod and a snotface"', 7: f"{long} zarquod {clean} snotface blithermug", 8: "ZARQUOD, you Snotface!",
    }
    docs, _ = tables(spark, texts.items(), [(1, 1)])
    got = {r.doc_id: r for r in toxicity.score(docs.unionByName(docs.filter("doc_id = 1")), model, keep=["doc_id", "score", "term"]).collect()}
    assert set(got) == set(texts) and got[1].asDict().keys() == {"doc_id", "term", "score", "predicted", "hits"}
    assert [got[i].predicted for i in (1, 2, 3, 4, 5, 6, 8)] == [1, 0, 1, 0, 0, 0, 1]
    assert got[7].score > got[6].score < got[8].score and got[4].score == got[5].score and len(got[7].hits) == 3
    assert [(h.word, h.edits) for h in got[3].hits if h.word == "sn*tface"] == [("sn*tface", 1)]
    assert all(h.quoted for h in got[6].hits) and not any(h.quoted for h in got[1].hits)
    assert texts[1].lower()[got[1].hits[0].start:].startswith(got[1].hits[0].word)


def test_nothing_is_learned_from_rows_held_out(spark):
    docs, labels = corpus()
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, other = (toxicity.fit(*tables(spark, docs, y), learn=~held) for y in (labels, flipped))
    assert one == other
    found = {r.doc_id: r.predicted for r in toxicity.score(tables(spark, docs, labels)[0], one).collect()}
    wrong = [i for i, y in labels if found[i] != y]
    assert len(wrong) <= 6


def test_copies_of_a_toxic_text_teach_no_words(spark):
    docs, labels = corpus()
    rng = random.Random(4)
    copied = "gribble " + prose(rng, insults=["zarquod"]) + " quastic"
    more = [(1000 + i, copied if i % 2 else copied.replace("bal", "balem", 1)) for i in range(150)]
    found = toxicity.fit(*tables(spark, docs + more, labels + [(i, 1) for i, _ in more]))
    assert not {"gribble", "quastic"} & {t.text for t in found.terms if t.weight >= toxicity.TERM_ODDS}


def test_odd_labels_and_no_rows(spark):
    docs, labels = tables(spark, [(1, None), (1, "a b"), (None, "x"), (2, ""), (3, "w " * 20_000)], [(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (9, 1)])
    model = toxicity.fit(docs, labels)
    assert model.terms == [] and toxicity.score(docs, model).count() == 5
    empty = toxicity.fit(docs.limit(0), labels.limit(0))
    assert empty.terms == [] and toxicity.score(docs, empty).filter("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("line,expected", [
    ('he "is a zarquod" ok', True), ("he is a zarquod ok", False), ("„du zarquod“ nein", True), ("«a» zarquod «b»", False),
    ("“zarquod”", True), ('"a" zarquod "b"', False)])
def test_quotation_marks(line, expected):
    start = line.index("zarquod")
    assert toxicity._quoted(line, start, start + 7) is expected
