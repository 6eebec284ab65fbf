import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.functions import contacts, keyvalues, links, text, times
from postlark.functions.stemming import stem, stem_all
from postlark.operators.aggregators import from_aggregator


def values(spark, inputs, column):
    """The column over ``t`` for each input, in order."""
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, t string")
    return [r.x for r in df.select("i", column.alias("x")).orderBy("i").collect()]


@pytest.fixture(scope="module", autouse=True)
def _column(spark):
    global T
    T = F.col("t")


NOISY = "RT @ann: We're  hiring! #Java jobs http://t.co/Ab1 https://t.co/Zz "


def test_clean_and_tokens(spark):
    assert values(spark, [NOISY, "a.b#c-d_e@"], text.clean(T)) == [
        "RT ann Were  hiring #Java jobs  httpstcoZz ",
        "ab#cde",
    ]
    expected = ["RT", "ann", "Were", "", "hiring", "#Java", "jobs", "", "httpstcoZz"]
    assert values(spark, [NOISY], text.tokens(text.clean(T))) == [expected]


def test_tokens_at_the_edges(spark):
    got = values(spark, ["", "  \n", " a", "a\t\tb \x0b", None], text.tokens(T))
    assert got == [[""], [], ["", "a"], ["a", "", "b"], None]
    assert values(spark, ["", "  ", " a  b "], text.words(T)) == [[""], [], ["", "a", "", "b"]]


def test_term_counts(spark):
    counted = values(spark, ["b a b  c b", "", " "], text.term_counts(text.tokens(T)))
    assert [{c.term: c.tf for c in row} for row in counted] == [
        {"b": 3, "a": 1, "c": 1, "": 1}, {"": 1}, {},
    ]


def test_length_counts_utf16_units(spark):
    cases = ["a" * 80, "a" * 81, "a" * 79 + "😀", "😀" * 40, "😀" * 41, ""]
    assert values(spark, cases, text.utf16_length(T)) == [80, 81, 81, 80, 82, 0]
    assert values(spark, cases, text.longer_than(T, 80)) == [False, True, True, False, True, False]


def test_keywords_are_substrings(spark):
    got = values(spark, ["Network", "HIRED", "hello"], text.contains_any(T, text.KEYWORDS))
    assert got == [True, True, False]


def test_links_tags_and_lists(spark):
    sample = "see http://t.co/abc, and www.x.com/a(b) note:this ok bit.ly/zz."
    assert values(spark, [sample], links.links(T)) == [
        ["http://t.co/abc", "www.x.com/a(b)", "note:this", "bit.ly/zz"]
    ]
    assert values(spark, [sample, "none"], links.first_link(T)) == ["http://t.co/abc", None]
    assert values(spark, ["Go #JobS #x_1 #é #JobS"], links.hashtags(T)) == [["jobs", "x_1", "jobs"]]
    parts = F.when(T == "none", F.array().cast("array<string>")).otherwise(F.split(T, "/"))
    assert values(spark, ["a/b", "", "a/", "none"], text.list_text(parts)) == ["[a,b]", "[]", "[a,]", "[]"]


def test_md5_is_lower_case_hex(spark):
    assert values(spark, ["hello"], F.md5(T)) == ["5d41402abc4b2a76b9719d911017c592"]


# Letters, marks and blanks that take part in a link, so that random texts are full of near links.
@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="awxz09:/%.-_()<>,!'\" »[", max_size=16))
def test_linear_link_pattern_finds_what_the_plain_one_finds(sample):
    plain = [m.group(0) for m in re.finditer(links.LINK_PATTERN, sample, re.ASCII)]
    linear = [m.group(0) for m in re.finditer(links.LINEAR_LINK_PATTERN, sample, re.ASCII)]
    assert plain == linear
    skipping = [m.group(1) for m in re.finditer(links.SKIPPING_LINK_PATTERN, sample, re.ASCII)]
    assert plain == [m for m in skipping if m]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["http://", "www.", "a.co/", "x:", "(", ")", "((", "b", ".", ",", "é", " "]), max_size=9))
def test_linear_link_pattern_on_link_pieces(pieces):
    test_linear_link_pattern_finds_what_the_plain_one_finds.hypothesis.inner_test("".join(pieces))


def test_links_of_hostile_texts_end(spark):
    hostile = [
        "ab:x" + "!" * 50_000, "http://a(" + "b" * 50_000, "xy:" + "a." * 50_000 + " ",
        "www." + "(" * 50_000, "a-" * 20_000, "http://" + "a,(b)" * 20_000,
        "a-" * 20_000 + " http://t.co/1.",
    ]
    found = values(spark, hostile, F.transform(links.links(T), F.length))
    assert [len(f) for f in found] == [0, 1, 1, 0, 0, 1, 1]
    assert found[2] == [3 + 100_000 - 1] and found[5] == [7 + 100_000]
    assert values(spark, hostile[-1:], links.first_link(T)) == ["http://t.co/1"]


STEMS = {
    "ba\U0001F600ed": "ba\U0001F600", "xa\U0001F600e": "xa\U0001F600",
    "hiring": "hire", "jobs": "job", "#jobs": "#job", "career": "career", "applied": "appli",
    "apply": "appli", "agreed": "agr", "feed": "fe", "snowing": "snowe", "happy": "happi",
    "python": "python", "relational": "relat", "caresses": "caress", "ponies": "poni",
    "controlling": "control", "hopping": "hop", "employment": "employ", "engineering": "engin",
    "Engineers": "engin", "sky": "sky", "s": "", "": "",
}


def test_stems(spark):
    assert dict(zip(STEMS, values(spark, list(STEMS), stem("t")))) == STEMS


def _by_hand(word):
    """Vowels and consonants letter by letter, to check the expressions that skip this step."""
    marks = ""
    for letter in reversed(word):
        vowel = letter in "aeiou" or (letter == "y" and marks[:1] == "c")
        marks = ("v" if vowel else "c") + marks
    return marks


def test_conditions_of_the_stemmer(spark):
    from itertools import product

    from postlark.functions import stemming

    words = ["".join(p) for n in range(1, 7) for p in product("aybt", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.selectExpr(
        "w", f"{stemming._has_vowel('w')} AS v", f"{stemming._m_over_0('w')} AS m0",
        f"{stemming._measure('w')} AS m", f"{stemming._matches('w', stemming._CVC_END)} AS cvc",
    ).collect()
    for row in rows:
        marks = _by_hand(row.w)
        steps = marks.count("vc")
        assert (row.v, row.m0, row.m) == ("v" in marks, steps > 0, steps), row.w
        assert row.cvc == (marks.endswith("cvc") and row.w[-2] != "y"), row.w


def test_stem_all_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(["Jobs", "", "hiring", "Jobs"],), (None,), ([],)], "t array<string>")
    assert [r[0] for r in df.select(stem_all("t")).collect()] == [["job", "", "hire", "job"], None, []]


def test_contacts(spark):
    phones = "Call (212) 555-1234 or 2125551234 x12 5551234x12, +1-212-555-1234 1234567 911-1234"
    emails = "a.b@x.com, foo@bar.co.uk <me@x.com> Me_1@Ex.com ok@ex-1.org ok@ex-1.org"
    assert values(spark, [phones], contacts.phones(T)) == [
        ["5551234", "2125551234", "5551234x12", "12125551234"]
    ]
    assert values(spark, [emails, "none", None], contacts.emails(T)) == [
        ["foo@bar.co.uk", "ok@ex-1.org"], [], None,
    ]


def test_profile_map(spark):
    profiles = [
        "UserJSONImpl{id=7, name='Ann, B', screenName='ann', url='http://x.y/?q=1', location=''}",
        "UserJSONImpl{id=7, bad=}",
        "id=7, id=8, a==b",
        "id=7, bad",
        "UserJSONImpl{id=7, name='O'Brien', x='1'}",
    ]
    got = values(spark, profiles, keyvalues.profile_map(T))
    assert got[0] == {"id": "7", "name": "Ann, B", "screenName": "ann", "url": "http://x.y/?q", "location": ""}
    assert got[1] is None and got[3] is None
    assert got[2] == {"id": "8", "a": ""}
    # An odd quote: commas split only where an even number of quotes follows.
    assert got[4] == {"id": "7, name", "x": "1"}


def test_aggregator(spark):
    sources = ['<a href="http://www.TweetMyJOBS.com">x</a>', "web", None, "http://jobsxac.uk"]
    assert values(spark, sources, from_aggregator(T)) == [True, False, False, False]


def test_times(spark):
    dates = ["Wed Mar 13 09:41:05 +0000 2019", "Wed Mar 13 11:41:05 +0200 2019", "soon"]
    parsed = values(spark, dates, times.epoch_ms(times.parse_corpus_time(T)))
    assert parsed == [1552470065000, 1552470065000, None]
    written = values(spark, dates[:1], times.format_corpus_time(times.parse_corpus_time(T)))
    assert written == dates[:1]


@pytest.mark.parametrize("n", [0, 1, -1, 2**31 - 1, 2**31, -(2**31) - 1, 6666666668, -(2**40)])
def test_wrap_int32(spark, n):
    expected = (n + 2**31) % 2**32 - 2**31
    assert spark.range(1).select(times.wrap_int32(F.lit(n))).first()[0] == expected
