"""Quality rules: repetition and length guards, then divergence from what a language usually looks like."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import words
from postlark.session import stage

# Frequent function words of each language, the bins of the word histogram.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "this",
           "are", "at", "from", "or", "an", "not", "have", "he", "his", "but", "they", "you", "which"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "nicht", "ein", "eine", "als", "auch", "es", "an", "werden", "aus", "er", "hat", "dass", "sie", "nach"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au",
           "sur", "pas", "avec", "plus", "ce", "il", "sont", "se", "ne", "son", "aux", "ou", "mais"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para",
           "es", "al", "lo", "como", "más", "o", "pero", "sus", "le", "ha", "me", "si", "sin"),
}
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5

MIN_WORDS = 10
MOST_REPEATED_PERCENT = 20
MIN_CHARS_COMPARED = 300
MIN_WORDS_COMPARED = 80
# The distance that a text may have: that of ordinary texts of any length, and what chance adds to a short one's.
CHAR_DISTANCE, CHAR_CHANCE = 0.15, 3.2
WORD_DISTANCE, WORD_CHANCE = 0.19, 1.1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more: equal hashes meet when (hash, place) is sorted, and the
    places that remain each add their window, less what the next one covers again."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def places(s: Column) -> Column:
        ahead = F.concat(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.lit(None)))
        behind = F.concat(F.array(F.lit(None)), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
        twice = F.zip_with(F.zip_with(s, ahead, lambda x, y: F.when(x["g"] == y["g"], x["i"])),
                           F.zip_with(s, behind, lambda x, y: F.when(x["g"] == y["g"], x["i"])), lambda x, y: F.coalesce(x, y))
        return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))

    def width(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(1))),
                           lambda x, y: F.coalesce(F.least(y - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return _let(placed, lambda s: _let(places(s), width))


def _window_hashes(hashes: str) -> Column:
    """A hash for each window of words from the column of the words' hashes; none for texts shorter than a window."""
    firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))


def language(lang: Column) -> Column:
    """The language whose common words are counted; empty for null and for languages without a list."""
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise("")


def _common_counts(w: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, small or capitalized, in the list's order, then how many words
    are none of them."""
    every = sorted({x for own in COMMON_WORDS.values() for x in own})
    listed = F.array().cast("array<string>")
    for key, own in COMMON_WORDS.items():
        listed = F.when(lang == key, F.array(*map(F.lit, own))).otherwise(listed)
    met = F.transform(F.filter(w, lambda x: x.isin(*every, *[x.capitalize() for x in every])), lambda x: F.lower(x))
    counts = _let(met, lambda m: F.transform(listed, lambda x: F.size(m) - F.size(F.array_remove(m, x))))
    return _let(counts, lambda c: F.concat(c, F.array(F.size(w) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))


def _class_counts() -> Column:
    """Characters by class: white space, small ASCII letters, capitals of any script, digits, punctuation, symbols, other
    letters, rest. ``_rest`` is the text without the first two."""
    left = lambda pattern: F.length(F.regexp_replace("_rest", pattern, ""))
    without = lambda pool: F.length("_rest") - F.length(F.translate("_rest", pool, ""))
    white = F.col("n_chars") - F.col("word_chars")
    parts = [white, F.col("n_chars") - F.length("_rest") - white, left("\\P{Lu}+"), left("[^0-9]+"), without(PUNCTUATION),
             without(SYMBOLS), left("[\\P{L}\\p{Lu}]+")]
    return _let(F.array(*[x.cast("long") for x in parts]), lambda a: F.concat(
        a, F.array(F.col("n_chars") - F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y))))


def measure(docs: DataFrame, keys: Sequence[str], text: str, lang: str) -> DataFrame:
    """The keys and all that the rules look at, from one pass over the words of each text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.select(*keys, language(F.col(lang)).alias("language"), whole.alias("_text"), words(whole).alias("_words"))
        .select(
            *keys, "language",
            F.size("_words").cast("long").alias("n_words"),
            F.length("_text").cast("long").alias("n_chars"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.transform("_words", lambda x: F.xxhash64(x)).alias("_word_hashes"),
            _common_counts(F.col("_words"), F.col("language")).alias("common"),
            F.regexp_replace("_text", "[a-z\\x20\\x09-\\x0D]+", "").alias("_rest"))
        .select(
            *keys, "language", "n_words", "n_chars", "word_chars", "n_dup_lines", "common", "_rest",
            _window_hashes("_word_hashes").alias("_hashes"))
        .select(
            *keys, "language", "n_words", "word_chars", "n_dup_lines", "common",
            (F.length("_rest") - F.length(F.translate("_rest", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), _covered(F.col("_hashes")))
            .otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
            _class_counts().alias("classes"))
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms over the same bins; 0 if either is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def distance(n: Column, m: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda x, y: _let(F.struct((x / n).alias("p"), (y / m).alias("q")), lambda s: (
            part(s["p"], (s["p"] + s["q"]) / 2) + part(s["q"], (s["p"] + s["q"]) / 2)) / 2))
        return F.sqrt(F.greatest(total(terms), F.lit(0.0)))

    return _let(F.struct(total(counts).alias("n"), total(reference).alias("m")),
                lambda s: F.when((s["n"] > 0) & (s["m"] > 0), distance(s["n"], s["m"])).otherwise(0.0))


def references(measured: DataFrame) -> DataFrame:
    """For each language the summed histograms of all documents that pass the base rules. Few numbers for each of the
    languages with a list, and one row for all others."""
    bins = {"common": max(map(len, COMMON_WORDS.values())) + 1, "classes": 8}
    sums = [F.sum(F.try_element_at(F.col(name), F.lit(i + 1))).alias(f"_{name}{i}") for name, n in bins.items() for i in range(n)]
    summed = measured.filter(~base_failed()).groupBy("language").agg(*sums)
    arrays = [F.filter(F.array(*[F.col(f"_{name}{i}") for i in range(n)]), lambda x: x.isNotNull()).alias(f"ref_{name}") for name, n in bins.items()]
    return summed.select("language", *arrays)


def assess(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", lang: str = "lang") -> DataFrame:
    """For each row its ``keys``, the counts of the base rules, ``base_failed``, the distances ``char_distance`` and
    ``word_distance`` from its language, and ``kept``.

    Histograms of character classes and of the language's common words are compared with those of all documents of the
    language that pass the base rules. A text too short for its histogram to mean something (fewer than
    MIN_CHARS_COMPARED characters in words, MIN_WORDS_COMPARED words) is not judged by it.

    Null text is empty: no words, so it fails the base rules. A null or unlisted language is compared by character
    classes alone, with all such documents. Repeated rows are judged apart and alike. No rows give no rows.
    """
    measured = stage(measure(docs, keys, text, lang), "measures")
    joined = measured.join(F.broadcast(references(measured)), "language", "left")  # five rows at most
    near = (
        ((F.col("word_chars") < MIN_CHARS_COMPARED) | (F.col("char_distance") <= CHAR_DISTANCE + CHAR_CHANCE / F.sqrt("word_chars")))
        & ((F.col("n_words") < MIN_WORDS_COMPARED) | (F.col("word_distance") <= WORD_DISTANCE + WORD_CHANCE / F.sqrt("n_words"))))
    empty = F.array().cast("array<bigint>")
    return (
        joined.withColumn("char_distance", divergence(F.col("classes"), F.coalesce("ref_classes", empty)))
        .withColumn("word_distance", divergence(F.col("common"), F.coalesce("ref_common", empty)))
        .withColumn("base_failed", base_failed())
        .select(*keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "char_distance", "word_distance", (~F.col("base_failed") & near).alias("kept"))
    )
