"""Line dedup by the number of distinct sites that a line is spread over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import words
from postlark.session import stage

MIN_SITES = 10
MIN_LINE_WORDS = 2
SKETCH_BITS = 10
MARGIN = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)  # four standard errors of a sketch
COPY_SHARE = 0.5  # of a text's words in widespread lines, above which it may be a copy


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\x0b\x0c\r"))


def text_digest(text: Column) -> list[Column]:
    """128 hashed bits of a text, by which equal texts meet without their texts travelling."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("_t1"), F.xxhash64(F.lit(1), whole).alias("_t2")]


def line_marks(docs: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """For each document its text's digest, its site, its words and, for each line, a hash and its number of words."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    hashed = lambda x: F.conv(F.left(F.md5(_trimmed(x)), F.lit(15)), 16, 10).cast("long")
    marks = F.transform(lines, lambda x: F.struct(hashed(x).alias("h"), F.size(words(x)).alias("w")))
    place = F.when(F.col(site).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(site)))
    marked = docs.select(*text_digest(F.col(text)), place.alias("site"), marks.alias("lines"))
    return marked.withColumn("words", F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["w"]))


def _on_many(rows: DataFrame, least: int, name: str) -> DataFrame:
    """The lines (``h``) of rows (h, who) that ``least`` distinct ones or more have, exactly.

    A line on fewer rows than that cannot; the others get a HyperLogLog sketch, merged from partial sketches. Where the
    estimate lies within four standard errors of the threshold they are counted exactly.
    """
    sketched = stage(
        rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("who", SKETCH_BITS).alias("all"))
        .filter(F.col("n") >= least).select("h", F.hll_sketch_estimate("all").alias("n_who")), name)
    sure = sketched.filter(F.col("n_who") >= least * (1 + MARGIN)).select("h")
    near = sketched.filter((F.col("n_who") < least * (1 + MARGIN)) & (F.col("n_who") >= least * (1 - MARGIN)))
    counted = rows.join(near, "h", "left_semi").groupBy("h").agg(F.count_distinct("who").alias("n_who")).filter(
        F.col("n_who") >= least).select("h")
    return sure.unionByName(counted)


def spread_lines(marks: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_LINE_WORDS,
                 copy_share: float = COPY_SHARE) -> DataFrame:
    """Hashes of the lines that stand on ``min_sites`` distinct sites or more, a group of copies counting as one site.

    Lines on so many sites are widespread. A text with more than ``copy_share`` of its words in such lines is either a short
    page full of boilerplate or one of many copies of a document. What is widespread among the other texts alone is
    boilerplate, wherever it stands. For the rest, copies are known by the smallest hash among their remaining widespread
    lines, which near copies mostly share, and all texts with one such hash count once.
    """
    each = marks.select("_t1", "_t2", "site", F.explode("lines").alias("line")).filter(F.col("line.w") >= min_words).select(
        "_t1", "_t2", F.col("site").alias("who"), F.col("line.h").alias("h"), F.col("line.w").alias("w"))
    often = each.groupBy("h").count().filter(F.col("count") >= min_sites).select("h")
    met = stage(each.join(often, "h", "left_semi"), "line_sites")
    held = stage(met.join(_on_many(met.select("h", "who"), min_sites, "line_spread"), "h", "left_semi"), "widespread")
    shares = held.groupBy("_t1", "_t2").agg(F.sum("w").alias("met")).join(
        marks.groupBy("_t1", "_t2").agg(F.sum("words").alias("words")), ["_t1", "_t2"])
    copies = shares.filter(F.col("met") > copy_share * F.col("words")).select("_t1", "_t2", F.lit(True).alias("copied"))
    flagged = stage(held.join(copies, ["_t1", "_t2"], "left"), "copied_lines")
    others = flagged.filter(F.col("copied").isNull()).select("h", "who")
    sure = stage(_on_many(others, min_sites, "plain_spread"), "boilerplate")
    left = flagged.filter("copied").join(sure, "h", "left_anti")
    names = left.groupBy("_t1", "_t2").agg(F.concat(F.lit("c"), F.min("h").cast("string")).alias("who"))
    counted = left.select("_t1", "_t2", "h").join(names, ["_t1", "_t2"]).select("h", "who").unionByName(others.join(sure, "h", "left_anti"))
    return sure.unionByName(_on_many(counted, min_sites, "copy_spread"))


def removals(marks: DataFrame, spread: DataFrame) -> DataFrame:
    """For each text with boilerplate, the places (from 0) of the lines to remove."""
    texts = marks.groupBy("_t1", "_t2").agg(F.first("lines").alias("lines"))
    lined = texts.select("_t1", "_t2", F.posexplode("lines").alias("place", "line")).select("_t1", "_t2", "place", F.col("line.h").alias("h"))
    return lined.join(spread, "h", "left_semi").groupBy("_t1", "_t2").agg(F.sort_array(F.collect_list("place")).alias("gone"))


def remove_spread_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                        min_words: int = MIN_LINE_WORDS) -> DataFrame:
    """The documents without their cross-site boilerplate, with ``n_lines`` and ``n_removed``.

    Lines are the parts between newlines and equal if they agree without the white space around them; shorter than
    ``min_words`` words they are never removed. Copies of a document, exact or nearly, count as one site, so what only they
    share stays, for near-duplicate removal to decide on. All other columns pass through, whatever they are called; columns
    called ``n_lines`` or ``n_removed`` are replaced.

    Null text stays null, with no lines; an empty text has one empty line. A null site is a site of its own. Equal
    texts, repeated rows among them, are treated alike. No rows give no rows.
    """
    keep = [c for c in docs.columns if c.lower() not in {"n_lines", "n_removed"}]
    marks = stage(line_marks(docs, text, site), "line_marks")
    gone = removals(marks, stage(spread_lines(marks, min_sites, min_words), "spread_lines"))
    whole = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), *text_digest(F.col(text)))
    joined = whole.join(gone, ["_t1", "_t2"], "left")
    lines = F.split(F.col("text"), "\n")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get("lines", i))
    cleaned = joined.withColumn("lines", F.when(F.col("gone").isNotNull(), lines))
    return cleaned.select(
        *[F.when(F.col("gone").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text")).alias(c) if c == text else
          F.col("row")[c].alias(c) for c in keep],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
