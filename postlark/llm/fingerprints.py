"""Document fingerprints: SimHash, and search within a Hamming radius over permuted block tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlark.llm.common import slices_for, words
from postlark.session import stage

TERM_WORDS = 2
RADIUS = 3
BLOCKS = 6
_PAIR = 0x0000000100000001


def text_key(text: Column) -> list[Column]:
    """128 hashed bits of a text; null is the empty text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(3), whole).alias("k2")]


def simhash(texts: DataFrame, keys: Sequence[str], text: str = "text", term_words: int = TERM_WORDS) -> DataFrame:
    """One row for each distinct value of ``keys``, with the 64-bit ``fingerprint`` of its text as a long.

    Terms are runs of ``term_words`` words (the last ones shorter), weighted by how often they occur. Each term's hash
    votes on every bit, for or against, with its weight; a bit is set if more than half of the weight is for it. A text
    without words has no votes and the fingerprint 0.

    Two of the 64 vote counters share a long, 32 bits apart, so 32 sums suffice. Texts do not travel: what is shuffled
    is a text's counters.
    """
    run = F.arrays_zip(*[F.slice("_words", i + 1, F.greatest(F.size("_words") - i, F.lit(0))).alias(f"w{i}") for i in range(term_words)])
    terms = (
        texts.select(*keys, words(F.col(text)).alias("_words"))
        .select(*keys, F.inline_outer(run))
        .toDF(*keys, *[f"_w{i}" for i in range(term_words)])
        .select(*keys, F.when(F.col("_w0").isNotNull(), F.xxhash64(*[f"_w{i}" for i in range(term_words)])).alias("_h"))
    )
    votes = terms.groupBy(*keys).agg(
        F.count("_h").alias("_n"),
        *[F.coalesce(F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(_PAIR))), F.lit(0)).alias(f"_v{j}") for j in range(32)])

    def bit(i: int) -> Column:
        counter = F.col(f"_v{i}").bitwiseAND(F.lit(0xFFFFFFFF)) if i < 32 else F.shiftrightunsigned(f"_v{i - 32}", 32)
        return F.when(2 * counter > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))

    joined = bit(0)
    for i in range(1, 64):
        joined = joined.bitwiseOR(bit(i))
    return votes.select(*keys, joined.alias("fingerprint"))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits in which two fingerprints agree."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def block_tables(fingerprint: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """The keys of a fingerprint in all permuted tables. Two fingerprints within the radius differ in at most ``radius``
    of the blocks, and so share the others: every choice of them is a table, keyed by those blocks' bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[
        F.struct(F.lit(t).alias("table"), fingerprint.bitwiseAND(F.lit(signed(sum(masks[i] for i in kept)))).alias("bits"))
        for t, kept in enumerate(combinations(range(blocks), blocks - radius))])


def within_radius(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (``query``, ``found``) of different fingerprints at most ``radius`` bits apart, each once.

    Both inputs have a column ``fingerprint`` and count each value once, however many documents share it; null finds
    nothing. Only fingerprints that agree in a whole table key meet, and the join itself keeps those within the radius.
    """
    def laid(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("fingerprint").alias(name)).dropna().distinct().select(
            name, F.explode(block_tables(F.col(name), radius, blocks)).alias("key")).select(name, "key.table", "key.bits")

    apart = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    q, f = laid(queries, "query"), laid(fingerprints, "found")
    near = (q["table"] == f["table"]) & (q["bits"] == f["bits"]) & (apart <= radius) & (apart > 0)
    # Sizes are guessed from before the keys are laid out, so a broadcast of the queries would have no proven bound.
    return q.hint("merge").join(f, near).select("query", "found").distinct()


def with_next(rows: DataFrame, order: str, carried: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """Each row with the columns ``carried`` of the next one, as ``next_...``, in descending ``order``; after the last
    comes the first. Nulls stand last, rows with the same value stand by ``ties``.

    Rows go once, to slices of the order between its quantiles. The first row of a slice goes to the slice before as
    well, to be the next of its last row.
    """
    total = rows.count()
    slices = slices_for(total)
    shares = [i / slices for i in range(1, slices)]
    bounds = F.lit(None).cast("array<bigint>")
    if shares:
        bounds = F.array(*[F.lit(x) for x in sorted({
            x for x in (rows.agg(F.percentile_approx(order, shares, 100 * slices).alias("b")).first()["b"] or []) if x is not None})])
    at = F.when(F.col(order).isNull(), slices + 1).otherwise(F.coalesce(F.size(F.filter(bounds, lambda b: b > F.col(order))), F.lit(0)))
    ordered = rows.select("*", at.alias("_slice"), *[t.alias(f"_tie{i}") for i, t in enumerate(ties)])
    tie_names = [f"_tie{i}" for i in range(len(ties))]
    place = lambda: [F.col(order).desc_nulls_last(), *tie_names]
    # A row for each slice, of which there are 4,098 at most.
    heads = ordered.groupBy("_slice").agg(F.max(order).alias("_head")).select(
        F.col("_slice").alias("_from"), "_head",
        F.coalesce(F.lag("_slice").over(W.orderBy("_slice")), F.max("_slice").over(W.partitionBy())).alias("_to"))
    first = W.partitionBy("_slice").orderBy(*tie_names)
    lent = (
        ordered.join(F.broadcast(heads), (F.col("_slice") == F.col("_from")) & F.col(order).eqNullSafe(F.col("_head")))
        .select("_slice", "_to", *tie_names, *carried)
        .withColumn("_at", F.row_number().over(first)).filter(F.col("_at") == 1)
    )
    own = ordered.select("*", F.lit(0).alias("_lent"))
    lent_rows = lent.select(F.col("_to").alias("_slice"), *tie_names, *carried, F.lit(1).alias("_lent"))
    line = W.partitionBy("_slice").orderBy("_lent", *place())
    both = own.unionByName(lent_rows, allowMissingColumns=True)
    return (
        both.select("*", *[F.lead(c).over(line).alias(f"next_{c}") for c in carried])
        .filter(F.col("_lent") == 0).drop("_slice", "_lent", *tie_names)
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last third of code points replaced by as many first ones of the following text, or all."""
    whole, third = F.coalesce(text, F.lit("")), F.floor(F.length(F.coalesce(text, F.lit(""))) / 3).cast("int")
    return F.concat(F.substring(whole, F.lit(1), F.length(whole) - third), F.substring(F.coalesce(following, F.lit("")), F.lit(1), third))


def fingerprint_documents(docs: DataFrame, every: int = 20) -> DataFrame:
    """For each document its fingerprint, that of its edited text and the likeness to it and to the next document's; for
    those whose id is divisible by ``every`` also ``n_within``, how many other fingerprints lie within the radius, and
    ``found`` (both null for the others).

    ``class_id`` is the smallest id with the same fingerprint (null where none of them has an id). ``found`` holds, in order,
    the ids of the classes within the radius, the document's own among them if other rows are in it; a class without
    an id is counted in ``n_within`` but has none to hold. So each link within the radius can be read off, copies included.

    Null text is empty and has the fingerprint 0. The next document is that with the next smaller id; null ids stand
    last; rows with the same id stand by a hash of their text, and equal ones are each other's next. A single row is its own
    next. No rows give no rows.
    """
    slim = docs.select("doc_id", "text", *text_key(F.col("text")))
    paired = with_next(slim, "doc_id", ["text", "k1", "k2"], [F.col("k1"), F.col("k2")])
    change = edited(F.col("text"), F.col("next_text"))
    carried = ["doc_id", "k1", "k2", "next_k1", "next_k2", "n_chars"]
    versions = paired.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "k1", "k2", "next_k1", "next_k2",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.array(F.col("text"), change).alias("_texts"))
    each = versions.select("_row", *carried, F.posexplode("_texts").alias("_version", "text")).withColumn(
        "_sha", F.when(F.col("_version") == 1, F.sha2("text", 256)).otherwise(""))
    prints = stage(simhash(each, ["_row", *carried, "_version", "_sha"]), "fingerprints")
    of = lambda v, c: F.max(F.when(F.col("_version") == v, F.col(c)))
    rows = prints.groupBy("_row", *carried).agg(
        of(1, "_sha").alias("edited_sha256"), of(0, "fingerprint").alias("_own"), of(1, "fingerprint").alias("_edited"))
    known = prints.filter(F.col("_version") == 0).groupBy(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2")).agg(
        F.first("fingerprint").alias("_next"))
    own = prints.filter(F.col("_version") == 0)
    classes = stage(own.groupBy(F.col("fingerprint").alias("_own")).agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("_members")), "fingerprint_classes")
    near = within_radius(own.filter(F.col("doc_id") % every == 0), own).join(
        classes.select(F.col("_own").alias("found"), "class_id"), "found")
    hits = near.groupBy(F.col("query").alias("_own")).agg(
        F.count(F.lit(1)).alias("_hits"), F.collect_list("class_id").alias("_classes"))
    none = F.array().cast("array<bigint>")
    alike = F.when(F.col("_members") > 1, F.array("class_id")).otherwise(none)
    return (
        rows.join(known, ["next_k1", "next_k2"]).join(classes, "_own").join(hits, "_own", "left")
        .select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("_own")).alias("fingerprint"),
                as_hex(F.col("_edited")).alias("edited_fingerprint"), likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
                likeness(F.col("_own"), F.col("_next")).alias("near_next"),
                F.when(F.col("doc_id") % every == 0, F.coalesce("_hits", F.lit(0))).alias("n_within"), "class_id",
                F.when(F.col("doc_id") % every == 0, F.sort_array(F.concat(alike, F.coalesce("_classes", none)))).alias("found"))
    )
