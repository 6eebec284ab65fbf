"""People, posts and tags as vertex and edge tables.

A post vertex is its whole set of properties, while edges name a post by id only; one id can
have several vertices, because a repost is stored under the original's id. An edge reaches every
vertex of that id that existed when the edge was made. The edge tables therefore hold one row
per (source, post id) with the times between which the edge was made, which grows with the
posts; ``*_vertices`` expands them to single vertices on demand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.functions.links import hashtags
from postlark.functions.times import epoch_ms
from postlark.operators.documents import SCORE_FIELDS
from postlark.operators.joins import count_rows, lookup
from postlark.session import stage

# Relation names.
POSTED = "TWEETED"
REPOSTED = "RETWEETED"
TAGGED = "TAGGED"

PERSON_PROPERTIES = ("id", "name")
POST_PROPERTIES = ("id", "text", "created_ms", "tags", "phone", "email", "link", "hash", "third_party")


def vertex_key(*properties: Column) -> Column:
    """Hash of the properties; nulls count as empty."""
    return F.md5(F.concat_ws("\x01", *[F.coalesce(p.cast("string"), F.lit("")) for p in properties]))


def graph_rows(documents: DataFrame) -> DataFrame:
    """One row per stored post with what the graph needs of it."""
    return documents.select(
        "post_id",
        F.col("user.id").cast("string").alias("person_id"),
        F.col("user.screen_name").alias("person_name"),
        F.col("tweet_id"),
        "text",
        epoch_ms(F.col("created_at")).alias("created_ms"),
        hashtags(F.col("text")).alias("tags"),
        "phone", "email", "link", "hash", "third_party",
        F.when(F.col("is_retweet"), F.lit(REPOSTED)).otherwise(F.lit(POSTED)).alias("relation"),
    )


def _person_key() -> Column:
    return vertex_key(F.col("person_id"), F.col("person_name"))


def persons(rows: DataFrame) -> DataFrame:
    """(person_key, id, name); a renamed user is a second person with the same id."""
    distinct = rows.select(F.col("person_id").alias("id"), F.col("person_name").alias("name")).distinct()
    return distinct.withColumn("person_key", vertex_key(*[F.col(p) for p in PERSON_PROPERTIES]))


def posts(rows: DataFrame) -> DataFrame:
    """(post_key, and the nine properties), one for each key. Properties that are not asked for are not shuffled."""
    return _post_properties(rows).dropDuplicates(["post_key"])


def whole_posts(rows: DataFrame) -> DataFrame:
    """``posts`` for those who want all properties, from rows that are written: keys are counted first, and only vertices
    that stand there more than once are shuffled with their texts."""
    every = _post_properties(rows)
    many = stage(every.groupBy("post_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("post_key"), "repeated_posts")
    if many.isEmpty():
        return every
    repeated = every.join(many, "post_key", "left_semi").dropDuplicates(["post_key"])
    return every.join(many, "post_key", "left_anti").unionByName(repeated)


def _post_properties(rows: DataFrame) -> DataFrame:
    properties = rows.select(F.col("tweet_id").alias("id"), *[F.col(p) for p in POST_PROPERTIES if p != "id"])
    listed = F.array_join("tags", ",")
    return properties.withColumn(
        "post_key",
        vertex_key(*[listed if p == "tags" else F.col(p) for p in POST_PROPERTIES]),
    )


def tags(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("tags").alias("name")).distinct()


def _edge_times() -> list[Column]:
    return [F.min("created_ms").alias("first_ms"), F.max("created_ms").alias("last_ms")]


def posted(rows: DataFrame) -> DataFrame:
    """(person_key, tweet_id, relation, first_ms, last_ms)."""
    return (
        rows.select(_person_key().alias("person_key"), "tweet_id", "relation", "created_ms")
        .groupBy("person_key", "tweet_id", "relation")
        .agg(*_edge_times())
    )


def tagged(rows: DataFrame) -> DataFrame:
    """(tweet_id, tag, first_ms, last_ms)."""
    return (
        rows.select("tweet_id", F.explode("tags").alias("tag"), "created_ms")
        .groupBy("tweet_id", "tag")
        .agg(*_edge_times())
    )


SHARE = 1 / 1000
LEAST_CELL = 256
RANGES = 256
_TIES = 4096  # vertices of one time are told apart by so many hashes


def _cells(edges: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and vertices (tweet_id, at) with the cell (tweet_id, part, salt) in which they meet.

    An id with more than a thousandth of the vertices is cut into ranges of time at quantiles, one with more than a
    thousandth of the edges into as many groups of edges. A vertex goes to all groups of its range, an edge to all ranges up
    to its own, so each pair meets in one cell and no cell holds more than a thousandth of either side (or LEAST_CELL rows).
    There are fewer than 2,000 such ids, which bounds what is broadcast.
    """
    sides = vertices.groupBy("tweet_id").agg(F.count(F.lit(1)).alias("n_v"), F.lit(0).cast("long").alias("n_e")).unionByName(
        edges.groupBy("tweet_id").agg(F.lit(0).cast("long").alias("n_v"), F.count(F.lit(1)).alias("n_e")))
    counts = stage(sides.groupBy("tweet_id").agg(F.sum("n_v").alias("n_v"), F.sum("n_e").alias("n_e")), "degrees")
    whole = counts.agg(F.sum("n_v").alias("n_v"), F.sum("n_e").alias("n_e")).first()
    most_v, most_e = (max(LEAST_CELL, int((n or 0) * SHARE)) for n in (whole.n_v, whole.n_e))
    hot = counts.filter((F.col("n_v") > most_v) | (F.col("n_e") > most_e)).select(
        "tweet_id", F.ceil(F.greatest(F.col("n_v") / most_v, F.lit(1))).cast("int").alias("ranges"),
        F.ceil(F.greatest(F.col("n_e") / most_e, F.lit(1))).cast("int").alias("groups"))
    cuts = vertices.join(F.broadcast(hot.select("tweet_id")), "tweet_id", "left_semi").groupBy("tweet_id").agg(
        F.percentile_approx("at", [i / RANGES for i in range(1, RANGES)], 10_000).alias("cuts"))
    plan = F.broadcast(stage(hot.join(cuts, "tweet_id", "left"), "hot_ids"))

    def placed(side: DataFrame, at: str) -> DataFrame:
        below = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col(at))), F.lit(0))
        ranges = F.least(F.coalesce("ranges", F.lit(1)), F.lit(RANGES))
        range_ = F.floor(F.greatest(below, F.lit(0)) * ranges / RANGES).cast("int")
        finer = F.ceil(F.coalesce("ranges", F.lit(1)) / RANGES).cast("int")
        return side.join(plan, "tweet_id", "left").select(
            *side.columns, range_.alias("_range"), finer.alias("_finer"), F.coalesce("groups", F.lit(1)).alias("_groups"))

    each = F.sequence(F.lit(0), F.col("_groups") - 1)
    right = placed(vertices, "at").select(
        *vertices.columns, (F.col("_range") * F.col("_finer") + F.pmod(F.xxhash64("post_key"), F.col("_finer"))).cast("int").alias("part"),
        F.explode(each).alias("salt"))
    names = [c for c in edges.columns if c != "tweet_id"]
    reached = F.sequence(F.lit(0), (F.col("_range") + 1) * F.col("_finer") - 1)
    left = placed(edges, "until").select(
        *edges.columns, F.pmod(F.xxhash64(*names), F.col("_groups")).cast("int").alias("salt"), F.explode(reached).alias("part"))
    return left, right


def _reached(edges: DataFrame, post_vertices: DataFrame) -> DataFrame:
    """Each edge with the vertices of its post id that there were when it was last made."""
    at = F.col("created_ms") * _TIES + F.pmod(F.xxhash64("post_key"), F.lit(_TIES))
    vertices = stage(post_vertices.select(F.col("id").alias("tweet_id"), at.alias("at"), "post_key").dropna(subset=["tweet_id", "at"]), "vertices")
    until = F.col("last_ms") * _TIES + _TIES - 1
    kept = stage(edges.dropna(subset=["tweet_id", "last_ms"]).withColumn("until", until), "edges")
    left, right = _cells(kept, vertices)
    return left.join(right, ["tweet_id", "part", "salt"]).filter(F.col("at") <= F.col("until"))


def posted_vertices(edges: DataFrame, post_vertices: DataFrame) -> DataFrame:
    """(person_key, post_key, relation): an edge to each vertex there was when it was made."""
    return _reached(edges, post_vertices).select("person_key", "post_key", "relation")


def tagged_vertices(edges: DataFrame, post_vertices: DataFrame) -> DataFrame:
    """(post_key, tag)."""
    return _reached(edges, post_vertices).select("post_key", "tag")


def merge_vertices(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The incoming vertices that are not there yet."""
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def merge_edges(existing: DataFrame, incoming: DataFrame, *keys: str) -> DataFrame:
    """All edges once each, with the widened times."""
    return (
        existing.unionByName(incoming)
        .groupBy(*keys)
        .agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    )


def score_persons(people: DataFrame, scores: DataFrame) -> DataFrame:
    """Put the scores on every person of that id; a person keeps older scores otherwise."""
    fresh = scores.select(
        F.col("user_id").cast("string").alias("id"),
        *[F.col(f).alias(f"_{f}") for f in SCORE_FIELDS],
    )
    joined = people.join(fresh, "id", "left")
    return joined.select(
        *[c for c in people.columns if c not in SCORE_FIELDS],
        *[
            F.coalesce(F.col(f"_{f}"), F.col(f)).alias(f) if f in people.columns else F.col(f"_{f}").alias(f)
            for f in SCORE_FIELDS
        ],
    )


def all_edges_made(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(post_id, all_ok): is there an edge for every tag of the post? True without tags."""
    wanted = rows.select("post_id", "tweet_id", F.explode_outer("tags").alias("tag"))
    keys = ["tweet_id", "tag"]
    made = edges.select(*keys, F.lit(True).alias("made"))
    found = lookup(wanted, made, keys, ["post_id"], count_rows(wanted, keys))
    return found.groupBy("post_id").agg(
        F.bool_and(F.col("tag").isNull() | F.coalesce("made", F.lit(False))).alias("all_ok")
    )


def names(person_vertices: DataFrame, post_vertices: DataFrame, tag_vertices: DataFrame) -> DataFrame:
    """The name of every vertex; posts have none."""
    unnamed = post_vertices.select(F.lit("TWEET").alias("kind"), F.lit(None).cast("string").alias("name"))
    return (
        person_vertices.select(F.lit("PERSON").alias("kind"), "name")
        .unionByName(unnamed)
        .unionByName(tag_vertices.select(F.lit("TAG").alias("kind"), "name"))
    )


HEAVY_TAGS = 10


def _best_of(rows: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first ``2k`` rows of a group with at most ``k`` of each author: enough for the best ``k`` of others, whoever asks."""
    of_author = Window.partitionBy(group, "author").orderBy(*order)
    of_group = Window.partitionBy(group).orderBy(*order)
    return (
        rows.withColumn("_rn", F.row_number().over(of_author)).filter(F.col("_rn") <= k)
        .withColumn("_rn", F.row_number().over(of_group)).filter(F.col("_rn") <= 2 * k).drop("_rn")
    )


def _submasks(mask: str, n: int) -> Column:
    return F.explode(F.filter(F.sequence(F.lit(1), F.lit((1 << n) - 1)), lambda x: x.bitwiseAND(F.col(mask)) == x))


def recommend(rows: DataFrame, k: int = 5, heavy: int = HEAVY_TAGS) -> DataFrame:
    """(person_id, rank, post_id, shared): for each person, the ``k`` posts of others that share most
    of the person's tags, newer ones first among equals.

    The ``heavy`` tags that would pair most persons with most sets of tags are bits of a mask and paired with nobody. Posts
    that share another tag with a person are found by joining on it, per person and set of tags: a person's best posts lie
    in their best ``k`` sets, and of a set no more is needed than its newest 2k posts with at most k of each author. For
    posts that share heavy tags only, masks meet by the parts that they have in common, of which there are at most
    3 ** heavy whatever the data. A post found both ways counts with the larger number, the exact one.
    """
    posts = stage(rows.select(
        "person_id", "post_id", "created_ms", F.sort_array(F.array_distinct("tags")).alias("tags")
    ).filter(F.size("tags") > 0).distinct(), "tagged_posts")
    of_person = posts.select("person_id", F.explode("tags").alias("tag")).distinct().groupBy("tag").agg(F.count(F.lit(1)).alias("n_p"))
    of_set = posts.select("tags").distinct().select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n_s"))
    pairs = F.col("n_p").cast("double") * F.col("n_s")
    hot = [r.tag for r in of_person.join(of_set, "tag").orderBy(pairs.desc(), "tag").limit(heavy).collect()]
    bits = [F.when(F.array_contains("tags", tag), F.lit(1 << i)).otherwise(F.lit(0)) for i, tag in enumerate(hot)]
    mask = sum(bits, F.lit(0))
    rest = F.array_except("tags", F.array(*map(F.lit, hot)).cast("array<string>"))
    newest = [F.desc("created_ms"), F.desc("post_id")]
    masks = stage(posts.groupBy("person_id").agg(F.bit_or(mask).alias("mask")), "person_masks")
    ways = [_by_rare_tags(posts, masks, rest, mask, k, newest)]
    if hot:
        ways.append(_by_heavy_tags(posts.withColumn("mask", mask), masks, len(hot), k, newest))
    found = ways[0] if len(ways) == 1 else ways[0].unionByName(ways[1])
    best = Window.partitionBy("person_id").orderBy(F.desc("shared"), *newest)
    return (
        found.groupBy("person_id", "post_id", "created_ms").agg(F.max("shared").alias("shared"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("person_id", "rank", "post_id", "shared")
    )


def _by_rare_tags(posts: DataFrame, masks: DataFrame, rest: Column, mask: Column, k: int, newest: list[Column]) -> DataFrame:
    """(person_id, post_id, created_ms, shared): the best posts of others that share a tag which is not heavy."""
    authored = posts.withColumnRenamed("person_id", "author")
    listed = _best_of(authored, "tags", k, *newest).groupBy("tags").agg(
        F.collect_list(F.struct("created_ms", "post_id", "author")).alias("listed"))
    interests = posts.select("person_id", F.explode(rest).alias("tag")).distinct().join(masks, "person_id")
    sets = listed.select("tags", F.explode(rest).alias("tag"))
    shared = interests.join(sets, "tag").groupBy("person_id", "tags").agg(F.count(F.lit(1)).alias("n"), F.first("mask").alias("mask"))
    counted = shared.withColumn("shared", F.col("n") + F.bit_count(F.col("mask").bitwiseAND(mask)))
    others = counted.join(listed, "tags").withColumn(
        "listed", F.filter("listed", lambda p: p["author"] != F.col("person_id"))
    ).filter(F.size("listed") > 0).withColumn("_newest", F.array_max("listed"))
    best_sets = Window.partitionBy("person_id").orderBy(F.desc("shared"), F.desc("_newest"))
    return (
        others.withColumn("_rn", F.row_number().over(best_sets)).filter(F.col("_rn") <= k)
        .select("person_id", "shared", F.inline("listed")).select("person_id", "post_id", "created_ms", "shared")
    )


def _by_heavy_tags(posts: DataFrame, masks: DataFrame, n: int, k: int, newest: list[Column]) -> DataFrame:
    """(person_id, post_id, created_ms, shared): the best posts of others by the heavy tags in common alone."""
    authored = posts.filter("mask > 0").select("mask", F.col("person_id").alias("author"), "post_id", "created_ms").distinct()
    of_mask = _best_of(authored, "mask", k, *newest)
    within = of_mask.select(_submasks("mask", n).alias("part"), "author", "post_id", "created_ms").distinct()
    of_part = _best_of(within, "part", k, *newest)
    asked = masks.select("mask").filter("mask > 0").distinct().select("mask", _submasks("mask", n).alias("part"))
    met = asked.join(of_part, "part").groupBy("mask", "author", "post_id", "created_ms").agg(
        F.max(F.bit_count("part")).cast("bigint").alias("shared"))
    for_mask = stage(_best_of(met, "mask", k, F.desc("shared"), *newest), "heavy_best")
    # at most 2k rows for each of 2 ** n masks
    return masks.join(F.broadcast(for_mask), "mask").filter(F.col("author") != F.col("person_id")).select(
        "person_id", "post_id", "created_ms", "shared")
