import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postlark.functions.text import one_line
from postlark.operators import cadence as bots
from postlark.operators import blocks, classify, dedup, documents, enrich, features, filters, graph
from postlark.operators.joins import count_rows, hot_keys, lookup
from postlark.session import scratch_path
from postlark.sources.messages import POST_SCHEMA

START = datetime(2024, 1, 1)


def post(i, text="x", user=7, name="ann", original=None, minutes=None, lang="en", source="web", place=None):
    return (
        i, text, lang, START + timedelta(minutes=i if minutes is None else minutes), source, 3, place,
        original is not None, (original,) if original is not None else None, (user, name, name, "town"),
    )


def posts(spark, *rows):
    return spark.createDataFrame(list(rows), POST_SCHEMA)


# -- posting rhythm ---------------------------------------------------------------------------

CADENCE = {
    "one": ([], (0, 0, 0, True)),
    "two": ([86400], (86400, 0, 0, True)),
    "regular": ([600, 600], (600, 0, 0, True)),
    "truncating": ([1, 2, 8], (3, -3, 30, True)),
    "irregular": ([30000, 2000, 40000], (24000, -5000, 776000000, False)),
    "spread": ([40000, 100, 40000], (26700, 0, 1061340000, False)),
    "overflow": ([100000, 0, 100000], (66666, 0, 6666666668, False)),
}


def histories(spark, stamps_ms):
    """(user_id, ts, post_id) from millisecond stamps per user, newest first."""
    rows = [
        (user, ms, len(stamps) - i)
        for user, stamps in enumerate(stamps_ms)
        for i, ms in enumerate(stamps)
    ]
    return spark.createDataFrame(rows, "user_id bigint, ms bigint, post_id bigint").select(
        "user_id", F.timestamp_millis("ms").alias("ts"), "post_id"
    )


def from_gaps(gaps):
    stamps = [2_000_000_000_000]
    for gap in gaps:
        stamps.append(stamps[-1] - gap * 1000)
    return stamps


def scores(df):
    return {r.user_id: tuple(r)[1:] for r in df.collect()}


def test_cadence_fixtures(spark):
    history = histories(spark, [from_gaps(g) for g, _ in CADENCE.values()])
    expected = dict(enumerate(e for _, e in CADENCE.values()))
    assert scores(bots.cadence(history)) == expected
    for seconds in (1, 700, 3600, 10**6):
        assert scores(bots.cadence(history, size=None, slice_seconds=seconds)) == expected


def test_cadence_int32_and_sub_second(spark):
    history = histories(spark, [from_gaps([100000, 0, 100000]), [100000, 98500, 97100, 90000]])
    assert scores(bots.cadence(history, int32_wrap=True)) == {
        0: (66666, 0, -1923267924, True), 1: (3, -3, 24, True),
    }


def test_cadence_sees_the_newest_posts_only(spark):
    history = histories(spark, [from_gaps([1000] * 19 + [5_000_000])])
    assert scores(bots.cadence(history))[0][:3] == (1000, 0, 0)
    assert scores(bots.cadence(history, size=None))[0][0] == (19 * 1000 + 5_000_000) // 20


def test_whole_history_equals_one_window_on_a_hot_user(spark):
    """A third of the rows belongs to one user; slices must not change the result."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("user_id"),
        F.timestamp_millis(F.pmod(F.xxhash64("id"), F.lit(10**9)) + 1_700_000_000_000).alias("ts"),
        F.col("id").alias("post_id"),
    )
    assert scores(bots.cadence(rows, size=None, slice_seconds=977)) == scores(bots.cadence(rows, size=10**6))


def test_people_without_posts_and_min_posts(spark):
    history = histories(spark, [from_gaps([600, 600])])
    people = spark.createDataFrame([(0,), (9,)], "user_id bigint")
    assert scores(bots.score_people(people, bots.cadence(history))) == {
        0: (600, 0, 0, True), 9: (0, 0, 0, True),
    }
    assert scores(bots.cadence(history, min_posts=4))[0][3] is False


def test_unscored_batches(spark):
    people = spark.range(200).select(F.col("id").alias("user_id"))
    scored = people.filter("user_id % 10 = 0")
    first = bots.unscored_batch(people, scored)
    assert first.count() == 150
    assert bots.unscored_batch(people, scored.union(first)).count() == 30


def test_newest_prunes_before_the_shuffle(spark):
    plan = bots.newest(histories(spark, [from_gaps([1])]))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# -- filters, documents -----------------------------------------------------------------------


def test_language_and_length(spark):
    rows = posts(spark, post(1, "a" * 80), post(2, "a" * 81), post(3, "a" * 79 + "😀"), post(4, "a" * 99, lang="de"))
    assert sorted(r.id for r in filters.in_language_and_long(rows).collect()) == [2, 3]


def test_rows_without_keyword_stay_until_accepted(spark):
    rows = posts(spark, post(1, "a network"), post(2, "hello"))
    matched = filters.has_keyword(F.col("text"))
    scored = rows.select(
        filters.score_or_zero(F.lit(1.0), matched).alias("prediction"),
        filters.post_or_null(rows, matched, ["id", "text"]).alias("post"),
    )
    assert sorted((r.prediction, r.post and r.post.id) for r in scored.collect()) == [(0.0, None), (1.0, 1)]
    assert filters.accepted(scored).count() == 1


def test_documents(spark):
    rows = posts(
        spark, post(1, "look http://t.co/1 now", source="via Indeed", place="here"), post(2, "RT look", original=1)
    )
    one, two = documents.to_documents(rows).orderBy("post_id").collect()
    assert (one.tweet_id, one.link, one.place, one.third_party) == ("1", "http://t.co/1", "here", True)
    assert (two.tweet_id, two.link, two.place, two.third_party) == ("1", "", "", False)
    assert one.phone == one.email == "[]" and one.favorites == "3" and one.metadata is None


def test_write_back(spark):
    docs = documents.to_documents(posts(spark, post(1), post(2), post(3, user=8)))
    score = spark.createDataFrame(
        [(7, 1, 2, 3, True)],
        "user_id bigint, avg_tweet_freq bigint, avg_tweet_reg bigint, tweet_freq_variance bigint, is_bot boolean",
    )
    written = documents.write_back_scores(docs, score)
    got = {r.post_id: r.metadata and tuple(r.metadata) for r in written.collect()}
    assert got == {1: (1, 2, 3, True), 2: (1, 2, 3, True), 3: None}
    again = documents.write_back_scores(written, score.limit(0))
    assert {r.post_id: r.metadata and tuple(r.metadata) for r in again.collect()} == got


def test_retention(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    cutoff = documents.retention_cutoff(now)
    stamps = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", None, "2024-01-20 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("created_at"))
    once = documents.retain(df, cutoff)
    assert once.count() == 3
    assert documents.retain(once, cutoff).count() == 3


def test_one_line(spark):
    assert spark.range(1).select(one_line(F.lit("a\nb\n"))).first()[0] == "a b "


# -- repeats ----------------------------------------------------------------------------------

ARRIVALS = [
    "job A http://t.co/1", "job B http://t.co/1", "job C http://t.co/2 http://t.co/1",
    "no link job", "no link job", "no link job!",
]


def pairwise(texts):
    """Row by row: a repeat has a stored hash, or its first link is stored."""
    import re

    from postlark.functions.links import LINK_PATTERN

    stored_texts, stored_links, kept = set(), set(), []
    for i, t in enumerate(texts):
        found = re.search(LINK_PATTERN, t, re.ASCII)
        link = found.group(0) if found else None
        if t in stored_texts or (link is not None and link in stored_links):
            continue
        kept.append(i)
        stored_texts.add(t)
        stored_links.add(link)
    return kept


def test_first_arrivals(spark):
    many = ARRIVALS + [f"text {i % 7} http://t.co/{i % 5}" if i % 3 else f"text {i % 4}" for i in range(60)]
    rows = posts(spark, *[post(i, t) for i, t in enumerate(many)])
    kept = sorted(r.id for r in dedup.first_arrivals(rows).collect())
    assert kept == pairwise(many)
    assert kept[:4] == [0, 2, 3, 5]


def test_store_blocks_repeats(spark):
    old = documents.to_documents(posts(spark, post(1, ARRIVALS[0]), post(2, ARRIVALS[3])))
    new = posts(spark, *[post(10 + i, t) for i, t in enumerate(ARRIVALS)])
    assert sorted(r.id for r in dedup.new_posts(new, old).collect()) == [12, 15]
    status = {r.id: r.status for r in dedup.insert_status(new, old).collect()}
    assert {i for i, s in status.items() if s == "inserted"} == {12, 15}
    assert len(status) == 6


# -- skewed lookups ---------------------------------------------------------------------------


def skewed(spark, n=3000):
    """A third of the rows under one key, the rest spread, some without key."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
        .alias("k"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_equals_plain_join(spark, how):
    facts = skewed(spark)
    table = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 700, 2)], "k string, v int")
    found = lookup(facts, table, ["k"], ["id"], count_rows(facts, ["k"]), how=how, share=0.1)
    plain = facts.join(table, "k", how)
    assert sorted(map(tuple, found.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, plain.select("id", "k", "v").collect()), key=str
    )


def test_hot_keys_are_bounded_by_the_share(spark):
    counts = count_rows(skewed(spark), ["k"])
    assert [r.k for r in hot_keys(counts, ["k"], "n_rows", 0.1).collect()] == ["hot"]
    assert hot_keys(counts, ["k"], "n_rows", 1 / 1000).count() < 1000


def test_page_contacts(spark):
    pages = spark.createDataFrame([("u1", "call 2125551234 a@b.com"), ("u2", "nothing")], "url string, html string")
    rows = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, None), (5, "u1")], "id bigint, link string")
    got = {r.id: (r.phone, r.email) for r in enrich.with_page_contacts(rows, pages).collect()}
    assert got == {
        1: (["2125551234"], ["a@b.com"]), 5: (["2125551234"], ["a@b.com"]), 2: ([], []),
        3: (None, None), 4: (None, None),
    }


# -- graph ------------------------------------------------------------------------------------


def graph_of(spark, *rows):
    return graph.graph_rows(documents.to_documents(posts(spark, *rows)))


def test_graph_fixture(spark):
    rows = graph_of(spark, post(100, "hi #A #a"), post(101, "RT hi #A", user=8, name="bob", original=100))
    people, vertices, tags = graph.persons(rows), graph.posts(rows), graph.tags(rows)
    assert sorted(r.name for r in people.collect()) == ["ann", "bob"]
    assert [(r.id, r.text) for r in vertices.orderBy("created_ms").collect()] == [
        ("100", "hi #A #a"), ("100", "RT hi #A"),
    ]
    assert [r.name for r in tags.collect()] == ["a"]
    named = (
        graph.posted_vertices(graph.posted(rows), vertices)
        .join(people, "person_key").join(vertices.select("post_key", "text"), "post_key")
    )
    assert sorted((r.name, r.relation, r.text) for r in named.collect()) == [
        ("ann", "TWEETED", "hi #A #a"), ("bob", "RETWEETED", "RT hi #A"), ("bob", "RETWEETED", "hi #A #a"),
    ]
    assert graph.tagged_vertices(graph.tagged(rows), vertices).count() == 2
    assert all(r.all_ok for r in graph.all_edges_made(rows, graph.tagged(rows)).collect())
    assert not any(r.all_ok for r in graph.all_edges_made(rows, graph.tagged(rows).limit(0)).collect())
    assert graph.names(people, vertices, tags).count() == 5


def test_renamed_user_is_two_persons_and_scores_reach_both(spark):
    rows = graph_of(spark, post(1, "a"), post(2, "b", name="anna"))
    people = graph.persons(rows)
    assert people.count() == 2
    score = spark.createDataFrame(
        [(7, 1, 2, 3, True)],
        "user_id bigint, avg_tweet_freq bigint, avg_tweet_reg bigint, tweet_freq_variance bigint, is_bot boolean",
    )
    scored = graph.score_persons(people, score)
    assert all(r.is_bot for r in scored.collect())
    assert all(r.is_bot for r in graph.score_persons(scored, score.limit(0)).collect())


def test_merging_twice_adds_nothing(spark):
    rows = graph_of(spark, post(1, "a #t"), post(2, "b #t"))
    people, edges = graph.persons(rows), graph.tagged(rows)
    assert graph.merge_vertices(people, people, "person_key").count() == 0
    keys = ["tweet_id", "tag"]
    merged = graph.merge_edges(edges, edges, *keys)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, edges.collect()))


def test_recommend(spark):
    rows = graph_of(
        spark, post(1, "#a #b"), post(2, "#a #b", user=8, name="bob"), post(3, "#a", user=9, name="cy"),
        post(4, "#z", user=9, name="cy"),
    )
    got = [tuple(r) for r in graph.recommend(rows, k=2).orderBy("person_id", "rank").collect()]
    assert ("7", 1, 2, 2) in got and ("8", 1, 1, 2) in got and ("9", 1, 2, 1) in got
    assert not any(person == "9" and p in (3, 4) for person, _, p, _ in got)


# -- classifier -------------------------------------------------------------------------------

CORPUS = [
    (i, t, label)
    for i, (t, label) in enumerate(
        [("we are hiring apply now", 1.0), ("great career job opening apply", 1.0),
         ("my job is boring today", 0.0), ("lovely weather at work", 0.0)] * 6
    )
]


def corpus(spark):
    return features.with_tokens(spark.createDataFrame(CORPUS, "id bigint, text string, label double"))


def test_tables_and_pipeline_agree(spark, tmp_path):
    docs = corpus(spark)
    side = F.col("id") % 4 != 3
    tables = classify.train_tables(docs, str(tmp_path / "m"), training=side, dimension=classify.HASHED_TERMS)
    fitted = classify.fit_pipeline(docs, training=side)
    unseen = features.with_tokens(
        spark.createDataFrame([(100, "apply for zebra jobs"), (101, "boring weather zebra"), (102, ""), (103, " ")],
                              "id bigint, text string")
    ).unionByName(docs.drop("label"))
    ml = {r.id: r.prediction for r in fitted.transform(unseen).collect()}
    predicted = tables.predict(features.term_freq(unseen, "id"), unseen.select("id"), "id")
    assert {r.id: r.prediction for r in predicted.collect()} == ml
    assert len(ml) == len(CORPUS) + 4

    saved = str(tmp_path / "pipeline")
    fitted.write().save(saved)
    restored = classify.PipelineModel.load(saved)
    assert {r.id: r.prediction for r in restored.transform(unseen).collect()} == ml


def test_accuracy_counts_the_other_side(spark, tmp_path):
    docs = corpus(spark)
    tables = classify.train_tables(docs, str(tmp_path / "m"))
    predicted = tables.predict(features.term_freq(docs, "id"), docs.select("id", "label"), "id")
    row = classify.accuracy(predicted).first()
    assert (row.accuracy, row.n) == (1.0, len(CORPUS))
    again = classify.NaiveBayesTables.load(spark, str(tmp_path / "m"))
    assert again.likelihoods().count() == 2 * again.terms.count()


def test_split_is_repeatable_and_near_its_share(spark):
    ids = spark.range(10_000).select((F.col("id") + 2**60).alias("id"))
    share = ids.select(F.avg(classify.in_training(F.col("id")).cast("int"))).first()[0]
    assert abs(share - 0.7) < 0.02


def test_classes_come_from_the_labels(spark, tmp_path):
    rows = [(1, ["red"], 0.0), (2, ["blue"], 1.0), (3, ["green"], 2.0), (4, ["green", "red"], 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>, label double")
    three = classify.train_tables(docs, str(tmp_path / "three"))
    assert three.classes == (0.0, 1.0, 2.0)
    found = three.predict(features.term_freq(docs, "doc_id"), docs, "doc_id")
    assert {r.doc_id: r.prediction for r in found.collect()}[3] == 2.0
    one = classify.train_tables(docs.filter("label = 1.0"), str(tmp_path / "one"))
    found = one.predict(features.term_freq(docs, "doc_id"), docs, "doc_id")
    assert {r.prediction for r in found.collect()} == {1.0}


def test_recommend_counts_all_shared_tags(spark):
    """The post that shares all tags is among the newest of none of them."""
    old = [post(1, "#a #b #c"), post(2, "#a #b #c", user=8, name="bob")]
    new = [post(10 + i, f"#{t}", user=20 + i, name=f"n{i}") for i, t in enumerate("abcabcabc")]
    got = graph.recommend(graph_of(spark, *old, *new), k=2).filter("person_id = '7'").orderBy("rank").collect()
    assert (got[0].post_id, got[0].shared) == (2, 3) and got[1].shared == 1 and len(got) == 2


def test_redelivered_post_is_inserted_once(spark):
    rows = [(1, "2024-01-01", "L:x"), (1, "2024-01-01", "L:x"), (2, "2024-01-02", "L:x"), (3, "2024-01-03", "L:y")]
    posts = spark.createDataFrame(rows, "id long, created_at string, repeat_key string")
    stored = spark.createDataFrame([("y", "h")], "link string, hash string")
    status = sorted((r.id, r.status) for r in dedup.insert_status(posts, stored).collect())
    assert status == [(1, "duplicate"), (1, "inserted"), (2, "duplicate"), (3, "duplicate")]


@pytest.mark.parametrize("same_time", [False, True])
def test_edges_of_a_hot_post_meet_its_vertices_in_even_cells(spark, same_time):
    """One id has a third of all posts, at different times or all at one."""
    n = 6000
    hot = F.col("id") % 3 == 0
    base = spark.range(n).select("id", F.when(hot, 0).otherwise(F.col("id") / 7).cast("int").cast("string").alias("tweet_id"))
    when = F.lit(10**12) if same_time else 10**12 + F.col("id") * 31
    vertices = base.select(F.col("tweet_id").alias("id"), when.alias("created_ms"), F.md5(F.col("id").cast("string")).alias("post_key"))
    edges = base.select(
        F.concat(F.lit("p"), F.col("id")).alias("person_key"), "tweet_id", F.lit("TWEETED").alias("relation"), when.alias("first_ms"),
        (when + F.col("id") % 50 * (0 if same_time else 997)).alias("last_ms"))
    got = graph.posted_vertices(edges, vertices).select("person_key", "post_key")
    v, plain = vertices.withColumnRenamed("id", "tweet_id"), None
    plain = edges.join(v, "tweet_id").filter("created_ms <= last_ms").select("person_key", "post_key")
    assert got.count() == plain.count() > n * 100 and got.exceptAll(plain).count() == 0
    at = F.col("created_ms") * 4096 + F.pmod(F.xxhash64("post_key"), F.lit(4096))
    left, right = graph._cells(
        edges.withColumn("until", F.col("last_ms") * 4096 + 4095), v.select("tweet_id", at.alias("at"), "post_key"))
    for side, most in ((left, 2 * 256), (right, 2 * 256)):
        sizes = sorted(r["count"] for r in side.filter("tweet_id = '0'").groupBy("part", "salt").count().collect())
        assert len(sizes) > 8 and sizes[-1] <= most and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_edges_without_vertices_or_ids(spark):
    edges = spark.createDataFrame(
        [("p", "1", "TWEETED", 1, 5), ("q", None, "TWEETED", 1, 5), ("r", "9", "TWEETED", 1, 5), ("s", "1", "TWEETED", 1, 2)],
        "person_key string, tweet_id string, relation string, first_ms long, last_ms long")
    vertices = spark.createDataFrame([("1", 3, "a"), ("1", 6, "b"), ("1", None, "c"), (None, 1, "d"), ("1", 5, "e")], "id string, created_ms long, post_key string")
    assert sorted(map(tuple, graph.posted_vertices(edges, vertices).collect())) == [("p", "a", "TWEETED"), ("p", "e", "TWEETED")]
    assert graph.posted_vertices(edges.limit(0), vertices).count() == graph.posted_vertices(edges, vertices.limit(0)).count() == 0


@pytest.mark.parametrize("heavy", [0, 3, 10])
def test_recommendation_with_a_tag_in_every_post(spark, heavy):
    """One tag is in every post, few posts share another one, and times tie."""
    rng = random.Random(heavy)
    rows = []
    for i in range(400):
        tags = ["all"] + [f"h{j}" for j in range(4) if rng.random() < 0.4] + [f"r{rng.randrange(90)}" for _ in range(rng.randrange(3))]
        rows.append((f"p{rng.randrange(25) if i % 3 else 0}", i, rng.randrange(60), tags))
    wanted = {}
    of = {}
    for person, _, _, tags in rows:
        of.setdefault(person, set()).update(tags)
    for person, own in of.items():
        ranked = sorted(((-len(own & set(t)), -ms, -i) for author, i, ms, t in rows if author != person))
        wanted[person] = [(-i, -n) for n, _, i in ranked[:5]]
    table = spark.createDataFrame(rows, "person_id string, post_id long, created_ms long, tags array<string>")
    got = {}
    for r in graph.recommend(table, heavy=heavy).orderBy("person_id", "rank").collect():
        got.setdefault(r.person_id, []).append((r.post_id, r.shared))
    assert got == wanted


def deriving(every):
    """All posts, or those with the times and ids of a table's rows."""
    return lambda only: every if only is None else every.join(only, dedup.same(every, only, ["created_at", "id"]), "left_semi")


def test_first_arrivals_of_derived_posts(spark):
    """Posts derived again for the rows that are first: rows that come twice, ids with several texts, nulls."""
    rows = [post(1, "a"), post(1, "a"), post(2, "b http://t.co/1"), post(2, "c"), post(3, "c"), post(None, "n", minutes=4), post(None, "n", minutes=4),
            post(5, None), post(6, None), post(7, "x http://t.co/1"), post(None, "m", minutes=9)]
    every = posts(spark, *rows)
    plain = lambda df: sorted((r.repeat_key or "", r.id or -1, r.text or "") for r in df.collect())
    expected = plain(dedup.first_arrivals(every))
    assert plain(dedup.first_derived(deriving(every))) == expected and len(expected) == 6
    root = scratch_path(spark, "store")
    keyed = dedup.with_repeat_key(every)
    keys = keyed.select("id", "created_at", "repeat_key")
    assert plain(dedup.unseen_derived(deriving(every), keys, root)) == plain(dedup.unseen_posts(keyed, root)) == expected


def test_texts_are_not_shuffled_for_their_keys(spark):
    asked = []

    def derive(only):
        asked.append(only)
        return deriving(posts(spark, *[post(i, f"text {i % 7}") for i in range(20)]))(only)

    plan = dedup.first_derived(derive)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and asked[0] is None and sorted(r.id for r in asked[1].collect()) == list(range(7))


def test_vertices_that_stand_twice(spark):
    rows = graph_of(spark, post(1, "a #t"), post(1, "a #t"), post(2, "b"), post(3, None))
    found = sorted(map(str, graph.whole_posts(rows).select(*sorted(graph.posts(rows).columns)).collect()))
    assert found == sorted(map(str, graph.posts(rows).select(*sorted(graph.posts(rows).columns)).collect())) and len(found) == 3
    once = graph.whole_posts(graph_of(spark, post(1, "a #t"), post(2, "b")))
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    slim = graph.posts(rows).select("id", "post_key")._jdf.queryExecution().optimizedPlan().toString()
    assert "first(text" not in slim


@pytest.mark.parametrize("block_tokens", [3, 1_000_000])
def test_blocks_predict_as_tables_do(spark, tmp_path, block_tokens):
    docs = features.with_tokens(spark.createDataFrame(CORPUS, "id bigint, text string, label double"))
    model = classify.train_tables(docs, str(tmp_path / "tables"))
    texts = [t for _, t, _ in CORPUS] + ["never seen words", "", " ", "apply apply apply"]
    asked = features.with_tokens(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string"))
    expected = {r.id: r.prediction for r in model.predict(features.term_freq(asked, "id"), asked.select("id"), "id").collect()}
    marked = asked.select("id", "tokens", (F.col("id") != 1).alias("wanted"))
    found = blocks.predict_texts(marked, model, "tokens", "wanted", block_tokens)
    assert found.columns == ["id", "wanted", "prediction"]
    assert {r.id: r.prediction for r in found.collect()} == expected | {1: 0.0} and len(set(expected.values())) == 2


@pytest.mark.parametrize("block_tokens", [3, 1_000_000])
def test_blocks_stem_their_distinct_words_only(spark, tmp_path, block_tokens):
    """Words that are stemmed block by block give the model and the predictions that stemmed tokens give."""
    frame = spark.createDataFrame([*CORPUS, (90, "jobs job JOB apply applied applying", None), (91, None, 1.0)], "id bigint, text string, label double")
    stems, words = features.with_tokens(frame), features.with_tokens(frame, stemmed=False)
    counted = blocks.class_counts(words, "label", (0.0, 1.0), "tokens", block_tokens)
    found = {r.term: (r.df, r.a, r.b) for r in counted.groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("tf_0").alias("a"), F.sum("tf_1").alias("b")).collect()}
    plain = {}
    for r in features.term_freq(stems, "label").collect():
        df, a, b = plain.get(r.term, (0, 0, 0))
        plain[r.term] = (df + 1, a + r.tf * (r.label == 0.0), b + r.tf * (r.label == 1.0))
    assert found == plain and found["job"][0] >= 1
    assert "transform(tokens" not in counted._jdf.queryExecution().optimizedPlan().toString()  # stems are not made of each text's tokens
    side = F.col("id") % 4 != 3
    one = classify.train_tables(stems, str(tmp_path / "one"), training=side)
    two = classify.train_tables(words, str(tmp_path / "two"), training=side, stemmed=False)
    for name in ("priors", "totals", "terms"):
        left, right = getattr(one, name), getattr(two, name)
        assert left.schema.simpleString() == right.schema.simpleString()
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    predicted = [
        {r.id: r.prediction for r in blocks.predict_texts(
            docs.select("id", "tokens", (F.col("id") != 1).alias("wanted")), one, "tokens", "wanted", block_tokens, stemmed).collect()}
        for docs, stemmed in ((stems, True), (words, False))]
    assert predicted[0] == predicted[1] and len(predicted[0]) == frame.count()
