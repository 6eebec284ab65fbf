import base64
import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from postlark.functions.text import one_line
from postlark.operators import aggregators, graph
from postlark.operators.documents import to_documents
from postlark.plans import jobs
from postlark.session import scratch_path
from postlark.sources import corpus, messages, search, sites, stores
from test_operators import START, post, posts

LINES = """Ann Example|#|1001|#|Wed Mar 13 09:41:05 +0000 2019|#|| Some, Town ||#|We are hiring! Apply now|#|1
Bob Example|#|1002|#|Wed Mar 13 09:41:06 +0000 2019|#||#|lovely weather today|#|0
broken row|#|1003
"""


def test_corpus_rows_and_rejects(spark, tmp_path):
    (tmp_path / "corpus.txt").write_text(LINES)
    good = corpus.read_corpus(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r.id, r.location, r.label) for r in good] == [(1001, "| Some, Town |", 1.0), (1002, "", 0.0)]
    assert good[0].created_at == datetime(2019, 3, 13, 9, 41, 5)
    assert [r.value for r in corpus.read_corpus_rejects(spark, str(tmp_path)).collect()] == ["broken row|#|1003"]


def test_corpus_appends_and_keeps_a_row_on_one_line(spark, tmp_path):
    rows = spark.createDataFrame(
        [("A\nB", 1, "Wed Mar 13 09:41:05 +0000 2019", "x\ny", "one\ntwo\rthree"), (None, 2, None, None, "t")],
        "username string, id bigint, created_at string, location string, text string",
    )
    path = str(tmp_path / "c")
    corpus.append_corpus(rows, path)
    corpus.append_corpus(rows, path, F.lit(1))
    back = corpus.read_corpus(spark, path)
    assert back.count() == 4
    one = back.filter("id = 1 AND label = 1").first()
    assert (one.username, one.location, one.text) == ("A B", "xy", "one two\rthree")


def test_bad_messages_are_set_apart(spark):
    good = posts(spark, post(1, "hi"), post(2, "RT é", original=1))
    encoded = messages.encode_posts(good)
    bad = [None, "!!!notb64", base64.b64encode(b"{bad").decode(), base64.b64encode(b"\xff\xfe{}").decode(),
           base64.b64encode(b"{}").decode(), "====", ""]
    damaged = spark.createDataFrame([(b,) for b in bad], "value string").select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
    decoded = messages.decode_messages(encoded.unionByName(damaged))
    back = messages.valid_posts(decoded)
    assert sorted(map(str, back.collect())) == sorted(map(str, good.collect()))
    assert messages.rejected_messages(decoded).count() == len(bad)


def test_envelope_of_nothing_is_nothing(spark):
    none = F.lit(None).cast("struct<id:bigint>")
    assert spark.range(1).select(messages.encode_post(none)).first()[0] is None


def test_search_responses(spark, tmp_path):
    status = {"created_at": "Wed Mar 13 09:41:05 +0000 2019", "id": 5, "text": "Hiring\nnow", "extra": 1,
              "user": {"name": "Ann", "location": "Town"}}
    lines = [json.dumps({"statuses": [status, {**status, "id": 6, "text": "nothing"}]}), json.dumps({"statuses": []})]
    (tmp_path / "r.json").write_text("\n".join(lines))
    found = search.found_posts(search.read_responses(spark, str(tmp_path)), "hiring")
    assert [tuple(r) for r in found.collect()] == [
        ("Ann", 5, "Wed Mar 13 09:41:05 +0000 2019", "Town", "Hiring\nnow")
    ]
    out = str(tmp_path / "corpus")
    jobs.collect(spark, str(tmp_path / "r.json"), "hiring", out)
    row = corpus.read_corpus(spark, out).first()
    assert (row.id, row.text, row.label) == (5, "Hiring now", 0.0)


def test_a_table_of_sites(spark, tmp_path):
    (tmp_path / "sites.txt").write_text("a.com\n\n b.com \ny+z\nq\n")
    listed = sites.read_sites(spark, str(tmp_path))
    rows = [("x", "via A.com"), ("y", "c.com"), ("z", None), ("za", "axcom"), ("zb", "an y+z job"), ("zc", ""), ("zd", "Q"), ("ze", "y+ +z")]
    posts = spark.createDataFrame(rows, "id string, source string")
    flagged = aggregators.flag_aggregators(posts, listed)
    assert flagged.columns == ["id", "source", "third_party"]
    assert [r.third_party for r in flagged.orderBy("id").collect()] == [True, False, False, False, True, False, True, False]
    assert not any(r.third_party for r in aggregators.flag_aggregators(posts, listed.limit(0)).collect())
    assert aggregators.flag_aggregators(posts.limit(0), listed).count() == 0
    assert len(sites.AGGREGATOR_SITES) == len(set(sites.AGGREGATOR_SITES)) == 70


def test_a_hundred_thousand_sites(spark):
    """A third of all posts have one source; the table's answer is the literal rule's."""
    listed = spark.range(100_000).select(F.concat(F.lit("site"), F.col("id") * 7, F.lit(".example")).alias("site"))
    number = F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id"))
    posts = spark.range(3000).select("id", F.concat(F.lit("<a href=http://Site"), number, F.lit(".example>")).alias("source"))
    got = {r.id: r.third_party for r in aggregators.flag_aggregators(posts, listed).collect()}
    assert got == {i: i % 3 == 0 or i % 7 == 0 for i in range(3000)}


def test_training_job(spark, tmp_path):
    texts = [("we are hiring apply now", 1), ("lovely weather at work", 0)]
    lines = [f"u|#|{i}|#|Wed Mar 13 09:41:05 +0000 2019|#||#|{texts[i % 2][0]}|#|{texts[i % 2][1]}" for i in range(60)]
    (tmp_path / "corpus.txt").write_text("\n".join(lines) + "\n")
    model = str(tmp_path / "model")
    row = jobs.train(spark, str(tmp_path / "corpus.txt"), model).first()
    assert row.accuracy == 1.0 and 0 < row.n < 60
    assert len(jobs.load_model(model).stages) == 3


def store_rows(spark, root, name):
    return sorted(str(r) for r in stores.read(spark, root, name).drop("batch_id").collect())


def test_running_a_batch_again_changes_nothing(spark):
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    first = to_documents(posts(spark, post(1, "a #t http://t.co/1"), post(2, "b #t")))
    second = to_documents(posts(spark, post(3, "c #t #u", user=8), post(4, "d #t")))
    for batch_id, docs in ((0, first), (1, second)):
        stores.append_documents(docs, root, batch_id)
        stores.append_graph(graph.graph_rows(docs), root, batch_id)
    before = {name: store_rows(spark, root, name) for name in stores.SCHEMAS}
    stores.append_documents(second, root, 1)
    stores.append_graph(graph.graph_rows(second), root, 1)
    assert {name: store_rows(spark, root, name) for name in stores.SCHEMAS} == before
    assert len(before["documents"]) == 4
    assert [stores.read_vertices(spark, root, n).count() for n in ("persons", "posts", "tags")] == [2, 4, 2]
    whole = graph.graph_rows(first.unionByName(second))
    assert stores.read_edges(spark, root, "tagged").count() == graph.tagged(whole).count()


def test_a_batch_run_again_with_other_rows_is_replaced_whole(spark):
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    for winner in (post(1, "a", minutes=0), post(2, "a", minutes=5000)):  # on different days
        stores.append_documents(to_documents(posts(spark, winner)), root, 5)
    assert [r.post_id for r in stores.read(spark, root, "documents").collect()] == [2]


def test_compaction_changes_no_vertex_or_edge(spark):
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    for batch_id in range(3):
        docs = to_documents(posts(spark, post(1, "a #t"), post(10 + batch_id, "b #t #u", user=batch_id)))
        stores.append_graph(graph.graph_rows(docs), root, batch_id)
    seen = lambda: {n: sorted(str(r) for r in (
        stores.read_vertices if n in stores.VERTEX_KEYS else stores.read_edges)(spark, root, n).collect())
        for n in (*stores.VERTEX_KEYS, *stores.EDGE_KEYS)}
    before = seen()
    for below in (2, 2, 3):
        stores.compact_graph(spark, root, below)
        assert seen() == before
    assert [r.batch_id for r in stores.read(spark, root, "tags").select("batch_id").distinct().collect()] == [-3]


def test_retention_on_the_store(spark):
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    for batch_id in range(2):
        rows = [post(10 * batch_id + i, minutes=i * 360) for i in range(8)]
        stores.append_documents(to_documents(posts(spark, *rows)), root, batch_id)
    cutoff = START + timedelta(minutes=360 * 5)
    for _ in range(2):
        stores.purge_documents(spark, root, F.lit(cutoff))
        left = sorted(r.post_id for r in stores.read(spark, root, "documents").collect())
        assert left == [5, 6, 7, 15, 16, 17]


def test_bot_scores_reach_the_store(spark):
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    docs = to_documents(posts(spark, *[post(i, user=i % 3) for i in range(6)]))
    stores.append_documents(docs, root, 0)
    stores.append_graph(graph.graph_rows(docs), root, 0)
    history = docs.select(F.col("user.id").alias("user_id"), F.col("created_at").alias("ts"), "post_id")
    for run, people in ((0, [0, 1]), (0, [0, 1]), (1, [2])):
        assert sorted(r.user_id for r in jobs.check_store(spark, root, history, run, batch=2).collect()) == people
        done = {r.id for r in stores.scored_persons(spark, root).filter("is_bot is not null").collect()}
        assert done == {str(u) for u in range(2 + run)}
    assert stores.scored_documents(spark, root).filter("metadata is null").count() == 0


def test_purge_drops_old_days_and_trims_the_cutoff_day(spark):
    rows = [post(i, minutes=i * 360) for i in range(12)]
    docs = to_documents(posts(spark, *rows)).withColumn("created_date", F.to_date("created_at"))
    undated = docs.limit(1).withColumns(
        {"created_at": F.lit(None).cast("timestamp"), "created_date": F.lit(None).cast("date"), "post_id": F.lit(99).cast("bigint")}
    )
    stores.save_table(docs.unionByName(undated), "kept_posts", "created_date")
    cutoff = START + timedelta(minutes=360 * 5)
    for _ in range(2):
        stores.purge_table(spark, "kept_posts", F.lit(cutoff))
        left = sorted(r.post_id for r in spark.table("kept_posts").select("post_id").collect())
        assert left == [*range(5, 12), 99]
    spark.sql("DROP TABLE kept_posts")


def test_retire(spark):
    docs = to_documents(posts(spark, post(1, minutes=0), post(2, minutes=60)))
    now = F.lit(START + timedelta(days=30, minutes=30))
    assert [r.post_id for r in jobs.retire(docs, now).collect()] == [2]


def test_one_line_of_null(spark):
    assert spark.range(1).select(one_line(F.lit(None).cast("string"))).first()[0] is None
