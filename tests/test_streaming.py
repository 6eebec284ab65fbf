import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlark.operators import classify, dedup, features, filters
from postlark.plans import jobs
from postlark.session import scratch_path, stage
from postlark.sources import messages, stores
from postlark.streaming import jobs as streams
from postlark.streaming import repeats
from test_operators import CORPUS, post, posts

LONG = " and some more words to get past the length that a post needs to be looked at at all"


@pytest.fixture(scope="module")
def model(spark):
    docs = features.with_tokens(spark.createDataFrame(CORPUS, "id bigint, text string, label double"))
    return classify.fit_pipeline(docs)


@pytest.fixture(scope="module")
def arriving(spark):
    """Three files of posts in order of time, with repeats inside and between the files."""
    texts = ["we are hiring apply now http://t.co/1" + LONG, "great career job opening apply #Jobs" + LONG,
             "lovely weather today" + LONG, "short job", "boring work" + LONG]
    return [
        posts(spark, *[post(10 * f + i, texts[(f + i) % 5], user=i % 2) for i in range(5)]) for f in range(3)
    ]


def union(frames):
    whole = frames[0]
    for other in frames[1:]:
        whole = whole.unionByName(other)
    return whole


@pytest.fixture(scope="module")
def inbox(spark, arriving):
    """The posts as messages, one folder scan per file, with damaged lines between them."""
    path = scratch_path(spark, "inbox")
    os.makedirs(path)
    for f, frame in enumerate(arriving):
        lines = [r.value for r in messages.encode_posts(frame).select(F.col("value").cast("string")).collect()]
        with open(f"{path}/{f}.txt", "w") as out:
            out.write("\n".join([*lines, "!!!notb64"]) + "\n")
        os.utime(f"{path}/{f}.txt", (1_700_000_000 + f, 1_700_000_000 + f))
    return path


def test_scoring_a_stream_equals_scoring_the_table(spark, arriving, inbox, model):
    decoded = messages.decode_messages(messages.read_message_files(spark, inbox, maxFilesPerTrigger="1"))
    scored = streams.score(messages.valid_posts(decoded), model).select("id", "matched", "prediction")
    got = streams.run_to_files(scored, scratch_path(spark, "out"), scratch_path(spark, "ck"))
    expected = streams.score(union(arriving), model).select("id", "matched", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert {r.prediction for r in expected.collect()} == {0.0, 1.0}


def test_streaming_duplicate_removal_equals_the_table(spark, arriving, inbox):
    decoded = messages.decode_messages(messages.read_message_files(spark, inbox, maxFilesPerTrigger="1"))
    kept = streams.without_repeats(messages.valid_posts(decoded)).select("repeat_key")
    got = streams.run_to_files(kept, scratch_path(spark, "out"), scratch_path(spark, "ck"))
    expected = dedup.first_arrivals(union(arriving)).select("repeat_key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_word_count_on_a_stream(spark, arriving):
    path = scratch_path(spark, "texts")
    for frame in arriving:
        frame.select("text").write.mode("append").parquet(path)
    stream = spark.readStream.schema("text string").option("maxFilesPerTrigger", "2").parquet(path)
    got = streams.run_counts(stream, scratch_path(spark, "n"), scratch_path(spark, "ck"))
    expected = features.word_count(union(arriving))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    each = streams.run_batch_counts(stream, scratch_path(spark, "n"), scratch_path(spark, "ck")).collect()
    assert len({r.batch_id for r in each}) > 1 and len(each) == len({(r.batch_id, r.word) for r in each})
    assert sum(r.n for r in each) == sum(r.n for r in expected.collect())


def test_the_store_job_stores_what_the_batch_would(spark, arriving, inbox, model):
    root = scratch_path(spark, "store")
    checkpoint = scratch_path(spark, "ck")
    for _ in range(2):  # A restart with nothing new adds nothing.
        stream = messages.read_message_files(spark, inbox, maxFilesPerTrigger="1")
        streams.start_store(stream, model, root, checkpoint, interval=None).awaitTermination()
    wanted = streams.accepted(streams.score(union(arriving), model))
    expected = sorted(r.id for r in dedup.first_arrivals(wanted).collect())
    documents = stores.read(spark, root, "documents")
    assert expected and sorted(r.post_id for r in documents.collect()) == expected
    assert stores.read(spark, root, "posts").count() == len(expected)
    assert spark.read.parquet(f"{root}/rejects").count() == 3
    # Batch 0 run again, with later batches already stored, leaves the documents as they are.
    first = spark.read.text(f"{inbox}/0.txt")
    streams.store_batch(first, 0, root, model)
    assert sorted(r.post_id for r in stores.read(spark, root, "documents").collect()) == expected


def test_the_store_job_by_state_stores_the_same(spark, arriving, inbox, model):
    root = scratch_path(spark, "store")
    read = lambda: messages.read_message_files(spark, inbox, maxFilesPerTrigger="1")
    for query in streams.start_store_by_state(read(), model, root, scratch_path(spark, "ck"), interval=None):
        query.awaitTermination()
    streams.start_rejects(read(), root, scratch_path(spark, "ck"), interval=None).awaitTermination()
    wanted = streams.accepted(streams.score(union(arriving), model))
    expected = dedup.first_arrivals(wanted)
    stored = stores.read(spark, root, "documents")
    assert sorted(r.hash for r in stored.collect()) == sorted(
        r.h for r in expected.select(F.md5("text").alias("h")).collect()
    )
    assert spark.read.parquet(f"{root}/rejects").count() == 3


def stored_ids(spark, root):
    return sorted(r.post_id for r in stores.read(spark, root, "documents").collect())


def test_a_new_checkpoint_admits_no_stored_post(spark, arriving, inbox, model):
    """Both store jobs, started anew over a filled store, with one more file of which one post is new."""
    root, more = scratch_path(spark, "store"), scratch_path(spark, "more")
    read = lambda path: messages.read_message_files(spark, path)
    streams.start_store(read(inbox), model, root, scratch_path(spark, "ck"), interval=None).awaitTermination()
    before = stored_ids(spark, root)
    repeat = [r for r in union(arriving).collect() if r.id in before][0]
    for n in (900, 901):
        fresh = posts(spark, post(n, f"great career job opening apply {n}" + LONG), post(n + 10, repeat.text))
        messages.write_message_files(fresh.coalesce(1), more)
        if n == 900:
            for query in streams.start_store_by_state(read(more), model, root, scratch_path(spark, "ck"), interval=None):
                query.awaitTermination()
        else:
            streams.start_store(read(more), model, root, scratch_path(spark, "ck"), interval=None).awaitTermination()
        assert stored_ids(spark, root) == before + list(range(900, n + 1))


def test_state_forgets_after_the_horizon(spark):
    """Earliest of a batch wins, known keys are dropped, and forgotten ones come again."""
    inbox = scratch_path(spark, "slim")
    slim = "k1 long, k2 long, created_at timestamp, id long, file string"
    stored = spark.createDataFrame([(7, 7)], "k1 long, k2 long")
    rounds = [[(1, 1, 5), (1, 1, 3), (7, 7, 1)], [(1, 1, 2), (2, 2, 9)], [(7, 7, 8)]]

    def run(horizon):
        checkpoint, out = scratch_path(spark, "ck"), []
        for rows in rounds:
            frame = spark.createDataFrame([(a, b, i, i, "f") for a, b, i in rows], "k1 long, k2 long, s long, id long, file string")
            path = f"{inbox}{horizon}"
            frame.select("k1", "k2", F.timestamp_seconds("s").alias("created_at"), "id", "file").coalesce(1).write.mode("append").parquet(path)
            found = streams.first_arrivals_by_state(spark.readStream.schema(slim).parquet(path), stored, horizon, int(time.time() * 1000))
            found.writeStream.foreachBatch(lambda b, _: out.extend(r.id for r in b.collect())).option(
                "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(out)

    assert run(10**10) == [3, 9]
    assert run(1) == [1, 2, 3, 8, 9] or run(1) == [2, 3, 8, 9]  # a horizon of a millisecond blocks nothing that comes later


def test_table_models_score_batches_as_they_score_tables(spark, arriving, inbox):
    docs = features.with_tokens(spark.createDataFrame(CORPUS, "id bigint, text string, label double"))
    tables = classify.train_tables(docs, scratch_path(spark, "tables"))
    decoded = messages.valid_posts(messages.decode_messages(messages.read_message_files(spark, inbox, maxFilesPerTrigger="1")))
    got = streams.run_scores(decoded, tables, scratch_path(spark, "out"), scratch_path(spark, "ck"))
    expected = streams.score(union(arriving), tables).select("id", "matched", "prediction")
    assert got.select("batch_id").distinct().count() == 3
    assert sorted(map(tuple, got.drop("batch_id").collect())) == sorted(map(tuple, expected.collect()))
    root = scratch_path(spark, "store")
    streams.start_store(messages.read_message_files(spark, inbox, maxFilesPerTrigger="1"), tables, root, scratch_path(spark, "ck"), interval=None).awaitTermination()
    wanted = dedup.first_arrivals(streams.accepted(streams.score(union(arriving), tables)))
    assert stored_ids(spark, root) == sorted(r.id for r in wanted.collect())
    counts = stores.read(spark, root, "counts").agg(F.sum("messages"), F.sum("rejected"), F.sum("late"), F.sum("stored")).first()
    assert tuple(counts) == (18, 3, 15, len(stored_ids(spark, root)))


def test_a_batch_that_dies_between_its_writes_is_made_whole(spark, arriving, inbox, model, monkeypatch):
    """The first run stops after the documents are committed and before the graph is written; the next one mends it."""
    root, checkpoint = scratch_path(spark, "store"), scratch_path(spark, "ck")
    read = lambda: messages.read_message_files(spark, inbox, maxFilesPerTrigger="1")
    with monkeypatch.context() as broken:
        broken.setattr(stores, "append_graph", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            streams.start_store(read(), model, root, checkpoint, interval=None).awaitTermination()
    assert stores.read(spark, root, "posts").count() == 0 < len(stored_ids(spark, root))
    streams.start_store(read(), model, root, checkpoint, interval=None).awaitTermination()
    expected = dedup.first_arrivals(streams.accepted(streams.score(union(arriving), model)))
    assert stored_ids(spark, root) == sorted(r.id for r in expected.collect())
    assert stores.read(spark, root, "posts").count() == len(stored_ids(spark, root))


def test_jobs_that_run_every_interval(spark, arriving, inbox, model):
    read = lambda: messages.read_message_files(spark, inbox, maxFilesPerTrigger="1")
    shown = streams.print_texts(read(), "1 second", "memory", "shown")
    root = scratch_path(spark, "store")
    storing = streams.start_store(read(), model, root, scratch_path(spark, "ck"), interval="1 second")
    for query in (shown, storing):
        query.processAllAvailable()
        query.stop()
    assert sorted(r.text for r in spark.table("shown").collect()) == sorted(r.text for r in union(arriving).collect())
    wanted = dedup.first_arrivals(streams.accepted(streams.score(union(arriving), model)))
    assert stored_ids(spark, root) == sorted(r.id for r in wanted.collect())


def test_bot_check_job(spark):
    history = spark.createDataFrame(
        [(u, f"2024-01-01 00:{m:02d}:00", u * 100 + m) for u in range(3) for m in range(0, 30, 10)],
        "user_id bigint, s string, post_id bigint",
    ).select("user_id", F.col("s").cast("timestamp").alias("ts"), "post_id")
    people = spark.range(5).select(F.col("id").alias("user_id"))
    done = people.filter("user_id = 0")
    scores = {r.user_id: tuple(r)[1:] for r in jobs.check_bots(people, done, history, batch=3).collect()}
    assert scores == {1: (600, 0, 0, True), 2: (600, 0, 0, True), 3: (0, 0, 0, True)}
    assert jobs.check_bots(people, done, history, batch=None).count() == 4


def test_late_posts_are_kept(spark, tmp_path):
    """A post older than the horizon that arrives after newer ones is no repeat of theirs."""
    inbox = tmp_path / "late"
    rows = [(1, "2024-03-01", "a"), (2, "2024-03-02", "b"), (3, "2024-01-01", "c"), (4, "2024-03-03", "a")]
    for id_, day, text in rows:
        spark.createDataFrame([(id_, day, text)], "id long, day string, text string").coalesce(1).write.mode("append").json(str(inbox))
    stream = spark.readStream.schema("id long, day string, text string").option("maxFilesPerTrigger", 1).json(str(inbox))
    posts = stream.withColumn("created_at", F.to_timestamp("day"))
    kept = streams.run_to_files(
        streams.without_repeats(posts).select("id", "text"), str(tmp_path / "kept"), str(tmp_path / "checkpoint"))
    assert sorted(r.text for r in kept.collect()) == ["a", "b", "c"]


def test_deliveries_are_written_once_and_packed(spark):
    from datetime import datetime

    from postlark.plans import queries

    every = posts(spark, *[post(n, f"job {n}") for n in range(4)]).withColumn("favorites", F.lit(3).cast("bigint"))
    days = [datetime(2024, 1, 5), datetime(2024, 1, 15), datetime(2023, 1, 1), None]
    dated = every.drop("created_at").join(spark.createDataFrame(list(enumerate(days)), "id bigint, created_at timestamp"), "id")
    path = queries._deliver(spark, dated.select(*every.columns))
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert [spark.read.text(f"{path}/delivery={n}").count() for n in (0, 1)] == [1, 1]
    assert not stores.move_folder(spark, f"{path}/delivery=2", f"{path}/moved/2")


def test_a_store_batch_writes_no_message_that_it_decoded(spark, arriving, inbox, model, monkeypatch):
    """Of decoded messages only undecodable ones and posts in language and length are written, the latter without their message."""
    written = []
    monkeypatch.setattr(streams, "stage", lambda df, name: written.append((name, df)) or stage(df, name))
    streams.store_batch(spark.read.text(inbox), 0, scratch_path(spark, "store"), model)
    decoded = dict(written)["decoded"].collect()
    assert {r.value for r in decoded} == {None, "!!!notb64"} and "short job" not in {r.post.text for r in decoded if r.post}


def test_state_is_one_value_for_a_bucket_of_keys(spark, monkeypatch):
    """What is let through is what a plain version lets through, and the state has no row for each key."""
    monkeypatch.setattr(repeats, "BUCKETS", 3)
    inbox, checkpoint, passed, state = scratch_path(spark, "slim"), scratch_path(spark, "ck"), [], []
    slim = "k1 long, k2 long, created_at timestamp, id long, file string"
    stored = spark.createDataFrame([(k, k) for k in range(5)], "k1 long, k2 long")
    rounds = [[(k % 23, None if k % 31 == 3 else 40 - k % 7, k) for k in range(60)], [(k % 40, k % 3, 100 + k) for k in range(60)]]
    known, expected = set(range(5)), []
    for rows in rounds:
        first = {}
        for key, second, row in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
            first.setdefault(key, row)
        expected += [row for key, row in first.items() if key not in known]
        known |= set(first)
        frame = spark.createDataFrame([(k, k, at, i, "f") for k, at, i in rows], "k1 long, k2 long, s long, id long, file string")
        frame.select("k1", "k2", F.timestamp_seconds("s").alias("created_at"), "id", "file").repartition(3).write.mode("append").parquet(inbox)
        found = repeats.first_arrivals_by_state(spark.readStream.schema(slim).parquet(inbox), stored, 10**10, int(time.time() * 1000))
        query = found.writeStream.foreachBatch(lambda b, _: passed.extend(r.id for r in b.collect())).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        state.append(max(p.stateOperators[0].numRowsTotal for p in query.recentProgress))
    assert sorted(passed) == sorted(expected) and len(passed) == 35
    assert max(state) < 12  # a value and a timer or two for each of three buckets, with 40 keys


def test_timers_of_a_bucket_forget_the_keys_that_ran_out():
    class Handle:
        def __init__(self):
            self.value, self.timers = None, []

        def getValueState(self, *_):  # noqa: N802
            return self

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

        def registerTimer(self, at):  # noqa: N802
            self.timers.append(at)

    class Expired:
        def __init__(self, at):
            self.getExpiryTimeInMs = lambda: at  # noqa: N802

    handle, bucket = Handle(), repeats.FirstOfKey(100, 0)
    bucket.init(handle)

    def arrive(at, *keys):
        rows = pd.DataFrame([(k, k, pd.Timestamp(n), n, "f", at) for n, k in enumerate(keys)],
                            columns=["k1", "k2", "created_at", "id", "file", "arrived_ms"])
        return [k for frame in bucket.handleInputRows((0,), iter([rows]), None) for k in frame["k1"].tolist()]

    assert arrive(10, 1, 2, 1) == [1, 2] and arrive(50, 2, 3) == [3] and handle.timers == [110]
    list(bucket.handleExpiredTimer((0,), None, Expired(110)))
    assert handle.timers == [110, 150] and arrive(120, 1, 3) == [1]
    assert arrive(155, 3) == [3]  # run out, though its timer has not fired
    list(bucket.handleExpiredTimer((0,), None, Expired(150)))
    list(bucket.handleExpiredTimer((0,), None, Expired(300)))
    assert handle.timers[:3] == [110, 150, 220] and handle.value is None


def test_messages_are_parsed_once_whatever_is_asked_of_the_posts(spark, inbox):
    lines = spark.read.text(inbox)
    once = filters.in_language_and_long(messages.decoded_posts(lines))
    assert once._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    plain = filters.in_language_and_long(messages.valid_posts(messages.decode_messages(lines)))
    assert once.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect())) and once.count() == 12


def test_messages_that_are_null_are_not_delivered(spark):
    from postlark.plans import queries

    kinds = [0, 1, 2, 3, 9, 6, None]
    every = posts(spark, *[post(n, f"job {n}") for n in range(len(kinds))]).drop("favorites").join(
        spark.createDataFrame(list(enumerate(kinds)), "id bigint, favorites bigint"), "id")
    path = queries._deliver(spark, every.select(*posts(spark, post(0)).columns))
    lines = spark.read.text(f"{path}/delivery=0")
    assert sorted(r.id for r in messages.decoded_posts(lines).select("id").collect()) == [3, 5]
    assert lines.count() == 4
