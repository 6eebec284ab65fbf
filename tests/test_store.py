"""The versions of a store, its key index, and upkeep beside writers."""

import os
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.operators import dedup
from postlark.operators.documents import to_documents
from postlark.session import scratch_path
from postlark.sources import keyindex, stores, versions
from postlark.sources.versions import Conflict, Part
from test_operators import START, post, posts


def ids(spark, root, version=None):
    return sorted(r.post_id for r in stores.read(spark, root, "documents", version).collect())


def batch(spark, root, n, *rows):
    stores.append_documents(to_documents(posts(spark, *rows)), root, n)


def test_versions_are_committed_once(spark, tmp_path):
    root = str(tmp_path / "store")
    one, two, other = Part("t", 0, "", "t/a"), Part("t", 1, "", "t/b"), Part("t", 2, "", "t/c")
    assert versions.read_version(spark, root).number == 0
    versions.commit(spark, root, versions.replacing((), [one]))
    looks = []

    def slow(now):
        looks.append(now.number)
        if len(looks) == 1:  # another writer is first
            versions.commit(spark, root, versions.replacing((), [other]))
        return versions.replacing([one], [two], note="x")(now)

    assert versions.commit(spark, root, slow).number == 3 and looks == [1, 2]
    now = versions.read_version(spark, root)
    assert set(now.parts) == {two, other} and now.settings == {"note": "x"}
    with pytest.raises(Conflict):
        versions.commit(spark, root, versions.replacing([one], []))
    assert versions.read_version(spark, root, 1).parts == (one,) and versions.read_version(spark, root).number == 3
    assert not any("." == n[0] and not n.endswith(".crc") for n in os.listdir(f"{root}/_versions"))


def test_a_reader_keeps_its_version_while_the_store_changes(spark):
    root = scratch_path(spark, "store")
    for n in range(3):
        batch(spark, root, n, *[post(10 * n + i, f"text {n} {i}", minutes=i * 700) for i in range(4)])
    whole = ids(spark, root)
    reader = stores.read(spark, root, "documents")
    stores.compact_documents(spark, root, 2)
    assert ids(spark, root) == whole
    stores.compact_documents(spark, root, 2)
    assert len({p.folder.split("/")[1] for p in versions.read_version(spark, root).of("documents")}) == 2
    stores.purge_documents(spark, root, F.lit(START + timedelta(minutes=1000)))
    left = [i for i in whole if i % 10 >= 2]
    assert ids(spark, root) == left
    assert sorted(r.post_id for r in reader.collect()) == whole  # files stay until they are swept
    stores.vacuum(spark, root, versions_kept=1, older_ms=0)
    assert ids(spark, root) == left
    folders = {p.folder.split("/")[1] for p in versions.read_version(spark, root).of("documents")}
    assert folders == {n for n in os.listdir(f"{root}/documents") if n.startswith("write=")}


def test_a_writer_that_dies_leaves_no_trace(spark, monkeypatch):
    root = scratch_path(spark, "store")
    batch(spark, root, 0, post(1, "a"), post(2, "b"))
    with monkeypatch.context() as broken:
        broken.setattr(keyindex, "write_keys", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batch(spark, root, 1, post(3, "c"))
    assert ids(spark, root) == [1, 2] and len(os.listdir(f"{root}/documents")) == 2
    stores.vacuum(spark, root, older_ms=0)
    assert ids(spark, root) == [1, 2] and len(os.listdir(f"{root}/documents")) == 1
    batch(spark, root, 1, post(3, "c"))
    assert ids(spark, root) == [1, 2, 3]


def test_a_batch_that_lands_during_retention_is_kept_and_trimmed(spark, monkeypatch):
    root = scratch_path(spark, "store")
    batch(spark, root, 0, post(1, "a", minutes=0), post(2, "b", minutes=1500), post(3, "c", minutes=3000))
    write, landed = versions.write_parts, []

    def slow(df, *args, **kwargs):
        if not landed:
            landed.append(True)
            batch(spark, root, 1, post(4, "d", minutes=10), post(5, "e", minutes=1450), post(6, "f", minutes=1700))
        return write(df, *args, **kwargs)

    monkeypatch.setattr(versions, "write_parts", slow)
    stores.purge_documents(spark, root, F.lit(START + timedelta(minutes=1460)))
    assert landed and ids(spark, root) == [2, 3, 6]
    monkeypatch.undo()
    again = posts(spark, post(11, "a", minutes=0), post(12, "b"), post(16, "f"), post(17, "new"))
    assert sorted(r.id for r in dedup.unseen_posts(again, root).collect()) == [11, 17]  # what was removed may come again
    stores.compact_documents(spark, root, 2)
    assert ids(spark, root) == [2, 3, 6]
    assert sorted(r.id for r in dedup.unseen_posts(again, root).collect()) == [11, 17]
    assert keyindex.stored_hashes(spark, root, versions.read_version(spark, root)).count() == 3


def test_compaction_gives_way_to_retention(spark, monkeypatch):
    root = scratch_path(spark, "store")
    for n in range(2):
        batch(spark, root, n, post(10 * n, f"a{n}", minutes=0), post(10 * n + 1, f"b{n}", minutes=3000))
    read, begun = stores._documents, []

    def slow(*args):
        rows = read(*args)
        if not begun:
            begun.append(True)
            stores.purge_documents(spark, root, F.lit(START + timedelta(minutes=2000)))
        return rows

    monkeypatch.setattr(stores, "_documents", slow)
    stores.compact_documents(spark, root, 2)
    assert ids(spark, root) == [1, 11]


def test_a_batch_run_again_does_not_see_itself(spark):
    root = scratch_path(spark, "store")
    rows = posts(spark, post(1, "a"), post(2, "see http://t.co/1"), post(3, "look http://t.co/1"), post(4, None))
    for _ in range(2):
        fresh = dedup.unseen_posts(rows, root, 0)
        assert sorted(r.id for r in fresh.collect()) == [1, 2, 4]
        stores.append_documents(to_documents(fresh.filter("text is not null")), root, 0)
    assert sorted(r.id for r in dedup.unseen_posts(rows, root, 1).collect()) == [4]
    assert dedup.unseen_posts(rows.limit(0), root, 1).count() == 0


def test_only_buckets_that_may_hold_a_key_are_read(spark, tmp_path):
    """A thousand stored batches of a hundred keys; a batch of posts that repeats three of them."""
    root = str(tmp_path / "store")
    rng = np.random.default_rng(1)
    keys = rng.integers(-2**62, 2**62, (1000, 100, 2))
    parts, filters = [], []
    for n, (k1, k2) in enumerate(keys.transpose(0, 2, 1)):
        folder = f"keys/write=w{n}/bucket=0"
        os.makedirs(f"{root}/{folder}")
        pq.write_table(pa.table({"k1": k1, "k2": k2, "created_at": pa.array([None] * 100, pa.timestamp("us")), "buckets": pa.array([1] * 100, pa.int32())}),
                       f"{root}/{folder}/part-0.parquet")
        parts.append(Part("keys", n, "0", folder))
        filters.append((1, 0, folder, keyindex.make_filter(k1, k2)))
    os.makedirs(f"{root}/filters/write=all")
    columns = [pa.array(x, t) for x, t in zip(zip(*filters), (pa.int32(), pa.int32(), pa.string(), pa.binary()))]
    pq.write_table(pa.table(columns, names=["buckets", "bucket", "folder", "bits"]), f"{root}/filters/write=all/part-0.parquet")
    versions.commit(spark, root, versions.replacing((), [*parts, Part("filters", -2, "", "filters/write=all")]))
    now = versions.read_version(spark, root)
    known = [tuple(map(int, keys[n, 5])) for n in (3, 500, 999)]
    asked = spark.createDataFrame([*known, *((int(a), int(b)) for a, b in rng.integers(0, 2**62, (50, 2)))], "k1 long, k2 long")
    hits, touched = keyindex.candidates(asked, root, now)
    assert {3, 500, 999} <= {p.batch for p in touched} and len(touched) < 400  # a filter errs in under 0.5 per cent of 50 keys
    found = keyindex.known(asked, root, now)
    assert sorted(map(tuple, found.collect())) == sorted(known)
    assert sorted(map(tuple, keyindex.known(asked, root, now, without=500).collect())) == sorted([known[0], known[2]])
    keyindex.compact_keys(spark, root, 1000)
    merged = versions.read_version(spark, root)
    assert len(merged.of("keys")) == 1 and sorted(map(tuple, keyindex.known(asked, root, merged).collect())) == sorted(known)
    plan = spark.read.schema(keyindex.KEY_SCHEMA).parquet(*[f"{root}/{p.folder}" for p in touched])
    assert len(plan.inputFiles()) == len(touched)


def test_large_writes_have_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(keyindex, "KEYS_PER_BUCKET", 100)
    root = scratch_path(spark, "store")
    rows = spark.range(1500).select(*keyindex.key_hashes(F.col("id").cast("string")), F.lit(None).cast("timestamp").alias("created_at"))
    parts = keyindex.write_keys(rows, root, 0)
    small = keyindex.write_keys(rows.limit(0), root, 1)
    assert small == [] and sum(p.table == "keys" for p in parts) == 16
    versions.commit(spark, root, versions.replacing((), parts + keyindex.write_keys(rows.limit(1), root, 2)))
    asked = spark.range(1400, 1600).select(*keyindex.key_hashes(F.col("id").cast("string")))
    assert keyindex.known(asked, root, versions.read_version(spark, root)).count() == 100


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(-2**63, 2**63 - 1), st.integers(-2**63, 2**63 - 1)), min_size=1, max_size=200))
def test_filters_hold_what_was_put_in(keys):
    k1, k2 = (np.array(x, np.int64) for x in zip(*keys))
    bits = keyindex.make_filter(k1, k2)
    assert keyindex.may_hold(bits, k1, k2).all() and len(bits) <= max(8, len(keys) * keyindex.BITS_PER_KEY // 8 + 8)


def test_filters_rarely_err():
    rng = np.random.default_rng(2)
    k = rng.integers(-2**63, 2**63 - 1, (4, 20_000))
    assert keyindex.may_hold(keyindex.make_filter(k[0], k[1]), k[2], k[3]).mean() < 0.01


def test_compaction_shuffles_no_documents(spark):
    root = scratch_path(spark, "store")
    for n in range(2):
        batch(spark, root, n, post(10 * n, f"a{n}", minutes=0), post(10 * n + 1, f"b{n}", minutes=3000))
    rows = stores._days_merged(spark, root, versions.read_version(spark, root).of(stores.DOCUMENTS))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.rdd.getNumPartitions() >= 2 and rows.count() == 4  # no task reads both days
