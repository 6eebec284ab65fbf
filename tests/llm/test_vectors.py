"""Centroid clustering and hard-negative mining against plain versions, and on odd rows."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.llm import clusters, negatives

VECTORS = "vec_id long, embedding array<float>, label int, cluster int, row string, ints string, block int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "x", "y", 3) for i, v, label in rows], VECTORS)


def seeded(n, dims=64, seed=5, step=0.125):
    """Coarse components, so that distances and scores tie."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-6, 7) * step for _ in range(dims)], rng.randrange(3)) for i in range(n)]


def odd_vectors(dims=64):
    rows = seeded(230, dims)
    rows += [rows[100], rows[100], rows[7], (100, rows[3][1], 1)]  # repeated rows, an id with two vectors
    rows += [(900, None, 1), (901, [], 1), (902, [None] * dims, 0), (903, [1.0] * (dims - 1) + [math.nan], 0),
             (904, [math.inf] + [0.0] * (dims - 1), 1), (905, [0.5] * (dims - 1) + [None], 2)]
    return [*rows, (None, rows[5][1], 1), (910, rows[6][1], None)]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def floors(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def plain_clusters(rows):
    kept = [(i, floors(v, 64)) for i, v, _ in rows if usable(v) and len(v) == 64]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:16]
    centroids = [v for _, v in first]

    def assign():
        return [min((sum((x - m) ** 2 for x, m in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(3):
        members = defaultdict(list)
        for (_, j), (_, v) in zip(assign(), kept, strict=True):
            members[j].append(v)
        for j, own in members.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    of = defaultdict(int)
    for distance, j in found:
        of[j] += distance
    return [(i, j, d, of[j], sum(of.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for (i, _), (d, j) in zip(kept, found, strict=True)]


def by_text(rows):
    return sorted(map(str, map(tuple, rows)))


def test_clusters_equal_plain_rounds(spark):
    rows = odd_vectors()
    got = clusters.cluster(vectors(spark, rows).repartition(3), keep=["row", "cluster"])
    assert got.columns == ["vec_id", "row", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert by_text(got.drop("row").collect()) == by_text(plain_clusters(rows))


def test_clusters_of_few_or_large_vectors(spark):
    none = clusters.cluster(vectors(spark, [(1, None, 1), (2, [1.0], 1)]))
    assert none.columns[0] == "vec_id" and none.count() == 0 and clusters.cluster(vectors(spark, [])).count() == 0
    rows = [(i, [float(2**17 * (i % 3))] * 63 + [float(i)], 0) for i in range(9)]
    assert by_text(clusters.cluster(vectors(spark, rows)).collect()) == by_text(plain_clusters(rows))
    beyond = clusters.cluster(vectors(spark, [(1, [3e38] * 64, 0), (2, [-3e38] * 64, 0), (3, [0.0] * 64, 0)])).collect()
    assert [r.distance for r in beyond] == [0, 0, 0]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 16), st.integers(0, 10**6), st.sampled_from([3, 900, 2**23, 2**26]))
def test_the_progressive_search_finds_the_nearest(n, k, seed, size):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-size, size, (n, 64)), rng.integers(-size, size, (k, 64))
    c[-1] = c[0]  # ties go to the smaller number
    whole = ((x[:, None].astype(object) - c.astype(object)) ** 2).sum(axis=2)
    chosen, distance = clusters.nearest(x, c)
    assert chosen.tolist() == [min(range(k), key=lambda j: row[j]) for row in whole]
    assert distance.tolist() == [min(row) for row in whole]


def test_the_transform_keeps_lengths_and_starts_coarse():
    x = np.arange(128).reshape(2, 64)
    t = clusters.transform(x)
    assert (t[:, 0] == x.sum(axis=1)).all() and ((t * t).sum(axis=1) == 64 * (x * x).sum(axis=1)).all()
    assert t[0, 1] == x[0, :32].sum() - x[0, 32:].sum()


def plain_negatives(rows):
    kept = [(i, label, floors(v, 256)) for i, v, label in rows if label is not None and usable(v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for a, (anchor, label, own) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        ranked = sorted(((-score(own, v), i is None, i or 0, b) for b, (i, _, v) in enumerate(kept) if b != a))
        for minus, _, _, p in [r for r in ranked if kept[r[3]][1] == label][:5]:
            high = -minus
            hard = [r for r in ranked if kept[r[3]][1] != label and 80 * high <= 100 * -r[0] <= 100 * high][:5]
            out += [(anchor, kept[p][0], n + 1, kept[r[3]][0], high, -r[0]) for n, r in enumerate(hard)]
    return out


@pytest.mark.parametrize("dims", [64, 3])
def test_hard_negatives_equal_plain_ranking(spark, dims, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", 50)  # several blocks of rows and of anchors
    monkeypatch.setattr(negatives, "ANCHORS_PER_BLOCK", 2)
    rows = [*odd_vectors(dims), (1000, [1.0], 2), (1100, [0.0] * dims, 0)]
    got = negatives.mine(vectors(spark, rows).repartition(3))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain_negatives(rows)
    assert len(expected) > 50 and by_text(got.collect()) == by_text(expected)


def test_hard_negatives_of_few_or_large_vectors(spark):
    assert negatives.mine(vectors(spark, [])).count() == 0
    assert negatives.mine(vectors(spark, [(100, [1.0], None), (200, None, 1)])).count() == 0
    assert negatives.mine(vectors(spark, [(100, [1.0, 2.0], 1), (101, [], 1), (102, [], 2)])).collect() == [(100, 101, 1, 102, 0, 0)]
    rows = [(100, [4e4, -4e4], 1), (101, [4e4, -4e4], 1), (102, [39e3, -39e3], 2), (103, [-4e4, 4e4], 2)]
    assert by_text(negatives.mine(vectors(spark, rows)).collect()) == by_text(plain_negatives(rows))
    beyond = negatives.mine(vectors(spark, [(100, [3e38], 1), (101, [3e38], 1), (102, [1e38], 2)])).first()
    assert beyond.positive_score == beyond.negative_score == 2**48


def test_other_anchors_and_columns(spark):
    rows = seeded(40, 8)
    table = vectors(spark, rows).withColumnRenamed("vec_id", "a_row").withColumnRenamed("embedding", "planes")
    got = negatives.mine(table, key="a_row", vector="planes", anchor=F.col("a_row") == 100, positives=2, negatives=1)
    assert got.count() == 0
    got = negatives.mine(table, key="a_row", vector="planes", anchor=F.col("a_row") == 3, positives=2, negatives=1, least_percent=0)
    assert 0 < got.count() <= 2 and {r.anchor_id for r in got.collect()} == {3}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(1, 20), st.integers(1, 30), st.integers(0, 10**6), st.sampled_from([1, 200, 2**24]))
def test_table_scores_are_inner_products(n, k, dims, seed, size):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-size, size, (k, dims), endpoint=True), rng.integers(-size, size, (n, dims), endpoint=True)
    planes = int(max(abs(b).max(), 1)).bit_length() + 1
    got = negatives.scores(negatives.subset_sums(a, np.int64), negatives.bit_planes(b, planes).reshape(n, planes, -1))
    assert (got == b @ a.T).all()
