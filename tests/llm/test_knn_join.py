"""Top-k against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import knn_join


def brute(rows, every, k, scale=1024):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.setdefault(i, []).append([float(np.float32(x)) * scale for x in v])
    out = set()
    for q in (i for i in kept if i % every == 0):
        mine = min(kept[q])
        scores = sorted((-sum(math.floor(a) * math.floor(b) for a, b in zip(mine, v, strict=False)), i) for i in kept if i != q for v in kept[i])
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("seed", "block", "dims"), [(1, 16_384, 4), (2, 50, 4), (3, 50, 16)])
def test_same_as_brute_force(spark, monkeypatch, seed, block, dims):
    monkeypatch.setattr(knn_join, "DATA_BLOCK", block)
    monkeypatch.setattr(knn_join, "QUERY_BLOCK", 7)
    monkeypatch.setattr(knn_join, "ROWS_PER_PIVOT", 25)
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, dims))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + 0.1 * pick.normal(size=dims)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # one vector many times
    rows += [(2000, None), (2010, [None] * dims), (2020, [float("nan")] * dims), (2030, [float("inf")] * dims), (None, rows[1][1]), (2040, [0.5])]
    random.Random(seed).shuffle(rows)
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    got = knn_join.top_k(table, F.col("vec_id") % 10 == 0, k=10).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == brute(rows, 10, 10) and len(got) == len(set(got))


def test_groups_are_sent_few_rows_of_clusters(spark):
    pick = np.random.default_rng(5)
    centres = pick.normal(size=(12, 16))
    rows = [(i, (centres[i // 7 % 12] + 0.05 * pick.normal(size=16)).tolist()) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    join = knn_join.VoronoiJoin(table, F.col("vec_id") % 10 == 0, 10, 1024, "vec_id", "embedding")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in join.run().collect()}
    sent, groups = join.routed.count(), join.routed.select("grp").distinct().count()
    assert groups >= 4 and sent < 0.5 * groups * len(rows)
    x = np.floor(np.array([v for _, v in rows]) * 1024).astype(np.int64)
    score = x[::10] @ x.T
    want = {(10 * q, r + 1, i, int(score[q, i])) for q in range(300) for r, i in enumerate(sorted((i for i in range(3000) if i != 10 * q), key=lambda i: (-score[q, i], i))[:10])}
    assert got == want


def test_vectors_without_clusters_are_sent_once(spark):
    pick = np.random.default_rng(6)
    rows = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(pick.normal(size=(2000, 64)))]
    join = knn_join.VoronoiJoin(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, 10, 1024, "vec_id", "embedding")
    join.run()
    assert join.routed.count() <= 2000


def test_wide_components_and_long_scores(spark):
    def search(rows, k=10):
        got = knn_join.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k).collect()
        return [(r.vec_id, r.score) for r in got]

    assert search([(0, [1.0, 1.0]), (1, [3.0e6, 0.0]), (2, [1.0, 1.0])]) == [(1, 3_145_728_000_000), (2, 2 * 1024**2)]
    # beyond 2**53, by differences that doubles don't hold
    assert search([(0, [1.0e6, 1.0]), (1, [3.0e6, 1.0]), (2, [3.0e6, 3.0]), (3, [3.0e6, 2.0]), (4, [-3.0e6, 0.0])]) == [(i, 1_024_000_000 * 3_072_000_000 + 1024 * 1024 * t) for i, t in ((2, 3), (3, 2), (1, 1))] + [(4, -1_024_000_000 * 3_072_000_000)]
    low, high = -(2**33), 2**33 - 2**-10
    assert search([(0, [1.0 * 2**10]), (1, [high]), (2, [float(low)])]) == [(1, 2**20 * int(high * 1024)), (2, -(2**63))]
    assert search([(0, [1.0, 0.0]), (1, [0.0, 1e100]), (2, [5.0, 1.0])]) == [(2, 5 * 1024**2), (1, 0)]
    for rows in ([(0, [2.0**33]), (1, [2.0**33])], [(0, [1.0]), (1, [1e200])]):
        with pytest.raises(Exception, match="does not fit a long|beyond 2"):
            search(rows)


def test_small_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [1.0, 1.0])], "vec_id int, embedding array<double>")
    got = knn_join.top_k(table, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 5, 3 * 1024 * 1024)]
    assert knn_join.top_k(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert knn_join.top_k(table, F.col("vec_id") == 7).count() == 0
    big = spark.createDataFrame([(0, [2.0e6, 1.0]), (1, [2.0e6, 2.0]), (2, [2.0e6, 3.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in knn_join.top_k(big, F.col("vec_id") == 0).collect()] == [(2, (2_048_000_000**2) + 1024 * 3072), (1, (2_048_000_000**2) + 1024 * 2048)]
