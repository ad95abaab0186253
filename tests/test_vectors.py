"""Principal components and clusters of sparse rows against NumPy and SQL."""

import duckdb
import numpy as np
import pyarrow as pa

from rillstone.operators import semantic as sm
from rillstone.operators import vectors as vc

DATA = "/root/testdata/sf0.01"


def sparse(spark, x):
    """Rows of a matrix as structs without their zeros."""
    rows = [(k, (np.flatnonzero(r).tolist(), r[np.flatnonzero(r)].tolist())) for k, r in enumerate(x)]
    return spark.createDataFrame(rows, "k long, v struct<i: array<int>, w: array<double>>")


def decaying(rows, width, seed=3):
    pick = np.random.default_rng(seed)
    x = pick.standard_normal((rows, width)) * (pick.random((rows, width)) < 0.2)
    return x + np.outer(pick.standard_normal(rows), pick.random(width)) + 0.5 * np.outer(pick.standard_normal(rows), pick.random(width))


def test_components_by_iteration(spark):
    x = decaying(400, 90)
    placed, shares = vc.with_pca(sparse(spark, x).repartition(5), "v", 3, block=24)
    values, axes = np.linalg.eigh(np.cov(x.T, ddof=0))
    assert np.allclose(shares, values[::-1][:3] / values.sum(), atol=1e-6)
    mine = np.array([[r.pca_1, r.pca_2, r.pca_3] for r in placed.orderBy("k").collect()])
    want = (x - x.mean(0)) @ axes[:, ::-1][:, :3]
    assert np.allclose(np.abs(mine[:, :2]), np.abs(want[:, :2]), atol=1e-3)


def test_wide_rows(spark):
    """20,000 places: neither dense rows nor a covariance are made."""
    pick, rows = np.random.default_rng(5), []
    for k in range(300):
        places = np.unique(np.concatenate([pick.integers(0, 20_000, 30), [k % 3, 7]]))
        rows.append((k, (places.tolist(), np.where(places == k % 3, 6.0, 1.0).tolist())))
    df = spark.createDataFrame(rows, "k long, v struct<i: array<int>, w: array<double>>")
    placed, shares = vc.with_pca(df, "v", 2, block=12)
    x = np.zeros((300, 20_000))
    for k, (i, w) in rows:
        x[k, i] = w
    c = x - x.mean(0)
    values = np.linalg.eigvalsh(c @ c.T)[::-1]
    assert np.allclose(shares, values[:2] / values.sum(), atol=1e-6)
    labelled = vc.with_clusters(df, "v", 3).collect()
    assert len({(r.k % 3, r.cluster_label) for r in labelled}) == 3


def test_a_lloyd_step_in_sql_changes_no_label(spark):
    rows = sm.with_clusters(spark.read.parquet(f"{DATA}/embeddings.parquet"), "embedding", 8).select("vec_id", "cluster_label").toPandas()  # noqa: F841
    assert set(rows.cluster_label) == set(range(8))
    moved = duckdb.sql(f"""
        WITH x AS (SELECT e.vec_id, r.cluster_label AS c, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM '{DATA}/embeddings.parquet' e JOIN rows r USING (vec_id)),
        m AS (SELECT c, i, avg(v) AS v FROM x GROUP BY ALL),
        d AS (SELECT vec_id, x.c AS mine, m.c AS other, sum((x.v - m.v) ** 2) AS far FROM x JOIN m USING (i) GROUP BY ALL)
        SELECT count(*) FROM (SELECT vec_id, any_value(mine) AS mine, min(far) AS least, min(far) FILTER (mine = other) AS own FROM d GROUP BY vec_id) WHERE own > least + 1e-9
    """).fetchall()[0][0]
    assert moved == 0


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (3, None, 3), (4, [1.0, None], 4), (5, [float("nan"), 1.0], 5), (6, [1.0, 0.0], 6), (7, [], 7)]
    df = spark.createDataFrame(rows, "id int, v array<double>, w int")
    placed, shares = vc.with_pca(df, "v", 3)
    got = {r.id: r for r in placed.collect()}
    assert got[1].w == 1 and got[3].pca_1 is None and got[4].pca_1 is None and got[5].pca_1 is None and got[1].pca_1 == got[6].pca_1
    assert abs(sum(shares) - 1) < 1e-9 and shares[2] == 0 and got[1].pca_3 == 0
    label = {r.id: r.cluster_label for r in vc.with_clusters(df, "v", 3).collect()}
    assert label[1] == label[6] and len({label[1], label[2], label[7]}) == 3 and label[3] is label[4] is label[5] is None
    for empty in (df.where("id = 3"), df.where("id < 0"), df.where("id = 7")):
        placed, shares = vc.with_pca(empty, "v", 2)
        assert shares == [0, 0] and all(r.pca_1 is None for r in placed.collect())
        assert all(r.cluster_label == (0 if r.v == [] else None) for r in vc.with_clusters(empty, "v", 2).collect())
    same = df.where("id in (1, 6)")
    assert vc.with_pca(same, "v", 1)[1] == [0.0] and {r.cluster_label for r in vc.with_clusters(same, "v", 5).collect()} == {0}


def test_analysis_keeps_texts_without_terms(spark):
    docs = spark.createDataFrame([(1, "red fish"), (2, "red fish fish"), (3, "blue sky sky"), (4, None), (None, "blue sky")], "k int, t string")
    labelled, info = sm.analyze(docs, "k", "t", "tfidf", 2, 3)
    got = {r.k: r for r in labelled.collect()}
    assert len(got) == 5 and got[1].cluster_label == got[2].cluster_label and got[3].cluster_label == got[None].cluster_label != got[1].cluster_label
    assert labelled.columns == ["k", "t", "pca_1", "pca_2", "cluster_label"] and 0 < sum(info["explained_variance"]) <= 1


def test_passes_read_slices_and_not_every_vector(spark):
    """The vectors are read a few times (first centres, slices, labels), however many rounds there are."""
    sc = spark.sparkContext

    def stages():
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {s.stageId(): s for s in map(found.apply, range(found.size()))}

    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    n, seen = df.count(), set(stages())
    assert sum(r["count"] for r in vc.with_clusters(df, "embedding", 8).groupBy("cluster_label").count().collect()) == n
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert sum(s.inputRecords() for k, s in stages().items() if k not in seen) < 8 * n


def test_sums_over_slices_of_all_kinds(spark):
    """Rows of unequal lengths, repeated places, values of four and eight bytes, empty rows."""
    pick, rows = np.random.default_rng(9), []
    for k in range(700):
        i = pick.integers(0, 40, k % 5).tolist()
        rows.append((i, [float(x) if k % 2 else float(np.float32(x)) for x in pick.standard_normal(len(i))]))
    rows += [([0, 1, 2], [1.0, 2.5, 1e300])] * 3 + [([], [])] * 300

    def add(total, used, m):
        total[used, 0] += m.sum(0)

    for some in (rows, [r for r in rows if len(r[0]) == 3], rows[-300:]):
        packed = vc._packed(spark.createDataFrame(some, "i array<int>, w array<double>"))
        got = vc._summed(packed, add, (40, 1))
        want = np.zeros((40, 1))
        for i, w in some:
            np.add.at(want[:, 0], i, w)
        assert np.allclose(got, want, rtol=1e-12) and packed.selectExpr("sum(n)").first()[0] == len(some)


def test_slices_keep_their_rows():
    for rows in ([[(0, 1.0)], [(1, 2.0), (0, 3.0), (1, 4.0)]], [[(3, 1.0), (5, 0.1)], [(3, 2.0), (5, 7.0)]], [[(5, 1.0), (3, 2.0)]], [[], [(9, 1e300)], []]):
        batch = pa.RecordBatch.from_arrays([pa.array([[i for i, _ in r] for r in rows], pa.list_(pa.int32())), pa.array([[w for _, w in r] for r in rows], pa.list_(pa.float64()))], ["i", "w"])
        want = np.zeros((len(rows), 10))
        for k, r in enumerate(rows):
            for i, w in r:
                want[k, i] += w
        ((used, got),) = vc._unpacked(next(vc._pack([batch])))
        assert np.array_equal(want[:, used], got) and want.sum() == got.sum()
