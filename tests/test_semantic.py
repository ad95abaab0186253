"""Components and clusters against NumPy, TF-IDF of odd rows."""

import json
from types import SimpleNamespace

import duckdb
import numpy as np

from rillstone.operators import semantic as sm
from rillstone.plans import reports
from rillstone.plans.linkage import QUERIES

DATA = "/root/testdata/sf0.01"


def vectors():
    return np.stack(duckdb.sql(f"SELECT embedding FROM '{DATA}/embeddings.parquet' ORDER BY vec_id").fetchnumpy()["embedding"]).astype(float)


def test_explained_variance_and_components(spark):
    x = vectors() - vectors().mean(0)
    values, axes = np.linalg.eigh(np.cov(x.T))
    want = values[::-1][:3] / values.sum()
    got = {r.component: r.share for r in QUERIES["pca_variance"](spark, DATA).collect()}
    assert np.allclose([got[k] for k in range(3)], want, atol=1e-6)
    placed, shares = sm.with_pca(spark.read.parquet(f"{DATA}/embeddings.parquet"), "embedding", 3)
    mine = np.array([[r.pca_1, r.pca_2, r.pca_3] for r in placed.orderBy("vec_id").collect()])
    assert np.allclose(np.abs(mine), np.abs(x @ axes[:, ::-1][:, :3]), atol=1e-6) and np.allclose(shares, want)


def test_clusters_are_a_fixed_point_of_lloyds_rounds(spark):
    placed, _ = sm.with_pca(spark.read.parquet(f"{DATA}/embeddings.parquet"), "embedding", 3)
    rows = sm.with_clusters(placed, ["pca_1", "pca_2", "pca_3"], 8).orderBy("vec_id").collect()
    x, label = np.array([[r.pca_1, r.pca_2, r.pca_3] for r in rows]), np.array([r.cluster_label for r in rows])
    used = sorted(set(label.tolist()))
    centres = np.stack([x[label == c].mean(0) for c in used])
    nearest = np.array(used)[((x[:, None] - centres) ** 2).sum(2).argmin(1)]
    assert len(used) == 8 and (nearest == label).mean() > 0.9
    # no worse than the best of some plain runs by a tenth
    pick, best = np.random.default_rng(1), np.inf
    for _ in range(10):
        c = x[pick.choice(len(x), 8, replace=False)]
        for _ in range(50):
            near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            c = np.stack([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(8)])
        best = min(best, ((x - c[near]) ** 2).sum())
    assert ((x - centres[[used.index(v) for v in label]]) ** 2).sum() < 1.1 * best
    assert {r.cluster_label: r.n for r in QUERIES["kmeans_sizes"](spark, DATA).collect()}.keys() == set(used)


def test_tfidf_of_repeated_keys_and_blank_texts(spark):
    rows = [(1, "aa bb", 0), (1, "aa cc", 0), (2, None, 0), (3, "b c", 0), (4, "bb bb dd", 0), (None, "aa", 0)]
    got = {(r.doc_id, r.term): r.weight for r in sm.tfidf(spark.createDataFrame(rows, "doc_id long, text string, tf int"), "doc_id", "text", 3).collect()}
    assert set(got) == {(1, "aa"), (1, "bb"), (1, "cc"), (4, "bb"), (None, "aa")} and got[None, "aa"] == 1.0 and got[4, "bb"] == 1.0
    assert abs(sum(w * w for (d, _), w in got.items() if d == 1) - 1) < 1e-12
    assert sm.tfidf(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0


def test_transformers_and_written_analysis(spark, tmp_path):
    class Session:
        """A model whose states are the token's number and one."""

        def get_inputs(self):
            return [SimpleNamespace(name="input_ids"), SimpleNamespace(name="attention_mask")]

        def run(self, _, given):
            return [np.stack([given["input_ids"], np.ones_like(given["input_ids"])], 2).astype(np.float32)]

    letters = SimpleNamespace(encode=lambda t: SimpleNamespace(ids=[ord(c) - 96 for c in t]))
    sm.register_transformer("letters", "m", "v", batch=2, open_model=lambda _: Session(), open_vocabulary=lambda _: letters)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a", "ac", " ", "c", None])], "k int, t string")
    got = [r.embedding for r in sm.EMBEDDINGS["letters"](docs, "k", "t").orderBy("k").collect()]
    unit = lambda x: (np.array([x, 1]) / np.hypot(x, 1)).tolist()
    assert np.allclose(got, [unit(1), unit(2), [0, 0], unit(3), [0, 0]])
    labelled, info = sm.analyze(docs, "k", "t", "letters", 1, 2)
    reports.write_analysis(labelled, info, f"file://{tmp_path}/a")
    told = json.loads((tmp_path / "a" / "metadata.json").read_text())
    assert told["embedding_method"] == "letters" and told["project_count"] == 5 and told["n_clusters"] == 2
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/a/projects").columns == ["k", "t", "pca_1", "cluster_label"]
