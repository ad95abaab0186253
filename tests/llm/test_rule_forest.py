"""Rule statistics against plain Python, the forest's separation, odd rows."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from rillstone.llm.queries import QUERIES
from rillstone.llm.rule_forest import COUNTS, best_cut, calibrated, fit, grow, rule_verdicts

DATA = "/root/testdata/sf0.01"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_query(spark):
    texts = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{DATA}/documents.parquet'").fetchall()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in QUERIES["op11_quality_rules"](spark, DATA).collect()}
    assert len(got) == len(texts)
    for d, t in texts:
        n, *_, repeated = want = plain(t)
        assert tuple(got[d])[1:6] == want
        assert got[d].base_failed == (n < 50 or 2 * repeated > n) and not (got[d].kept and got[d].base_failed)
    judged = [(labels[d], r.kept) for d, r in got.items() if d in labels and zlib.crc32(str(d).encode()) % 3 == 1 and not r.base_failed]
    good, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert np.mean(good) > 0.95 and (not bad or np.mean(bad) < 0.2)
    again = {r.doc_id: r.anomaly for r in QUERIES["op11_quality_rules"](spark, DATA).collect()}
    assert again == {d: r.anomaly for d, r in got.items()}


def test_forest_isolates_what_is_unusual():
    rng = np.random.Generator(np.random.PCG64(1))
    x = np.concatenate([rng.normal(size=(950, 4)), rng.normal(6, 2, size=(50, 4))])
    good = np.arange(1000) < 950
    forest = calibrated(grow(x), x, good)
    flagged = forest.anomaly(x) > forest.threshold
    assert flagged[~good].mean() > 0.9 and flagged[good].mean() < 0.1
    constant = grow(np.ones((10, 4)))
    assert len(set(constant.anomaly(np.ones((5, 4))))) == 1
    assert (grow(np.zeros((0, 4))).anomaly(np.ones((3, 4))) >= 0).all()


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n\t\n ", 0), (None, "a b c a b c", 0), (4, "x | y\nx | y\n\nx | y \n", 0), (4, "x | y\nx | y\n\nx | y \n", 0), (5, "wort é " * 40_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anomaly int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (4, 7), (None, 1), (5, 1), (5, 1)], "doc_id long, quality int")
    got = sorted(((r.doc_id or 0, *(r[c] for c in COUNTS[:5])) for r in rule_verdicts(docs, fit(docs, labels)).collect()))
    assert got == sorted((d or 0, *plain(t or "")) for d, t, _ in rows)
    unlabelled = fit(docs, labels.limit(0))
    assert not any(r.unusual for r in rule_verdicts(docs, unlabelled).collect())
    assert rule_verdicts(docs.limit(0), unlabelled).count() == 0


def test_every_labelled_document_counts(spark):
    """Leaves and the threshold come from all of more documents than the trees draw, of which the last ones differ."""
    rows = [(i, " ".join(f"w{i % 7}{k}" for k in range(20 + i % 5)), 1) for i in range(300)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, quality int"), spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(300)], "doc_id long, quality int")
    forest = fit(docs, labels, trees=4, sample=8)
    used = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1]
    by_hand = {r.doc_id: r.anomaly for r in rule_verdicts(docs, forest).collect()}
    x, good = np.array([by_hand[i] for i in used]), np.array([i % 10 > 0 for i in used])

    class Given:
        threshold = np.inf

        def anomaly(self, _):
            return x

    assert len(used) > 4 * 8 and abs(calibrated(Given(), x, good).threshold - forest.threshold) < 1e-12
    pairs = [(float(v), int(g)) for v, g in zip(x, good)]
    assert best_cut(spark.createDataFrame(pairs, "score double, label int").repartition(3), int(good.sum()), int((~good).sum())) == forest.threshold
