"""The field against brute force over all labellings, and held-out accuracy on the small tables."""

import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest

from rillstone.llm.quality import WIDTH, fit, held_out, line_features, line_labels, long_marginals, marginals, scorer, train
from rillstone.llm.words import slices

DATA = "/root/testdata/sf0.01"


def test_marginals_equal_sums_over_all_labellings():
    pick = np.random.default_rng(0)
    trans, lengths = pick.normal(size=(2, 2)), [1, 5, 0, 3, 7]
    first = np.concatenate(([0], np.cumsum(lengths)))
    unary = pick.normal(size=first[-1]) * 3
    got = marginals(unary, first, trans)[0]
    for a, n in zip(first, lengths, strict=False):
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            s = np.exp(sum(unary[a + t] * y[t] for t in range(n)) + sum(trans[y[t - 1], y[t]] for t in range(1, n)))
            total += s
            good += s * np.array(y)
        assert np.allclose(got[a : a + n], good / total)


def test_features_do_not_depend_on_the_slices():
    pick = random.Random(4)
    texts = [None, "", "\n\n", " \t\n x", "a", "Aé!! | 12\n\nrep rep rep\nAé!! | 12", "no end\n"] + ["\n".join(" ".join(pick.choices(["AB", "ab!", "|", "7", "é", ""], k=pick.randint(0, 6))) for _ in range(pick.randint(0, 9))) for _ in range(60)]
    rows = []
    for size in (1, 40, 1 << 20):
        x, first = [], []
        for data, offsets in slices(pa.array(texts), size):
            f, _, b = line_features(data, offsets)
            x.append(f)
            first += np.diff(b).tolist()
        rows.append((np.concatenate(x), first))
    assert all(np.allclose(rows[0][0], x) and rows[0][1] == first for x, first in rows)
    assert rows[0][1] == [len([line for line in (t or "").split("\n") if line.strip(" \t\r\v\f")]) for t in texts]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels)
    rows = docs.join(labels, "doc_id").where(held_out()).select("quality", scorer(model)("text").alias("s")).collect()
    right = [(r.s >= 0.5) == (r.quality == 1) for r in rows]
    assert len(rows) > 80 and sum(right) / len(right) > 0.93
    assert all(0 <= r.s <= 1 for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, " \n ", 3), (2, "ok line here\nBAD!! BAD!! BAD!!", 4), (3, "x " * 50_000, 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(2, 1), (2, 1), (3, 0), (None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    model = train(docs, labels)
    scores = [r[0] for r in docs.select(scorer(model)("text")).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert line_labels(docs, model).where("doc_id = 2").count() == 2
    none = train(docs, labels.limit(0))
    assert [r[0] for r in docs.select(scorer(none)("text")).collect()] == [0.5] * 5
    assert docs.limit(0).select(scorer(model)("text")).count() == 0
    assert fit([np.ones((2, WIDTH), np.float32)], [np.ones(2, np.int64)], np.array([1])).empty == 1.0


def test_whole_chains_in_segments():
    rng = np.random.Generator(np.random.PCG64(3))
    first = np.concatenate(([0], np.cumsum([1, 7, 64, 65, 300, 2, 128])))
    unary, trans = rng.normal(0, 3, first[-1]), rng.normal(0, 2, (2, 2))
    for segment in (1, 3, 64):
        for got, want in zip(long_marginals(unary, first, trans, segment), marginals(unary, first, trans), strict=True):
            got, want = (x / x.sum(-1, keepdims=True) if x.ndim == 2 else x for x in (got, want))  # vectors up to their scale
            assert np.allclose(got, want, atol=1e-9)
