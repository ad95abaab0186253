"""Quality rules by an isolation forest on rule statistics (operator 11).

Exact counts of a text's words, symbols, repeated lines and repeated three-word windows give rule statistics (shares and
logarithms). An isolation forest, trees of random splits over small samples, isolates unusual documents after few
splits: the average path length, put in relation to that of a search tree, is a document's anomaly. The threshold is
calibrated on labelled rows: of all cuts between their anomalies the one that keeps most of the good and drops most of
the bad (largest sum of both shares; of equal ones that which keeps most).

Fitting: all labelled documents that are not held out. Each tree's cuts are random ones in the ranges of ``SAMPLE`` of
them (of both labels, as the forest looks for the unusual); the sizes of its leaves, from which the path lengths come,
are counted over all of them, and so is the threshold, exactly. Documents are counted once and written as numbers.
Counts, paths and verdicts cover all documents and whole texts. Labels never enter a statistic.

Results: one row per input row. Null, empty and blank texts have no words and fail the base rules. Labels that are null
or not 0 or 1 are left out. Without labels of both kinds there is nothing to calibrate: the forest is fitted on what
labelled documents there are and keeps everything that passes the base rules. Repeated ids, null ids and further columns don't
matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, materialize, spread
from rillstone.llm.words import SPACED, slices, span_ids, text_ids, word_spans

TREES, SAMPLE = 256, 256
#: Exact counts, in order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_digits", "n_upper", "n_marks", "n_distinct", "n_ended", "n_short")
#: Rule statistics made of them, in order.
STATISTICS = ("log_words", "word_length", "symbols", "repeated_lines", "repeated_words", "line_words", "digits", "upper", "marks", "distinct", "ended_lines", "short_words")

_IS = {
    "n_symbols": np.isin(np.arange(256), list(b"#*$%&|<>")),
    "n_digits": (np.arange(256) >= 48) & (np.arange(256) < 58),
    "n_upper": (np.arange(256) >= 65) & (np.arange(256) < 91),
    "n_marks": np.isin(np.arange(256), list(b"!\"'(),-./:;=?@[\\]^_`{}~+")),
}


def _sums(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))


def repeated_words(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word whether a window of three words that holds it stands twice or more in its text; ids are ``text_ids``."""
    n = len(ids)
    out = np.zeros(n, bool)
    if n < 3:
        return out
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1].astype(np.int64)
    inner = np.flatnonzero(owner[:-2] == owner[2:])
    _, which, copies = np.unique(pairs[inner] * n + ids[inner + 2], return_inverse=True, return_counts=True)
    twice = inner[copies[which] > 1]
    out[twice] = out[twice + 1] = out[twice + 2] = True
    return out


def rule_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each text (texts x counts)."""
    start, end, first = word_spans(data, offsets, SPACED)
    out = np.zeros((len(offsets) - 1, len(COUNTS)), np.int64)
    at = {c: k for k, c in enumerate(COUNTS)}
    per_text = lambda sums, ends: sums[ends[1:]] - sums[ends[:-1]]
    points = _sums((data & 0xC0) != 0x80)
    chars = points[end] - points[start]
    out[:, at["n_words"]] = np.diff(first)
    out[:, at["word_chars"]] = per_text(_sums(chars), first)
    out[:, at["n_short"]] = per_text(_sums(chars <= 2), first)
    out[:, at["n_chars"]] = per_text(points, offsets)
    for name, table in _IS.items():
        out[:, at[name]] = per_text(_sums(table[data]), offsets)
    if len(start):
        ids = text_ids(span_ids(data, start, end), first)
        out[:, at["n_repeat_words"]] = per_text(_sums(repeated_words(ids, first)), first)
        fresh = np.zeros(len(ids), bool)
        fresh[np.unique(ids, return_index=True)[1]] = True
        out[:, at["n_distinct"]] = per_text(_sums(fresh), first)
    raw = data.tobytes()
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        lines = [line for line in raw[a:b].split(b"\n") if not line.isspace() and line]
        out[k, at["n_lines"]] = len(lines)
        out[k, at["n_dup_lines"]] = len(lines) - len(set(lines))
        out[k, at["n_ended"]] = sum(line.endswith((b".", b"!", b"?")) for line in lines)
    return out


def statistics(counts: np.ndarray) -> np.ndarray:
    """STATISTICS (texts x statistics) from COUNTS."""
    c = {name: counts[:, k].astype(np.float64) for k, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "n_chars", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        np.log1p(c["n_words"] / lines), c["n_digits"] / chars, c["n_upper"] / chars, c["n_marks"] / chars, c["n_distinct"] / words ** 0.9,
        c["n_ended"] / lines, c["n_short"] / words,
    ], 1)


def _search_path(n: float) -> float:
    """Average path length of an unsuccessful search among n keys in a binary tree."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as rows of nodes: statistic (-1: leaf), cut, children; a leaf's ``cut`` is its path length."""

    which: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    level: np.ndarray
    depth: int
    size: int
    threshold: float = np.inf

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Each tree's leaf of each row."""
        rows = np.arange(len(x))
        for which, cut, child in zip(self.which, self.cut, self.child, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = which[node] >= 0
                below = x[rows, np.maximum(which[node], 0)] < cut[node]
                node = np.where(inner, child[node] + ~below, node)
            yield node

    def sized(self, tree: np.ndarray, node: np.ndarray, n: np.ndarray, rows: int) -> None:
        """Path lengths from the numbers of rows in leaves, among ``rows`` in all; a leaf counts as its share of a sample."""
        sizes = np.zeros(self.cut.shape)
        sizes[tree, node] = n / max(rows, 1) * self.size
        known = [_search_path(k) for k in range(self.size + 1)]
        leaf = self.which < 0
        self.cut[leaf] = (self.level + np.interp(sizes, np.arange(self.size + 1), known))[leaf]

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-path / expected path) of each row: near 1 for rows that few splits isolate, 0.5 and less for others."""
        total = np.zeros(len(x))
        for cut, node in zip(self.cut, self.leaves(x), strict=True):
            total += cut[node]
        return np.exp2(-total / len(self.cut) / max(_search_path(self.size), 1e-9)) if len(self.cut) else np.zeros(len(x))


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 11) -> Forest:
    """A forest over random samples of rows; a split takes a random statistic that varies and a random cut in its range."""
    rng = np.random.Generator(np.random.PCG64(seed))
    size = min(sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    width = 2 << depth
    which, cut, child, levels = np.full((trees, width), -1), np.zeros((trees, width)), np.zeros((trees, width), np.int64), np.zeros((trees, width), np.int64)
    for t in range(trees if size else 0):
        nodes, todo = 1, [(0, x[rng.choice(len(x), size, replace=False)], 0)]
        while todo:
            node, rows, level = todo.pop()
            levels[t, node] = level
            low, high = rows.min(0), rows.max(0)
            vary = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(vary):
                cut[t, node] = level + _search_path(len(rows))
                continue
            s = int(rng.choice(vary))
            at = low[s] + rng.random() * (high[s] - low[s])
            at = at if at > low[s] else high[s]
            left = rows[:, s] < at
            which[t, node], cut[t, node], child[t, node] = s, at, nodes
            todo += [(nodes, rows[left], level + 1), (nodes + 1, rows[~left], level + 1)]
            nodes += 2
    return Forest(which, cut, child, levels, depth, size)


def calibrated(forest: Forest, x: np.ndarray, good: np.ndarray) -> Forest:
    """``forest`` with the threshold that parts good rows (below or at it) from bad ones best."""
    if not len(x) or good.all() or not good.any():
        return forest
    score = forest.anomaly(x)
    cuts = np.unique(score)
    kept = np.searchsorted(np.sort(score[good]), cuts, "right") / good.sum()
    dropped = 1 - np.searchsorted(np.sort(score[~good]), cuts, "right") / (~good).sum()
    best = int(np.flatnonzero(kept + dropped >= (kept + dropped).max() - 1e-12)[-1])
    forest.threshold = float(cuts[best] if best + 1 == len(cuts) else (cuts[best] + cuts[best + 1]) / 2)
    return forest



def _counter():
    @F.arrow_udf("array<long>")
    def count(texts: pa.Array) -> pa.Array:
        rows = [rule_counts(data, offsets) for data, offsets in slices(texts)]
        flat = np.concatenate(rows) if rows else np.zeros((0, len(COUNTS)), np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * len(COUNTS), pa.int32()), pa.array(flat.ravel()))

    return count


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label may not be learned from: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, counts`` of all documents, written; ``fit`` and ``rule_verdicts`` take it in place of texts."""
    bound_batches(docs.sparkSession)
    whole = spread(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return materialize(whole.select("doc_id", _counter()("text").alias("counts")), "rule-counts")


def _matrix(counts: pd.Series) -> np.ndarray:
    return statistics(np.array(counts.tolist(), np.int64).reshape(-1, len(COUNTS)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, sample: int = SAMPLE) -> Forest:
    """A forest, calibrated, whose leaves and threshold come from all labelled documents that are not held out.

    The driver gets ``trees`` times ``sample`` documents' counts, for the cuts, and sums for leaves and ranges of scores.
    """
    docs = docs.withColumnRenamed(id_col, "doc_id") if "counts" in docs.columns else counted(docs, id_col, text_col)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = materialize(docs.join(usable, "doc_id").select("doc_id", "label", "counts"), "labelled-counts")
    drawn = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "counts").limit(trees * sample).select("counts").toPandas()
    forest = grow(_matrix(drawn["counts"]), trees, sample)

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(forest.cut.shape, np.int64)
        for frame in frames:
            for t, node in enumerate(forest.leaves(_matrix(frame["counts"]))):
                total[t] += np.bincount(node, minlength=total.shape[1])
        tree, node = np.nonzero(total)
        yield pd.DataFrame({"tree": tree, "node": node, "n": total[tree, node]})

    n, good = rows.agg(F.count("*"), F.count_if(F.col("label") == 1)).first()
    if not n:
        return forest
    leaf = rows.select("counts").mapInPandas(sizes, "tree long, node long, n long").groupBy("tree", "node").agg(F.sum("n").alias("n")).toPandas()
    forest.sized(leaf["tree"].to_numpy(), leaf["node"].to_numpy(), leaf["n"].to_numpy(), n)
    if 0 < good < n:
        scores = rows.select(F.pandas_udf(lambda c: pd.Series(forest.anomaly(_matrix(c))), "double")("counts").alias("score"), "label")
        forest.threshold = best_cut(scores, good, n - good)
    return forest


def best_cut(scores: DataFrame, good: int, bad: int) -> float:
    """The cut of ``score`` that keeps most of the good (``label`` 1) and drops most of the bad, as ``calibrated`` finds it.

    Scores are dealt out by ranges that add up their own rows; the driver gets a row for each range.
    """
    each = scores.groupBy("score").agg(F.sum("label").alias("g"), F.count_if(F.col("label") == 0).alias("b"))
    ranged = materialize(each.repartitionByRange("score").withColumn("part", F.spark_partition_id()), "scores")
    sums = ranged.groupBy("part").agg(F.sum("g").alias("g"), F.sum("b").alias("b"), F.min("score").alias("first")).orderBy("part").toPandas()
    before = [(int(p), int(g), int(b), after) for p, g, b, after in zip(sums["part"], sums["g"].cumsum() - sums["g"], sums["b"].cumsum() - sums["b"], [*sums["first"][1:].tolist(), None], strict=True)]
    starts = F.broadcast(scores.sparkSession.createDataFrame(before, "part int, g0 long, b0 long, after double"))
    ordered = Window.partitionBy("part").orderBy("score")
    up_to = ordered.rowsBetween(Window.unboundedPreceding, 0)
    at = ranged.select("part", "score", F.sum("g").over(up_to).alias("g"), F.sum("b").over(up_to).alias("b"), F.lead("score").over(ordered).alias("next")).join(starts, "part")
    gain = (F.col("g") + F.col("g0")) * bad - (F.col("b") + F.col("b0")) * good
    best = at.agg(F.max(F.struct(gain.alias("gain"), "score", F.coalesce("next", "after", "score").alias("next"))).alias("x")).first().x
    return (best.score + best.next) / 2


def rule_verdicts(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the counts of COUNTS, ``anomaly`` (0 to 1) and ``unusual`` (above the calibrated threshold)."""
    docs = docs.withColumnRenamed(id_col, "doc_id") if "counts" in docs.columns else counted(docs, id_col, text_col)
    anomaly = F.pandas_udf(lambda c: pd.Series(forest.anomaly(_matrix(c))), "double")
    judged = docs.select("doc_id", "counts", anomaly("counts").alias("anomaly"))
    return judged.select("doc_id", *(F.col("counts")[k].alias(c) for k, c in enumerate(COUNTS)), "anomaly", (F.col("anomaly") > forest.threshold).alias("unusual"))
