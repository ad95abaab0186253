"""Quality by a linear-chain conditional random field over lines (operator 9).

Every non-blank line of a document is labelled good or bad; a line's features are its own and those of the lines beside
it, and the chain's transitions tie neighbours together. The forward-backward recursion gives each line's probability
of being good; their mean weighted by line length, put through a fitted logistic curve, is the document's score.

Training: lines of a labelled document carry its label. At most ``TRAIN_DOCS`` labelled documents are used, those of
smallest hash, and of these as many as have ``TRAIN_LINES`` lines together (the first always): both bound what the
driver gathers. Each of them is used with all its lines as one whole chain; the recursion runs over segments of
``SEGMENT`` lines at once, whose products of transitions carry it from one to the next. Scoring reads whole texts as whole chains, too.

Results: one score per row. A text without a line (null, empty, blank) scores as the trained share of good documents.
Labels that are null or not 0 or 1 are left out, repeated labels count as often as they stand. Without labels of both
kinds every score is that share, or 0.5 without any label.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, materialize, spread
from rillstone.llm.words import SPACED, mix, slices, span_hashes

TRAIN_DOCS, TRAIN_LINES, SEGMENT = 2000, 300_000, 64
#: A line's own features, in order; the last COPIED also stand for the line before and the line after.
OWN = ("one", "log_length", "word_length", "digits", "bytes_beyond_ascii", "upper", "marks", "bars", "repeated_words", "repeated_line")
COPIED = 5
WIDTH = len(OWN) + 2 * COPIED

_KIND = np.zeros((5, 256), bool)
_KIND[0, 48:58] = True
_KIND[1, 128:] = True
_KIND[2, 65:91] = True
_KIND[3, [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"-()|"]] = True
_KIND[4, ord("|")] = True


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x WIDTH), byte lengths, and for text i the lines ``first[i]`` to ``first[i + 1]``."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    newline = np.zeros(n + 1, bool)
    newline[:-1] = data == 10
    starts = np.flatnonzero(edge[:-1] | np.concatenate(([False], newline[:-1]))[:n]) if n else np.zeros(0, np.int64)
    ends = np.append(starts[1:], n) if len(starts) else starts
    ends = ends - newline[np.maximum(ends - 1, 0)] if len(starts) else ends
    word_byte = np.zeros(n + 2, bool)
    word_byte[1:-1] = SPACED[data]
    opens = np.flatnonzero(word_byte[1:-1] & (~word_byte[:-2] | edge[:-1]))
    closes = np.flatnonzero(word_byte[1:-1] & (~word_byte[2:] | edge[1:])) + 1
    word_from, word_to = np.searchsorted(opens, starts), np.searchsorted(opens, ends)
    full = word_to > word_from  # blank lines are none
    starts, ends, word_from, word_to = starts[full], ends[full], word_from[full], word_to[full]
    first = np.searchsorted(starts, offsets)
    m = len(starts)
    out = np.zeros((m, WIDTH), np.float32)
    if not m:
        return out, ends - starts, first
    size, count = (ends - starts).astype(np.float32), (word_to - word_from).astype(np.float32)
    hashed = span_hashes(data, opens, closes)
    again = np.concatenate(([0], np.cumsum(np.concatenate(([False], hashed[1:] == hashed[:-1])))))
    out[:, 0] = 1
    out[:, 1] = np.log1p(size) / 5
    out[:, 2] = np.minimum(size / count, 40) / 8
    for k in range(5):
        sums = np.concatenate(([0], np.cumsum(_KIND[k][data], dtype=np.int64)))
        share = (sums[ends] - sums[starts]) / size
        out[:, 3 + k] = np.minimum(share * (1, 1, 1, 4, 10)[k], 1)
    out[:, 8] = np.minimum((again[word_to] - again[np.minimum(word_from + 1, word_to)]) / np.maximum(count - 1, 1), 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    line = span_hashes(data, starts, ends) ^ mix(owner.astype(np.uint64) + np.uint64(1))
    _, which, copies = np.unique(line, return_inverse=True, return_counts=True)
    out[:, 9] = copies[which] > 1
    same = np.zeros(m, bool)
    same[1:] = owner[1:] == owner[:-1]
    own = out[:, len(OWN) - COPIED : len(OWN)]
    out[1:, len(OWN) : len(OWN) + COPIED] = own[:-1] * same[1:, None]
    out[:-1, len(OWN) + COPIED :] = own[1:] * same[1:, None]
    return out, ends - starts, first


def _factors(unary: np.ndarray) -> np.ndarray:
    """A line's factors of bad and good."""
    top = np.maximum(unary, 0)
    return np.stack([np.exp(-top), np.exp(unary - top)], 1)


def _alive(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains by length, longest first: their order, first lines, and how many are longer than t, for every t."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    steps = lengths[order]
    return order, first[:-1][order], np.searchsorted(-steps, -np.arange(steps[0] if len(steps) else 0), "left")


def marginals(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's probability of being good, and the forward and backward vectors (the latter with the line's own factor).

    ``unary`` is a line's score of good over bad; ``trans`` the 2 x 2 scores of neighbouring labels; ``first`` parts the
    lines into chains. All chains advance together, the longest last. ``enter`` and ``leave``: the factors that come
    from outside before a chain's first line and after its last.
    """
    m = len(unary)
    order, begin, alive = _alive(first)
    move = np.exp(trans)
    phi = _factors(unary)
    forward, back = np.zeros((m, 2)), np.ones((m, 2))
    if leave is not None:
        back[first[1:] - 1] = leave
    for t, k in enumerate(alive.tolist()):
        at = begin[:k] + t
        a = forward[at - 1] @ move * phi[at] if t else phi[at] if enter is None else phi[at] * enter[order]
        forward[at] = a / a.sum(1)[:, None]
    for t in range(len(alive) - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        b = (phi[at + 1] * back[at + 1]) @ move.T
        back[at] = b / b.sum(1)[:, None]
    both = forward * back
    return both[:, 1] / both.sum(1), forward, phi * back


def long_marginals(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``marginals`` of whole chains (none empty), in as many steps as a segment has lines and a chain has segments."""
    cuts = np.unique(np.concatenate([np.arange(a, b, segment) for a, b in zip(first[:-1], first[1:], strict=True)] + [first[-1:]]))
    chain = np.searchsorted(cuts, first)  # each chain's first segment
    phi, move = _factors(unary), np.exp(trans)
    order, begin, alive = _alive(cuts)
    product = np.broadcast_to(np.eye(2), (len(begin), 2, 2)).copy()  # of a segment's lines, from the label before it
    for t, k in enumerate(alive.tolist()):
        p = product[order[:k]] @ move * phi[begin[:k] + t][:, None, :]
        product[order[:k]] = p / p.sum((1, 2))[:, None, None]
    enter, leave = np.ones((len(begin), 2)), np.ones((len(begin), 2))
    _, head, many = _alive(chain)
    state = np.zeros((len(begin), 2))
    for t, k in enumerate(many.tolist()):
        at = head[:k] + t
        if t:
            enter[at] = state[at - 1] @ move
            a = (state[at - 1][:, None, :] @ product[at])[:, 0]
        else:  # no label before the first line
            a = _first_segments(phi, move, cuts, at)
        state[at] = a / a.sum(1)[:, None]
    for t in range(len(many) - 2, -1, -1):
        at = head[: many[t + 1]] + t
        b = (product[at + 1] @ leave[at + 1][:, :, None])[:, :, 0]
        leave[at] = b / b.sum(1)[:, None]
    return marginals(unary, cuts, trans, enter, leave)


def _first_segments(phi: np.ndarray, move: np.ndarray, cuts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Forward vectors at the ends of chains' first segments."""
    size = cuts[at + 1] - cuts[at]
    a = phi[cuts[at]]
    for t in range(1, int(size.max())):
        more = np.flatnonzero(size > t)
        b = a[more] @ move * phi[cuts[at[more]] + t]
        a[more] = b / b.sum(1)[:, None]
    return a


@dataclass
class Crf:
    """Weights of a trained field; ``curve`` turns a document's weighted mean into its score."""

    weights: np.ndarray
    trans: np.ndarray
    curve: tuple[float, float]
    empty: float

    def line_scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each line's probability of being good, its length, and the texts' first lines."""
        x, size, first = line_features(data, offsets)
        good = marginals(x @ self.weights, first, self.trans)[0] if len(x) else np.zeros(0)
        return good, size, first

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for data, offsets in slices(texts):
            good, size, first = self.line_scores(data, offsets)
            weight = np.concatenate(([0.0], np.cumsum(size)))
            mass = np.concatenate(([0.0], np.cumsum(size * good)))
            total = weight[first[1:]] - weight[first[:-1]]
            mean = (mass[first[1:]] - mass[first[:-1]]) / np.maximum(total, 1)
            curved = 1 / (1 + np.exp(-(self.curve[0] * mean + self.curve[1])))
            out.append(np.where(total > 0, curved, self.empty))
        return np.concatenate(out) if out else np.zeros(0)


def fit(chains: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> Crf:
    """Maximum likelihood of the line labels by gradient steps (Adam); every document weighs the same."""
    share = float(labels.mean()) if len(labels) else 0.5
    used = [k for k in range(len(chains)) if len(chains[k])]
    if not used or labels.min() == labels.max():
        return Crf(np.zeros(WIDTH), np.zeros((2, 2)), (0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))), share)
    x = np.concatenate([chains[k] for k in used]).astype(np.float64)
    lines = np.array([len(chains[k]) for k in used])
    y = np.repeat(labels[used], lines).astype(np.float64)
    doc = np.repeat(np.arange(len(used)), lines)
    begin = np.concatenate(([0], np.cumsum(lines)))
    weight = 1 / lines[doc] / len(used)
    inner = np.ones(len(x), bool)
    inner[begin[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), weight[inner])
    w, trans = np.zeros(WIDTH), np.zeros((2, 2))
    params = np.zeros(WIDTH + 4)
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, trans = params[:WIDTH], params[WIDTH:].reshape(2, 2)
        unary = x @ w
        p, forward, back = long_marginals(unary, begin, trans)
        grad_w = x.T @ ((p - y) * weight) + decay * w
        both = forward[np.flatnonzero(inner) - 1][:, :, None] * np.exp(trans) * back[inner][:, None, :]
        pair = (both * (weight[inner] / both.sum((1, 2)))[:, None, None]).sum(0)
        grad = np.concatenate([grad_w, (pair - seen).ravel() + decay * trans.ravel()])
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        params = params - 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    w, trans = params[:WIDTH].copy(), params[WIDTH:].reshape(2, 2).copy()
    p = long_marginals(x @ w, begin, trans)[0]
    size = np.concatenate([sizes[k] for k in used]).astype(np.float64)
    mean = np.bincount(doc, p * size) / np.bincount(doc, size)
    return Crf(w, trans, _logistic(mean, labels[used]), share)


def _logistic(mean: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and intercept of the score's curve, by damped Newton steps."""
    a, b = 4.0, -2.0
    design = np.stack([mean, np.ones_like(mean)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * mean + b)))
        g = design.T @ (p - y) / len(y) + np.array([1e-5 * a, 0])
        hess = (design * (p * (1 - p))[:, None]).T @ design / len(y) + np.diag([1e-5, 1e-6])
        da, db = np.linalg.solve(hess, g)
        a, b = max(a - np.clip(da, -2, 2), 1e-3), b - np.clip(db, -2, 2)
    return float(a), float(b)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label may not be learned from: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS, most_lines: int = TRAIN_LINES) -> Crf:
    """Fit on at most ``most`` labelled documents that are not held out, of at most ``most_lines`` lines together."""
    bound_batches(docs.sparkSession)
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    sample = usable.orderBy(F.xxhash64("__id"), "__id", "__label").limit(most)

    @F.arrow_udf("n long, features binary, sizes binary")
    def describe(texts: pa.Array) -> pa.Array:
        n, x, sizes = [], [], []
        for data, offsets in slices(texts):
            f, size, first = line_features(data, offsets)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                n.append(b - a)
                x.append(f[a:b].tobytes())
                sizes.append(size[a:b].astype(np.int64).tobytes())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(x, pa.binary()), pa.array(sizes, pa.binary())], names=["n", "features", "sizes"])

    # the sample has at most ``most`` rows of a few bytes
    joined = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")).join(F.broadcast(sample), "__id")
    described = materialize(joined.select("__id", "__label", describe("__text").alias("d")).select("__id", "__label", "d.*"), "training")
    order = [F.xxhash64("__id"), "__id", "__label", "n", "features"]
    sizes = described.select("__id", "__label", "n").orderBy(*order).limit(most).collect()
    used = max(1, int(np.searchsorted(np.cumsum([r["n"] for r in sizes]), most_lines, "right")))
    rows = described.orderBy(*order).limit(min(used, len(sizes))).collect()
    chains = [np.frombuffer(bytes(r["features"]), np.float32).reshape(-1, WIDTH) for r in rows]
    sizes = [np.frombuffer(bytes(r["sizes"]), np.int64) for r in rows]
    return fit(chains, sizes, np.array([r["__label"] for r in rows], np.int64))


def scorer(model: Crf) -> Callable[[Column | str], Column]:
    """A column function: a text's score."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts), pa.float64())

    return lambda text: score(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def line_labels(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per non-blank line: ``doc_id``, ``line`` (from 0), ``n_bytes``, ``good`` (its probability)."""

    @F.arrow_udf("array<struct<n_bytes:long,good:double>>")
    def label(texts: pa.Array) -> pa.Array:
        out = []
        for data, offsets in slices(texts):
            good, size, first = model.line_scores(data, offsets)
            rows = [{"n_bytes": int(s), "good": float(g)} for s, g in zip(size, good, strict=True)]
            out += [rows[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        return pa.array(out, pa.list_(pa.struct([("n_bytes", pa.int64()), ("good", pa.float64())])))

    found = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(label(F.coalesce(F.col(text_col), F.lit("")))).alias("line", "x"))
    return found.select("doc_id", "line", "x.n_bytes", "x.good")
