"""Principal components and k-means of sparse or dense vectors by passes that add up small matrices.

A vector is an array of numbers or a struct of ``i`` (places, array of int) and ``w`` (their values). The vectors are read
once and written as small matrices, which every pass reads; a partition adds up its own matrix, Spark merges the matrices
block by block, and only their sum reaches the driver. Its size is set by the width of the vectors and the parameters,
not by the number of rows.

Rows whose vector is null or holds null or non-finite values take no part and get nulls. Without any other rows the shares
are 0 and all results null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillstone.storage import discard, materialize, spread

#: Rows that a task turns into one small matrix, and values of a summed matrix in one row of the shuffle.
SLICE, BLOCK = 256, 4096


def _sparse(df: DataFrame, vector: str) -> Column:
    """A vector column as ``struct<i, w>``, null where it takes no part."""
    c = F.col(vector)
    if isinstance(df.schema[vector].dataType, StructType):
        i, w = c["i"].cast("array<int>"), c["w"].cast("array<double>")
    else:
        w = c.cast("array<double>")
        i = F.transform(w, lambda _, k: k)
    bad = F.exists(w, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.struct(i.alias("i"), w.alias("w")))


def _matrices(i: pd.Series, w: pd.Series) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, used places and dense values of each slice of rows; its columns are the places that it uses."""
    for at in range(0, len(i), SLICE):
        places, values = list(i.iloc[at : at + SLICE]), list(w.iloc[at : at + SLICE])
        used, column = np.unique(np.concatenate([np.asarray(p, np.int64) for p in places]), return_inverse=True)
        out = np.zeros((len(places), len(used)))
        np.add.at(out, (np.repeat(np.arange(len(places)), [len(p) for p in places]), column), np.concatenate([np.asarray(v, float) for v in values]))
        yield at, used, out


#: A slice of rows: their number, the places that they use (``top`` the last of them), the values (kept as four bytes if
#: none loses by it) and, unless every row has a value at every used place, each row's length and each value's column.
PACKED = "n int, top int, used binary, lengths binary, columns binary, kind string, w binary"
PACKED_ARROW = pa.schema([("n", pa.int32()), ("top", pa.int32()), ("used", pa.binary()), ("lengths", pa.binary()), ("columns", pa.binary()), ("kind", pa.string()), ("w", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, w) to rows of PACKED."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            i, w = (c.slice(at, SLICE) for c in batch.columns)
            places, values = i.flatten().to_numpy(zero_copy_only=False), w.flatten().to_numpy(zero_copy_only=False)
            used, column = np.unique(places.astype(np.int64), return_inverse=True)
            length = pc.list_value_length(i).to_numpy()
            whole = bool((length == len(used)).all()) and np.array_equal(column, np.tile(np.arange(len(used)), len(i)))
            with np.errstate(over="ignore"):
                short = values.astype("<f4")
            kind = "<f4" if np.array_equal(short.astype("<f8"), values) else "<f8"
            lengths, columns = (b"", b"") if whole else (length.astype("<i4").tobytes(), column.astype("<i4").tobytes())
            row = {"n": len(i), "top": int(used[-1]) if len(used) else None, "used": used.tobytes(), "lengths": lengths, "columns": columns, "kind": kind, "w": (short if kind == "<f4" else values).tobytes()}
            yield pa.RecordBatch.from_pylist([row], PACKED_ARROW)


def _packed(rows: DataFrame) -> DataFrame:
    """Vectors (i, w) as written slices, for passes that read them again and again."""
    return materialize(spread(rows).mapInArrow(_pack, PACKED), "packed-vectors")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Used places and dense values of each slice of PACKED."""
    for n, _, used, lengths, columns, kind, w in zip(*batch.columns, strict=True):
        n, used, values = n.as_py(), np.frombuffer(used.as_buffer(), np.int64), np.frombuffer(w.as_buffer(), kind.as_py()).astype(float)
        if len(values) == n * len(used) and not len(columns.as_buffer()):
            yield used, values.reshape(n, len(used))
        else:
            out = np.zeros((n, len(used)))
            np.add.at(out, (np.repeat(np.arange(n), np.frombuffer(lengths.as_buffer(), "<i4")), np.frombuffer(columns.as_buffer(), "<i4")), values)
            yield used, out


def _summed(packed: DataFrame, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], shape: tuple[int, int]) -> np.ndarray:
    """The sum of matrices to which ``add(total, used, values)`` adds the slices of all rows."""
    size = shape[0] * shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            for used, values in _unpacked(batch):
                add(total, used, values)
                seen = True
        if seen:
            starts = np.arange(0, size, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.ListArray.from_arrays(np.append(starts, size).astype(np.int32), pa.array(total.ravel()))], ["b", "v"])

    parts = packed.mapInArrow(run, "b int, v array<double>").select("b", array_to_vector("v").alias("v"))
    out = np.zeros(size)
    for r in parts.groupBy("b").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v")).collect():  # one matrix
        out[r.b : r.b + len(r.v)] = r.v
    return out.reshape(shape)


def _by_rows(of: Callable[[np.ndarray, np.ndarray], np.ndarray], kind: str) -> Callable[[Column], Column]:
    """A function of ``used`` and dense values as one of a struct column; null for null."""

    def column(v: pd.DataFrame) -> pd.Series:
        fine = v["i"].notna().to_numpy()
        out = pd.Series([None] * len(v), dtype=object)
        i, w = v["i"][fine].reset_index(drop=True), v["w"][fine].reset_index(drop=True)
        found = [x for _, used, values in _matrices(i, w) for x in of(used, values).tolist()]
        for at, x in zip(np.flatnonzero(fine), found, strict=True):
            out.iat[at] = x
        return out

    return F.pandas_udf(column, kind)


def with_pca(df: DataFrame, vector: str, k: int = 3, block: int = 64, rounds: int = 200, tolerance: float = 1e-10, seed: int = 42) -> tuple[DataFrame, list[float]]:
    """``df`` with ``pca_1`` .. ``pca_k`` of the centred vectors, and the explained shares of variance.

    Subspace iteration with Rayleigh-Ritz values over ``block`` random directions: each round multiplies the centred
    covariance, which is never formed, with a matrix of width x ``block``. It ends when the first ``k`` values change by
    less than ``tolerance`` of the largest; vectors of at most ``block`` places need one round. Signs make the largest
    loading of each component positive.
    """
    base = df.withColumn("__s", _sparse(df, vector))
    rows = base.where("__s is not null").select("__s.i", "__s.w")
    n, top, square = rows.agg(F.count("*"), F.max(F.array_max("i")), F.sum(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))).first()
    width = 0 if top is None else top + 1
    if not width:
        return base.drop("__s").withColumns({f"pca_{c + 1}": F.lit(None).cast("double") for c in range(k)}), [0.0] * k

    def count(total: np.ndarray, used: np.ndarray, m: np.ndarray) -> None:
        total[used, 0] += m.sum(0)

    packed = _packed(rows)
    mean = _summed(packed, count, (width, 1))[:, 0] / n
    variance = square / n - mean @ mean
    size = min(width, max(block, k))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    before = np.full(min(k, size), np.inf)
    for _ in range(rounds):
        shift = mean @ q

        def multiply(total: np.ndarray, used: np.ndarray, m: np.ndarray, q: np.ndarray = q, shift: np.ndarray = shift) -> None:
            y = m @ q[used] - shift
            total[used] += m.T @ y
            total[width] += y.sum(0)

        both = _summed(packed, multiply, (width + 1, size))
        z = (both[:width] - np.outer(mean, both[width])) / n
        inner = q.T @ z
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, axes = values[::-1], q @ turn[:, ::-1]
        if size == width or np.abs(values[: len(before)] - before).max() <= tolerance * max(values[0], 1e-300):
            break
        before, q = values[: len(before)], np.linalg.qr(z)[0]
    discard(packed)
    axes = np.pad(axes[:, :k], ((0, 0), (0, max(0, k - size))))
    axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(0)[None], 0) < 0, -1.0, 1.0)
    centre = mean @ axes
    project = _by_rows(lambda used, m: m @ axes[used] - centre, "array<double>")
    placed = base.withColumn("__p", project(F.col("__s"))).withColumns({f"pca_{c + 1}": F.col("__p")[c] for c in range(k)}).drop("__s", "__p")
    shares = np.pad(np.maximum(values[:k], 0), (0, max(0, k - size))) / variance if variance > 1e-12 * square / n else np.zeros(k)
    return placed, [float(s) for s in shares]


def _first_centres(sample: np.ndarray, k: int, starts: int, seed: int) -> np.ndarray:
    """``starts`` times ``k`` rows of a sample, each drawn by its squared distance from those before (k-means++)."""
    pick, out = np.random.default_rng(seed), []
    for _ in range(starts):
        chosen = [int(pick.integers(len(sample)))]
        near = ((sample - sample[chosen[0]]) ** 2).sum(1)
        while len(chosen) < k:
            chosen.append(int(pick.choice(len(sample), p=near / near.sum())) if near.sum() > 0 else chosen[0])
            near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        out.append(sample[chosen])
    return np.stack(out)


def with_clusters(df: DataFrame, vector: str | list[str], k: int = 8, seed: int = 42, starts: int = 4, together: int = 8, sample: int = 1000, rounds: int = 300) -> DataFrame:
    """``df`` with ``cluster_label`` (0 .. k - 1) by k-means of a vector column, or of columns of numbers; ties go to the smaller label.

    First centres are drawn from ``sample`` rows (smallest hashes). ``starts`` drafts go through their first ``together``
    rounds in the same passes over all rows; the one of least cost then goes on until no centre moves, or ``rounds``.
    """
    base = df.withColumn("__s", F.col(vector) if isinstance(vector, str) else F.array(*vector))
    base = base.withColumn("__s", _sparse(base, "__s"))
    rows = base.where("__s is not null").select("__s.i", "__s.w")
    packed = _packed(rows)
    top = packed.agg(F.max("top")).first()[0]
    if top is None:
        discard(packed)
        return base.withColumn("cluster_label", F.when(F.col("__s").isNotNull(), 0)).drop("__s")
    width = top + 1
    few = rows.orderBy(F.xxhash64("i", "w")).limit(sample).toPandas()
    drawn = np.zeros((len(few), width))
    for at, used, values in _matrices(few["i"], few["w"]):
        drawn[at : at + len(values), used] = values
    centres = _first_centres(drawn, k, starts, seed)

    def flat(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return c.reshape(-1, width).T.copy(), (c**2).sum(2).ravel()

    for turn in range(rounds):
        q, norms = flat(centres)

        def step(total: np.ndarray, used: np.ndarray, m: np.ndarray, q: np.ndarray = q, norms: np.ndarray = norms) -> None:
            far = norms - 2 * (m @ q[used])
            near = far.reshape(len(m), -1, k).argmin(2)
            hot = (near[:, :, None] == np.arange(k)).reshape(len(m), -1).astype(float)
            total[used] += m.T @ hot
            total[width] += hot.sum(0)
            total[width + 1] += (hot * (far + (m**2).sum(1)[:, None])).sum(0)

        sums = _summed(packed, step, (width + 2, q.shape[1]))
        n, cost = sums[width], sums[width + 1].reshape(-1, k).sum(1)
        moved = np.where(n > 0, sums[:width] / np.maximum(n, 1), q).T.reshape(centres.shape)
        still = np.allclose(moved, centres, rtol=0, atol=1e-12)
        centres = moved
        if len(centres) > 1 and (still or turn + 1 >= together):
            centres = centres[[int(cost.argmin())]]
        elif still:
            break
    discard(packed)
    q, norms = flat(centres)
    label = _by_rows(lambda used, m: (norms - 2 * (m @ q[used])).argmin(1), "int")
    return base.withColumn("cluster_label", label(F.col("__s"))).drop("__s")
