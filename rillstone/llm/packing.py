"""Best-two-fit packing (operator 5).

A greedy bin takes the longest piece that still fits until none does. Then its shortest piece makes room for the two
unpacked pieces that fill the widened gap best. Bins of the same contents come one after another, so the whole run
needs only the number of pieces of each length: the driver plans over at most ``capacity`` counts, whatever the
number of pieces, and each piece finds its bin from its rank among the pieces of its length.

Results: every piece is placed once; no piece is cut here. Lengths must lie in 1..capacity (a ValueError says how many
do not, nulls included). An empty table packs into an empty table. Repeated rows are separate pieces. A null text
counts as empty: its document is the end id alone.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.byte_bpe import byte_bpe
from rillstone.llm.common import bound_batches, spread

#: Pieces of one length are ranked in this many groups at least, and in more where a group would exceed GROUP_ROWS.
RANK_GROUPS, GROUP_ROWS = 64, 1_000_000


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit numbers).

    A document is its text's ids and ``end_id``. One longer than ``capacity`` is cut into pieces of ``capacity`` ids;
    only its first may be shorter.
    """
    bound_batches(docs.sparkSession)
    slim = spread(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(vocabulary).encode
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows: list[tuple[int, int, int]] = []
                ids: list[bytes] = []
                for k, text in enumerate(batch.column("text")):
                    data = encode(text.as_py()).tobytes() + end
                    stop = len(data) % width or width
                    start = piece = 0
                    while start < len(data):
                        rows.append((k, piece, start // 4))
                        ids.append(data[start:stop])
                        start, stop, piece = stop, stop + width, piece + 1
                owner, piece, start = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                length = np.array([len(x) // 4 for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins of a multiset of lengths (length -> count) as (lengths, number of such bins), in the order they are filled."""
    left = {n: c for n, c in counts.items() if c}
    sizes = sorted(left)
    bins: list[tuple[tuple[int, ...], int]] = []
    while sizes:
        used: Counter[int] = Counter()

        def largest(most: int) -> int:
            """The longest unpacked length of at most ``most``, or 0."""
            i = bisect_right(sizes, most)
            while i and left[sizes[i - 1]] <= used[sizes[i - 1]]:  # noqa: B023
                i -= 1
            return sizes[i - 1] if i else 0

        gap = capacity
        while gap and (n := largest(gap)):
            take = min(gap // n, left[n] - used[n])
            used[n] += take
            gap -= take * n
        if gap and used.total() > 1:
            smallest = min(used)
            room, best = gap + smallest, (smallest, 0, 0)
            i = bisect_right(sizes, room - 1)
            while i and 2 * sizes[i - 1] > best[0] and best[0] < room:
                a = sizes[i - 1]
                i -= 1
                if left[a] <= used[a]:
                    continue
                used[a] += 1
                b = largest(min(a, room - a))
                used[a] -= 1
                if b and a + b > best[0]:
                    best = (a + b, a, b)
            if best[1]:
                used[smallest] -= 1
                used[best[1]] += 1
                used[best[2]] += 1
        used = +used
        times = min(left[n] // c for n, c in used.items())
        bins.append((tuple(sorted(used.elements(), reverse=True)), times))
        for n, c in used.items():
            left[n] -= c * times
        sizes = [n for n in sizes if left[n]]
    return bins


def _places(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Length -> arrays by run of equal bins: first rank, pieces a bin, first bin, offset of the first piece there."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    placed: Counter[int] = Counter()
    first = 0
    for lengths, times in bins:
        offset = 0
        for n, c in Counter(lengths).items():
            runs.setdefault(n, []).append((placed[n], c, first, offset))
            placed[n] += c * times
            offset += c * n
        first += times
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for n, rows in runs.items()}


def pack(pieces: DataFrame, keys: list[str], capacity: int = 1024, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` (long) and ``offset`` (long, gapless from 0 in each sequence).

    ``pieces`` is read more than once and should be a written table; ``keys`` fix the order of equally long pieces
    (rows that agree on all keys are interchangeable). Columns named like those that are added are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    length = F.col(length_col).cast("long")
    fits = F.coalesce(length.between(1, capacity), F.lit(False))
    counts = {r["n"]: r["c"] for r in pieces.groupBy(F.when(fits, length).alias("n")).agg(F.count("*").alias("c")).collect()}  # capacity + 1 rows at most
    if None in counts:
        raise ValueError(f"{counts[None]} pieces have no length in 1..{capacity}")
    places = _places(plan_bins(counts, capacity))
    groups = max(RANK_GROUPS, -(-max(counts.values(), default=0) // GROUP_ROWS))
    grouped = pieces.withColumn("__group", F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int"))
    sums = grouped.groupBy(length.alias("__length"), "__group").agg(F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy("__length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("__length", F.col("__group").alias("__of"), before.alias("__before"))
    ranked = grouped.withColumn("__rank", F.row_number().over(Window.partitionBy(length, "__group").orderBy(*keys)) - 1)
    ranked = ranked.join(sums, (length == F.col("__length")) & (F.col("__group") == F.col("__of")), "inner")

    @F.pandas_udf("sequence_id long, offset long")
    def place(n: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, ranks = n.to_numpy(), rank.to_numpy()
        out = np.empty((2, len(ranks)), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            rows, size = order[a:b], int(lengths[order[a]])
            start, each, first, offset = places[size]
            run = np.searchsorted(start, ranks[rows], "right") - 1
            within = ranks[rows] - start[run]
            out[0, rows] = first[run] + within // each[run]
            out[1, rows] = offset[run] + within % each[run] * size
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    at = place(length, F.col("__rank") + F.col("__before"))
    return ranked.withColumn("__at", at).select(*pieces.columns, "__at.sequence_id", "__at.offset")


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The packed sequences: ``sequence_id`` and ``ids``, the pieces' ids joined in order (at most ``capacity``)."""
    inside = F.sort_array(F.collect_list(F.struct("offset", ids_col)))
    joined = F.aggregate(inside, F.lit(b""), lambda a, x: F.concat(a, x[ids_col]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
