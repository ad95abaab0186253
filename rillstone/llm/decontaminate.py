"""Benchmark decontamination by Wu-Manber search over words (operator 10).

Every run of ``window`` words of a benchmark text is a pattern (a text of fewer words is one pattern of them all).
For patterns of m words a table tells, for each block of two words, how far the search may move on when it ends there:
most blocks stand in no pattern and skip m - 1 words. Where a pattern may end, the patterns that end in the same block
are compared, first by their hash, then word by word.

Results: one per row; a null text has no words. Empty benchmark texts have no pattern. Benchmark rows with a null id
mark words but appear in no list of items; repeated benchmark rows count once. Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, materialize, spread
from rillstone.llm.words import PLAIN, mix, slices, words

WINDOW = 10
#: Benchmark text that one pass holds in each worker. A larger benchmark takes more passes, each with its share.
PASS_BYTES = 16 << 20


class _Patterns:
    """Shift table and suffix buckets of patterns of one length."""

    def __init__(self, length: int, found: dict[tuple[bytes, ...], tuple[int, set[int]]], hashes: dict[bytes, int]) -> None:
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[int, tuple[bytes, ...], set[int]]]] = {}
        for pattern, (first, items) in found.items():
            hashed = np.array([hashes[w] for w in pattern], np.uint64)
            ends = blocks(hashed, self.block).tolist()
            for at, block in enumerate(ends):
                left = len(ends) - 1 - at
                if left < self.shift.get(block, self.default):
                    self.shift[block] = left
            self.bucket.setdefault(ends[-1], []).append((first, pattern, items))


def blocks(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of each block of ``size`` (1 or 2) words."""
    return hashed if size == 1 else mix(hashed[:-1] * np.uint64(0xE7037ED1A0B428DB) + hashed[1:])


class WuManber:
    """Patterns of all lengths of some benchmark texts."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], window: int = WINDOW) -> None:
        found: dict[int, dict[tuple[bytes, ...], tuple[int, set[int]]]] = {}
        hashes: dict[bytes, int] = {}
        self.ids: list = []
        number: dict = {}
        for item, text in items:
            for data, offsets in slices(pa.array([text or ""])):
                w = words(data, offsets, PLAIN)
                terms, h = [w.word(k) for k in range(len(w.start))], w.hash.tolist()
                hashes.update(zip(terms, h, strict=True))
                n = min(window, len(terms))
                for k in range(len(terms) - n + 1 if n else 0):
                    mine = found.setdefault(n, {}).setdefault(tuple(terms[k : k + n]), (h[k], set()))[1]
                    if item is not None:
                        if item not in number:
                            number[item] = len(self.ids)
                            self.ids.append(item)
                        mine.add(number[item])
        self.groups = [_Patterns(n, patterns, hashes) for n, patterns in sorted(found.items())]

    def search(self, texts: pa.Array) -> list[tuple[int, list[tuple[int, int]], list]]:
        """Per text: number of words, hit spans (first and last word, merged, ascending) and the items that occur."""
        out = []
        for data, offsets in slices(texts):
            w = words(data, offsets, PLAIN)
            hits: dict[int, tuple[list, set]] = {}
            first, h = w.first.tolist(), memoryview(w.hash)
            for g in self.groups:
                step = memoryview(blocks(w.hash, g.block))
                shift, default, bucket, length, back = g.shift.get, g.default, g.bucket, g.length, g.block - 1
                for text in range(len(first) - 1):
                    i, stop = first[text] + length - 1, first[text + 1]
                    while i < stop:
                        block = step[i - back]
                        far = shift(block, default)
                        if far:
                            i += far
                            continue
                        a = i - length + 1
                        for start, pattern, items in bucket[block]:
                            if h[a] == start and all(w.word(a + k) == t for k, t in enumerate(pattern)):
                                mine = hits.setdefault(text, ([], set()))
                                mine[0].append((a - first[text], i - first[text]))
                                mine[1].update(items)
                                break
                        i += 1
            for text in range(len(first) - 1):
                spans, items = hits.get(text, ((), ()))
                out.append((first[text + 1] - first[text], _merged(spans), [self.ids[k] for k in items]))
        return out


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _searched(items: Broadcast, window: int, id_type: str) -> Callable[[str], Column]:
    made: list[WuManber] = []

    @F.arrow_udf(f"n_words long, spans array<struct<first:long,last:long>>, items array<{id_type}>")
    def search(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(WuManber(items.value, window))
        found = made[0].search(texts)
        spans = pa.array([[{"first": a, "last": b} for a, b in s] for _, s, _ in found], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
        ids = pa.array([i for _, _, i in found], pa.list_(pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()))
        return pa.StructArray.from_arrays([pa.array([n for n, _, _ in found], pa.int64()), spans, ids], names=["n_words", "spans", "items"])

    return search


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, hits_col: str = "hits", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` with a struct ``hits_col``: ``n_words``, ``spans`` (hit words, first and last) and ``items``.

    The benchmark's bytes are summed first: up to ``pass_bytes`` it is broadcast whole, and ``docs`` is not shuffled.
    Beyond that it is dealt out to as many passes as needed, each broadcasting its share. What occurs depends on the text
    alone, so all passes but the last write only the hits of texts that have any, by the text's digest.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null").distinct()
    id_type = items.schema["item"].dataType.simpleString()
    if id_type not in ("int", "bigint", "string"):
        raise ValueError(f"item ids of type {id_type}")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    share = F.pmod(F.xxhash64("text"), F.lit(passes))

    def found(k: int) -> Column:
        part = spark.sparkContext.broadcast([tuple(r) for r in items.where(share == k).collect()])  # at most about pass_bytes
        return _searched(part, window, id_type)(F.coalesce(F.col(text_col), F.lit("")))

    docs = spread(docs)
    hit = docs.withColumn(hits_col, found(0))
    if passes == 1:
        return hit
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    more = None
    for k in range(1, passes):
        some = docs.select(digest.alias("of"), found(k).alias("h")).where(F.size("h.spans") > 0).dropDuplicates(["of"])
        some = materialize(some.select("of", "h.spans", "h.items"), "hits")
        more = some if more is None else more.unionByName(some)
    more = more.groupBy("of").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))  # a row per pass, at most
    free = next(n for n in map("more{}".format, range(len(docs.columns) + 1)) if n not in docs.columns)
    both = hit.join(more.select(F.struct("of", "spans", "items").alias(free)), digest == F.col(free)["of"], "left")
    none = F.col(free).isNull()
    spans = F.array_sort(F.concat(f"{hits_col}.spans", F.col(free)["spans"]))
    joined = F.aggregate(
        spans,
        F.expr("cast(array() as array<struct<first:long,last:long>>)"),
        lambda a, s: F.when((F.size(a) > 0) & (s["first"] <= F.element_at(a, -1)["last"] + 1), F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(F.element_at(a, -1)["first"].alias("first"), F.greatest(F.element_at(a, -1)["last"], s["last"]).alias("last"))))).otherwise(
            F.concat(a, F.array(s))
        ),
    )
    merged = F.struct(F.col(f"{hits_col}.n_words").alias("n_words"), joined.alias("spans"), F.array_union(f"{hits_col}.items", F.col(free)["items"]).alias("items"))
    return both.withColumn(hits_col, F.when(none, F.col(hits_col)).otherwise(merged)).drop(free)


def hit_words(hits: Column) -> Column:
    """Number of hit words of a ``with_hits`` struct."""
    return F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """``docs`` without rows in which a benchmark pattern occurs; all columns as they were."""
    return with_hits(docs, benchmark, hits_col="__hits", **options).where(F.size("__hits.spans") == 0).select(*docs.columns)
