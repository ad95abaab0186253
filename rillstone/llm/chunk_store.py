"""Content-addressed store of token ids (operator 8).

A rolling hash over the last ids cuts every document's id stream where the hash says so, thus equal passages give equal
chunks wherever they stand. A chunk is named by its digest and stored once. A document is a recipe: its chunks' names in
order and the root of their Merkle tree; a manifest has the root over the recipes of each part.

Layout of a store (all Parquet, so any Spark file system holds it):
  chunks/   digest, n, ids (little-endian unsigned numbers of ``width`` bytes)
  recipes/  part, idx, doc_id, start_in_part, n_tokens, recipe (digests, 16 bytes each), root; ascending doc_id
  manifest/ part, n_docs, n_tokens, root, width; ``part`` ascends with doc_id

Results: one recipe per input row; a null text counts as empty (its document is the end id alone); null ids sort first;
rows of equal doc_id keep separate recipes next to each other; an empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillstone.llm.byte_bpe import byte_bpe
from rillstone.llm.common import bound_batches, new_folder, remove, spread

DIGEST = 16
#: Ids that the rolling hash looks at, and the bounds and mean (a power of two) of a chunk's length.
WINDOW, LEAST, MEAN, MOST = 16, 128, 512, 4096
#: Names a task remembers in order to leave out its own repeats; repeats beyond are found by the shuffle of names.
TASK_NAMES = 200_000
_FACTOR = 0x9E3779B97F4A7C15


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=DIGEST).digest()


def merkle_root(digests: bytes) -> bytes:
    """Root over digests in order; an odd one moves up a level. One digest is its own root; none: the empty digest."""
    level = [digests[i : i + DIGEST] for i in range(0, len(digests), DIGEST)] or [_digest(b"")]
    while len(level) > 1:
        level = [_digest(b"\x01" + level[i] + level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def cut_points(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of one id stream: where the window's hash is 0 modulo MEAN, within LEAST and MOST."""
    n = len(ids)
    if n <= LEAST:
        return [n] if n else []
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mixed(ids), out=sums[1:])
    rolled = sums[WINDOW:] - sums[:-WINDOW]
    rolled *= np.uint64(_FACTOR)
    ends = (np.flatnonzero(rolled >> np.uint64(65 - MEAN.bit_length()) == 0) + WINDOW).tolist()
    out, last = [], 0
    for e in [*ends, n]:
        while e - last > MOST:
            last += MOST
            out.append(last)
        if e - last >= LEAST or e == n and e > last:
            out.append(e)
            last = e
    return out


def _combine(op: int, crc: int) -> int:
    """Product of two polynomials over GF(2) modulo CRC-32's, bits reversed."""
    out, bit = 0, 1 << 31
    while bit:
        if op & bit:
            out ^= crc
        bit >>= 1
        crc = crc >> 1 ^ 0xEDB88320 if crc & 1 else crc >> 1
    return out


class Crc32:
    """CRC-32 of concatenations from the parts' CRCs and lengths."""

    def __init__(self) -> None:
        self.shifts: dict[int, int] = {}

    def shift(self, n: int) -> int:
        """x to the power 8 n."""
        if n not in self.shifts:
            out, square, k = 1 << 31, 1 << 23, n
            while k:
                if k & 1:
                    out = _combine(out, square)
                square = _combine(square, square)
                k >>= 1
            self.shifts[n] = out
        return self.shifts[n]

    def join(self, first: int, second: int, n: int) -> int:
        """CRC of A + B, where ``n`` is the number of bytes of B."""
        return _combine(self.shift(n), first) ^ second


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents, each with ``end_id`` at its end, and write the store at ``path``.

    One pass encodes and cuts; what it writes is dealt into recipes and chunks without encoding again. Only chunk names
    and places are shuffled to find repeats, never the ids.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    slim = spread(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    width = 2 if byte_bpe(vocabulary).size <= 1 << 16 and end_id < 1 << 16 else 4
    names = ["doc_id", "n_tokens", "recipe", "place", "digest", "n", "ids"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, place = byte_bpe(vocabulary).encode, set(), TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                n_tokens, recipes, chunks = [], [], []
                for text in batch.column("text"):
                    ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype(f"<u{width}")
                    data, start, recipe = ids.tobytes(), 0, []
                    for end in cut_points(ids):
                        chunk = data[start * width : end * width]
                        recipe.append(name := _digest(chunk))
                        if name not in seen:
                            if len(seen) < TASK_NAMES:
                                seen.add(name)
                            chunks.append((place, name, end - start, chunk))
                            place += 1
                        start = end
                    n_tokens.append(len(ids))
                    recipes.append(b"".join(recipe))
                k, empty = len(recipes), pa.nulls
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(recipes, pa.binary()), empty(k, pa.int64()), empty(k, pa.binary()), empty(k, pa.int32()), empty(k, pa.binary())], names=names)
                if chunks:
                    k, (places, digests, lengths, data) = len(chunks), zip(*chunks, strict=True)
                    yield pa.RecordBatch.from_arrays([empty(k, batch.column("doc_id").type), empty(k, pa.int64()), empty(k, pa.binary()), pa.array(places, pa.int64()), pa.array(digests, pa.binary()), pa.array(lengths, pa.int32()), pa.array(data, pa.binary())], names=names)

    kind = slim.schema["doc_id"].dataType.simpleString()
    staged = new_folder(spark, "chunks-staged")
    slim.mapInArrow(cut, f"doc_id {kind}, n_tokens long, recipe binary, place long, digest binary, n int, ids binary").write.option("compression", "zstd").parquet(staged)
    stage = spark.read.parquet(staged)

    named = stage.where("place is not null").select("digest", "place")
    repeated = named.groupBy("digest").agg(F.min("place").alias("kept"), F.count("*").alias("copies")).where("copies > 1")
    spare = named.join(repeated, "digest").where("place > kept").select("place")
    once = stage.where("place is not null").join(spare, "place", "left_anti")
    once.select("digest", "n", "ids").write.option("compression", "zstd").parquet(f"{path}/chunks")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, idx, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n, k = batch.column("n_tokens").to_numpy(), batch.num_rows
            roots = [merkle_root(r.as_py()) for r in batch.column("recipe")]
            before = start + np.cumsum(n) - n
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, part, np.int32)), pa.array(np.arange(idx, idx + k)), batch.column("doc_id"), pa.array(before), batch.column("n_tokens"), batch.column("recipe"), pa.array(roots, pa.binary())], names=["part", "idx", "doc_id", "start_in_part", "n_tokens", "recipe", "root"])
            idx, start = idx + k, start + int(n.sum())

    recipes = stage.where("recipe is not null").select("doc_id", "n_tokens", "recipe").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "recipe")
    recipes.mapInArrow(number, f"part int, idx long, doc_id {kind}, start_in_part long, n_tokens long, recipe binary, root binary").write.parquet(f"{path}/recipes")
    parts = part_roots(spark.read.parquet(f"{path}/recipes"))
    parts.withColumn("width", F.lit(width)).write.parquet(f"{path}/manifest")
    remove(spark, staged)


class MerkleFold:
    """The root over digests that come one after another, in memory of the tree's height: as ``merkle_root`` of all."""

    def __init__(self) -> None:
        self.full: list[tuple[int, bytes]] = []  # roots of full subtrees and their numbers of leaves, descending

    def add(self, digest: bytes) -> None:
        n = 1
        while self.full and self.full[-1][0] == n:
            digest, n = _digest(b"\x01" + self.full.pop()[1] + digest), 2 * n
        self.full.append((n, digest))

    def root(self) -> bytes:
        if not self.full:
            return _digest(b"")
        out = self.full[-1][1]
        for _, left in reversed(self.full[:-1]):
            out = _digest(b"\x01" + left + out)
        return out


def part_roots(recipes: DataFrame) -> DataFrame:
    """``part, n_docs, n_tokens, root`` over each part's recipes in the order of ``idx``; no part is gathered in a row."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([docs]), pa.array([tokens]), pa.array([tree.root()], pa.binary())], names=["part", "n_docs", "n_tokens", "root"])

        part, docs, tokens, tree = None, 0, 0, MerkleFold()
        for batch in batches:
            for p, n, root in zip(*(batch.column(c).to_pylist() for c in ("part", "n_tokens", "root")), strict=True):
                if p != part:
                    if part is not None:
                        yield told()
                    part, docs, tokens, tree = p, 0, 0, MerkleFold()
                docs, tokens = docs + 1, tokens + n
                tree.add(root)
        if part is not None:
            yield told()

    slim = recipes.select("part", "idx", "n_tokens", "root").repartition("part").sortWithinPartitions("part", "idx")
    return slim.mapInArrow(fold, "part int, n_docs long, n_tokens long, root binary")


def _chunk_facts(chunks: DataFrame) -> DataFrame:
    """``digest, n, crc`` of every stored chunk, after its content was compared with its name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for digest, n, ids in zip(*(batch.column(c).to_pylist() for c in ("digest", "n", "ids")), strict=True):
                if _digest(ids) != digest or len(ids) % n:
                    raise ValueError(f"chunk {digest.hex()} is damaged")
                crcs.append(zlib.crc32(np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("n"), pa.array(crcs, pa.int64())], names=["digest", "n", "crc"])

    return chunks.mapInArrow(read, "digest binary, n int, crc long")


def _exploded(recipes: DataFrame) -> DataFrame:
    names = F.transform(F.sequence(F.lit(0), (F.octet_length("recipe") / DIGEST).cast("int") - 1), lambda i: F.substring("recipe", i * DIGEST + 1, F.lit(DIGEST)))
    return recipes.select("part", "idx", "doc_id", "start_in_part", "n_tokens", "root", F.posexplode(names).alias("pos", "digest"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32``.

    Every stored chunk is read and checked against its name; a document's Merkle root is built again from its recipe,
    its CRC from those of its chunks. A damaged chunk, recipe or a missing chunk raises.
    """
    facts = _chunk_facts(spark.read.parquet(f"{path}/chunks"))
    recipes = spark.read.parquet(f"{path}/recipes")
    parts = spark.read.parquet(f"{path}/manifest").select("part", "n_tokens")
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))  # a row per recipe file

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc32 = Crc32()
        for batch in batches:
            out = []
            for doc, root, n_tokens, chunks in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "root", "n_tokens", "chunks")), strict=True):
                if any(c["n"] is None for c in chunks):
                    raise ValueError(f"document {doc} lacks a chunk")
                if merkle_root(b"".join(c["digest"] for c in chunks)) != root or sum(c["n"] for c in chunks) != n_tokens:
                    raise ValueError(f"document {doc} doesn't match its manifest")
                crc = 0
                for c in chunks:
                    crc = crc32.join(crc, c["crc"], 4 * c["n"])
                out.append(crc)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("part", "doc_id", "start_in_part", "n_tokens")), pa.array(out, pa.int64())], names=["part", "doc_id", "start_in_part", "n_tokens", "ids_crc32"])

    chunked = _exploded(recipes).join(facts, "digest", "left")
    whole = chunked.groupBy("part", "idx").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "start_in_part", "n_tokens", "root")), F.sort_array(F.collect_list(F.struct("pos", "digest", "n", "crc"))).alias("chunks")
    )
    kind = recipes.schema["doc_id"].dataType.simpleString()
    done = whole.mapInArrow(assemble, f"part int, doc_id {kind}, start_in_part long, n_tokens long, ids_crc32 long")
    return done.join(parts, "part").select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def restore(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit numbers) of all documents, or of those whose doc_id ``only`` has."""
    recipes = spark.read.parquet(f"{path}/recipes")
    if only is not None:
        recipes = recipes.join(only.select("doc_id").distinct(), "doc_id", "left_semi")
    chunked = _exploded(recipes).join(spark.read.parquet(f"{path}/chunks"), "digest")
    whole = chunked.groupBy("part", "idx").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("pos", "n", "ids"))).alias("chunks"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(np.frombuffer(c["ids"], f"<u{len(c['ids']) // c['n']}").astype("<u4").tobytes() for c in doc) for doc in batch.column("chunks").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return whole.mapInArrow(widen, f"doc_id {recipes.schema['doc_id'].dataType.simpleString()}, ids binary")


def verify_store(spark: SparkSession, path: str) -> int:
    """Number of parts whose recipes do not give the manifest's root or counts (0: the store is whole)."""
    found = part_roots(spark.read.parquet(f"{path}/recipes")).select("part", F.col("n_docs").alias("docs"), F.col("n_tokens").alias("tokens"), F.col("root").alias("found"))
    both = spark.read.parquet(f"{path}/manifest").join(found, "part", "full")
    return both.where(~(F.col("root").eqNullSafe(F.col("found")) & F.col("n_docs").eqNullSafe(F.col("docs")) & F.col("n_tokens").eqNullSafe(F.col("tokens")))).count()
