"""Near duplicates by MinHash bands with sequential Bayesian verification (operator 7).

1. A text's set of word shingles is sketched to ``BANDS * ROWS`` minimum hashes. Texts of equal sets are one class; from
   here on its smallest document stands for it.
2. Documents that agree on all hashes of a band share a bucket. In each bucket all are compared with its smallest
   document only: that is linear in the bucket and joins most of what belongs together.
3. What still lies in different components of a bucket is compared pair by pair: small buckets emit these pairs. The
   documents of large ones meet only where they share one of their rarest shingles (``_Finder.rare_pairs``), which loses
   no link and keeps apart what has a common passage only. Pairs inside a component need no comparison, since the result
   is the component and no link is lost by leaving them out.

A comparison looks at the signatures one batch after another and gives a pair up once the posterior probability of a
similarity of at least the threshold falls below ``MISS``. Survivors are verified on their full sets.

Losses: a link at exactly the threshold 0.8 shares no bucket with a probability of (1 - 0.8**5)**40 = 1.3e-7, a more
similar one with less; verification gives it up with a probability of about ``MISS``.

Results: one row per input row. Null, empty and blank texts have no set and link with nothing. Equal texts are linked.
Rows of a null doc_id keep their sets out of all links (component null, not kept). Rows of equal doc_id are told apart
by their texts. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, discard, materialize, spread
from rillstone.llm.components import connected_components
from rillstone.llm.words import SPACED, shingles, slices, words

BANDS, ROWS = 40, 5
#: Probability at which a pair is given up, and the number of hashes in each batch of the comparison.
MISS, BATCH = 1e-6, 40
#: Buckets of more documents than this emit only pairs with a rare shingle in common.
SMALL_BUCKET = 8
#: Documents in verification whose ids may be broadcast (16 bytes each); more are shuffled.
BROADCAST_IDS = 500_000

_MULTIPLIERS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = np.random.Generator(np.random.PCG64(8)).integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set that isn't empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_MULTIPLIERS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        h = np.multiply.outer(_MULTIPLIERS, x[i : i + 1024])
        h += _ADDENDS[:, None]
        np.minimum(out, h.min(1), out=out)
    return out


def posterior(m: int, n: int, threshold: float) -> float:
    """Probability of a similarity of at least ``threshold`` after ``m`` of ``n`` hashes agreed, all being alike likely before."""
    x = (np.arange(20_000) + 0.5) / 20_000
    log = m * np.log(x) + (n - m) * np.log1p(-x) - (lgamma(m + 1) + lgamma(n - m + 1) - lgamma(n + 2))
    density = np.exp(log)
    return float(density[x >= threshold].sum() / density.sum())


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """For each number of compared hashes: the smallest number of matches with which a pair goes on."""
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        low, high = 0, n
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if posterior(mid, n, threshold) >= miss else (mid + 1, high)
        out.append((n, low))
    return out


def _agree(a: np.ndarray, b: np.ndarray, stops: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two signature matrices that no batch of hashes gives up."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in stops:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)


def _sketch(size: int):
    @F.arrow_udf("n_shingles long, digest binary, signature binary")
    def sketch(texts: pa.Array) -> pa.Array:
        n, digest, sign = [], [], []
        for data, offsets in slices(texts):
            for s in shingles(words(data, offsets, SPACED), size):
                n.append(len(s))
                digest.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sign.append(signature(s).tobytes() if len(s) else None)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sign, pa.binary())], names=["n_shingles", "digest", "signature"])

    return sketch


def _full_set(size: int):
    @F.arrow_udf("array<long>")
    def full(texts: pa.Array) -> pa.Array:
        sets = [s for data, offsets in slices(texts) for s in shingles(words(data, offsets, SPACED), size)]
        ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64()))

    return full


class _Finder:
    """One run over one table."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> None:
        bound_batches(docs.sparkSession)
        self.size, self.percent = size, percent
        self.stops = least_matches(percent / 100)
        self.docs = spread(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        self.kind = self.docs.schema["doc_id"].dataType.simpleString()
        sketched = self.docs.select("doc_id", _sketch(size)("text").alias("s")).select("doc_id", "s.*")
        self.spent: list[DataFrame] = []
        self.sketched = materialize(sketched, "sketches")
        known = self.sketched.where("n_shingles > 0 and doc_id is not null")
        self.classes = self.write(known.groupBy("digest").agg(F.min("doc_id").alias("first")), "classes")  # a digest may stand for a third of all rows
        one = known.join(self.classes.withColumnRenamed("first", "doc_id"), ["digest", "doc_id"], "left_semi")
        self.signed = self.write(one.select("doc_id", "signature"), "signatures")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written until the run ends."""
        self.spent.append(materialize(df, name))
        return self.spent[-1]

    def members(self) -> DataFrame:
        """``bucket, hub, doc_id`` of all buckets with two documents or more; the hub is the smallest."""
        keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * 4 * ROWS + 1, F.lit(4 * ROWS))))
        rows = self.signed.select("doc_id", F.explode(keys).alias("bucket"))
        hubs = rows.groupBy("bucket").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").drop("last")
        return self.write(rows.join(self.write(hubs, "hubs"), "bucket"), "buckets")  # written, so that a large bucket's join can be split

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that their signatures do not rule out."""
        stops = self.stops

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = pa.array(_agree(_matrix(batch.column("sa")), _matrix(batch.column("sb")), stops))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

        left = self.signed.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
        right = self.signed.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))
        return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(compare, f"a {self.kind}, b {self.kind}")

    def sets(self, ids: DataFrame) -> DataFrame:
        """``doc_id, s``: the full sets of the documents in ``ids``."""
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        return self.docs.join(ids, "doc_id", "left_semi").select("doc_id", _full_set(self.size)("text").alias("s"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The likely pairs whose full sets reach the threshold."""
        likely = self.write(pairs, "likely")
        sets = self.write(self.sets(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()), "sets")
        left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
        x, y, both = F.size("sa"), F.size("sb"), F.size(F.array_intersect("sa", "sb"))
        paired = likely.join(right, "b").join(left, "a").where(100 * F.least(x, y) >= self.percent * F.greatest(x, y))
        found = paired.where(100 * both >= self.percent * (x + y - both)).select("a", "b")
        return self.write(found, "links")  # the pairs are distinct; an aggregate here would keep a hub's join from being split

    def rest(self, members: DataFrame, parts: DataFrame) -> DataFrame:
        """Links between bucket members in different components, besides those with the hub."""
        labelled = members.where("doc_id > hub").join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("part"))
        mixed = labelled.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n")).where("low < high")
        open_ = self.write(labelled.join(self.write(mixed.select("bucket", "n"), "mixed-buckets"), "bucket"), "open-buckets")
        small = open_.where(F.col("n") <= SMALL_BUCKET)
        other = small.select("bucket", F.col("doc_id").alias("b"), F.col("part").alias("other"))
        pairs = small.join(other, "bucket").where("doc_id < b and part != other").select(F.col("doc_id").alias("a"), "b")
        dense = self.rare_pairs(open_.where(F.col("n") > SMALL_BUCKET).select("doc_id", "part").distinct())
        return self.links(self.likely(pairs.union(dense).distinct()))

    def rare_pairs(self, dense: DataFrame) -> DataFrame:
        """Pairs (a < b) of documents (doc_id, part) of different parts that can be links and share a rare shingle.

        All sets are put in one order, shingles of the fewest documents first. Where two sets reach the threshold, their
        first common shingle stands so early in both that enough can follow it (prefix and position filters); a passage
        that many documents share stands behind that place. Shingles of a single part need no pairs; of others, the
        documents outside the shingle's largest part meet all.
        """
        percent, n = F.lit(self.percent), F.col("n")
        profiles = self.write(self.sets(dense.select("doc_id")).join(dense, "doc_id").select("doc_id", "part", F.size("s").cast("long").alias("n"), "s"), "dense-sets")
        single = profiles.select("doc_id", "part", "n", F.explode("s").alias("t"))
        often = self.write(single.groupBy("t").agg(F.count("*").alias("df")).where("df > 1"), "shared-shingles")  # written, so that a common shingle's join can be split
        known = single.join(often, "t").groupBy("doc_id", "part", "n").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("k"))  # those of one document come before them
        alone = n - F.size("k")
        reach = n - F.ceil(percent * n / 100) + 1  # against smaller sets; against larger ones fewer will do
        near = n - F.ceil(2 * percent * n / (percent + 100)) + 1
        first = known.withColumn("alone", alone).withColumn("k", F.slice("k", 1, F.greatest(F.lit(0), reach - alone).cast("int")))
        first = first.select("doc_id", "part", "n", "alone", near.alias("near"), F.posexplode("k").alias("i", "x"))
        first = self.write(first.select(F.col("x.t").alias("t"), "doc_id", "part", "n", (F.col("alone") + F.col("i")).alias("p"), (F.col("alone") + F.col("i") < F.col("near")).alias("early")), "rare-shingles")
        largest = first.groupBy("t", "part").agg(F.count("*").alias("c")).groupBy("t").agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
        largest = self.write(largest.drop("parts"), "largest-parts")
        mixed = self.write(first.join(largest, "t"), "mixed-shingles")
        x = mixed.where("part != main").select("t", *(F.col(c).alias(f"x_{c}") for c in ("doc_id", "part", "n", "p", "early")))
        y = mixed.drop("main")
        smaller = F.col("x_n") < n
        indexed = F.when(smaller, F.col("x_early")).when(F.col("x_n") > n, F.col("early")).otherwise(F.col("early") & F.col("x_early"))
        fits = percent * F.greatest("x_n", "n") <= 100 * F.least("x_n", "n")
        enough = (percent + 100) * F.least(F.col("x_n") - F.col("x_p"), n - F.col("p")) >= percent * (F.col("x_n") + n)
        found = x.join(y, (x["t"] == y["t"]) & (F.col("x_part") != F.col("part")) & indexed & fits & enough)
        return found.select(F.least("x_doc_id", "doc_id").alias("a"), F.greatest("x_doc_id", "doc_id").alias("b"))

    def run(self) -> DataFrame:
        members = self.members()
        first = self.links(self.likely(members.where("doc_id > hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()))
        parts = connected_components(first)
        second = self.rest(members, parts)
        parts = connected_components(first.union(second))
        classes = materialize(self.classes.join(parts, F.col("first") == F.col("node"), "left").select("digest", F.coalesce("component", "first").alias("component")), "classes")
        for written in self.spent:
            discard(written)
        slim = self.sketched.select("doc_id", "n_shingles", "digest")
        found = slim.join(classes, "digest", "left")
        alone = F.col("digest").isNull()
        component = F.when(F.col("doc_id").isNull(), None).when(alone, F.col("doc_id")).otherwise(F.col("component"))
        return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` (smallest doc_id reachable), ``kept``.

    Two documents are linked if 100 times the size of their sets' intersection is at least ``percent`` times that of
    their union. Ids are integers.
    """
    return _Finder(docs, id_col, text_col, shingle_words, percent).run()


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest document of each component only; all columns as they were.

    Rows of a null id and texts without words stay. Rows of equal id stay or go together; of equal id and text one stays.
    """
    found = materialize(near_duplicates(docs, id_col, text_col, shingle_words, percent), "components")
    known = found.where("doc_id is not null")
    gone = known.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    left = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    repeated = known.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(id_col))
    if repeated.isEmpty():
        return left
    single = left.join(repeated, id_col, "left_anti").select(*docs.columns)
    return single.unionByName(left.join(repeated, id_col, "left_semi").dropDuplicates([id_col, text_col]))
