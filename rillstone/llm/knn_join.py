"""Exact top-k search by a Voronoi kNN join (operator 4).

Data rows belong to the cell of their nearest pivot, queries to that of the pivot of largest product. A cell's summary
is its radius in steps and the ``k + 1`` rows next to its pivot. Scored against all summaries' rows, every query knows
k scores that its k-th best can't fall below. Since q.x <= q.c + |q| |x - c|, that score tells how far from the pivot c
a row must lie to be among the k best; the least such distance over a group's queries is the group's bound for the
cell, and only rows beyond it are sent to the group. Groups are solved in blocks of bounded size, and the blocks' best
are merged.

Query cells make up groups where that saves work: the summaries tell about how many rows a group would be sent, and of
several ways to join cells to groups the one of least rows and scores is taken. Vectors without clusters are all within
each other's reach; they make one group, and no row is sent twice but for the number of query blocks.

All scores are exact integers: sums that doubles can't hold are done once more in whole numbers of any size.

Results: as many rows per query as there are candidates, at most k. Vectors that are null or hold null or non-finite
components take no part, nor do rows of a null id. Shorter vectors count as padded with zeros. Rows that repeat an id
are separate candidates, never for their own id; a query id that repeats is answered once, for the smallest of its
vectors (component by component). Empty tables give empty results. Raises where a result's score doesn't fit a long, or
a component is beyond 2**500 after scaling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, materialize

#: Rows of data and queries that meet in one task, and queries that are scored at once there.
DATA_BLOCK, QUERY_BLOCK, AT_ONCE = 16_384, 2_048, 128
#: Rows for each pivot, bounds of the number of pivots, and rows for each pivot from which pivots are chosen.
ROWS_PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS, SAMPLE = 128, 4, 128, 16
#: Steps in which a cell's distances are told, and the scores that cost as much as sending a row.
STEPS, ROW_COST = 16, 200


def scaled_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` (scale * x as doubles, not yet rounded down) of the vectors that take part."""
    v = F.col(vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    scaled = F.when(F.coalesce(F.forall(v, finite), F.lit(False)), F.transform(v, lambda x: x.cast("double") * scale))
    return table.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("vec_id"), scaled.alias("v")).where("v is not null")


def _pack(dims: int, kind: str):
    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        n = np.asarray(vectors.value_lengths()).astype(np.int64)
        out = np.zeros((len(vectors), dims), kind)
        out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = np.floor(np.asarray(vectors.flatten()))
        return pa.array([row.tobytes() for row in out], pa.binary())

    return pack


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims) if dims else np.zeros((len(column), 0), kind)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def choose_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Centres of a few rounds of Lloyd's algorithm over a sample, begun at its first distinct rows."""
    _, first = np.unique(sample, axis=0, return_index=True)
    pivots = sample[np.sort(first)[:wanted]].copy()
    for _ in range(5):
        near = ((pivots * pivots).sum(1) - 2 * sample @ pivots.T).argmin(1)
        for j in np.unique(near).tolist():
            pivots[j] = sample[near == j].mean(0)
    return pivots


def _assign(pivots: np.ndarray, dims: int, kind: str):
    """Nearest pivot of each data vector and the distance to it."""

    @F.arrow_udf("cell int, dist double")
    def assign(vectors: pa.Array) -> pa.Array:
        x = _matrix(vectors, dims, kind).astype(np.float64)
        cell = ((pivots * pivots).sum(1) - 2 * x @ pivots.T).argmin(1)
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(_norms(x - pivots[cell]))], names=["cell", "dist"])

    return assign


def least_distances(q: np.ndarray, ids: np.ndarray, pivots: np.ndarray, known: np.ndarray, known_ids: np.ndarray, k: int) -> np.ndarray:
    """For each query and pivot: rows nearer to the pivot than this can't be among the query's k best."""
    score = q @ known.T
    score[ids[:, None] == known_ids] = -np.inf
    norm, far = _norms(q), max(_norms(known).max(initial=0), _norms(pivots).max(initial=0))
    kth = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if score.shape[1] >= k else np.full(len(q), -np.inf)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = (kth[:, None] - q @ pivots.T) / norm[:, None] - 1e-9 * (far + 1)  # a margin for rounding
    return np.where(np.isfinite(out) & (norm > 0)[:, None], out, -np.inf)


def _queries(pivots: np.ndarray, used: np.ndarray, shared: Broadcast, dims: int, kind: str, k: int):
    """Cell of each query and its least distances by cell."""

    @F.arrow_udf("cell int, least array<double>")
    def place(ids: pa.Array, vectors: pa.Array) -> pa.Array:
        q = _matrix(vectors, dims, kind).astype(np.float64)
        known, known_ids = shared.value
        least = least_distances(q, np.asarray(ids), pivots, known, known_ids, k)
        cell = used[(q @ pivots[used].T).argmax(1)] if len(used) else np.zeros(len(q), np.int64)
        return pa.StructArray.from_arrays([pa.array(cell.astype(np.int32)), pa.array(least.tolist(), pa.list_(pa.float64()))], names=["cell", "least"])

    return place


def plan_groups(sizes: dict[int, int], bounds: dict[int, np.ndarray], rows: np.ndarray, steps: np.ndarray, pivots: np.ndarray) -> dict[int, int]:
    """Query cell -> group. ``bounds``: least distances by query cell; ``rows`` and ``steps``: rows and distances of data cells."""
    cells = sorted(sizes)
    if not cells:
        return {}
    order, left = [cells[0]], set(cells[1:])  # from one cell to the most similar one left
    while left:
        order.append(max(left, key=lambda c: (float(pivots[c] @ pivots[order[-1]]), -c)))
        left.remove(order[-1])

    def sent(bound: np.ndarray) -> float:
        return sum(n * (1 - (np.searchsorted(s, b, "left") - 1) / STEPS if b > s[0] else 1.0) for n, s, b in zip(rows, steps, bound, strict=True) if n and b <= s[-1])

    best, least = None, np.inf
    parts = 1
    while True:
        groups = [g.tolist() for g in np.array_split(np.array(order), parts)]
        cost = 0.0
        for g in groups:
            asked = sum(sizes[c] for c in g)
            cost += sent(np.min([bounds[c] for c in g], axis=0)) * (ROW_COST * -(-asked // QUERY_BLOCK) + asked)
        if cost < least:
            best, least = groups, cost
        if parts == len(order):
            return {c: i for i, g in enumerate(best) for c in g}
        parts = min(2 * parts, len(order))


def exact_best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int, k: int, approximate: np.ndarray, error: float) -> tuple[list[int], list[int]]:
    """Places and exact scores of a query's k best rows, which stand in ascending order of ``ids``."""
    near = np.flatnonzero(ids != own)
    if len(near) > k:
        mine = approximate[near]
        near = near[mine >= np.partition(mine, len(mine) - k)[len(mine) - k] - 2 * error]
    whole = [int(v) for v in q.tolist()]
    scored = sorted(((-sum(a * int(b) for a, b in zip(whole, x[i].tolist(), strict=True)), i) for i in near.tolist()))[:k]
    return [i for _, i in scored], [-s for s, _ in scored]


def _best(k: int, dims: int, id_type: str, kind: str):
    """Top k of every query of a block among the block's data."""

    def solve(table: pa.Table) -> pa.Table:
        query = np.asarray(table.column("is_query"))
        ids, x = np.asarray(table.column("vec_id")), _matrix(table.column("vec"), dims, kind).astype(np.float64)
        data = np.flatnonzero(~query)
        data = data[np.argsort(ids[data], kind="stable")]  # equal scores: smaller ids stand first
        asked, data_ids, right = np.flatnonzero(query), ids[data], x[data]
        most, out = _norms(right).max(initial=0), []
        for a in range(0, len(asked), AT_ONCE):
            rows = asked[a : a + AT_ONCE]
            for q, r, s in zip(x[rows], ids[rows].tolist(), x[rows] @ right.T, strict=True):
                bound = float(_norms(q[None])[0] * most)  # of all partial sums
                if bound < 2.0**52:
                    near = np.flatnonzero(data_ids != r)
                    if len(near) > k:
                        mine = s[near]
                        near = near[mine >= np.partition(mine, len(mine) - k)[len(mine) - k]]
                    near = near[np.argsort(-s[near], kind="stable")[:k]]
                    scores = s[near].astype(np.int64)
                else:
                    near, scores = exact_best(q, right, data_ids, r, k, s, bound * (dims + 2) * 2.0**-52)
                    if any(not -(2**63) <= v < 2**63 for v in scores):
                        raise ValueError(f"a score of the query {r} does not fit a long")
                out.append((np.full(len(near), r), data_ids[near], np.array(scores, np.int64)))
        parts = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        made = pa.table(dict(zip(("query_id", "vec_id", "score"), parts, strict=True)))
        ids_type = pa.int32() if id_type == "int" else pa.int64()
        return made.cast(pa.schema([("query_id", ids_type), ("vec_id", ids_type), ("score", pa.int64())]))

    return solve


class VoronoiJoin:
    """One search over one table; ``routed`` holds the rows that groups are sent."""

    def __init__(self, table: DataFrame, is_query: Column, k: int, scale: int, id_col: str, vector_col: str) -> None:
        self.spark, self.k = table.sparkSession, k
        bound_batches(self.spark)
        scaled = scaled_vectors(table, id_col, vector_col, scale)
        self.id_type = scaled.schema["vec_id"].dataType.simpleString()
        widest = F.aggregate("v", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
        facts = scaled.agg(F.max(F.size("v")).alias("dims"), F.max(widest).alias("most")).first()
        self.dims, most = facts["dims"] or 1, facts["most"] or 0.0
        if most > 2.0**500:
            raise ValueError("a component is beyond 2**500 after scaling")
        self.kind = "<i4" if most < 2**31 - 1 else "<f8"
        pack = _pack(self.dims, self.kind)
        self.packed = materialize(scaled.select("vec_id", pack("v").alias("vec")), "vectors")
        self.queries = scaled.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", pack("v").alias("vec"))
        self.asked = self.queries.count()
        self.routed = None

    def _wide(self, rows: list) -> np.ndarray:
        return np.array([np.frombuffer(bytes(r["vec"]), self.kind) for r in rows], np.float64).reshape(len(rows), self.dims)

    def run(self) -> DataFrame:
        spark, dims, kind, k = self.spark, self.dims, self.kind, self.k
        result = f"query_id {self.id_type}, rank int, vec_id {self.id_type}, score long"
        wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, self.packed.count() // ROWS_PER_PIVOT))
        sample = self.packed.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE * wanted).collect() if self.asked else []
        if not sample:
            return spark.createDataFrame([], result)
        pivots = choose_pivots(self._wide(sample), wanted)

        assign = _assign(pivots, dims, kind)("vec")
        placed = materialize(self.packed.select("vec_id", "vec", assign.alias("a")).select("vec_id", "vec", "a.*"), "cells")
        steps = F.percentile_approx("dist", [i / STEPS for i in range(STEPS + 1)], 1000)
        facts = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), steps.alias("steps"), F.min("dist").alias("low"), F.max("dist").alias("high")).collect()}  # a row per pivot
        nearest = F.row_number().over(Window.partitionBy("cell").orderBy("dist", "vec_id", "vec"))
        summary = placed.withColumn("r", nearest).where(F.col("r") <= k + 1).select("vec_id", "vec").collect()  # (k + 1) rows per pivot
        shared = spark.sparkContext.broadcast((self._wide(summary), np.array([r["vec_id"] for r in summary])))
        used = np.array(sorted(facts))
        place = _queries(pivots, used, shared, dims, kind, k)("vec_id", "vec")
        grouped = materialize(self.queries.select("vec_id", "vec", place.alias("a")).select("vec_id", "vec", "a.*"), "queries")

        by_cell = grouped.select("cell", F.posexplode("least").alias("j", "d")).groupBy("cell", "j").agg(F.min("d").alias("d"), F.count("*").alias("n")).collect()  # pivots squared, at most
        sizes = {r["cell"]: r["n"] for r in by_cell}
        bounds = {c: np.full(len(pivots), -np.inf) for c in sizes}
        for r in by_cell:
            bounds[r["cell"]][r["j"]] = r["d"]
        rows = np.array([facts[j]["n"] if j in facts else 0 for j in range(len(pivots))])
        told = np.array([[facts[j]["low"], *facts[j]["steps"][1:-1], facts[j]["high"]] if j in facts else [0.0] * (STEPS + 1) for j in range(len(pivots))])
        group = plan_groups(sizes, bounds, rows, told, pivots)
        members = {g: [c for c in group if group[c] == g] for g in set(group.values())}
        least = [(g, j, float(np.min([bounds[c][j] for c in cs]))) for g, cs in members.items() for j in facts]
        rings = spark.createDataFrame(least, "grp int, cell int, least double")
        near = placed.join(F.broadcast(rings), "cell").where("dist >= least").select("grp", "vec_id", "vec")  # pivots squared rows, at most
        self.routed = near

        counts = {r["grp"]: r["n"] for r in near.groupBy("grp").agg(F.count("*").alias("n")).collect()}
        plan = [(c, g, max(1, -(-sum(sizes[x] for x in members[g]) // QUERY_BLOCK)), max(1, -(-counts.get(g, 0) // DATA_BLOCK))) for c, g in group.items()]
        blocks = spark.createDataFrame(plan, "cell int, grp int, qn int, dn int")
        own = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        data = near.join(F.broadcast(blocks.drop("cell").distinct()), "grp").select("grp", own("dn").alias("db"), every("qn").alias("qb"), F.lit(False).alias("is_query"), "vec_id", "vec")
        asks = grouped.drop("least").join(F.broadcast(blocks), "cell").select("grp", every("dn").alias("db"), own("qn").alias("qb"), F.lit(True).alias("is_query"), "vec_id", "vec")
        best = data.unionByName(asks).groupBy("grp", "qb", "db").applyInArrow(_best(k, dims, self.id_type, kind), f"query_id {self.id_type}, vec_id {self.id_type}, score long")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(table: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k largest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on the column ``vec_id`` (the id under that name).
    """
    return VoronoiJoin(table, is_query, k, scale, id_col, vector_col).run()
