"""Values at exact ranks of a column, by narrowing ranges instead of sorting or gathering the column."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows among which a rank is found by sorting them, and the accuracy of the sketches that narrow a larger range.
SORTED, ACCURACY = 100_000, 2_000


def _sorted_at(values: DataFrame, rank: int) -> float:
    """The value at a rank of a few rows (``SORTED`` at most): equal ones are counted before they meet in one task."""
    counts = values.groupBy("v").agg(F.count("*").alias("n")).sort("v").collect()
    for r in counts:
        if rank < r.n:
            return r.v
        rank -= r.n
    raise IndexError("rank beyond the rows")


def value_at(values: DataFrame, rank: int, rows: int, few: int = SORTED, accuracy: int = ACCURACY) -> float:
    """The value at ``rank`` (from 0) of ``values`` (v: double without nulls and NaN), which has ``rows`` rows.

    A sketch of quantiles, merged over the partitions, names two values around the rank, and one more pass counts the
    rows below, at and between them exactly. The rank is at one of the two, or the search goes on strictly inside a
    smaller range, mostly of 4 / ``accuracy`` of the rows. A sketch that errs costs a pass and never the result.
    """
    inside = values
    while rows > few:
        q, e = (rank + 0.5) / rows, 2 / accuracy
        a, b = inside.agg(F.percentile_approx("v", [max(0.0, q - e), min(1.0, q + e)], accuracy).alias("q")).first().q
        v = F.col("v")
        below_a, upto_a, below_b, upto_b = inside.agg(*(F.count_if(c) for c in (v < a, v <= a, v < b, v <= b))).first()
        if below_a <= rank < upto_a:
            return a
        if below_b <= rank < upto_b:
            return b
        if rank < below_a:
            inside, rows = inside.where(v < a), below_a
        elif rank < below_b:
            inside, rank, rows = inside.where((v > a) & (v < b)), rank - upto_a, below_b - upto_a
        else:
            inside, rank, rows = inside.where(v > b), rank - upto_b, rows - upto_b
    return _sorted_at(inside, rank)


def exact_median(df: DataFrame, column: str, few: int = SORTED, accuracy: int = ACCURACY) -> float | None:
    """The mean of the two middle values (of the middle one, if their number is odd) without nulls; None without values.

    NaN counts as the largest value. ``df`` is read a few times, so a costly plan is best written first. No task holds
    more than a sketch or ``few`` rows, whatever the column's length and number of distinct values.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    rows, odd = values.agg(F.count("*"), F.count_if(F.isnan("v"))).first()
    if not rows:
        return None
    numbers, n = values.where(~F.isnan("v")), rows - odd
    low, high = (rows - 1) // 2, rows // 2
    at = lambda rank: value_at(numbers, rank, n, few, accuracy) if rank < n else math.nan
    one = at(low)
    return one if low == high else (one + at(high)) / 2
