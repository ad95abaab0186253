"""Exact medians against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import metrics as mt
from rillstone.operators import selection
from rillstone.operators.selection import exact_median, value_at


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("few", [1, 7, 100_000])
def test_small_columns(spark, few):
    rows = [[3, 1], [2, 2, 2, 9], [1, None, 5, 4], [-1e308, 0, 1e-300, 1e308], [7] * 40 + [8] * 41, [0, math.inf, -math.inf]]
    for values in rows:
        assert exact_median(column(spark, values), "x", few, 50) == np.median([v for v in values if v is not None])


def test_nothing_and_nan(spark):
    assert exact_median(column(spark, []), "x") is None and exact_median(column(spark, [None]), "x") is None
    assert exact_median(column(spark, [1, 2, math.nan]), "x") == 2.0
    assert math.isnan(exact_median(column(spark, [1, math.nan, math.nan]), "x"))


def test_distinct_doubles_in_bounded_buffers(spark, monkeypatch):
    wide = spark.range(200_000, numPartitions=6).select(F.exp((F.xxhash64("id") % 100_003) / 2_000.0 + F.col("id") * 1e-9).alias("x"))
    held, sort = [], selection._sorted_at
    monkeypatch.setattr(selection, "_sorted_at", lambda v, r: held.append(v.count()) or sort(v, r))
    values = np.sort([r.x for r in wide.collect()])
    assert exact_median(wide, "x", 500, 200) == np.median(values)
    assert value_at(wide.select(F.col("x").alias("v")), 3, 200_000, 500, 200) == values[3]
    assert value_at(wide.select(F.col("x").alias("v")), 199_999, 200_000, 500, 200) == values[-1]
    assert held and max(held) <= 500


def test_half_of_the_rows_are_one_value(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(1 + F.col("id") / 50_000).alias("x"))
    assert exact_median(rows, "x", 100, 100) == np.median([r.x for r in rows.collect()])


def test_statistics_take_them(spark):
    links = spark.createDataFrame([(1, 10.0, 0.1), (1, 20.0, 0.4), (2, 40.0, 0.6)], "project_id int, score double, title_similarity double")
    one = mt.score_stats(links).first()
    assert (one.median_score, one.median_similarity, one.over_30) == (20.0, 0.4, 2)
    assert mt.group_size_stats(links, "project_id").first().median_size == 1.5
    empty = links.where("score < 0")
    assert mt.score_stats(empty).first().median_score is None and mt.group_size_stats(empty, "project_id").first().median_size == 0.0
