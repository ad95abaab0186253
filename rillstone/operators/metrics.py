"""Counts, shares, distributions and the comparison of link sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions.similarity import half_up_percent
from rillstone.operators.selection import exact_median
from rillstone.storage import materialize


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """``value`` (null: 'NA'), ``n``, ``pct`` of all rows."""
    counts = df.groupBy(F.coalesce(F.col(value).cast("string"), F.lit("NA")).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("value", "n", half_up_percent(F.col("n"), F.col("__total")).alias("pct"))


def top_values(df: DataFrame, value: str, k: int) -> DataFrame:
    """The ``k`` commonest values, ties by value."""
    return value_counts(df, value).orderBy(F.desc("n"), "value").limit(k)


def group_size_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: groups, mean, median and largest size; zeros without groups.

    The median is taken of the groups' number for each size; r rows have fewer than the root of 2 r sizes.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("groups"))  # a row per size
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    total = F.coalesce(F.sum("groups"), F.lit(0).cast("long"))
    return sizes.agg(total.alias("groups"), zero(F.sum(F.col("n") * F.col("groups")) / F.sum("groups")).alias("mean_size"), zero(F.percentile("n", F.lit(0.5), F.col("groups"))).alias("median_size"), F.coalesce(F.max("n"), F.lit(0)).alias("max_size"))


def score_stats(links: DataFrame) -> DataFrame:
    """One row of score and similarity statistics with counts over 0.30 and 0.50.

    Both columns are written first, since the medians are found by several passes over them.
    """
    s, t = "score", "title_similarity"
    links = materialize(links.select(s, t), "scores")
    median = lambda c: F.lit(exact_median(links, c)).cast("double")
    return links.agg(
        F.round(F.avg(s), 6).alias("mean_score"), median(s).alias("median_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"), F.round(F.stddev_samp(s), 6).alias("std_score"),
        F.round(F.avg(t), 6).alias("mean_similarity"), median(t).alias("median_similarity"), F.count_if(F.col(t) > 0.3).alias("over_30"), F.count_if(F.col(t) > 0.5).alias("over_50"),
    )


def source_label(ri: Column, scopus: Column, wos: Column) -> Column:
    """'RI+SCOPUS', ... or 'none'."""
    joined = F.concat_ws("+", F.when(ri, "RI"), F.when(scopus, "SCOPUS"), F.when(wos, "WOS"))
    return F.when(joined == "", "none").otherwise(joined)


def delta_buckets(links: DataFrame) -> DataFrame:
    """``year_delta, n, bucket`` over links with a year."""
    counts = links.where("year_delta is not null").groupBy("year_delta").agg(F.count("*").alias("n"))
    d = F.col("year_delta")
    return counts.withColumn("bucket", F.when(d == 0, "same").when(d.between(1, 2), "1-2").when(d.between(3, 5), "3-5").otherwise("other"))


def source_shares(links: DataFrame) -> DataFrame:
    """One row: percent of links from any source, from two or more, and of those within two years."""
    n = F.count("*")
    found = F.col("ri").cast("int") + F.col("scopus").cast("int") + F.col("wos").cast("int")
    return links.agg(half_up_percent(F.count_if(found > 0), n).alias("any_source_pct"), half_up_percent(F.count_if(found > 1), n).alias("multi_source_pct"), half_up_percent(F.count_if(F.col("year_delta").isin(0, 1, 2)), n).alias("within_two_years_pct"))


def coverage(projects: DataFrame, links: DataFrame) -> DataFrame:
    """One row: projects, covered ones and their percent, links per covered project, most links of one project."""
    p = projects.agg(F.countDistinct("project_id").alias("projects"))
    sizes = links.groupBy("project_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("covered"), F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.coalesce(F.max("n"), F.lit(0)).alias("max_links"))
    one = p.crossJoin(sizes)  # one row by one row
    mean = F.when(F.col("covered") == 0, F.lit(0.0)).otherwise(F.col("links").cast("double") / F.nullif(F.col("covered"), F.lit(0)))
    return one.select("projects", "covered", (F.col("projects") - F.col("covered")).alias("uncovered"), half_up_percent(F.col("covered"), F.col("projects")).alias("coverage_pct"), F.round(mean, 6).alias("mean_links"), "max_links")


def link_quality(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """``level, candidates, truth, matched, precision_pct, recall_pct`` for all, Alta, Media and both together.

    One full join of the distinct pairs; levels are conditional counts over it.
    """
    pair = ["project_id", "publication_id"]
    c = candidates.groupBy(*pair).agg(F.min("confidence").alias("confidence"))
    t = truth.select(*pair).distinct().withColumn("declared", F.lit(True))
    both = c.join(t, pair, "full").select("confidence", F.coalesce("declared", F.lit(False)).alias("declared"))
    is_ = {"overall": F.col("confidence").isNotNull(), "high": F.col("confidence") == "Alta", "medium": F.col("confidence") == "Media", "high_medium": F.col("confidence").isin("Alta", "Media")}
    sums = [x for k, f in is_.items() for x in (F.count_if(f).alias(f"c_{k}"), F.count_if(f & F.col("declared")).alias(f"m_{k}"))]
    one = both.agg(F.count_if("declared").alias("t"), *sums)
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.col(f"c_{k}").alias("candidates"), F.col("t").alias("truth"), F.col(f"m_{k}").alias("matched")) for k in is_))).alias("x")
    rows = one.select(levels).select("x.*")
    return rows.withColumn("precision_pct", half_up_percent(F.col("matched"), F.col("candidates"))).withColumn("recall_pct", half_up_percent(F.col("matched"), F.col("truth")))


def overlap(one: DataFrame, two: DataFrame) -> DataFrame:
    """One row: distinct pairs of each set, in both, in only one, and the net gain of the second in percent."""
    pair = ["project_id", "publication_id"]
    a, b = (d.select(*pair).distinct().withColumn(f"in_{k}", F.lit(True)) for k, d in (("one", one), ("two", two)))
    x, y = F.coalesce("in_one", F.lit(False)), F.coalesce("in_two", F.lit(False))
    sums = a.join(b, pair, "full").agg(F.count_if(x).alias("n_one"), F.count_if(y).alias("n_two"), F.count_if(x & y).alias("n_both"), F.count_if(x & ~y).alias("only_one"), F.count_if(y & ~x).alias("only_two"))
    return sums.withColumn("gain_pct", half_up_percent(F.col("only_two"), F.greatest("n_one", F.lit(1))))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """``bin`` (1..bins), ``n`` over equal widths from the least to the largest value, which falls in the last bin."""
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    at = F.floor((F.col(value) - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))) + 1
    return df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(span)).groupBy(F.least(F.coalesce(at, F.lit(1)), F.lit(bins)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """``stage, label, n, pct, loss, loss_pct``: rows that pass all conditions up to a stage.

    ``pct`` of the first stage refers to itself, of later ones to the second; the loss refers to the stage before. One
    pass of conditional counts.
    """
    passed, sums = F.lit(True), []
    for k, (_, condition) in enumerate(stages):
        passed = passed & F.coalesce(condition, F.lit(False))
        sums.append(F.count_if(passed).alias(f"n{k}"))
    one = df.agg(*sums)
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("stage"), F.lit(label).alias("label"), F.col(f"n{k}").alias("n"), F.col(f"n{0 if not k else 1}").alias("base")) for k, (label, _) in enumerate(stages)))).alias("x")).select("x.*")
    before = F.lag("n").over(Window.orderBy("stage"))  # a row per stage
    return rows.withColumn("loss", before - F.col("n")).withColumn("loss_pct", half_up_percent(before - F.col("n"), before)).select("stage", "label", "n", half_up_percent(F.col("n"), F.col("base")).alias("pct"), "loss", "loss_pct")
