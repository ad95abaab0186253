"""Dense numbers in a given order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.storage import materialize

#: Characters by which long texts are put in order, before the rest of those that begin alike is looked at.
HEAD = 128


def number_rows(df: DataFrame, name: str, *order: Column | str, start: int = 1) -> DataFrame:
    """``df`` with ``name``: start, start + 1, ... in ``order``.

    Rows are dealt out by ranges of the order; each range counts its own rows, and the ranges' sums (one row each) shift
    them. Ties get numbers in any order, so ``order`` should tell rows apart. The ranges are written to the shared
    folder, since both readers must see the same ones, also after an executor was lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    sums = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("__part", before.alias("__before"))
    number = (F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__before") + start).cast("long")
    return placed.withColumn("__part", part).join(F.broadcast(sums), "__part").withColumn(name, number).drop("__part", "__at", "__before")


def digest(c: str) -> Column:
    """32 bytes that stand for a long text in joins and groups."""
    return F.unhex(F.sha2(c, 256))


def head(c: str) -> Column:
    """The first characters of a text."""
    return F.substring(c, 1, HEAD)


def number_texts(df: DataFrame, text: str, name: str, heads: DataFrame | None = None) -> DataFrame:
    """``digest, name``: the distinct texts of a column, numbered from 1 in their order.

    Digests and heads are shuffled; of texts that share their head with another one, the rest, too. ``heads``: the
    distinct ``digest, head`` of the column, where they are known.
    """
    if heads is None:
        heads = materialize(df.select(digest(text).alias("digest"), head(text).alias("head")).distinct(), "heads")
    alike = heads.groupBy("head").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("head").alias("__head"))
    if alike.isEmpty():
        return number_rows(heads, name, "head").select("digest", name)
    rest = df.where(F.length(text) > HEAD).select(digest(text).alias("digest"), F.xxhash64(head(text)).alias("__head"), F.substring(F.col(text), F.lit(HEAD + 1), F.length(text)).alias("rest"))
    rest = rest.join(alike.distinct(), "__head", "left_semi").select("digest", "rest").distinct()
    return number_rows(heads.join(rest, "digest", "left"), name, "head", "rest").select("digest", name)


def keep_first(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in ``order``; all columns."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def first_n(df: DataFrame, keys: list[str], n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of each key in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def last_value(df: DataFrame, keys: list[str], value: str, seq: str, name: str | None = None) -> DataFrame:
    """One row per key with the value of largest ``seq`` (a map that later rows overwrite)."""
    return df.groupBy(*keys).agg(F.max_by(value, seq).alias(name or value))


def first_nonblank(value: str, seq: str, placeholders: tuple[str, ...] = ("", "-", "nan")) -> Column:
    """Aggregate: the value of smallest ``seq`` that is none of the placeholders after stripping, as it stands; else ''."""
    from rillstone.functions.text import strip

    fine = F.col(value).isNotNull() & ~strip(value).isin(list(placeholders))
    return F.coalesce(F.min_by(F.when(fine, F.col(value)), F.when(fine, F.col(seq))), F.lit(""))
