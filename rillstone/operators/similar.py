"""Names whose sequence ratio reaches a bound, by filters that lose no pair and Python for what they leave."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.similarity import sequence_ratio
from rillstone.storage import materialize


def _grams(name: Column, q: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(name) - q + 1), lambda k: F.substring(name, k, q))


def _common_letters(a: Column, b: Column) -> Column:
    """Letters that two names have in common, each as often as it stands in both."""
    often = lambda name, c: F.length(name) - F.length(F.replace(name, c, F.lit("")))
    return F.aggregate(F.array_distinct(_grams(a, 1)), F.lit(0), lambda n, c: n + F.least(often(a, c), often(b, c)))


def gram_length(least: float) -> int:
    """The longest grams (of 4 at most) that still tell names of a ratio of ``least`` apart, with some to spare."""
    return max((q for q in (1, 2, 3, 4) if q == 1 or (2 * q - 1) * least / 2 - (q - 1) >= 0.1), default=1)


def shared_at_least(length: Column | int, q: int, least: float) -> Column | float:
    """A bound of the grams that a name of ``length`` shares with any name of a ratio of ``least`` or more to it.

    m letters in common leave length - m letters of one name and those of the other as deletions and insertions; a
    deletion takes q grams from the name at most, an insertion q - 1. The shortest partner has length * t / (2 - t)
    letters, and the bound grows with a partner's length.
    """
    slope = (2 * q - 1) * least / 2 - (q - 1)
    return (1 - q) + length * (2 / (2 - least) * slope) - 1e-9


def similar_names(df: DataFrame, name: str, least: float = 0.8) -> DataFrame:
    """``a, b, ratio``: all ordered pairs of different names with ``sequence_ratio(a, b) >= least`` (above 0, 1 at most).

    Repeated names count once; null and empty ones have no ratio. The ratio is twice the letters in common over all
    letters, and those in common stand in one order in both names. So two names with a high ratio share grams, and one of
    each name's rarest ones (all but as many as it must share, less one) at least. Names meet by these, within the
    lengths that allow the ratio; letters counted as multisets bound it once more; Python sees the rest. Names too short
    for a bound on longer grams, and their partners, meet by single letters. Counts of grams are written before they
    meet the grams, so that a hot one can be split.
    """
    if not 0 < least <= 1:
        raise ValueError("a ratio above 0 and of 1 at most")
    names = df.select(F.col(name).cast("string").alias("name")).where("name <> ''").distinct().withColumn("len", F.length("name"))
    names = materialize(names, "names")
    q = gram_length(least)
    short = _longest_short(q, least)
    near = (2 - least) / least  # the longer of two lengths over the shorter, at most
    pairs = _meet(names.where(F.col("len") > short), q, least)
    if short:
        pairs = pairs.unionByName(_meet(names.where(F.col("len") <= math.floor(short * near + 1e-9)), 1, least, short))
    pairs = materialize(pairs.distinct(), "name-pairs")  # else the bound is counted for each gram that a pair shares
    bounded = pairs.where(2 * _common_letters(F.col("a"), F.col("b")) + 1e-9 >= least * (F.length("a") + F.length("b")))
    both = bounded.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.*")
    return both.withColumn("ratio", sequence_ratio(F.col("a"), F.col("b"))).where(F.col("ratio") >= least)


def _longest_short(q: int, least: float) -> int:
    """The length up to which names need not share a gram of q letters; 0 for single letters."""
    n = 0
    while q > 1 and shared_at_least(n + 1, q, least) <= 0:
        n += 1
    return n


def _meet(names: DataFrame, q: int, least: float, short: int | None = None) -> DataFrame:
    """Pairs ``a < b`` of names that share one of their rarest grams and whose lengths allow the ratio.

    With ``short``, at least one of them has that length or less.
    """
    often = names.select("name", "len", F.explode(_grams(F.col("name"), q)).alias("gram")).groupBy("name", "len", "gram").agg(F.count("*").alias("k"))
    # equal grams differ by their ordinal, so that sets of them meet as multisets do
    grams = often.select("name", "len", F.explode(F.transform(F.sequence(F.lit(1).cast("long"), "k"), lambda k: F.concat("gram", F.lit(" "), k.cast("string")))).alias("gram"))
    counts = materialize(grams.groupBy("gram").agg(F.count("*").alias("n")), "gram-counts")
    rare = grams.join(counts, "gram").groupBy("name", "len").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("g"))
    must = F.greatest(F.ceil(shared_at_least(F.col("len"), q, least)), F.lit(1)).cast("int")
    prefix = F.slice("g", 1, F.greatest(F.size("g") - must + 1, F.lit(0)))
    some = materialize(rare.select("name", "len", F.explode(prefix).alias("g")).select("name", "len", "g.gram"), "rare-grams")
    one, two = some.select("gram", F.col("name").alias("a"), F.col("len").alias("la")), some.select("gram", F.col("name").alias("b"), F.col("len").alias("lb"))
    fits = (F.col("a") < F.col("b")) & (2 * F.least("la", "lb") + 1e-9 >= least * (F.col("la") + F.col("lb")))
    if short is not None:
        fits = fits & (F.least("la", "lb") <= short)
    return one.join(two, "gram").where(fits).select("a", "b")
