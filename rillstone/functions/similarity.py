"""Similarity of titles and the candidate score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_up_percent(n: Column, d: Column) -> Column:
    """100 n / d with two decimals, halves up, in whole numbers; 0 where ``d`` is 0."""
    return F.when(d == 0, F.lit(0.0)).otherwise(F.floor((F.lit(20000) * n + d) / (F.lit(2) * F.nullif(d, F.lit(0)))).cast("double") / F.lit(100.0))


def jaccard(a: Column, b: Column) -> Column:
    """Common over all words of two arrays; 0 where one is empty."""
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both.cast("double") / F.greatest(union, F.lit(1))).otherwise(F.lit(0.0))


def jaccard_4(a: Column, b: Column) -> Column:
    """The word overlap with four decimals, halves up, in whole numbers."""
    both, union = F.size(F.array_intersect(a, b)), F.greatest(F.size(F.array_union(a, b)), F.lit(1))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.floor((20000 * both + union) / (2 * union)).cast("double") / 10000).otherwise(F.lit(0.0))


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a.fillna(""), b.fillna(""), strict=True)], dtype="float64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Gestalt ratio of two titles; not symmetric, popular characters of long titles are ignored in the second."""
    return F.pandas_udf(_ratios, "double")(a, b)


#: ``SequenceMatcher`` leaves out popular characters of second texts of this length or more.
POPULAR = 200


def half_ratio_above(a: str, b: str, least: float) -> float:
    """Half the gestalt ratio of two texts, or ``least`` where it is not above that.

    Equal characters are bits of one number, a row for each character of ``a``; a bit of ``E & (E >> row + 1)`` starts two
    equal characters, and so on by doubling. The lowest bit of the longest run is the match that ``SequenceMatcher``
    takes. The search ends once what is left open can't lift the ratio above ``least``.
    """
    if not a or not b:
        return max(0.0, least)
    if len(b) >= POPULAR:
        return max(0.5 * SequenceMatcher(None, a, b).ratio(), least)
    size = len(b) // 8 + 1  # a bit in each row stays free
    width, both = 8 * size, len(a) + len(b)
    masks: dict[str, int] = {}
    for j, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << j
    rows = {c: m.to_bytes(size, "little") for c, m in masks.items()}
    none = bytes(size)
    equal = int.from_bytes(b"".join([rows.get(c, none) for c in a]), "little")
    ones = int.from_bytes((b"\1" + none[1:]) * len(a), "little")
    matched, left = 0, min(len(a), len(b))
    todo = [(0, len(a), 0, len(b))]
    while todo:
        if 0.5 * (2.0 * (matched + left) / both) <= least:
            return least
        alo, ahi, blo, bhi = todo.pop()
        left -= min(ahi - alo, bhi - blo)
        if ahi - alo == len(a) and bhi - blo == len(b):
            some = equal
        else:
            inside = (1 << (ahi - alo) * width) - 1
            some = equal >> alo * width & inside & (ones & inside) * ((1 << bhi) - (1 << blo))
        if not some:
            continue
        runs = [some]  # starts of 1, 2, 4, ... equal characters
        while further := runs[-1] & runs[-1] >> (width + 1 << len(runs) - 1):
            runs.append(further)
        best = runs.pop()
        n = 1 << len(runs)
        while runs:
            if further := best & runs.pop() >> n * (width + 1):
                best, n = further, n + (1 << len(runs))
        i, j = divmod((best & -best).bit_length() - 1, width)
        i += alo
        matched += n
        for part in ((alo, i, blo, j), (i + n, ahi, j + n, bhi)):
            if (most := min(part[1] - part[0], part[3] - part[2])) > 0:
                left += most
                todo.append(part)
    return max(0.5 * (2.0 * matched / both), least)


def _larger(a: pd.Series, b: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([round(half_ratio_above(x, y, j), 4) for x, y, j in zip(a.fillna(""), b.fillna(""), overlap, strict=True)], dtype="float64")


def with_title_score(pairs: DataFrame, a: str, b: str, tokens_a: str, tokens_b: str) -> DataFrame:
    """``pairs`` with ``title_similarity``: the larger of half the sequence ratio and the word overlap, 4 decimals.

    A sequence ratio is at most 2 min / (min + max) of the lengths; the titles of pairs that this bound decides are not
    sent to Python, where only their overlap is rounded (by its binary value, as decimals of a ratio are).
    """
    la, lb = F.length(a), F.length(b)
    overlap = F.col("__overlap")
    open_ = F.least(la, lb).cast("double") / F.nullif(la + lb, F.lit(0)) > overlap
    larger = F.pandas_udf(_larger, "double")
    base = pairs.withColumn("__overlap", jaccard(F.col(tokens_a), F.col(tokens_b)))
    return base.withColumn("title_similarity", larger(F.when(open_, F.col(a)), F.when(open_, F.col(b)), overlap)).drop("__overlap")


@dataclass(frozen=True)
class Weights:
    """Fixed values of the candidate score: base, points by years between project and publication, by source, by title."""

    base: float = 50.0
    same_year: float = 20.0
    near_years: float = 18.0
    far_years: float = 12.0
    repository: float = 15.0
    scopus: float = 10.0
    wos: float = 10.0
    title: float = 25.0
    horizon: int = 5
    high: float = 85.0
    medium: float = 65.0
    shown_similarity: float = 0.2


WEIGHTS = Weights()


def year_points(delta: Column, w: Weights = WEIGHTS) -> Column:
    """Points by the years from project to publication; none without a year."""
    return F.when(delta == 0, w.same_year).when(delta.between(1, 2), w.near_years).when(delta.between(3, w.horizon), w.far_years).otherwise(F.lit(0.0))


def _by_similarity(of: Callable[[float], float | str], similarity: Column) -> Column:
    """A function of the 10,001 similarities of four decimals as text, computed once on the driver: decimals round by binary value."""
    table = F.split(F.lit(" ".join(str(of(n / 10_000)) for n in range(10_001))), " ")  # folded when planned
    return F.get(table, F.round(similarity * 10_000).cast("int"))


def candidate_score(delta: Column, ri: Column, scopus: Column, wos: Column, similarity: Column, w: Weights = WEIGHTS) -> Column:
    """Sum of all points, two decimals."""
    part = lambda flag, points: F.when(flag, F.lit(points)).otherwise(F.lit(0.0))
    title = _by_similarity(lambda s: round(s * w.title, 2), similarity).cast("double")
    return F.round(F.lit(w.base) + year_points(delta, w) + part(ri, w.repository) + part(scopus, w.scopus) + part(wos, w.wos) + title, 2)


def confidence(score: Column, w: Weights = WEIGHTS) -> Column:
    """Alta, Media or Baja."""
    return F.when(score >= w.high, "Alta").when(score >= w.medium, "Media").otherwise("Baja")


def evidence(delta: Column, ri: Column, scopus: Column, wos: Column, similarity: Column, w: Weights = WEIGHTS) -> Column:
    """The reasons of a score in order, joined by ' | '."""
    shown = F.concat(F.lit("similitud_tematica_"), _by_similarity(lambda s: f"{s:.2f}", similarity))
    return F.concat_ws(
        " | ",
        F.lit("responsable_autor"),
        F.when(delta == 0, "publicado_mismo_anio").when(delta.between(1, 2), "publicado_1_2_anios_despues").when(delta.between(3, w.horizon), "publicado_3_5_anios_despues"),
        F.when(ri, "fuente_RI"), F.when(scopus, "fuente_SCOPUS"), F.when(wos, "fuente_WOS"),
        F.when(similarity >= w.shown_similarity, shown),
    )
