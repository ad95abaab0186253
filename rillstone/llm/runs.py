"""Periodic runs of words by Lyndon arrays on ordered alphabets, in the manner of Ellert and Fischer (operator 12).

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least 2q and ``least`` words.
Each run has a Lyndon root with respect to one of two opposite orders of the words, and that root ends where the next
smaller suffix begins. So two passes over a text, one for each order, find the next and the previous smaller suffix of
every place together with the length of their common prefix; a root extended by that prefix to the right, and word by
word to the left, is a run or no run.

Right extensions are linear: a place inside the last matched extension copies the comparisons of the place it matches,
as far as they end inside, and compares anew from the extension's end only. No word is matched twice. Left extensions
stay between the previous smaller suffix and the root and are shorter than the root, at most O(n log n) words by the
smaller-half argument; mostly the first word decides. There are no suffix structures and no hashes: words are numbered
by sorting their bytes (``span_ids``).

A run holds each of its words twice. So a text is parted at words that occur once in it, the parts likewise, and parts
too short for a run are left out, which loses no run and changes none: a neighbour that is unique in the part can't
extend one.

Results: one row per input row, texts whole. A null, empty or blank text has no word and no run, and the empty text is
left of it. Rows are independent: repeated rows and ids, null ids and further columns of any name don't matter; an empty
table gives an empty result.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, spread
from rillstone.llm.words import SPACED, slices, span_ids, text_ids, word_spans

#: Words of a run at least.
LEAST = 12
#: Rounds in which parts are parted again; further ones would change the time only.
ROUNDS = 8


def lyndon_arrays(x) -> tuple[array, array, array]:
    """Next smaller suffixes (the length, where there is none) with their common prefixes, and previous ones (or -1).

    ``x`` is a sequence of numbers; a suffix that begins another is smaller.
    """
    n = len(x)
    following, common = array("q", [n]) * n, array("q", [0]) * n
    before, shared = array("q", [-1]) * n, array("q", [0]) * n  # previous smaller suffixes, and their common prefixes
    edge = shift = 0  # x[i:edge] == x[i - shift:edge - shift] for the places i after the one that was compared last
    for i in range(1, n):
        j, m = i - 1, 0
        if i < edge:
            twin = i - shift
            while True:
                closes = following[j - shift] == twin
                m = common[j - shift] if closes else shared[twin]
                if i + m >= edge:  # decided beyond the extension
                    m = edge - i
                    break
                if not closes:
                    before[i], shared[i] = j, m
                    break
                following[j], common[j] = i, m
                j = before[j]
            if before[i] >= 0:
                continue
        while j >= 0:
            while i + m < n and x[j + m] == x[i + m]:
                m += 1
            edge, shift = i + m, i - j
            if i + m < n and x[j + m] < x[i + m]:
                before[i], shared[i] = j, m
                break
            following[j], common[j] = i, m
            above, both = before[j], shared[j]
            if above >= 0 and both < m:  # smaller than j's suffix at a place where i's agrees with j's
                before[i], shared[i] = above, both
                break
            j = above
    return following, common, before


def find_runs(x, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, in order."""
    n, found = len(x), set()
    for ordered in (x, array("q", [-v for v in x])):
        following, common, _ = lyndon_arrays(ordered)
        for i in range(n):
            j, right = following[i], common[i]
            p = j - i
            need = max(p - right, least - p - right)  # words to the left that make it a run
            if need >= p or need > i or (need > 0 and ordered[i - need] != ordered[j - need]):
                continue
            left = 0
            while left < p and left < i and ordered[i - left - 1] == ordered[j - left - 1]:
                left += 1
            if need <= left < p:  # with a whole period to the left, the root before this one finds the run
                found.add((i - left, left + p + right, p))
    return sorted(found)


def repeating_parts(ids: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of ``least`` words or more that can hold a run; ``ids`` are ``text_ids``."""
    n = len(ids)
    place, part = np.arange(n), np.repeat(np.arange(len(first) - 1), np.diff(first))
    for _ in range(ROUNDS):
        _, which, copies = np.unique(part * (n + 1) + ids[place], return_inverse=True, return_counts=True)
        again = copies[which] > 1
        whole = again.all()
        place, part = place[again], part[again]
        opens = np.ones(len(place), bool)
        opens[1:] = (np.diff(place) != 1) | (np.diff(part) != 0)
        size = np.diff(np.append(np.flatnonzero(opens), len(place)))
        part = np.cumsum(opens) - 1
        long = size[part] >= least if len(part) else np.zeros(0, bool)
        if whole and long.all():
            break
        place, part = place[long], part[long]
    opens = np.ones(len(place), bool)
    opens[1:] = np.diff(part) != 0
    begin = place[opens]
    return begin, begin + np.diff(np.append(np.flatnonzero(opens), len(place)))


def text_runs(data: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[list[list[tuple[int, int, int]]], np.ndarray]:
    """The runs of each text, and the texts' first words."""
    start, end, first = word_spans(data, offsets, SPACED)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    if len(start):
        ids = text_ids(span_ids(data, start, end), first)
        begin, stop = repeating_parts(ids, first, least)
        owner = np.searchsorted(first, begin, "right") - 1
        for a, b, k in zip(begin.tolist(), stop.tolist(), owner.tolist(), strict=True):
            out[k] += [(s + a - int(first[k]), m, p) for s, m, p in find_runs(array("q", ids[a:b].tobytes()), least)]
    return out, first


def collapsed(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text, joined by one space, without those that stand in a run after its first period."""
    words = text.split()  # at \\x20 and \\x09-\\x0D
    if runs:
        keep = np.ones(len(words), bool)
        for s, m, p in runs:
            keep[s + p : s + m] = False
        words = [words[k] for k in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def run_finder(least: int = LEAST):
    """A column function: a text's ``n_words``, ``runs`` (start, length, period, by start and period) and ``collapsed``."""

    @F.arrow_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def describe(texts: pa.Array) -> pa.Array:
        counts: list[int] = []
        ends, flat, left = [0], [], []
        for data, offsets in slices(texts):
            runs, first = text_runs(data, offsets, least)
            counts += np.diff(first).tolist()
            raw = data.tobytes()
            for found, a, b in zip(runs, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                flat += found
                ends.append(len(flat))
                left.append(collapsed(raw[a:b], found))
        columns = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names=["start", "length", "period"]))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), listed, pa.array(left, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])

    return describe


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text", least: int = LEAST) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (start, length, period), ``collapsed`` (the text without repetitions)."""
    bound_batches(docs.sparkSession)
    whole = spread(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("text"))
    return whole.select("doc_id", run_finder(least)("text").alias("r")).select("doc_id", "r.*")
