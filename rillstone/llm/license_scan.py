"""Licence scan by canonical digests (operator 1), in built-in functions only.

A text's lines are put into canonical form: lower case, copyright lines dropped, equivalent spellings made one, every
run of other characters a space. Spellings are made one in each line and, where they have several words, once more in
all lines together. A credit such as "Copyright Jane Doe", without sign, year, "by" or an ending that tells a holder,
can't be told from a broken term and stays. The SHA-256 of all lines together is looked up among the digests of known
licence texts, that of each single line among those of known notices; both lookups are hash joins with tables of fixed
size.

Results: one row per input row; a null text is empty, and empty texts match nothing. Rows of equal id and equal
canonical text have the same result. Columns of the input besides id and text don't matter. Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import materialize, spread
from rillstone.llm.license_texts import TEXTS, notices

#: Lines that name a holder and no term, with or without comment marks. After "copyright" comes a sign, a
#: year or its placeholder, "by", or a name that ends the line and begins with "the" or ends as a company's does; "(c)"
#: alone begins such a line if a year or at most five words follow, not beginning with "you", since it also numbers terms.
_MARKS = r"""^[ \t\r/*#;%!<>|"'.\\-]*"""
_NAMED = r"(?:the[ \t].*(?:authors|contributors|developers|maintainers|team|project)|.*[ \t,](?:inc|llc|ltd|gmbh|corp|corporation|foundation))"
COPYRIGHT = (
    _MARKS + r"(?:(?:portions[ \t]+)?copyright(?:[ \t,:;-]*(?:\(c\)|©|&copy;|[0-9]{4}|[\[{<(]?(?:yyyy|year)[\]}>)])|[ \t]+by[ \t]|[ \t]+" + _NAMED + r"[^a-z0-9]*$)"
    r"|\(c\)[ \t,]*(?:copyright|[0-9]{4}|(?:[^y \t\r]|y[^o \t\r]|yo[^u \t\r])[^ \t\r]*[ \t\r]*(?:[^ \t\r]+[ \t\r]*){0,4}$)|©|all rights reserved)"
)
#: Spellings that count as equal, replaced in this order.
SPELLINGS = [("licenc", "licens"), ("isation", "ization"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("honour", "honor"), ("fulfil ", "fulfill "), ("copyright owner", "copyright holder"), ("https:", "http:")]
#: Those of several words, which a line's end may part.
PHRASES = [(a, b) for a, b in SPELLINGS if " " in a]


def canonical_lines(text: Column) -> Column:
    """The text's lines in canonical form, without those that are empty then."""

    def one(line: Column) -> Column:
        spelt = line
        for a, b in SPELLINGS:
            spelt = F.replace(spelt, F.lit(a), F.lit(b))
        return F.when(F.rlike(line, F.lit(COPYRIGHT)), "").otherwise(F.trim(F.regexp_replace(spelt, "[^a-z0-9]+", " ")))

    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("İ"), F.lit("i")))
    return F.filter(F.transform(F.split(lowered, "\n"), one), lambda line: line != "")


def canonical_text(lines: Column) -> Column:
    """All canonical lines as one text; phrases that lines or other characters parted are spelt alike."""
    joined = F.concat(F.array_join(lines, " "), F.lit(" "))
    for a, b in PHRASES:
        joined = F.replace(joined, F.lit(a), F.lit(b))
    return F.rtrim(joined)


def _known(df: DataFrame, rows: list[tuple[str, str]], digest: str, name: str) -> DataFrame:
    """Digest -> identifier of known texts: a table of fixed size."""
    packed = "\x1e".join(f"{i}\x1f{t}" for i, t in rows)  # one literal, not thousands of expressions
    pair = F.split("r", "\x1f")
    table = df.sparkSession.range(1).select(F.explode(F.split(F.lit(packed), "\x1e")).alias("r")).select(pair[0].alias(name), F.sha2(canonical_text(canonical_lines(pair[1])), 256).alias(digest))
    return table.groupBy(digest).agg(F.min(name).alias(name))


def license_scan(docs: DataFrame, texts: list[tuple[str, str]] = TEXTS, lines: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``digest`` (of the canonical text), ``license_id`` (of the whole text, or null), ``n_notices``
    (lines that are a known notice) and ``notice_licenses`` (their licences, distinct, sorted, comma-joined)."""
    canonical = spread(docs).select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))
    digests = F.transform("lines", lambda x: F.unhex(F.sha2(x, 256)))
    hashed = materialize(canonical.select("doc_id", F.sha2(canonical_text(F.col("lines")), 256).alias("digest"), digests.alias("lines")), "line-digests")
    noted = _known(docs, notices() if lines is None else lines, "line", "notice").withColumn("line", F.unhex("line"))
    found = hashed.select("doc_id", "digest", F.posexplode("lines").alias("at", "line")).join(F.broadcast(noted), "line")
    per_text = found.groupBy("doc_id", "digest").agg(F.countDistinct("at").alias("n"), F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("names"))
    whole = hashed.select("doc_id", "digest").join(F.broadcast(_known(docs, texts, "digest", "license_id")), "digest", "left")
    both = whole.join(per_text.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__of"), "n", "names"), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__of")), "left")
    return both.select("doc_id", "digest", "license_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("names", F.lit("")).alias("notice_licenses"))
