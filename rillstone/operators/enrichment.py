"""Enrichment of records from nested JSON through a resumable cache, and the merge of abstracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import text as tx
from rillstone.operators.numbering import first_nonblank, last_value

#: Marks of errors that pass by themselves; the first two also ask for a repair.
RETRY_MARKS = ["429", "Too Many Requests"]
TRANSIENT_MARKS = [*RETRY_MARKS, "after retries", "timed out", "timeout"]
#: What is read of a work.
WORK = """
id string, doi string, publication_year int, cited_by_count int,
open_access struct<is_oa: boolean, oa_status: string>,
primary_location struct<is_oa: boolean, landing_page_url: string, source: struct<display_name: string>>,
best_oa_location struct<is_oa: boolean, landing_page_url: string, source: struct<display_name: string>>,
authorships array<struct<author: struct<display_name: string>, institutions: array<struct<display_name: string, country_code: string>>>>
"""
#: Names of the enrichment columns without their prefix.
FIELDS = ["work_id", "doi", "is_oa", "oa_status", "oa_url", "publication_year", "cited_by_count", "source_display_name", "authors", "institution_names", "institution_country_codes", "enrichment_error"]


def parse_work(payload: Column | str) -> Column:
    """A work's struct from JSON text: of a search answer the first result. Null for other than objects."""
    c = F.col(payload) if isinstance(payload, str) else payload
    answer = F.from_json(c, f"struct<results: array<struct<{_typed(WORK)}>>>", {"mode": "PERMISSIVE"})
    single = F.from_json(c, f"struct<{_typed(WORK)}>", {"mode": "PERMISSIVE"})
    return F.when(~F.trim(F.coalesce(c, F.lit(""))).startswith("{"), None).otherwise(F.coalesce(F.get(answer["results"], F.lit(0)), single))


def _typed(ddl: str) -> str:
    """A column list as the fields of a struct."""
    out, depth = [], 0
    for word in ddl.replace("\n", " ").split():
        if not depth and ":" not in word and not word.startswith(("struct", "array")) and (not out or out[-1].endswith(",")):
            word += ":"
        depth += word.count("<") - word.count(">")
        out.append(word)
    return " ".join(out)


def extract_work(work: Column, prefix: str = "work_") -> list[Column]:
    """The enrichment columns of a parsed work, in order; a null work is an 'empty response'."""
    text = lambda c: F.nullif(c, F.lit(""))
    oa, first = work["best_oa_location"], work["primary_location"]
    is_oa = F.coalesce(work["open_access"]["is_oa"], F.lit(False)) | F.coalesce(first["is_oa"], F.lit(False))
    status = F.coalesce(text(work["open_access"]["oa_status"]), F.when(is_oa, "green").otherwise("closed"))
    people = F.coalesce(work["authorships"], F.array())
    names = F.filter(F.transform(people, lambda a: a["author"]["display_name"]), lambda n: n.isNotNull() & (n != ""))
    places = F.flatten(F.transform(people, lambda a: F.coalesce(a["institutions"], F.array())))
    distinct = lambda field, f: F.array_join(F.array_distinct(F.filter(F.transform(places, lambda i: f(i[field])), lambda n: n.isNotNull() & (n != ""))), "; ")
    missing = work.isNull()
    values = [
        F.coalesce(work["id"], F.lit("")), F.coalesce(work["doi"], F.lit("")), F.when(~missing, is_oa), F.when(missing, "unknown").otherwise(status),
        F.coalesce(text(oa["landing_page_url"]), text(first["landing_page_url"]), F.lit("")), work["publication_year"], work["cited_by_count"],
        F.coalesce(text(oa["source"]["display_name"]), text(first["source"]["display_name"]), F.lit("")),
        F.array_join(names, "; "), distinct("display_name", lambda n: n), distinct("country_code", F.upper),
        F.when(missing, "empty response").when(work["id"].isNull(), "not_found").otherwise(""),
    ]
    return [v.alias(prefix + f) for v, f in zip(values, FIELDS, strict=True)]


def has_mark(error: Column | str, marks: Iterable[str]) -> Column:
    """Whether an error's text has one of the marks (case matters); null has none."""
    c = F.coalesce(F.col(error) if isinstance(error, str) else error, F.lit(""))
    out = F.lit(False)
    for m in marks:
        out = out | F.contains(c, F.lit(m))
    return out


def compact_cache(changes: DataFrame, key: str, seq: str, values: list[str]) -> DataFrame:
    """The last record of each key; rows without a key go."""
    record = F.max_by(F.struct(*values), F.col(seq)).alias("r")
    return changes.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(record).select(key, *(f"r.{v}" for v in values))


def cacheable(records: DataFrame, error: str) -> DataFrame:
    """Records whose error, if any, isn't a passing one."""
    return records.where(~has_mark(error, TRANSIENT_MARKS))


def pending(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the cache lacks."""
    return requests.where(F.col(key) != "").select(key).distinct().join(cache.select(key), key, "left_anti")


def overlay(old: DataFrame, fresh: DataFrame, key: str, values: list[str], error: str) -> DataFrame:
    """``old`` in which rows whose error asks for a repair take all ``values`` from ``fresh``, where it has the key."""
    new = fresh.select(key, F.struct(*values).alias("__new"))
    take = has_mark(error, RETRY_MARKS) & F.col("__new").isNotNull()
    return old.join(new, key, "left").withColumns({v: F.when(take, F.col("__new")[v]).otherwise(F.col(v)) for v in values}).drop("__new")


def add_missing(df: DataFrame, columns: dict[str, str], legacy: Iterable[str] = ()) -> DataFrame:
    """``df`` without legacy columns and with null columns of the given types where they are missing."""
    return df.drop(*legacy).withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def merge_abstracts(main: DataFrame, abstracts: DataFrame, key: str, other_key: str, names: dict[str, str], seq: str) -> DataFrame:
    """``main`` with the present columns of ``names`` (old -> new), '' where nothing matches; earlier merges are replaced.

    Keys are normalized DOIs on both sides; of several abstracts for a key each column takes its first non-blank value
    by ``seq``. The number of rows stays.
    """
    present = {a: b for a, b in names.items() if a in abstracts.columns}
    keyed = abstracts.withColumn("__key", tx.normalize_doi(F.col(other_key).cast("string"), wide=True)).where("__key <> ''")
    one = keyed.groupBy("__key").agg(*(first_nonblank(a, seq, ("",)).alias(b) for a, b in present.items()))
    base = main.drop(*present.values())
    merged = base.withColumn("__mine", tx.normalize_doi(F.col(key).cast("string"), wide=True)).join(one, F.col("__mine") == F.col("__key"), "left").drop("__mine", "__key")
    return merged.na.fill("", list(present.values()))


def abstracts_matched(merged: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``rows`` and ``matched``, those whose first merged column isn't blank."""
    found = F.count_if(tx.strip(F.coalesce(F.col(columns[0]), F.lit(""))) != "") if columns else F.lit(0).cast("long")
    return merged.agg(F.count("*").alias("rows"), found.alias("matched"))
