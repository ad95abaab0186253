"""Tables, CSV, JSON and JSONL in and out."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.storage import filesystem, read_text, write_bytes


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A Parquet table; columns and condition reach the scan."""
    df = spark.read.parquet(path)
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


#: Texts that typed CSV scans read as missing.
NA_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; types are inferred without a schema. NA_TEXTS are null.

    With ``multi_line`` a field may hold line ends, and a file is one task; without it large files are split.
    """
    text = _csv(spark, multi_line).csv(path)
    known = text.select([F.when(~F.col(f"`{c}`").isin(NA_TEXTS), F.col(f"`{c}`")).alias(c) for c in text.columns])
    if schema:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        return known.select([F.col(f"`{c}`").try_cast(f.dataType).alias(f.name) for c, f in zip(known.columns, fields, strict=True)])
    kinds = ["int", "bigint", "double", "boolean"]
    fit = [F.coalesce(F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(k).isNotNull()), F.lit(False)).alias(f"{i}_{k}") for i, c in enumerate(known.columns) for k in kinds]
    found = known.agg(*fit).first()
    types = [next((k for k in kinds if found[f"{i}_{k}"]), "string") for i in range(len(known.columns))]
    return known.select([F.col(f"`{c}`").cast(t).alias(c) for c, t in zip(known.columns, types, strict=True)])


def read_csv_text(spark: SparkSession, path: str, keep_blanks: bool = True, multi_line: bool = True) -> DataFrame:
    """CSV with a header, all columns text; blanks stay '' or become null."""
    df = _csv(spark, multi_line).csv(path)
    return df.na.fill("") if keep_blanks else df


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header's names; no row is read."""
    return spark.read.option("header", True).csv(path).columns


def find_abstracts(folder: str) -> str | None:
    """The first 'doi-resultados*.csv' below a folder, else the first CSV with the columns resumen and doi."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        found = sorted(str(p) for p in Path(folder).rglob("*.csv"))
    else:
        fs, where = filesystem(spark, folder)
        walk, found = fs.listFiles(where, True), []
        while walk.hasNext():
            found.append(walk.next().getPath().toString())
        found = sorted(p for p in found if p.endswith(".csv"))
    for path in found:
        if path.rsplit("/", 1)[-1].startswith("doi-resultados"):
            return path
    for path in found:
        if spark is None:
            with open(path, encoding="utf-8-sig") as f:
                names = f.readline().split(",")
        else:
            names = csv_columns(spark, path)
        if {"resumen", "doi"} <= {n.strip().strip('"\ufeff').lower() for n in names}:
            return path
    return None


def resolve_column(df: DataFrame, name: str) -> str | None:
    """A column's actual name, whatever its case and outer spaces."""
    return next((c for c in df.columns if c.strip().lower() == name.strip().lower()), None)


def read_jsonl_cache(spark: SparkSession, path: str, result: str) -> DataFrame:
    """``key, result, seq`` of a JSONL changelog; blank and broken lines and lines without a key are skipped.

    ``result`` is the type of the results; ``seq`` orders lines by file name and place, however files are split.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", place.alias("seq")).where(F.trim("value") != "")
    parsed = F.from_json("value", f"key string, result {result}, bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    return lines.select("seq", parsed.alias("r")).where("r.key is not null and r.key <> '' and r.bad is null").select("r.key", "r.result", "seq")


def write_table(df: DataFrame, path: str, replace: bool = False) -> None:
    """A Parquet table: fails if it exists, or replaces it."""
    df.write.mode("overwrite" if replace else "errorifexists").parquet(path)


def recreate_folder(spark: SparkSession, path: str) -> None:
    """An empty folder in place of whatever stood there."""
    fs, where = filesystem(spark, path)
    fs.delete(where, True)
    fs.mkdirs(where)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested values as JSON."""
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    df.withColumns(nested).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """A JSON object per row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append" if append else "overwrite").text(path)


def update_summary(path: str, values: dict, spark: SparkSession | None = None) -> dict:
    """Merge values into a small JSON file (on any of Spark's file systems with ``spark``); later values win. Returns the whole."""
    local = Path(path)
    old = read_text(spark, path) if spark else local.read_text(encoding="utf-8") if local.exists() else None
    merged = json.loads(old or "{}") | values
    text = json.dumps(merged, ensure_ascii=False, indent=2, default=str)
    if spark:
        write_bytes(spark, path, text.encode())
    else:
        local.write_text(text, encoding="utf-8")
    return merged


def load_env(path: str, env: dict[str, str] | None = None) -> dict[str, str]:
    """NAME=value lines that don't override what is set."""
    env = os.environ if env is None else env
    for line in Path(path).read_text(encoding="utf-8").splitlines() if Path(path).exists() else []:
        name, sep, value = line.strip().partition("=")
        if sep and not name.startswith("#"):
            env.setdefault(name.strip(), value.strip().strip("'\""))
    return env


def markdown_report(title: str, sections: Iterable[tuple[str, DataFrame]], rows: int | None = None) -> str:
    """Small result tables as Markdown. With ``rows``, longer ones end after their first rows, and say so."""
    out = [f"# {title}"]
    for name, df in sections:
        shown = df.collect() if rows is None else df.limit(rows + 1).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in shown[:rows]]
        if rows is not None and len(shown) > rows:
            out += ["", f"The first {rows} of {df.count()} rows."]
    return "\n".join(out) + "\n"
