"""The corpus pipeline: quality, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. The first three return the columns
of ``documents``; the last returns the packed pieces: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

Null and empty texts score as the share of good labels, link with nothing, hold no window and pack as their end id.
Rows of a null doc_id are never dropped as copies. Rows that repeat id and text become one. Without labels all
documents score 0.5 and stay; an empty benchmark drops nothing; an empty table gives an empty result. Further columns,
whatever their names, pass through the first three stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import materialize, spread
from rillstone.llm.decontaminate import without_contaminated
from rillstone.llm.near_dup import without_duplicates
from rillstone.llm.packing import cut_documents, pack
from rillstone.llm.quality import scorer, train


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the trained field holds for good (score of 0.5 or more)."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return spread(docs).where(scorer(model)("text") >= 0.5)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    return without_duplicates(docs, shingle_words=5, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window of ten words occurs."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    pieces = cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    pieces = materialize(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, ["doc_id", "piece"], capacity=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", packed),
]

#: SQL cannot express the trained field or the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = before = materialize(docs, f"stage-{k}", instead=before)
    return docs
