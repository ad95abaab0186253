"""Registered queries against their SQL twins over the small tables, and their columns."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rillstone.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.01"
COLUMNS = {
    "op2_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op4_exact_top_k": {"query_id", "rank", "vec_id", "score"},
    "op5_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op6_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op7_near_duplicates": {"doc_id", "n_shingles", "component_id", "kept"},
    "op8_chunk_store": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op9_quality": {"doc_id", "held_out", "score", "predicted"},
    "op10_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op11_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op12_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op13_conversation_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"},
}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(str(r) for r in want.select(*cols).fetchall())


def test_operators_and_their_columns(spark):
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    for name, columns in COLUMNS.items():
        if name not in ORACLE_SQL and name != "op7_near_duplicates":
            assert columns <= set(QUERIES[name](spark, "/root/testdata/sf0.001").columns)


SMALL = "/root/testdata/sf0.001"


def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SMALL}/documents.parquet'").fetchall())


def test_op2_counts_as_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {(d, len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in texts().items()}
    assert {tuple(r) for r in QUERIES["op2_token_counts"](spark, SMALL).collect()} == want


def test_op5_and_op8_have_the_librarys_ids(spark):
    library, start, stored = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    cut = set()
    for d, t in sorted(texts().items()):
        ids = library.encode(t, add_special_tokens=False).ids
        whole = np.array([*ids, 0], "<u4")
        stored.append((d, start, len(whole), zlib.crc32(whole.tobytes())))
        start += len(whole)
        whole[-1] = 2
        first = len(whole) % 1024 or 1024
        ends = [first, *range(first + 1024, len(whole) + 1, 1024)]
        cut |= {(d, k, a, b - a, zlib.crc32(whole[a:b].tobytes())) for k, (a, b) in enumerate(zip([0, *ends], ends, strict=False))}
    assert sorted(map(tuple, QUERIES["op8_chunk_store"](spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == stored
    got = QUERIES["op5_best_fit_packing"](spark, SMALL).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == cut and len(got) == len(cut)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(o == sum(n for _, n in sorted(b)[:k]) for b in filled.values() for k, (o, _) in enumerate(sorted(b)))
    assert max(sum(n for _, n in b) for b in filled.values()) <= 1024 and len(filled) <= 1.01 * -(-sum(r.length for r in got) // 1024) + 1


def test_op9_held_out_and_predicted(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
    rows = QUERIES["op9_quality"](spark, SMALL).collect()
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in texts()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == q for p, q in judged) > 0.9 * len(judged)
