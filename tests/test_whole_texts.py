"""Queries over documents read whole texts."""

import duckdb

from rillstone.plans.linkage import QUERIES

DATA = "/root/testdata/sf0.001"


def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())


def test_authors_are_all_words(spark):
    want = {(i, k, a) for i, t in texts().items() for k, a in enumerate((w for w in (p.strip() for p in (t or "").replace(" ", "|").split("|")) if w), 1)}
    got = [(r.doc_id, r.author_order, r.author) for r in QUERIES["split_authors"](spark, DATA).collect()]
    assert len(got) == len(want) and set(got) == want
    assert {(r.doc_id, r.author_order) for r in QUERIES["authorships_attach"](spark, DATA).select("doc_id", "author_order").collect()} == {(i, k) for i, k, _ in want}


def test_keys_hold_whole_texts(spark):
    want = {i: f"title:{' '.join(t.lower().split())}" for i, t in texts().items() if i % 3 and t and t.strip()}
    got = {r.doc_id: r.key for r in QUERIES["work_queries"](spark, DATA).collect()}
    assert {i: got[i] for i in want} == want


def test_publications_of_different_texts_stay_apart(spark):
    docs = {i: t or "" for i, t in texts().items()}
    got = QUERIES["publication_master"](spark, DATA).collect()
    assert {r.title for r in got} | {r.abstract for r in got} <= set(docs.values()) | {""}
    # master keys by DOI, or by the normalized whole text and year
    norm = {r.doc_id: r.text_norm for r in QUERIES["text_normalize"](spark, DATA).collect()}
    keys = {f"doi:10.1/{i % 40}" if i % 5 == 0 else f"titleyear:{norm[i]}|{2000 + i % 20 if i % 11 else ''}" for i in docs}
    assert {r.master_key for r in got} == keys and len(got) == len(keys)
