"""The pipeline's stages against brute force over the smallest tables."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from rillstone.llm.near_dup import without_duplicates
from rillstone.llm.queries import QUERIES
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_near_dup import brute as components

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    names = [n for n, _ in cp.STAGES]
    good = cp.keep_good(spark, docs, DATA).cache()
    kept = {r.doc_id for r in good.collect()}
    judged = [d for d in quality if quality[d] in (0, 1)]
    assert good.columns == docs.columns and sum((d in kept) == (quality[d] == 1) for d in judged) > 0.95 * len(judged)

    one = cp.keep_one_of_each(spark, good, DATA).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {d for d, _, _, keep in components(rows, 5) if keep}

    clean = cp.keep_uncontaminated(spark, one, DATA).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {d for (d, _), (_, n, _) in zip(rows, hits([t for _, t in rows], items), strict=True) if not n}

    last = cp.packed(spark, clean, DATA).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in clean.collect()} and len(names) == 4
    assert sorted(map(str, cp.run(spark, DATA).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(str(r) for r in spark.createDataFrame([(r.doc_id, r.piece, r.length, r.ids_crc32) for r in last], "doc_id long, piece int, length long, ids_crc32 long").collect())


def test_duplicates_in_odd_rows(spark):
    docs = spark.createDataFrame([(2, "a b c", "x"), (2, "a b c", "x"), (3, "a b c", "y"), (4, None, "z"), (5, "", "z"), (None, "a b c", "n")], "doc_id long, text string, lang string")
    left = without_duplicates(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r.lang) for r in left.collect()) == [(0, "n"), (2, "x"), (4, "z"), (5, "z")]
    assert without_duplicates(docs.limit(0)).count() == 0


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(1, None), (2, ""), (None, "no id at all here"), (3, " " * 700_000), (4, "w " * 40_000), (5, "same text of some words"), (5, "same text of some words"), (6, "Same  text of some WORDS")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, "c", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, signature string, hits int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = cp.run(spark, folder).collect()
    # without labels all score 0.5 and stay; of equal and near texts the smallest id stays
    assert sorted({-1 if r.doc_id is None else r.doc_id for r in out}) == [-1, 1, 2, 3, 4, 5] and sum(r.doc_id == 5 for r in out) == 1
    assert all(0 <= r.offset and r.offset + r.length <= 1024 for r in out)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{folder}/empty/{name}.parquet")
    assert cp.run(spark, f"{folder}/empty").count() == 0


def test_the_classifier_stage_keeps_what_its_scores_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scored = {r.doc_id: r.score for r in QUERIES["op9_quality"](spark, DATA).collect()}
    assert {r.doc_id for r in cp.keep_good(spark, docs, DATA).collect()} == {d for d, s in scored.items() if s >= 0.5}


def test_packing_places_each_piece_once(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in cp.packed(spark, docs, DATA).collect():
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    for placed in bins.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))] and sum(n for _, n in placed) <= 1024
    for r in docs.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        assert sorted(pieces[r.doc_id]) == [(a, b - a, zlib.crc32(ids[a:b].tobytes())) for a, b in zip(cuts, cuts[1:], strict=False)]
