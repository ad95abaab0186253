"""The store's round trip against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillstone.llm import chunk_store as cs
from rillstone.llm.common import new_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_crc_of_joined_parts():
    pick, crc = random.Random(5), cs.Crc32()
    for _ in range(50):
        a, b = pick.randbytes(pick.randint(0, 90)), pick.randbytes(pick.randint(0, 3000))
        assert crc.join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_equal_passages_give_equal_chunks():
    pick = np.random.default_rng(1)
    shared = pick.integers(0, 50_000, 20_000)
    cuts = []
    for k in (0, 700, 1301):
        ids = np.concatenate([pick.integers(0, 50_000, k), shared])
        ends = cs.cut_points(ids)
        assert ends[-1] == len(ids) and all(0 < b - a <= cs.MOST for a, b in zip([0, *ends], ends, strict=False))
        cuts.append({ids[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)})
    assert len(cuts[0] & cuts[1] & cuts[2]) > 0.8 * len(cuts[0])
    assert cs.cut_points(np.zeros(0, np.int64)) == [] and cs.cut_points(np.zeros(10_000, np.int64))[-1] == 10_000


def test_round_trip(spark):
    pick = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    long = " ".join(pick.choices(words, k=9000))
    texts = [None, "", "a", long, long, "x " + long, long + " tail"] + [" ".join(pick.choices(words, k=pick.randint(1, 900))) for _ in range(60)]
    order = list(range(len(texts)))
    pick.shuffle(order)
    docs = spark.createDataFrame([(i * 3, texts[i], 1) for i in order], "doc_id long, text string, start int").repartition(5)
    path = new_folder(spark, "test-store")
    cs.write_store(docs, path, VOCABULARY)
    library, start, want = Tokenizer.from_file(VOCABULARY), 0, []
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i * 3, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, cs.read_store(spark, path).collect())) == want
    assert sorted((r.doc_id, len(r.ids) // 4, zlib.crc32(bytes(r.ids))) for r in cs.restore(spark, path).collect()) == [(d, n, c) for d, _, n, c in want]
    some = spark.createDataFrame([(9,), (12,)], "doc_id long")
    assert {r.doc_id for r in cs.restore(spark, path, some).collect()} == {9, 12}
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    assert chunks.selectExpr("sum(n)").first()[0] < 0.75 * start
    assert cs.verify_store(spark, path) == 0


def test_damage_is_found(spark):
    path = new_folder(spark, "test-store")
    cs.write_store(spark.createDataFrame([(1, "some text"), (1, "some text"), (None, "b")], "doc_id long, text string"), path, VOCABULARY)
    assert cs.read_store(spark, path).count() == 3
    other = new_folder(spark, "test-store")
    spark.read.parquet(f"{path}/recipes").write.parquet(f"{other}/recipes")
    spark.read.parquet(f"{path}/manifest").selectExpr("part", "n_docs", "n_tokens + 1 as n_tokens", "root", "width").write.parquet(f"{other}/manifest")
    spark.read.parquet(f"{path}/chunks").selectExpr("digest", "n", "cast(reverse(cast(hex(ids) as string)) as binary) as ids").write.parquet(f"{other}/chunks")
    assert cs.verify_store(spark, other) == 1
    with pytest.raises(Exception, match="damaged"):
        cs.read_store(spark, other).collect()


def test_empty_table(spark):
    path = new_folder(spark, "test-store")
    cs.write_store(spark.createDataFrame([], "doc_id long, text string"), path, VOCABULARY)
    assert cs.read_store(spark, path).count() == 0 and cs.restore(spark, path).count() == 0 and cs.verify_store(spark, path) == 0


def test_folding_gives_the_root_of_all_levels():
    for n in [*range(20), 127, 128, 129]:
        leaves, fold = [bytes([k]) * 16 for k in range(n)], cs.MerkleFold()
        for leaf in leaves:
            fold.add(leaf)
        assert fold.root() == cs.merkle_root(b"".join(leaves)) and len(fold.full) <= 8


def test_parts_have_the_roots_of_their_recipes(spark):
    path = new_folder(spark, "test-store")
    cs.write_store(spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string").repartition(3), path, VOCABULARY)
    parts = {}
    for r in spark.read.parquet(f"{path}/recipes").orderBy("part", "idx").collect():
        parts.setdefault(r.part, []).append(bytes(r.root))
    assert {r.part: bytes(r.root) for r in spark.read.parquet(f"{path}/manifest").collect()} == {p: cs.merkle_root(b"".join(rs)) for p, rs in parts.items()}


def test_long_white_space_and_clashing_columns(spark):
    texts = [" " * 3_000_000, "a" + "\n" * 2_000_000 + "b", "\t \u3000" * 400_000, ("x" + " " * 700) * 300]
    docs = spark.createDataFrame([(i, t, b"", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, digest binary, n int, place int")
    path = new_folder(spark, "test-store")
    cs.write_store(docs, path, VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    want = [np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for t in texts]
    got = sorted(map(tuple, cs.read_store(spark, path).collect()))
    assert [(d, n, c) for d, _, n, c in got] == [(i, len(w), zlib.crc32(w.tobytes())) for i, w in enumerate(want)]
