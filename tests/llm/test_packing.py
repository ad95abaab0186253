"""Cutting against the tokenizers library, packing against its rules and a greedy run piece by piece."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillstone.llm.byte_bpe import ByteBpe
from rillstone.llm.packing import cut_documents, pack, plan_bins, sequences

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_librarys(library):
    pick = random.Random(3)
    texts = ["", " ", "  a", "a ", "<|endoftext|> x <|endoftext|>", "it's 'll\n\n b", " \n \n a"] + ["".join(pick.choice(["a", "b", " ", "\n", "é", "1", "'s", "<|endoftext|>", "\t", "!", "日"]) for _ in range(pick.randint(0, 60))) for _ in range(500)]
    encoder = ByteBpe(VOCABULARY)
    assert all(encoder.encode(t).tolist() == ids_of(library, t) for t in texts)


def one_by_one(counts, capacity):
    """Best-two-fit one bin after another, without runs of equal bins."""
    left, bins = Counter(counts), []
    while left := +left:
        bin_, gap = [], capacity
        while fit := [n for n in left if n <= gap and left[n] > 0]:
            bin_.append(n := max(fit))
            left[n] -= 1
            gap -= n
        if gap and len(bin_) > 1:
            small = min(bin_)
            pairs = [(a + b, a, b) for a in left for b in left if b <= a and small < a + b <= gap + small and left[a] > 0 and left[b] > (a == b)]
            if pairs:
                _, a, b = max(pairs)
                bin_.remove(small)
                bin_ += [a, b]
                left.update({small: 1})
                left.subtract([a, b])
        bins.append(tuple(sorted(bin_, reverse=True)))
    return bins


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_bins_equal_bins_filled_one_by_one(seed):
    pick = random.Random(seed)
    counts = Counter(pick.randint(1, pick.choice([6, 20, 40])) for _ in range(pick.randint(1, 120)))
    assert [b for b, times in plan_bins(dict(counts), 40) for _ in range(times)] == one_by_one(counts, 40)


def test_documents_are_cut_packed_and_joined_again(spark, library):
    texts = [None, "", "one", "many words " * 700, "many words " * 700, "ünïcode ☃ " * 40] + [f"text {i} " * (i % 37) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, offset string")
    pieces = cut_documents(docs, VOCABULARY).cache()
    packed = pack(pieces, ["doc_id", "piece"])
    found = defaultdict(list)
    rows = packed.collect()
    for r in rows:
        found[r.doc_id].append(r)
    for i, t in enumerate(texts):
        ids = [*ids_of(library, t), 2]
        mine = sorted(found[i], key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in mine) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))]
        assert [r.length for r in mine[1:]] == [1024] * (len(mine) - 1) and (len(mine) == 1 or len(ids) > 1024)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    assert all([o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 1024 for b in bins.values())
    total = sum(r.length for r in rows)
    assert len(bins) <= -(-total // 1024) + 2
    joined = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    assert sum(map(len, joined.values())) == 4 * total
    one = max(rows, key=lambda r: r.offset)
    assert zlib.crc32(joined[one.sequence_id][4 * one.offset : 4 * (one.offset + one.length)]) == zlib.crc32(bytes(one.ids))


def test_repeated_and_odd_pieces(spark):
    pieces = spark.createDataFrame([(1, 0, 600), (1, 0, 600), (None, 0, 424), (2, None, 424)], "doc_id long, piece int, length long")
    rows = pack(pieces, ["doc_id", "piece"]).collect()
    assert len(rows) == 4 and len({r.sequence_id for r in rows}) == 2
    assert pack(pieces.limit(0), ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="2 pieces"):
        pack(spark.createDataFrame([(1, 0), (2, None), (3, 5)], "doc_id long, length long"), ["doc_id"])


def test_long_white_space_and_clashing_columns(spark, library):
    texts = [" " * 2_000_000 + "x", "\r\n" * 1_500_000, None]
    docs = spark.createDataFrame([(i, t, 7, 7, 7) for i, t in enumerate(texts)], "doc_id long, text string, piece int, start int, sequence_id int")
    got = sorted((r.doc_id, r.start, bytes(r.ids)) for r in cut_documents(docs, VOCABULARY).collect())
    for i, t in enumerate(texts):
        whole = b"".join(ids for d, _, ids in got if d == i)
        assert np.frombuffer(whole, "<u4").tolist() == [*ids_of(library, t), 2]
