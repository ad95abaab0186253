"""Token counts against the library that the model belongs to."""

import random

import public_tokenizers
import pytest
import sentencepiece

from rillstone.llm import token_counts as tc
from rillstone.llm.token_counts import Counter, read_pieces, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGE = ["", "a", " ", "  ", "   a  b", "a  ", " \n x", "ß☃😀a", "▁▁x ▁", "\x00", "aaa" * 50, "日本語テキスト 中文", "<s> </s> <unk>", "a▁b", "http://x.y/" + "ab" * 3000, "word " * 20_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("chunk_chars", [1, 2, 7, 1 << 16])
def test_counts_equal_the_librarys_for_any_chunk_length(library, chunk_chars):
    pick = random.Random(chunk_chars)
    texts = EDGE[: -2 if chunk_chars < 7 else None] + ["".join(pick.choice(["a", "b", " ", "  ", "\n", "▁", "é", "☃", "the", "ing "]) for _ in range(pick.randint(0, 80))) for _ in range(300)]
    counter = Counter(read_pieces(MODEL), chunk_chars)
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_maps_compose_associatively():
    counter = Counter(read_pieces(MODEL))
    a, b, c = (counter.chunk_map(x) for x in ("some te", "xt", " of words here"))
    assert counter.compose(counter.compose(a, b), c) == counter.compose(a, counter.compose(b, c))


def test_prefix_counts(library):
    pick = random.Random(4)
    for step in (1, 5, 64):
        counter = Counter(read_pieces(MODEL), step)
        for text in ["".join(pick.choice(["a", "b", " ", "  ", "\n", "the", "ing ", "é"]) for _ in range(n)) for n in (1, 40, 150)] + ["x" * 70]:
            ends = [min(i + step, len(text) + 1) - 1 for i in range(0, len(text) + 1, step)]  # the first chunk holds the dummy space
            assert [c for c, e in zip(counter.counts_at_chunks(text), ends, strict=True) if e] == [len(library.encode(text[:e])) for e in ends if e]


def test_states_are_bounded_within_a_text(library, monkeypatch):
    monkeypatch.setattr(tc, "STATE_ENTRIES", 500)
    monkeypatch.setattr(tc, "CHUNK_CHARS", 100)
    pick = random.Random(9)
    text = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))
    counter = Counter(read_pieces(MODEL), 100)
    assert counter.count(text) == len(library.encode(text)) and len(counter.transducer.states) <= 601


def test_rows_nulls_clashes_and_empty_tables(spark, library):
    rows = [(1, None, 7), (2, "hello world", 8), (2, "hello world", 8), (None, "é", 9), (3, "x " * 5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, MODEL).collect()}
    want = {(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t, _ in rows}
    assert got == want and token_counts(docs, MODEL).count() == 5
    assert token_counts(docs.limit(0), MODEL).count() == 0


