"""Hashes and numbers of words."""

import random

import numpy as np
import pyarrow as pa

from rillstone.llm import words as w

RNG = random.Random(1)
TEXTS = ["".join(RNG.choice("abcdé \n") for _ in range(RNG.randrange(300))) + "x" * RNG.choice([0, 9, 64, 70]) for _ in range(50)] + ["", None, "a\x00 a b\x00 a", "A a"]


def test_hash_is_the_polynomial():
    for data, offsets in w.slices(pa.array(TEXTS)):
        found = w.words(data, offsets, w.SPACED)
        for k in range(len(found.start)):
            word = found.word(k)
            value = sum((c + 1) * pow(w._BASE, i, w.PRIME) for i, c in enumerate(word)) % w.PRIME
            mixed = w.mix(np.array([(value + len(word) * 0xD6E8FEB86659FD93) & (1 << 64) - 1], np.uint64))
            assert int(mixed[0]) == int(found.hash[k])


def test_words_that_collide_modulo_a_power_of_two_stay_apart():
    signs = [0]
    while len(signs) < 1024:
        signs += [1 - s for s in signs]
    a, b = ("".join(letters[s] for s in signs) for letters in ("ab", "ba"))
    data, offsets = next(w.slices(pa.array([f"{a} x", f"{b} x"])))
    one, other = w.shingles(w.words(data, offsets, w.SPACED), 2)
    assert set(one.tolist()).isdisjoint(other.tolist())


def test_very_long_words_are_told_apart(monkeypatch):
    monkeypatch.setattr(w, "LONGEST", 4)
    data, offsets = next(w.slices(pa.array(["abcdef abcdeg abcdef abc"])))
    h = w.words(data, offsets, w.SPACED).hash.tolist()
    assert h[0] == h[2] and len(set(h)) == 3


def test_ids_by_bytes():
    for data, offsets in w.slices(pa.array(TEXTS + ["ab" * 40 + " " + "ab" * 40 + "c " + "ab" * 40])):
        start, end, first = w.word_spans(data, offsets, w.SPACED)
        ids = w.span_ids(data, start, end)
        seen = {}
        for k, i in enumerate(ids.tolist()):
            seen.setdefault(data[start[k] : end[k]].tobytes(), set()).add(i)
        assert all(len(v) == 1 for v in seen.values()) and len(set.union(*seen.values())) == len(seen)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first)).tolist()
        own = w.text_ids(ids, first).tolist()
        assert len(set(own)) == len(set(zip(owner, ids.tolist()))) == max(own) + 1
