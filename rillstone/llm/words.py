"""Words and word shingles of whole texts as 64-bit hashes, for a batch of texts at a time.

All work is on UTF-8 bytes in NumPy: a table lowers A-Z, another tells word bytes from separators, and a polynomial
modulo the prime 2**61 - 1 gives every word's hash from two running sums. The hashes stand for the words in set
comparisons: two given words of n bytes agree for n of the 2**61 bases at most, of which one was drawn. ``span_ids``
numbers words by their bytes themselves, where a hash won't do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of white-space words: \x20 and \x09-\x0D.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Word bytes of plain words: digits, letters and all beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = PLAIN[128:] = True

#: The prime modulus of the words' polynomial, and its base, drawn once.
PRIME = (1 << 61) - 1
_BASE = 1 + int(np.random.Generator(np.random.PCG64(20240601)).integers(1 << 60, PRIME - 1))
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)


def _reduced(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo PRIME."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, in halves of 31 and 30 bits; 2**61 counts as 1."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(np.uint64(2) * a1 * b1 + (middle >> _30) + ((middle & _LOW30) << _31) + a0 * b0)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2**bits of each."""
    out = []
    for base in (_BASE, pow(_BASE, -1, PRIME)):
        p = np.ones(1, np.uint64)
        for _ in range(bits):
            p = np.concatenate([p, _product(p, np.uint64(pow(base, len(p), PRIME)))])
        out.append(p)
    return tuple(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some texts: ``data`` lowered bytes, ``start`` and ``end`` of each word in it, ``hash``, and for text i the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def word(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' bytes and the n + 1 offsets in them, about ``size`` bytes at a time. Null texts are empty."""
    texts = (texts if pa.types.is_string(texts.type) else texts.cast(pa.string())).fill_null("")
    _, where, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(where, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield whole[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


#: Longer spans are hashed by a digest: beyond this the halves of a sum could pass 64 bits.
LONGEST = 1 << 23


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    power, inverse = _powers(max(20, int(len(data)).bit_length()))
    value, power = data.astype(np.uint64) + np.uint64(1), power[: len(data)]
    halves = []
    for half in (power >> _31, power & _LOW31):  # running sums may wrap; their differences don't, below LONGEST bytes
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value * half, out=sums[1:])
        halves.append(_reduced(sums[end] - sums[start]))
    whole = _reduced(_product(halves[0], np.full_like(halves[0], 1 << 31)) + halves[1])
    out = mix(_product(whole, inverse[start]) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(end - start > LONGEST).tolist():
        out[k] = int.from_bytes(blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def span_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each span: the same for equal bytes, another for others, by sorting alone.

    Spans are told apart by eight bytes after the other, those of more than 64 bytes or with a zero byte as a whole.
    """
    size = end - start
    zeros = np.concatenate(([0], np.cumsum(data == 0)))
    hard = np.flatnonzero((size > 64) | (zeros[end] > zeros[start]))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    shifts = np.arange(56, -8, -8).astype(np.uint64)

    def eight(which: np.ndarray, at: int) -> np.ndarray:
        key = np.zeros(len(which), np.uint64)
        begin, left = start[which] + at, size[which] - at
        for k in range(8):
            key |= (padded[np.minimum(begin + k, len(data))].astype(np.uint64) * (left > k).astype(np.uint64)) << shifts[k]
        return key

    out = np.unique(eight(np.arange(len(start)), 0), return_inverse=True)[1].astype(np.int64)
    fresh = int(out.max(initial=0)) + 1
    for at in range(8, 64, 8):
        which = np.flatnonzero((size > at) & (size <= 64))
        if not len(which):
            break
        tail = np.unique(eight(which, at), return_inverse=True)[1].astype(np.int64)
        out[which] = fresh + np.unique(out[which] * (int(tail.max()) + 1) + tail, return_inverse=True)[1]
        fresh = int(out.max()) + 1
    last = None
    for word, k in sorted((data[start[k] : end[k]].tobytes(), k) for k in hard.tolist()):
        if word != last:
            last, fresh = word, fresh + 1
        out[k] = fresh
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, and for text i the words ``first[i]`` to ``first[i + 1]``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True  # a text's end parts words, too
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | fresh[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | fresh[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes in each text, lowered and hashed."""
    data = LOWER[data]
    start, end, first = word_spans(data, offsets, is_word)
    return Words(data, offsets, start, end, span_hashes(data, start, end), first)


def text_ids(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Dense numbers of (text, word): what one text's words share nothing with another's."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.unique(owner * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1].astype(np.int64)


def shingles(found: Words, size: int) -> list[np.ndarray]:
    """Each text's set of shingles as sorted distinct hashes.

    A shingle is ``size`` words in a row; a text of fewer words, but not none, has them all as its one shingle.
    """
    h = found.hash
    joined = np.full(max(0, len(h) - size + 1), size, np.uint64)
    for k in range(size):
        joined = mix(joined * np.uint64(0xA0761D6478BD642F) + h[k : k + len(joined)])
    out = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(joined[a : b - size + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            one = np.full(min(1, b - a), b - a, np.uint64)
            for k in range(a, b):
                one = mix(one * np.uint64(0xA0761D6478BD642F) + h[k : k + 1])
            out.append(one)
    return out
