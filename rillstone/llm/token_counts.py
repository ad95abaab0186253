"""Token counts by a compiled finite-state transducer (operator 2).

A BPE vocabulary is compiled, state by state as texts need it, into a deterministic transducer over characters.
Position i of a text has exactly one last token (a sequence is the encoding of its text if and only if each adjacent
pair encodes to itself), so a state holds what the future needs of the past: for each open start position its place in
the vocabulary's trie, the last token before it and the number of tokens up to it, relative to now. A transition
carries the change of the token count, which is negative where two tokens become one; the sum along a path is the
count of the path's text.

A space after another character resets the transducer, since no piece spans such a place. So the state map of a chunk
is short: text before the first reset still waits for the entry state; all after it is a count and an exit state that
hold for every entry. Maps compose associatively; ``scan`` gives all prefixes of a text's chunk maps by a parallel
prefix scan (each level composes neighbours that don't depend on each other), thus the count up to every chunk's end.

The table of states is bounded: a full one is emptied, also within a text, as maps hold states by their keys.

Results: one row per input row. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results,
an empty table an empty result, other columns of the input are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, spread

SPACE = "▁"
CHUNK_CHARS = 1 << 16
#: Entries of the per-worker caches (segment counts, states). They bound memory; results do not depend on them.
MEMO_ENTRIES, MEMO_CHARS = 300_000, 64
STATE_ENTRIES = 300_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a serialized protocol buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, i = varint(i)
            value, i = data[i : i + n], i + n
        yield key >> 3, value


def read_pieces(path: str) -> dict[str, int]:
    """Piece -> rank (0 merges first) of a BPE model file; raises if the model asks for what is not compiled here."""
    import struct

    with open(path, "rb") as f:
        message = list(_fields(f.read()))
    trainer = dict(_fields(next(v for k, v in message if k == 2)))
    normalizer = dict(_fields(next(v for k, v in message if k == 3)))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
        raise ValueError("only BPE models with byte fallback and leading space marks are compiled")
    if normalizer.get(2, b"") or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("only models with identity normalization, a dummy prefix and kept spaces are compiled")
    scored = []
    for k, v in message:
        if k == 1:
            piece = dict(_fields(v))
            kind = piece.get(3, 1)
            if kind == 1:
                scored.append((-struct.unpack("<f", piece[2])[0], piece[1].decode()))
            elif kind in (4, 5):
                raise ValueError("user-defined and unused pieces are not compiled")
    ranks: dict[str, int] = {}
    score, rank = None, -1
    for s, text in sorted(scored):  # equal scores share a rank: the leftmost pair goes first
        rank, score = rank + (s != score), s
        ranks[text] = rank
    if any(SPACE in p.lstrip(SPACE) for p in ranks):
        raise ValueError("a piece spans a space: segments would not be independent")
    return ranks


class Transducer:
    """The lazily compiled transducer. ``run`` follows it; states and transitions are made when first asked for.

    A state's key is its open starts as packed 64-bit words: trie node, last token before the start (a token's
    number, a character that is no piece, or none) and the count relative to now. A transition is the next state
    times 1024 plus the change of the count plus 512.
    """

    _NONE, _CHARACTER = (1 << 23) - 1, 1 << 21
    #: Key of the state before any text; its number is 0.
    START = array("Q", [_NONE << 12 | 2048]).tobytes()

    def __init__(self, ranks: dict[str, int]) -> None:
        if max(map(len, ranks)) > 200 or len(ranks) >= self._CHARACTER:
            raise ValueError("the vocabulary doesn't fit the packed states")
        self.ranks = ranks
        self.children: list[dict[str, int] | None] = [None]
        self.token: list[int] = [-1]
        self.text: list[str] = []
        self._merges: dict[str, tuple] = {}
        self._valid: dict[int, bool] = {}
        for p in ranks:
            if len(p) == 1 or self.merges(p) is not None:
                self._add(p)
        self._reset()

    def _add(self, p: str) -> None:
        node = 0
        for c in p:
            below = self.children[node]
            if below is None:
                below = self.children[node] = {}
            node = below.get(c, 0)
            if not node:
                node = below[c] = len(self.children)
                self.children.append(None)
                self.token.append(-1)
        self.token[node] = len(self.text)
        self.text.append(p)

    def _reset(self) -> None:
        self.states: list[bytes] = []
        self.index: dict[bytes, int] = {}
        self.next: list[dict[str, int]] = []
        self.spaced: list[bool] = []
        self.enter(self.START)

    def enter(self, key: bytes) -> int:
        """The number of the state with this key."""
        q = self.index.get(key)
        if q is None:
            last = array("Q", key[-8:])[0] >> 12 & 0x7FFFFF
            ends = SPACE if last == self._NONE else self.text[last][-1] if last < self._CHARACTER else chr(last - self._CHARACTER)
            q = self.index[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
            self.spaced.append(ends == SPACE)
        return q

    def merges(self, p: str) -> tuple | None:
        """Merges that build ``p`` alone, in order: (rank, last symbol then, first symbol then); None if they don't."""
        if p in self._merges:
            return self._merges[p]
        symbols, out, ranks = list(p), [], self.ranks
        while len(symbols) > 1:
            best, at = min((ranks.get(symbols[i] + symbols[i + 1], 1 << 60), i) for i in range(len(symbols) - 1))
            if best == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            out.append((best, symbols[-1], symbols[0]))
        self._merges[p] = found = tuple(out) if len(symbols) == 1 else None
        return found

    def valid(self, left: str, right: str) -> bool:
        """Whether the text left + right encodes to these two: no merge across the boundary comes up."""
        a, b = self.merges(left), self.merges(right)
        x, y, i, j, far = left[-1], right[0], 0, 0, 1 << 60
        while True:
            p = a[i][0] if i < len(a) else far
            q = b[j][0] if j < len(b) else far
            across = self.ranks.get(x + y, far)
            if across < p and across <= q and across < far:
                return False
            if p == q == far:
                return True
            if p <= q:
                x, i = a[i][1], i + 1
            else:
                y, j = b[j][2], j + 1

    def _may_follow(self, last: int, token: int) -> bool:
        if last == self._NONE:
            return True
        known = self._valid.get(last << 24 | token)
        if known is None:
            if len(self._valid) > 1_000_000:
                self._valid.clear()
            left = self.text[last] if last < self._CHARACTER else chr(last - self._CHARACTER)
            known = self._valid[last << 24 | token] = self.valid(left, self.text[token])
        return known

    def _extend(self, q: int, c: str) -> int:
        """Make the transition of state ``q`` on character ``c``."""
        entries = array("Q", self.states[0 if c == SPACE and not self.spaced[q] else q])
        found = count = None
        live = []
        for e in entries:
            child = (self.children[e >> 35] or {}).get(c)
            if child is None:
                continue
            last, rel = e >> 12 & 0x7FFFFF, (e & 4095) - 2048
            token = self.token[child]
            if token >= 0 and found is None and self._may_follow(last, token):
                found, count = token, rel + 1
            if self.children[child]:
                live.append((child, last, rel))
        if found is None:  # a character that is no piece: its bytes
            found, count = self._CHARACTER + ord(c), (entries[-1] & 4095) - 2048 + len(c.encode())
        key = array("Q", [child << 35 | last << 12 | rel - count + 2048 for child, last, rel in live])
        key.append(found << 12 | 2048)
        self.next[q][c] = step = self.enter(key.tobytes()) << 10 | count + 512
        return step

    def run(self, q: int, text: str) -> tuple[int, int]:
        """Exit state and count of ``text`` from state ``q``."""
        n, nexts = -512 * len(text), self.next
        for c in text:
            step = nexts[q].get(c) or self._extend(q, c)
            q = step >> 10
            n += step & 1023
        return q, n

    def follow(self, key: bytes, parts: Iterable[str]) -> tuple[bytes, int]:
        """Key of the exit state and count of the parts of a text (spaces as SPACE), from the state of ``key``."""
        n = 0
        for part in parts:
            for i in range(0, len(part), CHUNK_CHARS):
                if len(self.states) > STATE_ENTRIES:
                    self._reset()
                q, k = self.run(self.enter(key), part[i : i + CHUNK_CHARS])
                key, n = self.states[q], n + k
        return key, n


class _Counts(dict):
    """Segment without its leading space mark -> count."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        n = self.transducer.follow(Transducer.START, [SPACE, word])[1]
        if len(self) < MEMO_ENTRIES and len(word) <= MEMO_CHARS:
            self[word] = n
        return n


#: A chunk's map: parts of the text that wait for the entry state, the count after them, the exit state's key (None: no
#: reset inside, all text waits).
Map = tuple[tuple[str, ...], int, bytes | None]


class Counter:
    """Token counts of texts by chunk state maps."""

    def __init__(self, ranks: dict[str, int], chunk_chars: int = CHUNK_CHARS) -> None:
        self.transducer, self.chunk_chars = Transducer(ranks), chunk_chars
        self.counts = _Counts(self.transducer)

    def chunk_map(self, chunk: str) -> Map:
        """The state map of a chunk in which spaces are ' '."""
        words = chunk.split(" ")
        first = 1
        while first < len(words) and not words[first - 1]:
            first += 1  # a reset needs a character other than a space before it
        if first >= len(words):
            return (chunk.replace(" ", SPACE),), 0, None
        head, middle, get = SPACE.join(words[:first]), words[first:-1], self.counts.__getitem__
        follow, start = self.transducer.follow, Transducer.START
        n = spaces = 0
        if "" not in middle:
            n = sum(map(get, middle))
        else:
            for w in middle:
                if not w:
                    spaces += 1
                elif spaces:
                    n += follow(start, [SPACE * (spaces + 1), w])[1]
                    spaces = 0
                else:
                    n += get(w)
        key, k = follow(start, [SPACE * (spaces + 1), words[-1]])
        return (head,), n + k, key

    def compose(self, a: Map, b: Map) -> Map:
        """The map of a's chunk followed by b's."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        key, n = self.transducer.follow(a[2], b[0])
        return a[0], a[1] + n + b[1], key if b[2] is None else b[2]

    def scan(self, maps: list[Map]) -> list[Map]:
        """All prefixes' maps: those of pairs by the same rule, the others by one more composition each."""
        if len(maps) == 1:
            return maps
        pairs = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)])
        return [maps[0], *(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]) for i in range(1, len(maps)))]

    def prefixes(self, text: str) -> list[Map]:
        """Maps of the text up to each chunk's end; a dummy space stands before it."""
        text, step = " " + text.replace(SPACE, " "), self.chunk_chars
        return self.scan([self.chunk_map(text[i : i + step]) for i in range(0, len(text), step)])

    def total(self, whole: Map) -> int:
        """Count of a text whose map begins at its start."""
        return self.transducer.follow(Transducer.START, whole[0])[1] + whole[1]

    def count(self, text: str) -> int:
        return self.total(self.prefixes(text)[-1]) if text else 0

    def counts_at_chunks(self, text: str) -> list[int]:
        """Counts of the text up to the end of each chunk, as if it ended there."""
        return [self.total(p) for p in self.prefixes(text)] if text else []


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(read_pieces(path))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` by the model, ``over_limit`` (n_tokens > limit).

    One pass without a shuffle. Each Python worker compiles its own transducer from ``model_path``, which every
    executor must be able to open.
    """
    bound_batches(docs.sparkSession)
    slim = spread(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    slim = slim.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = slim.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
