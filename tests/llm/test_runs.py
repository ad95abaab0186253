"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib
from array import array

import duckdb

from rillstone.llm.queries import QUERIES
from rillstone.llm.runs import find_runs, lyndon_arrays, periodic_runs

SMALL = "/root/testdata/sf0.001"


def by_definition(x, least=12):
    """All (start, length, period): stretches of equal words a period apart that can't be longer, smallest period only."""
    out, n = {}, len(x)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and x[k] == x[k + q]:
                k += 1
            length = k - i + q
            if k > i and length >= max(least, 2 * q):
                out.setdefault((i, length), q)
            i = max(k, i + 1)
    return sorted((s, m, q) for (s, m), q in out.items())


def some(rng):
    x = [rng.randrange(rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randrange(40))]
    if x and rng.random() < 0.5:
        x = (x + x[: rng.randrange(1, 7)] * rng.randrange(1, 6) + x)[:70]
    return x


def test_lyndon_arrays():
    rng = random.Random(3)
    for _ in range(1500):
        x = some(rng)
        n = len(x)
        following, common, before = lyndon_arrays(array("q", x))
        for i in range(n):
            assert following[i] == next((j for j in range(i + 1, n) if x[j:] < x[i:]), n)
            assert before[i] == next((j for j in range(i - 1, -1, -1) if x[j:] < x[i:]), -1)
            j = following[i]
            assert common[i] == next((m for m in range(n - j) if x[i + m] != x[j + m]), n - j)


def test_runs_of_random_words():
    rng = random.Random(4)
    for _ in range(3000):
        x = some(rng)
        for least in (2, 12):
            assert find_runs(array("q", x), least) == by_definition(x, least)


class Counted(list):
    """A list that counts how often it is read."""

    reads = 0

    def __getitem__(self, i):
        Counted.reads += 1
        return super().__getitem__(i)


def test_comparisons_are_linear():
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    rng = random.Random(5)
    block = [rng.randrange(50) for _ in range(97)]
    for x in (b, [0] * 20_000, list(range(20_000)), block * 200, [rng.randrange(2) for _ in range(20_000)]):
        Counted.reads = 0
        lyndon_arrays(Counted(x))
        assert Counted.reads < 12 * len(x)


def whole(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = whole(text, doc_id)
    runs = by_definition(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_query_by_definition(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' WHERE length(coalesce(text, '')) < 12000").fetchall()
    want = {d: expected(d, t) for d, t in rows}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{SMALL}/documents.parquet'").fetchall()[0][0] and len(want) > 150
    assert {d: got[d] for d in want} == want and sum(w[1] > 0 for w in want.values()) > 10


def test_odd_rows(spark):
    same = "é x " * 9
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", "c"), (None, same, "d"), (4, same, "e"), (4, same, "f"), (5, "a b " * 5, "g"), (6, "w " * 30_000, "h"), (7, "a a " * 12, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    assert got == [
        (0, 18, [(0, 18, 2)], "é x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 18, [(0, 18, 2)], "é x"), (4, 18, [(0, 18, 2)], "é x"),
        (5, 10, [], "a b a b a b a b a b"), (6, 30_000, [(0, 30_000, 1)], "w"), (7, 12, [(0, 12, 1)], "a a"),
    ]
    assert periodic_runs(docs.limit(0)).count() == 0
    none = docs.select("doc_id", docs.text.cast("string").alias("text")).where("doc_id = 2")
    assert periodic_runs(none).first().collapsed == ""
