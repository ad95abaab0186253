"""The table's rules and the placement."""

import hashlib
from collections import Counter

import pytest

from rillstone.llm.common import new_folder
from rillstone.llm.sharding import lookup_table, next_prime, place, write_shards


def test_shards_claim_slots_in_turns_by_their_order_of_preference():
    names, size = ["a", "b", "c"], 13
    orders = []
    for n in names:
        h = hashlib.sha256(n.encode()).digest()
        offset, stride = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:16], "big") % (size - 1) + 1
        orders.append([(offset + stride * j) % size for j in range(size)])
    want: dict[int, int] = {}
    for turn in range(size):
        k = turn % 3
        want[next(s for s in orders[k] if s not in want)] = k
    assert lookup_table(names, size) == [want[s] for s in range(size)]


def test_shares_are_even_and_changes_small():
    names = [f"s{i}" for i in range(20)]
    table = lookup_table(names)
    counts = Counter(table)
    assert len(table) == next_prime(2000) and max(counts.values()) - min(counts.values()) <= 1
    fewer = lookup_table(names[:-1], len(table))
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 19)
    assert moved < 0.2 * len(table)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            lookup_table(bad)
    with pytest.raises(ValueError):
        lookup_table(["a", "b"], 12)


def test_rows(spark):
    table = lookup_table(["x", "y", "z"])
    df = spark.createDataFrame([(1, "k", 9), (1, "k", 8), (2, None, 7), (3, "", 6), (4, "é" * 9000, 5)], "id int, key string, shard int")
    rows = place(df, table, "key").collect()
    by = {r.id: (r.slot, r.shard) for r in rows}
    want = lambda k: int(hashlib.md5(k.encode()).hexdigest()[:15], 16) % len(table)
    assert len(rows) == 5 and by[1][0] == want("k") and by[2] == by[3] and by[2][0] == want("") and all(table[s] == h for s, h in by.values())
    assert place(df.limit(0), table, "key").count() == 0
    path = new_folder(spark, "test-shards")
    write_shards(df, table, "key", path, files=2)
    back = spark.read.parquet(path)
    assert back.count() == 5 and {(r.id, r.shard) for r in back.collect()} == {(i, s) for i, (_, s) in by.items()}
