"""Shard placement by a permutation-filled lookup table (operator 3).

Every shard has its own order of preference over the slots of a table of prime size: an offset and a stride, both from
its name. Shards take turns in claiming the first free slot of their order, so each gets a fair share, and one shard
more or less moves little besides its own part. A key's slot is its digest modulo the table's size.

Results: one row per input row with all its columns; a null key is placed like the empty text; equal keys share a
shard; existing columns named ``slot`` or ``shard`` are replaced. Empty tables give empty results.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots for each shard, and the most slots of a table: that bounds what is broadcast (about 16 MB).
SLOTS_PER_SHARD, MOST_SLOTS = 100, 1_000_000


def next_prime(n: int) -> int:
    """The smallest prime of at least ``n``."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def lookup_table(shards: list[str], size: int | None = None) -> list[int]:
    """Slot -> number of its shard. ``size`` must be prime, so that every stride reaches every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    size = size or next_prime(SLOTS_PER_SHARD * len(shards))
    if size > MOST_SLOTS or size < len(shards) or next_prime(size) != size:
        raise ValueError(f"{size} slots: not a prime from {len(shards)} to {MOST_SLOTS}")
    at, stride = [], []
    for name in shards:
        h = sha256(name.encode()).digest()
        at.append(int.from_bytes(h[:8], "big") % size)
        stride.append(int.from_bytes(h[8:16], "big") % (size - 1) + 1 if size > 2 else 1)
    table = [-1] * size
    for turn in range(size):
        k = turn % len(shards)
        while table[at[k]] >= 0:
            at[k] = (at[k] + stride[k]) % size
        table[at[k]] = k
    return table


def place(df: DataFrame, table: list[int], key_col: str) -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (int); the table is broadcast, no row is shuffled."""
    text = ",".join(map(str, table))  # at most MOST_SLOTS numbers
    slots = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard")).select("slot", F.col("shard").cast("int").alias("shard"))
    digest = F.substring(F.md5(F.coalesce(F.col(key_col).cast("string"), F.lit(""))), 1, 15)
    slot = (F.conv(digest, 16, 10).cast("long") % len(table)).cast("int")
    return df.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(slots), "slot").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(df: DataFrame, table: list[int], key_col: str, path: str, files: int = 1) -> None:
    """Write ``df`` as Parquet folders shard=0, 1, ...; each shard's rows are dealt over ``files`` files by slot."""
    placed = place(df, table, key_col)
    n = len(set(table)) * files
    placed.repartition(n, "shard", F.col("slot") % files).write.partitionBy("shard").parquet(path)
