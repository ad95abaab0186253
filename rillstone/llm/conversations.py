"""Conversation structure repair by a time-major tensor of state costs (operator 13).

A conversation should read ``(s?(ua)+)?`` by its roles' initials: perhaps a system turn, then user and assistant by
turns. Edits make it so: Keep (0), Rerole to user or assistant (2), Delete (3; blank and repeated rows must go), Insert
an empty user or assistant row (2, anywhere); a truncated row that stays adds 1. The cheapest edits are sought, and of
equally cheap ones those whose initials are least in ASCII order.

Conversations are put into buckets by length. A bucket is one tensor: going back turn by turn, the costs from each of
the four states (start, after system, after user, after assistant) are updated for all its conversations at once and
stored; going forth, the stored costs give every conversation's edits, again a turn of all conversations at a time.

A conversation of up to ``BLOCK`` rows is solved by the task that sorts it. Of a longer one, equal rows are counted
before they are shuffled, the rest is sorted by ranges and cut into blocks; each block yields the cheapest costs from
every state to every state, these matrices (128 bytes a block) are composed from the end, and each block then finds its
edits from all four states it could begin in. One task reads the blocks in order, as the digest of a whole text must,
holding one batch of rows and the edits' initials.

Rows are ordered by turn (nulls first), then role, then text, so repeated rows stand together. Null roles and texts are
one space. A role counts by its first character; one that begins with another letter than s, u or a can't be kept. Rows
of a null id are a conversation of their own. An empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rillstone.llm.common import bound_batches, discard, materialize

#: Rows of a conversation that one task solves whole, and of a block of a longer one.
BLOCK = 2048
#: Ids of long conversations that may be broadcast; more are shuffled.
BROADCAST_IDS = 100_000
#: Rows that a task gathers before it solves the conversations among them.
GATHER = 20_000

INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
FAR = 1 << 40
#: The state after an inserted or reroled row; the states are start, after system, after user, after assistant.
NEXT = np.array([2, 2, 3, 2])
#: The state after a kept row, by its initial (s, u, a, other) and the state before; -1: it can't be kept there.
KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
#: Costs from each state to the end of a conversation.
FINAL = np.array([0, 2 * INSERT, INSERT, 0])
D, K, R = 0, 1, 2
LEGAL = {"su", "ua", "au"}
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _costs(after: np.ndarray, initial: np.ndarray, forced: np.ndarray, extra: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Costs before a row from those after it, of all conversations: ``after`` is (conversations, states, ends)."""
    move = KEEP[initial]
    rows = np.arange(len(after))[:, None]
    stay = np.where((move >= 0)[:, :, None], after[rows, move] + extra[:, None, None], FAR)
    other = after[:, NEXT] + (REROLE + extra)[:, None, None]
    free = np.minimum(stay, other) + (DELETE * (copies - 1))[:, None, None]
    gone = after + (DELETE * copies)[:, None, None]
    best = np.where(forced[:, None, None], gone, np.minimum(gone, free))
    user, assistant = best[:, 2], best[:, 3]
    best[:, 2], best[:, 3] = np.minimum(user, assistant + INSERT), np.minimum(assistant, user + INSERT)
    best[:, :2] = np.minimum(best[:, :2], best[:, 2:3] + INSERT)
    return np.minimum(best, FAR)


class Bucket:
    """Rows of conversations (or blocks) of similar lengths, turn by turn; shorter ones end in rows that change nothing."""

    def __init__(self, first: np.ndarray, which: np.ndarray, initial: np.ndarray, forced: np.ndarray, extra: np.ndarray, copies: np.ndarray) -> None:
        self.which, size = which, first[which + 1] - first[which]
        self.turns = int(size.max(initial=0))
        at = first[which][None, :] + np.arange(self.turns)[:, None]
        self.real = np.arange(self.turns)[:, None] < size[None, :]
        at = np.where(self.real, at, 0)
        self.facts = [c[at] if len(c) else np.zeros(at.shape, c.dtype) for c in (initial, forced, extra, copies)]

    def back(self, ends: np.ndarray) -> np.ndarray:
        """Stored costs (turns + 1, conversations, states, ends) before every turn and after the last."""
        out = np.empty((self.turns + 1, *ends.shape), np.int64)
        out[-1] = ends
        for t in range(self.turns - 1, -1, -1):
            new = _costs(out[t + 1], *(c[t] for c in self.facts))
            out[t] = np.where(self.real[t][:, None, None], new, out[t + 1])
        return out

    def trace(self, stored: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From costs to one end: rows inserted before each turn, its edit, and the states after the last turn."""
        n = np.arange(len(state))
        inserted = np.zeros((self.turns, len(state)), np.int8)
        edit = np.zeros((self.turns, len(state)), np.int8)
        for t in range(self.turns):
            now, after, real = stored[t, :, :, 0], stored[t + 1, :, :, 0], self.real[t]
            initial, forced, extra, copies = (c[t] for c in self.facts)
            for _ in range(2):
                delete = now[n, state] == after[n, state] + DELETE * copies
                more = real & ~delete & (now[n, state] == now[n, NEXT[state]] + INSERT)
                inserted[t] += more
                state = np.where(more, NEXT[state], state)
            delete = now[n, state] == after[n, state] + DELETE * copies
            move = KEEP[initial, state]
            keep = ~forced & (move >= 0) & (now[n, state] == after[n, move] + extra + DELETE * (copies - 1))
            edit[t] = np.where(delete, D, np.where(keep, K, R))
            state = np.where(real & ~delete, np.where(keep, move, NEXT[state]), state)
        return inserted, edit, state


def buckets(first: np.ndarray, *facts: np.ndarray) -> Iterator[Bucket]:
    """Conversations from row ``first[i]`` to ``first[i + 1]`` by the number of binary digits of their lengths."""
    digits = np.frexp(np.diff(first))[1]
    for d in np.unique(digits):
        yield Bucket(first, np.flatnonzero(digits == d), *facts)


class Rows:
    """Sorted rows of whole conversations (or blocks), from Arrow columns."""

    def __init__(self, table: pa.Table, keys: list[str]) -> None:
        self.keys = list(zip(*(table.column(k).to_pylist() for k in keys), strict=True))
        self.first = np.array([0] + [i for i in range(1, len(self.keys)) if self.keys[i] != self.keys[i - 1]] + ([len(self.keys)] if self.keys else []), np.int64)
        self.role, self.text = table.column("role").to_pylist(), table.column("text").to_pylist()
        self.turn, self.copies = table.column("turn").to_pylist(), table.column("copies").to_numpy().astype(np.int64)
        roles = pc.utf8_slice_codeunits(table.column("role"), 0, 1)
        self.letter = roles.to_pylist()
        self.initial = np.array(["sua".find(c) if c else 3 for c in self.letter], np.int64)
        self.initial[self.initial < 0] = 3
        bare = pc.utf8_trim(table.column("text"), characters=" \t\n\v\f\r")
        self.blank = pc.equal(pc.utf8_length(bare), 0).to_numpy().astype(bool)
        ended = pc.or_(pc.or_(pc.ends_with(bare, "."), pc.ends_with(bare, "!")), pc.ends_with(bare, "?")).to_numpy().astype(bool)
        again = ~table.column("fresh").to_numpy().astype(bool) if "fresh" in table.column_names else self._seen(table)
        self.again = again & ~self.blank
        self.forced = self.blank | self.again
        self.truncated = ~self.forced & ~ended
        self.extra = self.truncated.astype(np.int64) * TRUNCATED

    def _seen(self, table: pa.Table) -> np.ndarray:
        """Rows whose role and text stand earlier in their conversation."""
        owner = np.repeat(np.arange(max(0, len(self.first) - 1)), np.diff(self.first)) if len(self.keys) else np.zeros(0, np.int64)
        codes = [table.column(c).combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64) for c in ("role", "text")]
        pair = np.unique(codes[0] * (len(owner) + 1) + codes[1], return_inverse=True)[1]
        fresh = np.zeros(len(owner), bool)
        fresh[np.unique(owner * (len(owner) + 1) + pair, return_index=True)[1]] = True
        return ~fresh

    def facts(self) -> tuple[np.ndarray, ...]:
        return self.initial, self.forced, self.extra, self.copies

    def buckets(self) -> Iterator[Bucket]:
        return buckets(self.first, *self.facts()) if self.keys else iter(())


class Fold:
    """One conversation, read block after block: its counts, its edits' initials and its repaired lines."""

    def __init__(self, conv: object) -> None:
        self.conv, self.state, self.cost, self.lines = conv, 0, 0, 0
        self.blank = self.again = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None
        self.audit: list[str] = []
        self.digest = sha256()
        self.repaired: list[tuple[object, int, str, str]] = []

    def _line(self, role: str, text: str, wanted: bool) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode())
        if wanted:
            self.repaired.append((self.conv, self.lines, role, text))
        self.lines += 1

    def _insert(self, wanted: bool) -> None:
        self.state = int(NEXT[self.state])
        self.cost += INSERT
        self._line("user" if self.state == 2 else "assistant", "", wanted)

    def add(self, rows: Rows, a: int, b: int, inserted: list[int], edits: list[int], wanted: bool = False) -> None:
        """The next rows a to b with their edits."""
        letters = []
        for i, more, edit in zip(range(a, b), inserted, edits, strict=True):
            copies, turn, letter = int(rows.copies[i]), rows.turn[i], rows.letter[i]
            if rows.blank[i]:
                self.blank += copies
            else:
                self.again += copies - (not rows.again[i])
                self.truncated += bool(rows.truncated[i])
            self.illegal += copies - 1 + (self.last is not None and self.last + letter not in LEGAL)
            self.last = letter
            if turn is not None and turn != self.high:  # turns ascend
                self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            for _ in range(more):
                self._insert(wanted)
            letters.append("I" * more + "DKR"[edit])
            if edit == D:
                self.cost += DELETE * copies
            else:
                self.cost += DELETE * (copies - 1) + int(rows.extra[i]) + (REROLE if edit == R else 0)
                self.state = int(NEXT[self.state] if edit == R else KEEP[rows.initial[i], self.state])
                self._line(rows.role[i] if edit == K else "user" if self.state == 2 else "assistant", rows.text[i], wanted)
            if copies > 1:
                letters.append("D" * (copies - 1))
        self.audit.append("".join(letters))

    def close(self, wanted: bool = False) -> dict:
        while self.state in (1, 2):
            self._insert(wanted)
            self.audit.append("I")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"conv_id": self.conv, "gaps": gaps, "blank": self.blank, "duplicate": self.again, "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


def whole_conversations(rows: Rows, present: np.ndarray, wanted: bool = False) -> Iterator[Fold]:
    """Solve all conversations of ``rows``; those with a row that isn't ``present`` have that one row only."""
    at = {}
    for bucket in rows.buckets():
        ends = np.broadcast_to(FINAL[None, :, None], (len(bucket.which), 4, 1))
        inserted, edits, _ = bucket.trace(bucket.back(ends), np.zeros(len(bucket.which), np.int64))
        for k, unit in enumerate(bucket.which.tolist()):
            at[unit] = inserted[:, k], edits[:, k]
    for unit, (a, b) in enumerate(zip(rows.first[:-1].tolist(), rows.first[1:].tolist(), strict=True)):
        fold = Fold(rows.keys[a][0])
        if present[a]:
            fold.add(rows, a, b, at[unit][0][: b - a].tolist(), at[unit][1][: b - a].tolist(), wanted)
        yield fold


def _gathered(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The sorted rows in tables that end where a key does."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        if sum(b.num_rows for b in held) >= GATHER:
            last = key(held[-1], held[-1].num_rows - 1)
            cut = 0
            while cut < batch.num_rows and key(batch, cut) == last:
                cut += 1
            held.append(batch.slice(0, cut))
            if cut == batch.num_rows:
                continue
            yield pa.Table.from_batches(held)
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _solver(kind: pa.DataType, wanted: bool):
    """Task function: sorted rows of ordinary conversations to their summaries, or to their repaired rows."""
    empty = (pa.field("conv_id", kind),)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, ["conv_id"]):
            solid = table.column("present").to_numpy().astype(bool)
            known = set(table.filter(pa.array(solid)).column("conv_id").to_pylist())  # of others one row stands for the id
            seen: set = set()
            keep = [p or (c not in known and not (c in seen or seen.add(c))) for p, c in zip(solid.tolist(), table.column("conv_id").to_pylist(), strict=True)]
            table = table.filter(pa.array(keep))
            folds = list(whole_conversations(Rows(table, ["conv_id"]), table.column("present").to_numpy().astype(bool), wanted))
            yield from _emit([f.close(wanted) for f in folds], folds, empty, wanted)

    return solve


def _emit(closed: list[dict], folds: list[Fold], head: tuple, wanted: bool) -> Iterator[pa.RecordBatch]:
    if wanted:
        rows = [r for f in folds for r in f.repaired]
        schema = pa.schema([*head, pa.field("place", pa.int64()), pa.field("role", pa.string()), pa.field("text", pa.string())])
        yield from pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema).to_batches()
    else:
        numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        schema = pa.schema([*head, *(pa.field(c, pa.int64()) for c in numbers), pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
        yield from pa.Table.from_pylist(closed, schema).to_batches()


def _matrices(kind: pa.DataType):
    """Task function: sorted rows of blocks to the costs from every state to every state."""
    identity = np.where(np.eye(4, dtype=bool), 0, FAR)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, ["conv_id", "block"]):
            rows = Rows(table, ["conv_id", "block"])
            found = {}
            for bucket in rows.buckets():
                costs = bucket.back(np.broadcast_to(identity, (len(bucket.which), 4, 4)))[0]
                found |= dict(zip(bucket.which.tolist(), costs.reshape(-1, 16).tolist(), strict=True))
            keys = [rows.keys[a] for a in rows.first[:-1].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], kind), pa.array([k[1] for k in keys], pa.int64()), pa.array([found[u] for u in range(len(keys))], pa.list_(pa.int64()))], names=["conv_id", "block", "costs"])

    return measure


def _composed():
    """A column function: for each block of a conversation, ordered, the costs from each state after it to the conversation's end."""

    @F.arrow_udf("array<struct<block:long,ends:array<long>>>")
    def ends(blocks: pa.Array) -> pa.Array:
        out = []
        for units in blocks.to_pylist():
            after, rows = FINAL.astype(np.int64), []
            for unit in reversed(units):
                rows.append({"block": unit["block"], "ends": after.tolist()})
                after = (np.array(unit["costs"], np.int64).reshape(4, 4) + after[None, :]).min(1)
            out.append(rows[::-1])
        return pa.array(out, pa.list_(pa.struct([("block", pa.int64()), ("ends", pa.list_(pa.int64()))])))

    return ends


def _tracer(kind: pa.DataType):
    """Task function: blocks' rows with their ``ends`` to the edits from each of the four states."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, ["conv_id", "block"]):
            rows = Rows(table, ["conv_id", "block"])
            ends = table.column("ends").take(pa.array(rows.first[:-1])).to_pylist()
            found: dict[int, list[bytes]] = {}
            for bucket in rows.buckets():
                stored = bucket.back(np.array([ends[u] for u in bucket.which.tolist()], np.int64)[:, :, None])
                for state in range(4):
                    inserted, edits, _ = bucket.trace(stored, np.full(len(bucket.which), state))
                    packed = (inserted * 3 + edits).astype(np.uint8)
                    for k, u in enumerate(bucket.which.tolist()):
                        found.setdefault(u, []).append(packed[: rows.first[u + 1] - rows.first[u], k].tobytes())
            keys = [rows.keys[a] for a in rows.first[:-1].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], kind), pa.array([k[1] for k in keys], pa.int64()), pa.array([found[u] for u in range(len(keys))], pa.list_(pa.binary()))], names=["conv_id", "block", "edits"])

    return find


def _folder(kind: pa.DataType, wanted: bool):
    """Task function: blocks in order, each after its edits, to their conversations' summaries or repaired rows."""
    head = (pa.field("conv_id", kind),)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Fold | None = None
        for table in _gathered(batches, ["conv_id", "block"]):
            opens = [e is not None for e in table.column("edits").to_pylist()]
            edits = [e for e in table.column("edits").to_pylist() if e is not None]
            rows = Rows(table.filter(pa.array([not o for o in opens])), ["conv_id", "block"])
            for u, (a, b) in enumerate(zip(rows.first[:-1].tolist(), rows.first[1:].tolist(), strict=True)):
                conv = rows.keys[a][0]
                if now is None or now.conv != conv:
                    if now is not None:
                        yield from _emit([now.close(wanted)], [now], head, wanted)
                    now = Fold(conv)
                packed = np.frombuffer(edits[u][now.state], np.uint8)
                now.add(rows, a, b, (packed // 3).tolist(), (packed % 3).tolist(), wanted)
                if wanted:
                    yield from _emit([], [now], head, wanted)
                    now.repaired = []
        if now is not None:
            yield from _emit([now.close(wanted)], [now], head, wanted)

    return fold


def _solve(rows: DataFrame, kind: str, wanted: bool) -> DataFrame:
    schema = f"conv_id {kind}, " + ("place long, role string, text string" if wanted else SUMMARY)
    arrow = to_arrow_type(rows.schema["conv_id"].dataType)
    ordered = rows.withColumn("copies", F.lit(1).cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_solver(arrow, wanted), schema)


def _solve_long(rows: DataFrame, kind: str, block: int, wanted: bool) -> DataFrame:
    """The same for long conversations, in blocks."""
    schema = f"conv_id {kind}, " + ("place long, role string, text string" if wanted else SUMMARY)
    arrow = to_arrow_type(rows.schema["conv_id"].dataType)
    single = materialize(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "distinct-rows")
    keyed = single.withColumn("digest", F.sha2("text", 256))
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))).alias("e")
    firsts = materialize(keyed.groupBy("conv_id", "role", "digest").agg(earliest).select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest"), F.col("e.turn").alias("f_turn"), F.lit(True).alias("fresh")), "first-rows")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest")) & F.col("turn").eqNullSafe(F.col("f_turn"))
    flagged = keyed.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "copies", F.coalesce("fresh", F.lit(False)).alias("fresh"))
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = flagged.repartitionByRange(parts, "conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    placed = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered-rows", instead=single)
    discard(firsts)
    blocks = placed.withColumn("block", F.expr(f"place div {block}"))
    costs = blocks.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place").mapInArrow(_matrices(arrow), f"conv_id {kind}, block long, costs array<long>")
    costs = costs.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "costs"))).alias("blocks"))  # 128 bytes for each block
    ends = materialize(costs.select(F.col("conv_id").alias("e_conv"), F.explode(_composed()("blocks")).alias("e")).select("e_conv", F.col("e.block").alias("e_block"), "e.ends"), "block-ends")
    known = blocks.join(ends, F.col("conv_id").eqNullSafe(F.col("e_conv")) & (F.col("block") == F.col("e_block"))).drop("e_conv", "e_block")
    edits = known.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place").mapInArrow(_tracer(arrow), f"conv_id {kind}, block long, edits array<binary>")
    edits = materialize(edits, "block-edits", instead=ends)
    nothing = {c: F.lit(None).cast(t) for c, t in (("turn", blocks.schema["turn"].dataType), ("role", "string"), ("text", "string"))}
    opened = edits.withColumns(nothing).withColumns({"copies": F.lit(0).cast("long"), "fresh": F.lit(False), "place": F.lit(-1).cast("long")})
    both = blocks.withColumn("edits", F.lit(None).cast("array<binary>")).unionByName(opened)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "block", "place").mapInArrow(_folder(arrow, wanted), schema)


def _repaired(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None, block: int, wanted: bool) -> DataFrame:
    bound_batches(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    slim = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    kind = slim.schema["conv_id"].dataType.simpleString()
    counted = slim.where("present").groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).where(F.col("n") > block).select("long_id")
    long = materialize(counted, "long-conversations")
    some = long.count()
    if not some:
        return _solve(slim, kind, wanted)
    ids = F.broadcast(long) if some <= BROADCAST_IDS else long
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = slim.join(ids, same, "left_anti")
    return _solve(short, kind, wanted).unionByName(_solve_long(slim.where("present").join(ids, same, "left_semi").drop("present"), kind, block, wanted))


def repair_report(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None, block: int = BLOCK) -> DataFrame:
    """Per conversation: ``conv_id``, its faults (gaps, blank, duplicate, truncated, illegal), ``cost``, ``audit`` and ``repaired_sha256``.

    A row counts by its first fault: blank, duplicate (role and text stand earlier), truncated (its last character that
    is no white space is none of ``.!?``). ``gaps`` are missing turn numbers, ``illegal`` neighbours whose initials
    are not su, ua or au. ``present``: rows for which it isn't true are no rows, but their conversation is reported.
    """
    return _repaired(rows, conv_col, turn_col, role_col, text_col, present, block, False)


def repaired_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``role``, ``text``."""
    return _repaired(rows, conv_col, turn_col, role_col, text_col, present, block, True)
