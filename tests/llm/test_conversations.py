"""Repaired conversations against an exhaustive search, whole and in blocks."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rillstone.llm.conversations import repair_report, repaired_rows
from rillstone.llm.queries import damaged

SMALL = "/root/testdata/sf0.001"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = (("u", "user"), ("a", "assistant"))


def cheapest(rows):
    """(report, repaired lines) of ordered (turn, role, text), trying all edits place by place."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    def better(to, state, cost, audit, lines):
        if state is not None and (state not in to or (cost, audit) < to[state][:2]):
            to[state] = (cost, audit, lines)

    def with_inserted(ways):
        for _ in range(4):
            for state, (cost, audit, lines) in list(ways.items()):
                for letter, name in NAMES:
                    better(ways, STEP.get((state, letter)), cost + 2, audit + "I", (*lines, (name, "")))
        return ways

    ways = {0: (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit, lines) in with_inserted(ways).items():
            better(new, state, cost + 3, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                better(new, STEP.get((state, role[:1])), more, audit + "K", (*lines, (role, text)))
                for letter, name in NAMES:
                    better(new, STEP.get((state, letter)), more + 2, audit + "R", (*lines, (name, text)))
        ways = new
    cost, audit, lines = min((w for s, w in with_inserted(ways).items() if s in (0, 3)), key=lambda w: w[:2])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), lines


def solved(data):
    found = {}
    for conv, turn, role, text, present in data:
        found.setdefault(conv, [])
        if present:
            found[conv].append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: cheapest(sorted(rows, key=order)) for c, rows in found.items()}


@pytest.fixture(scope="module")
def odd():
    rng, data = random.Random(5), []
    for conv in [None, *range(200)]:
        for _ in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            data.append((conv, rng.choice([None, 0, 1, 2, 3, 4, 9]), role, rng.choice(["a.", "b!", "c", "  ", "", None, "é?\n", "z", "a."]), rng.random() < 0.85))
    data += [(500, 1, "user", "same.", True)] * 40 + [(501, t, "user", "same.", True) for t in range(40)] + [(502, None, None, None, False)] * 3
    return data


@pytest.mark.parametrize("block", [2048, 3, 1])
def test_odd_conversations(spark, odd, block):
    df = spark.createDataFrame([(*r, "x") for r in odd], "conv_id long, turn long, role string, text string, present boolean, cost string")
    want = solved(odd)
    got = {r.conv_id: tuple(r)[1:] for r in repair_report(df, present=F.col("present"), block=block).collect()}
    assert got == {c: w[0] for c, w in want.items()}
    lines = {}
    for r in repaired_rows(df, present=F.col("present"), block=block).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    assert lines == {c: [(i, *x) for i, x in enumerate(w[1])] for c, w in want.items() if w[1]}


def test_damaged_conversations(spark):
    rows = damaged(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    want = solved([tuple(r) for r in rows.collect()])
    got = {r.conv_id: tuple(r)[1:] for r in repair_report(rows, present=F.col("present")).collect()}
    assert got == {c: w[0] for c, w in want.items()} and len(got) == 20


def test_one_hot_conversation(spark):
    """Equal rows are counted before they meet, and a conversation longer than a block is cut into several."""
    df = spark.range(20_000).selectExpr("7 AS conv_id", "id div 2 AS turn", "CASE WHEN id % 4 < 2 THEN 'user' ELSE 'assistant' END AS role", "concat('t', id div 2, '.') AS text")
    got = repair_report(df, block=512).first()
    assert (got.gaps, got.duplicate, got.cost, len(got.audit)) == (0, 10_000, 30_000, 20_000)
    assert repaired_rows(df, block=512).count() == 10_000


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair_report(df).count() == 0 and repair_report(df).schema["conv_id"].dataType.simpleString() == "string"
