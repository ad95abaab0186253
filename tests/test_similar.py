"""Similar names against all pairs."""

import random
from difflib import SequenceMatcher

import pytest

from rillstone.operators import similar as sl
from rillstone.plans.linkage import QUERIES


def all_pairs(names, least):
    kept = sorted({n for n in names if n})
    return {(a, b): r for a in kept for b in kept if a != b and (r := SequenceMatcher(None, a, b).ratio()) >= least}


def found(df, least):
    rows = sl.similar_names(df, "name", least).collect()
    assert len({(r.a, r.b) for r in rows}) == len(rows)
    return {(r.a, r.b): r.ratio for r in rows}


def edited(pick, base, letters):
    out = list(base)
    for _ in range(pick.randint(0, 4)):
        at = pick.randint(0, len(out))
        out[at : at + pick.randint(0, 2)] = pick.choices(letters, k=pick.randint(0, 2))
    return "".join(out)


@pytest.mark.parametrize("least", [0.3, 0.6, 0.75, 0.8, 0.9, 0.95, 1.0])
def test_same_as_all_pairs(spark, least):
    pick = random.Random(int(least * 100))
    bases = ["".join(pick.choices("abcdefghij ", k=pick.randint(1, 30))) for _ in range(12)] + ["customer#0000001", "é", "ab", "\u0000a", "x" * 230]
    names = [edited(pick, b, "abcxyz") for b in bases for _ in range(9)] + bases + bases + ["", None, "aaaa", "aaab", "baaa"]
    df = spark.createDataFrame([(n, 1) for n in names], "name string, len int").repartition(3)
    assert found(df, least) == all_pairs(names, least)


def test_nothing_and_bounds(spark):
    none = spark.createDataFrame([], "name string")
    assert found(none, 0.8) == {} and found(spark.createDataFrame([(None,), ("",), ("a",)], "name string"), 0.5) == {}
    for wrong in (0, 1.1):
        with pytest.raises(ValueError, match="ratio"):
            sl.similar_names(none, "name", wrong)
    assert [sl.gram_length(t) for t in (0.3, 0.7, 0.8, 0.9, 1.0)] == [1, 1, 2, 4, 4]


def test_query_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    names = [f"{r.p_name} {r.p_type}" for r in spark.read.parquet(f"{folder}/part.parquet").collect()]
    assert {(r.a, r.b): r.ratio for r in QUERIES["similar_names"](spark, folder).collect()} == all_pairs(names, 0.9)
