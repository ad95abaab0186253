"""Components against brute force over all pairs."""

import random
import re

import pytest

from rillstone.llm import near_dup as nd
from rillstone.llm.components import connected_components


def shingle_set(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size, percent=80):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[b] = a
    return {(rows[i][0], len(sets[i]), rows[find(i)][0], find(i) == i) for i in range(len(rows))}


def corpus(seed, n=220):
    pick = random.Random(seed)
    terms = [f"w{i}" for i in range(300)]
    base = [pick.choices(terms, k=pick.randint(3, 120)) for _ in range(25)]
    passage = pick.choices(terms, k=60)
    out = []
    for _ in range(n):
        w = list(pick.choice(base))
        kind = pick.random()
        if kind < 0.5:  # a chain of ever more changes: links pass through others
            for _ in range(pick.randint(0, max(1, len(w) // 9))):
                w[pick.randrange(len(w))] = pick.choice(terms)
        elif kind < 0.75:  # much in common, not enough for a link
            w = passage + pick.choices(terms, k=pick.randint(5, 60))
        out.append(pick.choice([" ", "\n", "\t "]).join(w).replace("w1", "W1") if kind < 0.9 else " ".join(w))
    return [*out, None, "", " \n ", "one", "ONE", "two words", "é", "É"]


@pytest.mark.parametrize(("seed", "size", "bucket"), [(1, 2, 8), (2, 2, 1)])
def test_components_equal_brute_force(spark, monkeypatch, seed, size, bucket):
    monkeypatch.setattr(nd, "SMALL_BUCKET", bucket)
    texts = corpus(seed)
    ids = random.Random(seed).sample(range(1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, signature string").repartition(6)
    got = nd.near_duplicates(docs, shingle_words=size).collect()
    assert {tuple(r) for r in got} == brute(rows, size) and len(got) == len(rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (None, "a b c"), (7, "A\tB c"), (8, None), (9, "x " * 30_000)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs, shingle_words=2).collect())
    assert got == [(0, 2, None, False), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 0, 8, True), (9, 1, 9, True)]
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_stops_keep_what_the_miss_probability_asks_for():
    stops = nd.least_matches(0.8)
    for n, least in stops:
        assert nd.posterior(least, n, 0.8) >= nd.MISS > nd.posterior(least - 1, n, 0.8)


def test_components_of_chains_stars_and_odd_links(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (9, 8), (8, 9), (8, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {k: 500 for k in range(500, 560)} | {8: 8, 9: 8}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def passage_corpus(n):
    """``n`` texts that share a passage but no link, the last ten of which are near copies of the first ten."""
    pick = random.Random(n)
    passage = [f"p{i}" for i in range(80)]
    own = [[f"o{pick.randrange(10**9)}" for _ in range(25)] for _ in range(n - 10)]
    own += [[*words[:-1], "changed"] for words in own[:10]]
    return [" ".join(passage + words) for words in own]


def test_documents_of_one_passage_make_few_pairs(spark):
    made = {}
    for n in (1000, 5000):
        docs = spark.createDataFrame(list(enumerate(passage_corpus(n))), "doc_id long, text string").repartition(8)
        finder = nd._Finder(docs, "doc_id", "text", 2, 80)
        made[n] = finder.rare_pairs(finder.signed.select("doc_id", finder.signed["doc_id"].alias("part"))).distinct().count()
    assert made == {1000: 10, 5000: 10}  # no pair that shares the passage alone
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, shingle_words=2).collect()}
    assert got == {i: i - 4990 if i >= 4990 else i for i in range(5000)}


@pytest.mark.parametrize("percent", [50, 80])
def test_rare_pairs_lose_no_link(spark, percent):
    rows = list(enumerate(corpus(percent, 160)))
    finder = nd._Finder(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 2, percent)
    found = {tuple(r) for r in finder.rare_pairs(finder.signed.select("doc_id", finder.signed["doc_id"].alias("part"))).collect()}
    sets = {i: shingle_set(t, 2) for i, t in rows}
    standing = {r.doc_id for r in finder.signed.collect()}
    linked = {(i, j) for i in standing for j in standing if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    assert len(linked) > 20 and linked <= found


def final_plans(spark, since):
    """The plans, as adaptive execution left them, of the executions after the first ``since``."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(since, found.size())]


def test_joins_of_one_large_group_are_split(spark):
    """A group of near copies that holds nearly all rows: its buckets' and its hub's joins are dealt over tasks."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6",
    }
    before = {k: spark.conf.get(k) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        words = " ".join(f"w{i}" for i in range(200))
        rows = [(i, f"{words} x{i}") for i in range(1200)] + [(i, f"{i} alone y{i}") for i in range(1200, 1300)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        seen = spark._jsparkSession.sharedState().statusStore().executionsCount()
        found = {r.doc_id: r.component_id for r in nd.near_duplicates(docs, shingle_words=2).collect()}
        assert found == {i: 0 if i < 1200 else i for i, _ in rows}
        split = [p for p in final_plans(spark, seen) if "skew=true" in p]
        assert any("bucket" in p for p in split), "joins on buckets"
        star = spark.range(1, 20_000).selectExpr("id AS b", "CASE WHEN id < 19990 THEN 0 ELSE id - 1 END AS a")
        seen = spark._jsparkSession.sharedState().statusStore().executionsCount()
        assert connected_components(star).select("component").distinct().count() == 1
        assert sum("skew=true" in p for p in final_plans(spark, seen)) >= 2, "joins of stars"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
