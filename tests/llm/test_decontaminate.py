"""The word search against a brute-force one."""

import random
import re

import pytest

from rillstone.llm.decontaminate import hit_words, with_hits, without_contaminated
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window=10):
    out = []
    for t in texts:
        w, hit, found = split(t), set(), set()
        for item, text in items:
            p = split(text)
            n = min(window, len(p))
            for k in range(len(p) - n + 1 if n else 0):
                for a in range(len(w) - n + 1):
                    if w[a : a + n] == p[k : k + n]:
                        hit.update(range(a, a + n))
                        if item is not None:
                            found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return out


def made(seed):
    pick = random.Random(seed)
    terms = ["the", "of", "a1", "été", "日本", "x", "straße", "İz", "b"]
    items = [(i % 17, " ".join(pick.choices(terms, k=pick.choice([1, 2, 3, 9, 10, 11, 25])))) for i in range(14)]
    items += [(90, None), (91, ""), (92, "...!"), (None, "only null id here in ten words or so a b c")]
    texts = [None, "", "?!", "The  OF\na1-été " * 30]
    for _ in range(80):
        parts = [" ".join(pick.choices(terms, k=pick.randint(0, 30)))]
        for _, t in pick.sample(items, 2):
            p = split(t)
            a = pick.randint(0, max(0, len(p) - 10))
            parts.append(pick.choice([" ", "\n", "--", "\t ¿"]).join(p[a : a + pick.randint(8, 14)]).title())
        pick.shuffle(parts)
        texts.append(" ".join(parts))
    return items, texts


@pytest.mark.parametrize(("seed", "pass_bytes"), [(1, 1 << 20), (2, 1 << 20), (3, 150)])
def test_same_as_brute_force(spark, seed, pass_bytes):
    items, texts = made(seed)
    items = [i for i in items if not (seed == 2 and len(split(i[1])) < 9)]
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*i, "x") for i in items + items[:3]], "item_id long, text string, doc_id string")
    got = with_hits(docs, bench, pass_bytes=pass_bytes).withColumn("n", hit_words(F.col("hits"))).orderBy("doc_id").collect()
    assert [(r.hits.n_words, r.n, sorted(r.hits.items)) for r in got] == brute(texts, items)
    clean = {r.doc_id for r in without_contaminated(docs, bench).collect()}
    assert clean == {k for k, b in enumerate(brute(texts, items)) if not b[1]}


def test_long_text_ties_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w " * 60_000 + "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10"), (1, "Q1,q2,q3,q4,q5,q6,q7,q8,q9,q10!")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10"), ("j", "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10")], "item_id string, text string")
    rows = with_hits(docs, bench).collect()
    assert sorted(r.hits.n_words for r in rows) == [10, 60_010] and all(sorted(r.hits.items) == ["i", "j"] and r.hits.spans[0].last - r.hits.spans[0].first == 9 for r in rows)
    assert with_hits(docs.limit(0), bench).count() == 0
    assert all(not r.hits.spans for r in with_hits(docs, bench.limit(0)).collect())
