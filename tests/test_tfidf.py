"""The registered TF-IDF against its definition in plain Python."""

import math
import re
from collections import Counter, defaultdict

import duckdb

from pyspark.sql import functions as F

from rillstone.operators.semantic import common_terms, tfidf
from rillstone.plans.linkage import QUERIES

DATA = "/root/testdata/sf0.001"


def test_two_thousand_terms_of_unaltered_texts(spark):
    docs = {i: Counter(re.findall(r"\w\w+", (t or "").lower())) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()}
    total, df = Counter(), Counter()
    for words in docs.values():
        total.update(words)
        df.update(words.keys())
    terms = set(sorted(total, key=lambda w: (-total[w], w.encode()))[:2000])
    assert len(terms) > 200 and any(re.search("[à-ɏ]", w) for w in terms)
    want = defaultdict(dict)
    for i, words in docs.items():
        raw = {w: n * (math.log((1 + len(docs)) / (1 + df[w])) + 1) for w, n in words.items() if w in terms}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        want[i] = {w: x / norm for w, x in raw.items()}
    got = {(r.doc_id, r.term): r.weight for r in QUERIES["tfidf_relational"](spark, DATA).collect()}
    assert set(got) == {(i, w) for i, ws in want.items() for w in ws}
    assert all(abs(got[i, w] - x) < 2e-6 for i, ws in want.items() for w, x in ws.items())


def test_words_of_all_scripts(spark):
    texts = ["Москва город", "Αθήνα πόλη", "北京大学", "x×y ab×cd", "ñandú_1 ٣٤ a b", "हिन्दी भाषा", "東京 ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {(r.k, r.term) for r in tfidf(rows, "k", "t").collect()}
    assert got == {(i, w) for i, t in enumerate(texts) for w in re.findall(r"\w\w+", t.lower())}


def test_common_terms_by_sketch_and_by_counting_all(spark):
    """A small sketch over few common and many rare words, with ties at the end; without such words all are counted."""
    rows = [(i, [(f"w{k:03d}", 1 + (k < 40) * 3) for k in range(0, 300, 1 + i % 3)] + [(f"rare{i}", 1)]) for i in range(400)]
    counts = spark.createDataFrame(rows, "k long, c array<struct<term:string,tf:long>>").repartition(4)
    total, df = Counter(), Counter()
    for _, c in rows:
        for t, n in c:
            total[t] += n
            df[t] += 1
    for most, tracked in ((30, 200), (30, 100_000), (350, 1000), (5, 40)):
        want = [(t, total[t], df[t]) for t in sorted(total, key=lambda t: (-total[t], t))[:most]]
        got = [tuple(r) for r in common_terms(counts, most, tracked).orderBy(F.desc("total"), "term").collect()]
        assert got == want
    assert common_terms(counts.limit(0), 5).count() == 0


def test_no_task_gathers_the_words(spark):
    """Of 120,000 words, what a single task reads at the end has the size of the vocabulary; sketches of all were merged by one."""
    texts = spark.range(0, 400, 1, 4).selectExpr("id AS k", "concat('common often ', array_join(transform(sequence(1, 300), x -> concat('w', id, '_', x)), ' ')) AS t")
    adaptive, sc = spark.conf.get("spark.sql.adaptive.enabled"), spark.sparkContext

    def stages():
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {s.stageId(): s for s in map(found.apply, range(found.size()))}

    seen = set(stages())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = Counter(r.term for r in tfidf(texts, "k", "t", 30).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    alone = [s.shuffleReadBytes() for k, s in stages().items() if k not in seen and s.numTasks() == 1]
    assert len(got) == 30 and got["common"] == got["often"] == 400 and max(alone) < 50_000
