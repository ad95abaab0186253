"""Linkage, enrichment and text profiles on small tables with odd rows."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.operators import enrichment as en
from rillstone.operators import linkage as ln
from rillstone.operators import metrics as mt
from rillstone.operators import semantic as sm
from rillstone.operators.numbering import keep_first, number_rows


def test_numbers_are_dense_in_order(spark):
    df = spark.range(1000).repartition(7).withColumn("k", F.expr("1000 - id"))
    got = {r.id: r.n for r in number_rows(df, "n", "k").collect()}
    assert got == {i: 1000 - i for i in range(1000)}
    assert number_rows(df.limit(0), "n", "k").count() == 0


def test_first_and_last_values_follow_the_given_order(spark):
    df = spark.createDataFrame([("a", 2, "-"), ("a", 1, " "), ("a", 3, " x "), ("a", 4, "y"), ("b", 1, None)], "k string, seq int, v string")
    from rillstone.operators.numbering import first_nonblank, last_value

    assert {r.k: r.v for r in df.groupBy("k").agg(first_nonblank("v", "seq").alias("v")).collect()} == {"a": " x ", "b": ""}
    assert {r.k: r.v for r in last_value(df, ["k"], "v", "seq").collect()} == {"a": "y", "b": None}
    assert keep_first(df, ["k"], "seq").count() == 2


def test_truth_and_blank_keys(spark):
    projects = spark.createDataFrame([(1, "A"), (2, "-"), (3, None), (4, "A ")], "project_id int, cod string")
    results = spark.createDataFrame([("A", "10.1/a"), ("-", "10.1/b"), (None, ""), ("Z", "10.1/a")], "rcod string, doi_norm string")
    pubs = spark.createDataFrame([(9, "10.1/a"), (8, "10.1/a"), (7, "")], "publication_id int, doi string")
    strict = {(r.project_id, r.doi_norm, r.publication_id, r.match_method) for r in ln.results_truth(projects, results, pubs, "cod", "rcod").collect()}
    assert strict == {(1, "10.1/a", 8, "doi"), (4, "10.1/a", 8, "doi")}
    loose = ln.results_truth(projects, results, pubs, "cod", "rcod", "match")
    assert {(r.project_id, r.publication_id) for r in loose.collect()} == {(1, 8), (4, 8), (2, None), (3, None)}
    with pytest.raises(ValueError):
        ln.join_key("cod", "maybe")


def test_candidates_keep_missing_years_and_the_first_author_row(spark):
    projects = spark.createDataFrame([(1, 2010, "ANA", ["DATA"]), (2, 2010, "", ["DATA"]), (3, None, "ANA", [])], "project_id int, project_year int, coordinator_norm string, project_tokens array<string>")
    authored = spark.createDataFrame(
        [("ANA", "Ana 2", 2, 10, 2012, ["DATA"], True, False, False), ("ANA", "Ana 1", 1, 10, 2012, ["DATA"], True, False, False), ("ANA", "Ana", 3, 11, 2016, [], False, False, False), ("ANA", "Ana", 4, 12, None, [], False, False, False), ("ANA", "Ana", 5, None, 2011, [], False, False, False)],
        "author_name_norm string, author_name_raw string, auth_seq int, publication_id int, publication_year int, publication_tokens array<string>, ri boolean, scopus boolean, wos boolean",
    )
    got = {(r.project_id, r.publication_id): (r.matched_author, r.year_delta, r.score) for r in ln.candidate_links(projects, authored).collect()}
    assert got[1, 10] == ("Ana 1", 2, 108.0) and got[1, 12] == ("Ana", None, 50.0) and (1, 11) not in got and (3, 11) in got and {p for p, _ in got} == {1, 3}
    none = ln.candidate_links(projects.limit(0), authored)
    assert none.count() == 0 and "score" in none.columns
    assert mt.link_quality(none, none).where("precision_pct = 0 and recall_pct = 0").count() == 4


def test_containment_leaves_out_blanks(spark):
    probes = spark.createDataFrame([("10.1/ab",), ("",), ("zz",)], "p string")
    masters = spark.createDataFrame([("10.1/abc", 2), ("", 1), ("10.1", 3)], "m string, seq int")
    assert [(r.p, r.m) for r in ln.containment(probes, masters, "p", "m", "seq").collect()] == [("10.1/ab", "10.1/abc")]
    assert ln.containment(probes.limit(0), masters, "p", "m", "seq").count() == 0


def test_containment_by_comparing_all(spark, monkeypatch):
    pick = random.Random(2)
    texts = ["".join(pick.choices("abé ", k=pick.randint(0, 14))) for _ in range(120)]
    probes, masters = texts[:60] + texts[:3], texts[30:]
    want = {}
    for p in probes:
        hits = [(i, m) for i, m in enumerate(masters) if p and m and (p in m or m in p)]
        if hits:
            want[p] = min(hits)
    a = spark.createDataFrame([(p,) for p in [*probes, None]], "p string")
    b = spark.createDataFrame([(m, i) for i, m in enumerate(masters)], "m string, seq int").repartition(3)
    for size in (16 << 20, 100):
        monkeypatch.setattr(ln, "PASS_BYTES", size)
        assert {r.p: (r.seq, r.m) for r in ln.containment(a, b, "p", "m", "seq").collect()} == want
    assert [r.p for r in ln.containment(a, b, "p", "m", "seq", most=4).orderBy("p").collect()] == [p for p in sorted(set(probes) - {""}, key=str.encode)[:4] if p in want]


def test_candidates_of_a_common_name_meet_within_the_years(spark):
    """What the join hands on grows with the answer, not with all pairs of the name."""
    years = [None, *range(1990, 2020)]
    projects = spark.createDataFrame([(i, years[i % 31], "ANA", ["open"]) for i in range(310)], "project_id int, project_year int, coordinator_norm string, project_tokens array<string>")
    authored = spark.createDataFrame([("ANA", "Ana", i, i, years[i % 31], ["open"], True, False, False) for i in range(310)], "author_name_norm string, author_name_raw string, auth_seq int, publication_id int, publication_year int, publication_tokens array<string>, ri boolean, scopus boolean, wos boolean")
    want = {(p, q) for p in range(310) for q in range(310) if years[p % 31] is None or years[q % 31] is None or 0 <= years[q % 31] - years[p % 31] <= ln.sim.WEIGHTS.horizon}
    pairs = [(r.project_id, r.publication_id) for r in ln.candidate_links(projects, authored).collect()]
    assert len(pairs) == len(want) and set(pairs) == want


WORK = {"id": "W123", "doi": "10.1000/test", "publication_year": 2022, "cited_by_count": 11, "primary_location": {"is_oa": True, "landing_page_url": "http://x", "source": {"display_name": "Nature"}, "license": "cc"}, "authorships": [{"author": {"display_name": "Jane Doe"}}]}


def test_work_extraction(spark):
    payloads = [json.dumps(WORK), json.dumps({"results": [WORK]}), json.dumps({"results": []}), "[]", "", None, "{broken"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string").withColumn("w", en.parse_work("p"))
    got = {r.i: r for r in df.select("i", *en.extract_work(F.col("w"))).collect()}
    for i in (0, 1):
        r = got[i]
        assert (r.work_work_id, r.work_is_oa, r.work_oa_status, r.work_oa_url, r.work_publication_year, r.work_cited_by_count, r.work_authors, r.work_institution_names, r.work_institution_country_codes, r.work_enrichment_error) == ("W123", True, "green", "http://x", 2022, 11, "Jane Doe", "", "", "")
    assert got[2].work_enrichment_error == "not_found" and got[2].work_oa_status == "closed"
    assert {got[i].work_enrichment_error for i in (3, 4, 5)} == {"empty response"} and got[3].work_oa_status == "unknown"
    assert got[6].work_work_id == ""


def test_cache(spark):
    changes = spark.createDataFrame([("a", 1, "HTTP Error 429"), ("a", 2, ""), ("b", 3, "timed out"), ("c", 4, "HTTP Error 404"), ("", 5, ""), (None, 6, "")], "key string, seq int, error string")
    kept = en.compact_cache(en.cacheable(changes, "error"), "key", "seq", ["seq"])
    assert {(r.key, r.seq) for r in kept.collect()} == {("a", 2), ("c", 4)}
    assert {r.key for r in en.pending(changes, kept, "key").collect()} == {"b"}
    fresh = spark.createDataFrame([("a", 20, ""), ("c", 40, "")], "key string, seq int, error string")
    assert {(r.key, r.seq) for r in en.overlay(changes.where("key in ('a', 'b', 'c')"), fresh, "key", ["seq", "error"], "error").collect()} == {("a", 20), ("a", 2), ("b", 3), ("c", 4)}


def test_abstracts(spark):
    main = spark.createDataFrame([(1, "10.1/a", "t"), (2, "10.2/b", "u")], "project_id int, doi_norm string, result_title string")
    found = spark.createDataFrame([(1, "https://doi.org/10.1/A", " ", None), (2, "doi: 10.1/a", "text", "Scopus")], "seq int, doi string, resumen string, fuente string")
    names = {"resumen": "resumen", "fuente": "fuente_resumen", "missing": "missing"}
    once = en.merge_abstracts(main, found, "doi_norm", "doi", names, "seq")
    twice = en.merge_abstracts(once, found, "doi_norm", "doi", names, "seq")
    want = [(1, "text", "Scopus"), (2, "", "")]
    assert sorted((r.project_id, r.resumen, r.fuente_resumen) for r in once.collect()) == want == sorted((r.project_id, r.resumen, r.fuente_resumen) for r in twice.collect())


def test_profiles(spark):
    pick = np.random.default_rng(0)
    x = pick.normal(size=(200, 6)) * [9, 4, 2, 0.1, 0.1, 0.1] + 5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    placed, shares = sm.with_pca(df, "v", 3)
    centred = x - x.mean(0)
    want = np.linalg.svd(centred, compute_uv=False) ** 2
    assert np.allclose(shares, (want / want.sum())[:3])
    got = np.array([[r.pca_1, r.pca_2, r.pca_3] for r in placed.orderBy("id").collect()])
    assert np.allclose(got.mean(0), 0, atol=1e-6) and np.allclose((got**2).sum(0), want[:3])
    assert sm.with_clusters(placed, ["pca_1", "pca_2"], 4).select("cluster_label").distinct().count() == 4
    texts = spark.createDataFrame([(i, f"river flow model {'alpha' if i % 2 else 'beta'} w{i % 5}") for i in range(40)], "id int, t string")
    labelled, about = sm.analyze(texts, "id", "t", components=2, clusters=2)
    assert labelled.count() == 40 and about["clusters"] == 2 and {"pca_1", "pca_2", "cluster_label"} <= set(labelled.columns)
    with pytest.raises(ValueError):
        sm.analyze(texts, "id", "t", method="other")
    with pytest.raises(ValueError):
        sm.analyze(texts.withColumn("t", F.lit(" ")), "id", "t")


def test_ids_are_not_copied_to_every_author(spark):
    """Arrays of a record don't stay beside its exploded authors, where they would be copied once an author."""
    records = spark.createDataFrame([("k", "RI", 1, " Ana |Eva|  |Zoë", "1|-||4|5"), ("l", "RI", 2, "A |B", "1"), ("m", "RI", 3, "", "9")], "master_key string, source string, seq int, authors string, ids string")
    rows = ln.authorships(records, "authors", "ids")
    got = [tuple(r) for r in rows.orderBy("seq", "author_order").collect()]
    assert got == [("k", "RI", 1, 1, "Ana", "ANA", "1"), ("k", "RI", 1, 2, "Eva", "EVA", ""), ("k", "RI", 1, 3, "Zoë", "ZOE", "4"), ("l", "RI", 2, 1, "A", "A", "1"), ("l", "RI", 2, 2, "B", "B", "")]
    assert not re.search(r"\w#\d+\[p#\d+\]", rows._jdf.queryExecution().optimizedPlan().toString())  # no array is looked into by the author's place


def test_numbers_of_texts_that_begin_alike(spark):
    from rillstone.operators.numbering import HEAD, number_texts

    texts = ["a" * HEAD + x for x in ("", "b", "ab", "ñ", "a")] + ["a" * n for n in (0, 1, HEAD - 1)] + ["é" * HEAD, "é" * (HEAD + 1), "z"]
    df = spark.createDataFrame([(t,) for t in texts * 3], "t string").repartition(5)
    for some in (texts, texts[-1:]):
        rows = number_texts(df.where(F.col("t").isin(some)), "t", "n").join(df.select("t", F.unhex(F.sha2("t", 256)).alias("digest")).distinct(), "digest").collect()
        assert [r.t for r in sorted(rows, key=lambda r: r.n)] == sorted(some, key=str.encode) and sorted(r.n for r in rows) == list(range(1, len(some) + 1))


def test_publications_shuffle_texts_once(spark):
    """Unknown sources count, keys that begin alike keep their order, and numbering writes no whole text."""
    rows = [(i, t, a) for i, (t, a) in enumerate([("x " * 200 + "b", "-"), ("x " * 200 + "a", "one"), ("x " * 200 + "b", "two"), ("", None)])]
    one = spark.createDataFrame(rows, "seq long, title string, abstract string")
    got = ln.consolidate(ln.source_records({"SCOPUS": one, "NEW": one, "RI": one.where("seq = 1")}))
    want = [("titleyear:" + "X " * 200 + "A|", "one", 3, 1, 1), ("titleyear:" + "X " * 200 + "B|", "two", 2, 0, 2), ("titleyear:|", "", 2, 0, 1)]
    assert [tuple(r) for r in got.orderBy("publication_id").select("master_key", "abstract", "source_count", "RI", "SCOPUS").collect()] == want
    leaves = got._jdf.queryExecution().optimizedPlan().collectLeaves()
    written = [leaves.apply(k).output().mkString(",") for k in range(leaves.size()) if leaves.apply(k).getClass().getSimpleName() == "LogicalRelation"]
    assert written and not any("abstract" in columns for columns in written)
