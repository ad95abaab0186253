"""Candidate links and what is counted from them, against the score's definition in plain Python."""

import random
from collections import Counter
from difflib import SequenceMatcher
from statistics import mean, median, stdev

import duckdb
import pytest

from rillstone.functions.similarity import half_ratio_above
from rillstone.functions.text import STOPWORDS
from rillstone.operators import linkage as ln
from rillstone.plans import run
from rillstone.plans.linkage import QUERIES
from rillstone.plans.linkage_sql import _DECLARED, _PAIRS
from tests.test_run import tables

DATA = "/root/testdata/sf0.001"


def words(title):
    return {w for w in title.split() if len(w) > 2 and w not in STOPWORDS}


def similarity(a, b):
    """The larger of half the sequence ratio and the word overlap."""
    one, two = words(a), words(b)
    overlap = len(one & two) / len(one | two) if one and two else 0.0
    return round(max(0.5 * SequenceMatcher(None, a, b).ratio() if a and b else 0.0, overlap), 4)


def scored(delta, ri, scopus, wos, sim):
    years = 0 if delta is None else 20 if delta == 0 else 18 if delta <= 2 else 12
    reasons = ["responsable_autor", *([] if delta is None else ["publicado_mismo_anio" if delta == 0 else "publicado_1_2_anios_despues" if delta <= 2 else "publicado_3_5_anios_despues"])]
    reasons += [n for f, n in ((ri, "fuente_RI"), (scopus, "fuente_SCOPUS"), (wos, "fuente_WOS")) if f]
    reasons += [f"similitud_tematica_{sim:.2f}"] if sim >= 0.2 else []
    score = round(50 + years + 15 * ri + 10 * scopus + 10 * wos + round(25 * sim, 2), 2)
    return score, "Alta" if score >= 85 else "Media" if score >= 65 else "Baja", " | ".join(reasons)


@pytest.fixture(scope="module")
def wanted():
    """(project, publication) -> similarity, score, confidence, evidence; and the declared pairs."""
    con = duckdb.connect()
    for t in "customer part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    pairs = con.sql(f"WITH {_PAIRS} SELECT project_id, publication_id, ta, tb, year_delta, ri, scopus, wos FROM j").fetchall()
    found = {(p, q): ((sim := similarity(a, b)), *scored(delta, ri, scopus, wos, sim)) for p, q, a, b, delta, ri, scopus, wos in pairs}
    return found, set(con.sql(f"WITH {_DECLARED} SELECT * FROM declared").fetchall())


def test_candidates(spark, wanted):
    got = {(r.project_id, r.publication_id): (r.title_similarity, r.score, r.confidence, r.evidence) for r in QUERIES["candidates"](spark, DATA).collect()}
    assert got == wanted[0]


def test_counts_of_candidates(spark, wanted):
    found, declared = wanted
    levels = {"overall": ("Alta", "Media", "Baja"), "high": ("Alta",), "medium": ("Media",), "high_medium": ("Alta", "Media")}
    chosen = {k: {p for p, v in found.items() if v[2] in c} for k, c in levels.items()}
    assert {r.level: (r.candidates, r.truth, r.matched) for r in QUERIES["link_quality"](spark, DATA).collect()} == {k: (len(s), len(declared), len(s & declared)) for k, s in chosen.items()}
    assert {r.value: r.n for r in QUERIES["confidence_counts"](spark, DATA).collect()} == Counter(v[2] for v in found.values())
    evidence = sorted(Counter(v[3] for v in found.values()).items(), key=lambda x: (-x[1], x[0]))[:5]
    assert sorted((r.pattern, r.n) for r in QUERIES["evidence_topk"](spark, DATA).collect()) == sorted((e[:65], n) for e, n in evidence)
    r, sims, scores = QUERIES["score_stats"](spark, DATA).first(), [v[0] for v in found.values()], [v[1] for v in found.values()]
    assert (r.mean_score, r.median_score, r.min_score, r.max_score, r.std_score) == pytest.approx((mean(scores), median(scores), min(scores), max(scores), stdev(scores)), abs=1e-5)
    assert (r.mean_similarity, r.median_similarity, r.over_30, r.over_50) == pytest.approx((mean(sims), median(sims), sum(s > 0.3 for s in sims), sum(s > 0.5 for s in sims)), abs=1e-5)


def test_titles_without_common_words(spark):
    projects = spark.createDataFrame([(1, 2010, "ANA", "RIVER ECOLOGIES", ["RIVER", "ECOLOGIES"])], "project_id int, project_year int, coordinator_norm string, project_title_norm string, project_tokens array<string>")
    authored = spark.createDataFrame([("ANA", "Ana", 1, 10, 2010, "RIVERS ECOLOGY", ["RIVERS", "ECOLOGY"], False, False, False)], "author_name_norm string, author_name_raw string, auth_seq int, publication_id int, publication_year int, publication_title_norm string, publication_tokens array<string>, ri boolean, scopus boolean, wos boolean")
    sim = similarity("RIVER ECOLOGIES", "RIVERS ECOLOGY")
    r = ln.candidate_links(projects, authored).first()
    assert sim > 0.4 and (r.title_similarity, r.score) == (sim, scored(0, 0, 0, 0, sim)[0])
    with pytest.raises(ValueError):
        ln.candidate_links(projects.drop("project_title_norm"), authored)


def test_the_whole_run_compares_titles(spark):
    links = run.build(tables(spark))["project_publication_candidates"]
    assert {"project_title", "publication_title"} <= set(links.columns) and not {"project_title_norm", "publication_title_norm"} & set(links.columns)
    undated = links.where("publication_title = 'Undated'").first()
    assert undated.title_similarity == similarity(undated.project_title.upper(), "UNDATED") > 0


def test_half_ratios_equal_difflib():
    """The ratio from rows of bits, for texts with many ties and beyond the length where characters get popular; a bound ends it."""
    pick = random.Random(5)
    text = lambda: "".join(pick.choices("abé "[: pick.randint(1, 4)], k=pick.choice((0, 1, 7, 8, 30, 70, 199, 200, 240))))
    for _ in range(400):
        a, b = text(), text()
        want = 0.5 * SequenceMatcher(None, a, b).ratio() if a and b else 0.0
        assert half_ratio_above(a, b, 0.0) == want
        least = pick.random() / 2
        assert half_ratio_above(a, b, least) == max(want, least)
