"""The whole run on small sheets."""

import json

import pytest
from pyspark.sql import functions as F

from rillstone.plans import run
from rillstone.sources import xlsx

SHEETS = {
    "projects": [
        {"Año": "2015.0", "Estado": " 5. Cerrado ", "COD_AERI": "A1", "Título": "Open data rivers", "COORDINADOR DE LA INVESTIGACIÓN": "Pérez, Ana", "CÓDIGO CAMPUS": "c1"},
        {"Año": "2009", "Estado": "5. Cerrado", "COD_AERI": "A2", "Título": "Old", "COORDINADOR DE LA INVESTIGACIÓN": "Pérez, Ana"},
        {"Año": "2016", "Estado": "5. Cerrado", "COD_AERI": "-", "Título": "No code", "COORDINADOR DE LA INVESTIGACIÓN": None},
        {"Año": None, "Estado": "5. Cerrado", "COD_AERI": "A3", "Título": "No year", "COORDINADOR DE LA INVESTIGACIÓN": "X"},
    ],
    "persons": [{"Nombres": "PEREZ ANA", "Código ORCID": "0000-1", "dni": "1"}, {"Nombres": "Perez Ana", "Código ORCID": "-", "dni": "2"}],
    "repository": [{"idperson": "9", "nombre": "Luis Gómez", "doc": "3", "doi": "https://doi.org/10.1/A", "titulo": "Rivers open data", "año": "2016", "medio_div": "J", "key_words": None}, {"idperson": "9", "nombre": "Luis Gómez", "doc": "3", "doi": "-", "titulo": "Other", "año": "2018"}],
    "scopus": [{"DOI": "10.1/a", "Title": "Open data rivers", "Year": "2016", "Authors": "Pérez Ana|Gómez Luis", "Scopus Author Ids": "-|77"}, {"DOI": "", "Title": "Undated", "Year": None, "Authors": "Perez  Ana", "Scopus Author Ids": ""}],
    "wos": [{"doi": "10.1/A.", "title": "", "pub_year": "2015", "keywords": None, "keywords_plus": "flow"}],
    "results": [{"COD_AERI": "A1", "DOI": "HTTPS://doi.org/10.1/a", "cod_prod": "p1", "tipo": "Artículo indizado", "producto_e": "T"}, {"COD_AERI": "-", "DOI": "10.1/a", "cod_prod": "p2", "tipo": "Artículo indizado"}, {"COD_AERI": "A1", "DOI": "-", "cod_prod": "p3", "tipo": "Otro"}],
}


def tables(spark):
    out = {}
    for name, rows in SHEETS.items():
        columns = sorted({c for r in rows for c in r})
        out[name] = spark.createDataFrame([(k, *(r.get(c) for c in columns)) for k, r in enumerate(rows)], "row_index long, " + ", ".join(f"`{c}` string" for c in columns))
    return out


def test_run(spark, tmp_path):
    payload = json.dumps({"id": "W1", "doi": "10.1/a"})
    asked = []

    def fetch(requests):
        asked.extend(r.key for r in requests.collect())
        return requests.select("key", F.lit(payload).alias("payload"), F.lit("").alias("error"))

    abstracts = spark.createDataFrame([(0, "doi:10.1/A", "text")], "row_index long, doi string, resumen string")
    out = run.build(tables(spark), fetch=fetch, abstracts=abstracts)
    assert [(r.project_id, r.cod_aeri) for r in out["projects"].orderBy("project_id").collect()] == [(1, "A1"), (2, "-")]
    people = [(r.investigator_id, r.name_norm, r.source_seed) for r in out["investigators"].orderBy("investigator_id").collect()]
    assert people == [(1, "PEREZ ANA", "ORCID"), (2, "PEREZ ANA", "ORCID"), (3, "LUIS GOMEZ", "RI")]
    master = {r.master_key: r for r in out["publications"].collect()}
    one = master["doi:10.1/a"]
    assert (one.title, one.year, one.keywords, one.source_count, one.RI, one.SCOPUS, one.WOS) == ("Open data rivers", 2015, "flow", 3, 1, 1, 1)
    assert sorted(r.publication_id for r in master.values()) == list(range(1, len(master) + 1))
    authors = {(r.source, r.author_order, r.author_name_norm, r.external_author_id, r.investigator_id) for r in out["authorships"].collect()}
    assert ("SCOPUS", 1, "PEREZ ANA", "", 2) in authors and ("SCOPUS", 2, "GOMEZ LUIS", "77", None) in authors and ("RI", 1, "LUIS GOMEZ", "9", 3) in authors
    truth = {r.cod_prod: r for r in out["project_results_ground_truth"].collect()}
    assert set(truth) == {"p1", "p3"} and truth["p1"].publication_id == one.publication_id and truth["p1"].work_work_id == "W1" and truth["p1"].resumen == "text" and truth["p3"].resumen == ""
    assert truth["p1"].coordinator_orcid == "0000-1" and asked == ["doi:10.1/a"]
    links = {(r.project_id, r.publication_title): r for r in out["project_publication_candidates"].collect()}
    assert set(links) == {(1, "Open data rivers"), (1, "Undated")}
    assert links[1, "Open data rivers"].score == 130.0 and links[1, "Undated"].year_delta is None and links[1, "Undated"].coordinator_orcid == "0000-1"
    quality = {r.level: (r.candidates, r.truth, r.matched) for r in out["link_quality"].collect()}
    assert quality == {"overall": (2, 1, 1), "high": (1, 1, 1), "medium": (1, 1, 0), "high_medium": (2, 1, 1)}
    folder = str(tmp_path / "out")
    told = run.write(out, folder, tables(spark), workbook=True)
    assert told == json.loads((tmp_path / "out" / "summary.json").read_text())
    want = {"projects_total": 4, "projects_closed_since_2010": 2, "investigators_master": 3, "publication_source_records": 5, "publications_master": len(master), "authorship_rows": 5}
    want |= {"ground_truth_rows": 2, "ground_truth_projects": 1, "ground_truth_rows_with_doi": 1, "ground_truth_rows_matched_by_doi": 1, "ground_truth_publication_rows": 1, "candidate_links_v1": 2}
    want |= {"candidate_links_high_confidence": 1, "candidate_links_medium_confidence": 1, "candidate_links_low_confidence": 0, "ground_truth_linked_rows_pct": 50.0, "abstracts_matched": 1}
    want |= {"candidate_precision_vs_ground_truth_pct": 50.0, "ground_truth_recall_by_candidates_pct": 100.0, "ground_truth_linked_top_result_type": "Artículo indizado", "efficacy_high_precision_pct": 100.0}
    assert {k: told[k] for k in want} == want
    metrics = json.loads((tmp_path / "out" / "truth_metrics.json").read_text())
    assert metrics["ground_truth_overview"]["linked_publications_per_project"] == {"mean": 1.0, "median": 1.0, "max": 1}
    assert metrics["distribution"]["match_method"] == [{"value": "doi", "count": 1, "pct": 100.0}] and metrics["efficacy"]["high_plus_medium"]["matched_pairs"] == 1
    assert "- Rows: 2" in (tmp_path / "out" / "truth_metrics.md").read_text() and "## Sources" in (tmp_path / "out" / "efficacy.md").read_text()
    assert "Leyenda" in xlsx.sheet_names(folder + "/project_publication_ground_truth.xlsx")


def test_sheets_by_name_or_beginning():
    assert run.sheet_of(["ORCID", "ORCID old"], "ORCID") == "ORCID" and run.sheet_of(["A", "ORCID list"], "ORCID") == "ORCID list"
    with pytest.raises(ValueError, match="2 sheets"):
        run.sheet_of(["ORCID a", "ORCID b"], "ORCID")
