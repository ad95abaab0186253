"""What a linkage run tells about itself: the summary, the truth's metrics and the efficacy report.

All figures are counted by Spark; only rows whose number the run bounds (kinds, levels, single rows) reach the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions import text as tx
from rillstone.operators import enrichment as en
from rillstone.operators import metrics as mt
from rillstone.sources import files
from rillstone.storage import write_bytes

#: Columns of the truth whose values are counted among linked rows.
DISTRIBUTIONS = ("result_type", "result_category", "match_method", "call_name")


def _one(df: DataFrame, **aggregates) -> dict:
    return df.agg(*(a.alias(n) for n, a in aggregates.items())).first().asDict()


def _pct(n: int, d: int) -> float:
    """Percent with two decimals, halves up, as ``half_up_percent``."""
    return (20_000 * n + d) // (2 * d) / 100 if d else 0.0


def truth_metrics(out: dict[str, DataFrame]) -> dict:
    """Overview of the truth, distributions of its linked rows, and precision and recall by level."""
    truth = out["project_results_ground_truth"]
    linked = truth.where("publication_id is not null")
    facts = _one(
        truth,
        rows=F.count("*"), projects=F.countDistinct("project_id"), linked=F.count("publication_id"),
        linked_projects=F.countDistinct(F.when(F.col("publication_id").isNotNull(), F.col("project_id"))),
    )
    sizes = mt.group_size_stats(linked, "project_id").first()
    levels = {r.level: r for r in out["link_quality"].collect()}

    def level(name: str) -> dict:
        r = levels[name]
        return {"candidate_pairs": r.candidates, "matched_pairs": r.matched, "precision_pct": r.precision_pct, "recall_pct": r.recall_pct}

    def distribution(column: str) -> list[dict]:
        if column not in linked.columns:
            return []
        rows = mt.value_counts(linked, column).orderBy(F.desc("n"), "value").collect()  # kinds of results and calls
        return [{"value": r.value, "count": r.n, "pct": r.pct} for r in rows]

    return {
        "ground_truth_overview": {
            "rows_total": facts["rows"], "projects_total": facts["projects"], "rows_linked_publication": facts["linked"], "rows_linked_publication_pct": _pct(facts["linked"], facts["rows"]),
            "projects_with_linked_publication": facts["linked_projects"], "projects_with_linked_publication_pct": _pct(facts["linked_projects"], facts["projects"]),
            "unique_project_publication_pairs": levels["overall"].truth,
            "linked_publications_per_project": {"mean": round(sizes.mean_size, 2), "median": round(sizes.median_size, 2), "max": sizes.max_size},
        },
        "distribution": {c: distribution(c) for c in DISTRIBUTIONS},
        "efficacy": {"overall": level("overall"), "by_confidence": {"high": level("high"), "medium": level("medium")}, "high_plus_medium": level("high_medium")},
    }


def summary(tables: dict[str, DataFrame], out: dict[str, DataFrame], metrics: dict) -> dict:
    """The run's counts under their fixed names."""
    truth, like = out["project_results_ground_truth"], out["project_publication_ground_truth"]
    told = lambda df: _one(df, rows=F.count("*"), projects=F.countDistinct("project_id"), doi=F.count_if(F.col("doi_norm") != ""), matched=F.count("publication_id"))
    every, some = told(truth), told(like)
    level = {r.value: r.n for r in mt.value_counts(out["project_publication_candidates"].withColumn("level", tx.map_level("confidence")), "level").collect()}
    overview, efficacy = metrics["ground_truth_overview"], metrics["efficacy"]
    top = metrics["distribution"]["result_type"][:1]
    merged = [c for c in ("resumen", "fuente_resumen", "palabras_clave") if c in truth.columns]
    return {
        "projects_total": tables["projects"].count(), "projects_closed_since_2010": out["projects"].count(), "investigators_master": out["investigators"].count(),
        "publication_source_records": out["publication_sources"].count(), "publications_master": out["publications"].count(), "authorship_rows": out["authorships"].count(),
        "ground_truth_rows": every["rows"], "ground_truth_projects": every["projects"], "ground_truth_rows_with_doi": every["doi"], "ground_truth_rows_matched_by_doi": every["matched"],
        "ground_truth_publication_rows": some["rows"], "ground_truth_publication_projects": some["projects"], "ground_truth_publication_rows_matched_by_doi": some["matched"],
        "candidate_links_v1": sum(level.values()), **{f"candidate_links_{k}_confidence": level.get(k, 0) for k in ("high", "medium", "low")},
        "ground_truth_publication_pairs": overview["unique_project_publication_pairs"], "candidate_pairs_confirmed_by_ground_truth": efficacy["overall"]["matched_pairs"],
        "candidate_precision_vs_ground_truth_pct": efficacy["overall"]["precision_pct"], "ground_truth_recall_by_candidates_pct": efficacy["overall"]["recall_pct"],
        "ground_truth_linked_rows": overview["rows_linked_publication"], "ground_truth_linked_rows_pct": overview["rows_linked_publication_pct"],
        "ground_truth_linked_projects": overview["projects_with_linked_publication"], "ground_truth_linked_projects_pct": overview["projects_with_linked_publication_pct"],
        "ground_truth_linked_top_result_type": top[0]["value"] if top else None,
        **{f"efficacy_{k}_{m}_pct": efficacy["by_confidence"][k][f"{m}_pct"] for k in ("high", "medium") for m in ("precision", "recall")},
        **({"abstracts_matched": en.abstracts_matched(truth, merged).first().matched} if merged else {}),
    }


def efficacy(out: dict[str, DataFrame]) -> list[tuple[str, DataFrame]]:
    """Sections of the efficacy report; none has more rows than kinds, levels or the five commonest reasons."""
    links = out["project_publication_candidates"]
    label = mt.source_label(F.col("ri"), F.col("scopus"), F.col("wos"))
    top = mt.top_values(links, "evidence", 5).select(tx.snippet("value", 65).alias("evidence"), "n", "pct")
    return [
        ("Project coverage", out["coverage"]), ("Confidence", mt.value_counts(links, "confidence").orderBy("value")), ("Scores", out["score_stats"]),
        ("Commonest evidence", top), ("Sources", mt.value_counts(links.withColumn("sources", label), "sources").orderBy(F.desc("n"), "value")),
        ("Years after the project", mt.delta_buckets(links).orderBy("year_delta")), ("Shares of links", mt.source_shares(links)),
        ("Against declared links", out["overlap"]), ("Precision and recall", out["link_quality"]),
    ]


def truth_markdown(metrics: dict) -> str:
    """The truth's metrics as a page."""
    o, e = metrics["ground_truth_overview"], metrics["efficacy"]
    per = o["linked_publications_per_project"]
    rates = {"Overall": e["overall"], "High confidence": e["by_confidence"]["high"], "Medium confidence": e["by_confidence"]["medium"], "High and medium": e["high_plus_medium"]}
    return "\n".join([
        "# Declared results", "", f"- Rows: {o['rows_total']}", f"- Projects: {o['projects_total']}",
        f"- Rows with a publication: {o['rows_linked_publication']} ({o['rows_linked_publication_pct']} %)",
        f"- Projects with a publication: {o['projects_with_linked_publication']} ({o['projects_with_linked_publication_pct']} %)",
        f"- Distinct pairs: {o['unique_project_publication_pairs']}", f"- Publications of a project, mean, median, most: {per['mean']}, {per['median']}, {per['max']}",
        "", "## The ten commonest kinds", "", *(f"- {r['value']}: {r['count']} ({r['pct']} %)" for r in metrics["distribution"]["result_type"][:10]),
        "", "## Precision and recall", "", *(f"- {n}: {r['precision_pct']} %, {r['recall_pct']} %" for n, r in rates.items()), "",
    ])


def write_analysis(labelled: DataFrame, info: dict, folder: str) -> None:
    """The result of ``semantic.analyze``: rows as CSV below ``folder``, and what was done in ``metadata.json`` beside them."""
    files.write_csv(labelled, f"{folder}/projects")
    told = {"embedding_method": info["method"], "pca_explained_variance_ratio": info["explained_variance"], "n_clusters": info["clusters"], "project_count": labelled.count()}
    write_bytes(labelled.sparkSession, f"{folder}/metadata.json", json.dumps(told, ensure_ascii=False, indent=2).encode())
