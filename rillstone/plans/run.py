"""The whole linkage run: tables or a workbook in, masters, truth, candidates and metrics out.

    python -m rillstone.plans.run --workbook in.xlsx --out folder

One lazy plan per output; persons, publications, authorships and candidates, which several outputs share, are written
to the shared folder once.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import text as tx
from rillstone.operators import enrichment as en
from rillstone.operators import linkage as ln
from rillstone.operators import metrics as mt
from rillstone.plans import reports
from rillstone.sources import files, rest, xlsx
from rillstone.storage import materialize, write_bytes
from rillstone.streaming.cache import durable_fetch

#: Sheet of each table; others can be given.
SHEETS = {"projects": "PROYECTOS", "persons": "ORCID", "repository": "Pubs_RI", "scopus": "Pubs_SCOPUS", "wos": "Pubs_WoS", "results": "PROY_RESULTADOS"}
CLOSED, SINCE = "5. Cerrado", 2010
#: Columns of the project sheet and their names.
PROJECT_COLUMNS = {
    "CÓDIGO DE PROYECTO": "codigo_actividad", "COD_AERI": "cod_aeri", "CÓDIGO CAMPUS": "codigo_campus", "Título": "title", "Estado": "status", "Tipo de Proyecto": "project_type",
    "Área de Conocimiento": "knowledge_area", "LÍNEA DE INVESTIGACIÓN HOMOLOGADA": "research_line", "UNIDAD EJECUTORA": "executing_unit", "SECCIÓN EJECUTORA": "executing_section",
    "COORDINADOR DE LA INVESTIGACIÓN": "coordinator_original", "UNIDAD DE GESTIÓN": "management_unit", "Tipo de Financiamiento": "funding_type", "Entidad Financiadora": "funder",
}
#: Columns of the results sheet and their names.
RESULT_COLUMNS = {
    "COD_AERI": "result_cod_aeri", "cod_prod": "cod_prod", "tipo": "result_type", "cat_e": "result_category", "producto_e": "result_title", "otros_e": "result_other", "año_pub": "result_year",
    "equivalencia": "equivalencia", "DOI": "doi_raw", "issn": "issn_raw", "isbn": "isbn_raw", "estado": "result_status", "evidencia": "result_evidence", "eid": "scopus_eid", "journal": "journal_raw",
    "quartil": "quartile_raw", "citation": "citation_raw", "citation_fw": "citation_fw_raw", "citation_fa": "citation_fa_raw", "cit_policy": "citation_policy_raw", "conv": "call_name",
    "idperson": "result_idperson", "coordinador": "result_coordinator",
}


def _pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns by name, missing ones as null text; ``row_index`` is kept."""
    have = {c.strip().lower(): c for c in df.columns}
    return df.select("row_index", *((F.col(f"`{have[a.lower()]}`") if a.lower() in have else F.lit(None).cast("string")).alias(b) for a, b in columns.items()))


def _year(c: str) -> F.Column:
    return F.col(c).try_cast("double").cast("int")


def enrichment_requests(truth: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Distinct requests ``key, url`` of publication-like results, the first ``limit`` rows in ``order`` if asked for."""
    rows = truth.where(F.col("result_type").isin(ln.PUBLICATION_TYPES))
    rows = rows.orderBy(*order).limit(limit) if limit is not None else rows
    title = F.coalesce(*(F.nullif(tx.hint(c), F.lit("")) for c in ("result_title", "result_other", "project_title")), F.lit(""))
    keyed = rows.select(tx.cache_key(tx.hint("doi_norm"), title).alias("key"), tx.work_query(tx.hint("doi_norm"), title).alias("url"))
    return keyed.where("key <> ''").groupBy("key").agg(F.min("url").alias("url"))


def build(tables: dict[str, DataFrame], blank_keys: str = "exclude", limit: int | None = None, fetch: Callable[[DataFrame], DataFrame] | None = None, abstracts: DataFrame | None = None) -> dict[str, DataFrame]:
    """All outputs by name from the six inputs, each with ``row_index``. ``fetch`` turns key, url into key, payload, error."""
    sheet = _pick(tables["projects"], PROJECT_COLUMNS | {"Año": "year_raw"}).withColumn("year", _year("year_raw")).drop("year_raw")
    projects = ln.closed_projects(sheet, "year", "status", CLOSED, SINCE, "row_index").withColumn("title_norm", tx.normalize_text("title")).withColumn("coordinator_norm", tx.normalize_text("coordinator_original")).drop("row_index")

    seed = _pick(tables["persons"], {"Nombres": "name_original", "Código ORCID": "orcid", "dni": "dni"}).withColumnRenamed("row_index", "seq")
    repository = _pick(tables["repository"], {"idperson": "idperson", "nombre": "name_original", "doc": "dni", "doi": "doi", "titulo": "title", "año": "year", "medio_div": "journal", "key_words": "keywords"}).withColumnRenamed("row_index", "seq")
    persons = materialize(ln.persons_master(seed, repository), "persons")
    orcids = seed.select(tx.normalize_text("name_original").alias("name_norm"), tx.blank_to_null("orcid", ("", "nan", "-", "none")).alias("orcid"), "seq").where("orcid is not null")
    with_orcid = lambda df, name: ln.lookup_last(df, name, orcids, "name_norm", "orcid", "seq", F.lit("")).withColumnRenamed("orcid", "coordinator_orcid")

    scopus = _pick(tables["scopus"], {"DOI": "doi", "Title": "title", "Year": "year", "Scopus Source title": "journal", "Abstract": "abstract", "Topic name": "keywords", "Authors": "authors", "Scopus Author Ids": "ids"}).withColumnRenamed("row_index", "seq")
    wos = _pick(tables["wos"], {"doi": "doi", "title": "title", "pub_year": "year", "source": "journal", "abstract": "abstract", "keywords": "k1", "keywords_plus": "k2"}).withColumnRenamed("row_index", "seq").withColumn("keywords", tx.join_keywords("k1", "k2"))
    streams = {"SCOPUS": scopus, "WOS": wos, "RI": repository}
    records = ln.source_records({s: d.withColumn("year", _year("year")) for s, d in streams.items()})
    publications = materialize(ln.consolidate(records), "publications")
    written = scopus.select("seq", "authors", "ids", F.lit("SCOPUS").alias("source")).unionByName(repository.select("seq", F.regexp_replace("name_original", "[|]", " ").alias("authors"), F.col("idperson").alias("ids"), F.lit("RI").alias("source")))
    authored = ln.authorships(records.join(written, ["source", "seq"]), "authors", "ids")
    authored = materialize(ln.lookup_last(ln.attach_publications(authored, publications), "author_name_norm", persons.select(F.col("name_norm").alias("person"), "investigator_id"), "person", "investigator_id", "investigator_id"), "authorships")

    results = _pick(tables["results"], RESULT_COLUMNS).withColumn("doi_norm", tx.normalize_doi("doi_raw")).drop("row_index")
    base = projects.select("project_id", "cod_aeri", "codigo_campus", F.col("year").alias("project_year"), F.col("title").alias("project_title"), "coordinator_original", "coordinator_norm")
    truth = with_orcid(ln.results_truth(base, results, publications, "cod_aeri", "result_cod_aeri", blank_keys), "coordinator_norm").drop("coordinator_norm", "result_cod_aeri")
    if fetch is not None:
        answers = fetch(enrichment_requests(truth, ["project_id", "cod_prod"], limit))
        works = answers.withColumn("w", en.parse_work("payload")).select("key", F.col("error").alias("__error"), *en.extract_work(F.col("w")))
        title = F.coalesce(*(F.nullif(tx.hint(c), F.lit("")) for c in ("result_title", "result_other", "project_title")), F.lit(""))
        truth = truth.withColumn("key", tx.cache_key(tx.hint("doi_norm"), title)).join(works, "key", "left").drop("key")
        truth = truth.withColumn("work_enrichment_error", F.coalesce(F.nullif(F.col("__error"), F.lit("")), F.col("work_enrichment_error"))).drop("__error")
    if abstracts is not None:
        names = {a: a for a in ("resumen", "fuente_resumen", "palabras_clave", "fuente_palabras_clave", "titulo", "fuente_titulo", "scopus_id", "eid", "pubmed_id")}
        truth = en.merge_abstracts(truth, abstracts, "doi_norm", files.resolve_column(abstracts, "doi") or "doi", names, "row_index")
    like = truth.where(F.col("result_type").isin(ln.PUBLICATION_TYPES)).withColumn("result_is_publication_like", F.lit(True))

    sides = publications.select("publication_id", F.col("year").alias("publication_year"), F.col("title").alias("publication_title"), F.col("title_norm").alias("publication_title_norm"), tx.tokens("title_norm").alias("publication_tokens"), "doi", F.col("found_in_RI").alias("ri"), F.col("found_in_SCOPUS").alias("scopus"), F.col("found_in_WOS").alias("wos"))
    order = F.struct((F.col("source") != "SCOPUS").alias("s"), "seq", "author_order")
    authors = authored.select("publication_id", "author_name_norm", "author_name_raw", order.alias("auth_seq")).join(sides, "publication_id")
    coordinated = projects.select("project_id", "codigo_campus", F.col("year").alias("project_year"), F.col("title").alias("project_title"), "coordinator_original", "coordinator_norm", F.col("title_norm").alias("project_title_norm"), tx.tokens("title_norm").alias("project_tokens"))
    candidates = materialize(with_orcid(ln.candidate_links(coordinated, authors), "coordinator_norm").drop("project_title_norm", "publication_title_norm", "project_tokens", "publication_tokens"), "candidates")
    pairs = like.where("publication_id is not null").select("project_id", "publication_id").distinct()
    return {
        "projects": projects, "investigators": persons, "investigator_aliases": ln.person_aliases(persons), "publications": publications,
        "publication_sources": ln.attach_publications(records.drop("rank"), publications), "authorships": authored, "project_results_ground_truth": truth,
        "project_publication_ground_truth": like, "project_publication_candidates": candidates, "link_quality": mt.link_quality(candidates, pairs),
        "result_types": mt.value_counts(like, "result_type"), "links_per_project": mt.group_size_stats(pairs, "project_id"), "score_stats": mt.score_stats(candidates),
        "coverage": mt.coverage(projects, candidates), "overlap": mt.overlap(candidates, pairs),
    }


def write(outputs: dict[str, DataFrame], folder: str, tables: dict[str, DataFrame], workbook: bool = False) -> dict:
    """Parquet tables below ``folder``, which may lie on any of Spark's file systems, and reports read from them.

    ``summary.json`` (merged into an earlier one), ``truth_metrics.json`` and ``.md``, ``efficacy.md``; ``workbook`` adds
    the publications among the declared results as a styled workbook. Returns the summary.
    """
    spark = next(iter(outputs.values())).sparkSession
    for name, df in outputs.items():
        files.write_table(df, f"{folder}/{name}", replace=True)
    written = {name: files.read_table(spark, f"{folder}/{name}") for name in outputs}
    metrics = reports.truth_metrics(written)
    write_bytes(spark, f"{folder}/truth_metrics.json", json.dumps(metrics, ensure_ascii=False, indent=2).encode())
    write_bytes(spark, f"{folder}/truth_metrics.md", reports.truth_markdown(metrics).encode())
    write_bytes(spark, f"{folder}/efficacy.md", files.markdown_report("Efficacy of the links", reports.efficacy(written)).encode())
    if workbook:
        like = written["project_publication_ground_truth"]
        kinds = spark.createDataFrame([(c,) for c in like.columns], "c string").select("c", tx.column_class("c").alias("k")).collect()
        xlsx.write_styled(like, f"{folder}/project_publication_ground_truth.xlsx", {r.c: r.k for r in kinds})
    return files.update_summary(f"{folder}/summary.json", reports.summary(tables, written, metrics), spark)


def sheet_of(names: list[str], wanted: str) -> str:
    """The sheet of that name, else the only one that begins with it."""
    found = [n for n in names if n == wanted] or [n for n in names if n.startswith(wanted)]
    if len(found) != 1:
        raise ValueError(f"{len(found)} sheets for {wanted!r} among {', '.join(names)}; name it with --sheet")
    return found[0]


def main(argv: list[str] | None = None) -> None:
    """Command line: a workbook's sheets to a folder of outputs."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--workbook", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--blank-keys", choices=["exclude", "match"], default="exclude")
    parser.add_argument("--abstracts", help="a CSV of abstracts by DOI")
    parser.add_argument("--enrich", action="store_true", help="look the declared publications up at the service, paced by the environment")
    parser.add_argument("--cache", help="folder of the answers, which a run that was interrupted goes on with; enrichment below the output unless given")
    parser.add_argument("--env", default=".env", help="a file of NAME=value lines for the environment, if it exists")
    parser.add_argument("--limit", type=int, help="look up the first rows only, by project and product")
    parser.add_argument("--xlsx", action="store_true", help="also write the declared publications as a styled workbook")
    parser.add_argument("--sheet", action="append", default=[], metavar="TABLE=NAME", help=f"sheet of a table, or how its name begins; tables: {', '.join(SHEETS)}")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    spark.dataSource.register(xlsx.XlsxSource)
    names, sheets = xlsx.sheet_names(args.workbook), SHEETS | dict(s.split("=", 1) for s in args.sheet)
    tables = {t: spark.read.format("xlsx").option("sheet", sheet_of(names, s)).load(args.workbook) for t, s in sheets.items()}
    found = files.read_csv_text(spark, args.abstracts).withColumn("row_index", F.monotonically_increasing_id()) if args.abstracts else None
    files.load_env(args.env)
    look_up = durable_fetch(args.cache or f"{args.out}/enrichment", pacing=rest.Pacing.from_env()) if args.enrich else None
    write(build(tables, args.blank_keys, limit=args.limit, fetch=look_up, abstracts=found), args.out, tables, args.xlsx)


if __name__ == "__main__":
    main()
