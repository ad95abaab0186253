"""Registered queries of the linkage engine over the synthetic tables.

Projects are closed orders (status F), publications open ones (status O), persons customers, titles the part names of
an order's lines, sources their return flags.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import text as tx
from rillstone.functions.similarity import sequence_ratio
from rillstone.operators import enrichment as en
from rillstone.operators import linkage as ln
from rillstone.operators import metrics as mt
from rillstone.operators import semantic as sm
from rillstone.operators import similar as sl
from rillstone.operators.numbering import first_n, number_rows
from rillstone.storage import new_folder
from rillstone.streaming import cache

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@_query
def text_normalize(spark, d):
    return _t(spark, d, "documents").select("doc_id", tx.normalize_text("text").alias("text_norm"))


def _identifiers(spark, d):
    p = F.col("page_id")
    raw = F.when(p % 5 == 0, F.concat(F.lit("https://doi.org/10.1/AB"), p)).when(p % 5 == 1, F.concat(F.lit(" HTTP://dx.doi.org/10.2/x"), p, F.lit(". "))).when(p % 5 == 2, F.concat(F.lit("DOI: 10.3/Y"), p, F.lit(" ;,"))).when(p % 5 == 3, "-").otherwise(F.concat(F.lit("https://doi.org/https://doi.org/10.4/"), p))
    return _t(spark, d, "pages").select("page_id", raw.alias("raw"))


@_query
def identifier_normalize(spark, d):
    return _identifiers(spark, d).select("page_id", tx.normalize_doi("raw").alias("doi_norm"))


@_query
def identifier_normalize_wide(spark, d):
    return _identifiers(spark, d).select("page_id", tx.normalize_doi("raw", wide=True).alias("doi_norm"))


@_query
def work_queries(spark, d):
    docs = _t(spark, d, "documents")
    doi = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("10.1/AB"), F.col("doc_id"))).otherwise("-")
    return docs.select("doc_id", tx.cache_key(doi, F.col("text")).alias("key"), tx.work_query(doi, F.col("text")).alias("url"))


@_query
def name_aliases(spark, d):
    people = _t(spark, d, "customer").select("c_custkey", F.concat_ws(", ", "c_mktsegment", "c_name").alias("name"))
    return ln.person_aliases(people, "name", "c_custkey").select("c_custkey", "alias_norm").distinct()


def _with_authors(records):
    words = F.split("title", " ")  # the whole texts
    ids = F.transform(words, lambda w, i: F.when(i % 3 == 0, "-").otherwise(F.concat(F.lit("id"), i)))
    return records.withColumns({"authors": F.array_join(words, "|"), "ids": F.array_join(ids, "|")})


@_query
def split_authors(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.array_join(F.split("text", " "), "|").alias("authors"))
    return docs.select("doc_id", F.posexplode(tx.split_list("authors")).alias("p", "author")).select("doc_id", (F.col("p") + 1).alias("author_order"), "author")


@_query
def closed_projects(spark, d):
    orders = _t(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    return ln.closed_projects(orders, "year", "o_orderstatus", "F", 1996, "o_orderkey").select("project_id", "o_orderkey", "o_custkey", "year")


@_query
def persons_master(spark, d):
    one = _t(spark, d, "customer").select(F.col("c_name").alias("name_original"), F.col("c_custkey").alias("seq"))
    two = _t(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))).otherwise(F.col("s_name")).alias("name_original"), F.col("s_suppkey").alias("seq"))
    return ln.persons_master(one, two)


@_query
def person_lookup_last_wins(spark, d):
    part = _t(spark, d, "part")
    names = part.select(F.col("p_name").alias("wanted")).distinct()
    return ln.lookup_last(names, "wanted", part, "p_name", "p_brand", "p_partkey", F.lit("")).select("wanted", "p_brand")


def _records(spark, d):
    k = F.col("doc_id")
    base = _t(spark, d, "documents").select(
        k.alias("seq"), F.when(k % 5 == 0, F.concat(F.lit("https://doi.org/10.1/"), k % 40)).otherwise("-").alias("doi"), F.col("text").alias("title"), F.when(k % 11 != 0, 2000 + k % 20).cast("int").alias("year"),
        F.when(k % 7 == 0, "-").otherwise(F.col("source")).alias("journal"), F.when(k % 6 == 0, "").otherwise(F.col("text")).alias("abstract"), F.when(k % 4 != 0, F.col("lang")).alias("keywords"),
    )
    return ln.source_records({s: base.where(F.col("seq") % 3 == i) for i, s in enumerate(("SCOPUS", "WOS", "RI"))})


@_query
def publication_master(spark, d):
    return ln.consolidate(_records(spark, d)).select("publication_id", "master_key", "doi", "title", "year", "journal", "abstract", "keywords", "source_count", "RI", "SCOPUS", "WOS", "found_in_RI", "found_in_SCOPUS", "found_in_WOS")


@_query
def source_pivot_flags(spark, d):
    rows = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(*(F.count_if(F.col("l_returnflag") == f).alias(s) for f, s in (("R", "RI"), ("A", "SCOPUS"), ("N", "WOS"))))
    return rows.withColumns({f"found_in_{s}": F.col(s) > 0 for s in ("RI", "SCOPUS", "WOS")})


@_query
def authorships_attach(spark, d):
    records = _records(spark, d)
    attached = _with_authors(ln.attach_publications(records, ln.publication_ids(records)))
    return ln.authorships(attached, "authors", "ids", "publication_id").select("publication_id", "source", F.col("seq").alias("doc_id"), "author_order", "author_name_norm", "external_author_id")


def _truth(spark, d, policy, every):
    code = lambda c: F.when(F.col(c) % every != 0, F.col(c).cast("string"))
    projects = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("project_id"), code("o_orderkey").alias("cod"))
    kind = F.when(F.col("l_returnflag") == "R", "Artículo indizado").otherwise("Otro")
    results = _t(spark, d, "lineitem").select(code("l_orderkey").alias("rcod"), F.col("l_partkey").alias("cod_prod"), "l_linenumber", kind.alias("result_type"), F.concat(F.lit("10.1/p"), F.col("l_partkey") % 1500).alias("doi_norm"))
    pubs = _t(spark, d, "part").where("p_partkey % 3 > 0").select(F.concat(F.lit("10.1/p"), F.col("p_partkey") % 1500).alias("doi"), F.col("p_partkey").alias("publication_id"))
    both = ln.results_truth(projects, results, pubs, "cod", "rcod", policy).where(F.col("result_type").isin(ln.PUBLICATION_TYPES))
    return both.select("project_id", "cod_prod", "l_linenumber", "doi_norm", "publication_id", "match_method").orderBy(F.asc_nulls_last("project_id"), F.asc_nulls_last("cod_prod"))


@_query
def results_truth(spark, d):
    return _truth(spark, d, "exclude", 7)


@_query
def results_truth_blank_match(spark, d):
    return _truth(spark, d, "match", 3001)


def _titled(spark, d):
    part = _t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag").join(part, "l_partkey")
    titles = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.array_sort(F.collect_set("p_name")), " ").alias("title"), *(F.max(F.col("l_returnflag") == f).alias(s) for f, s in (("R", "ri"), ("A", "scopus"), ("N", "wos"))))
    orders = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year")).join(titles, "o_orderkey", "left")
    people = _t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    named = orders.join(people, "o_custkey").withColumn("name_norm", tx.normalize_text("c_name")).withColumn("title_norm", tx.normalize_text("title"))
    return named.withColumns({"tokens": tx.tokens("title_norm"), **{s: F.coalesce(s, F.lit(False)) for s in ("ri", "scopus", "wos")}})


def _candidates(spark, d):
    named = _titled(spark, d)
    projects = named.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("project_id"), F.col("year").alias("project_year"), F.col("name_norm").alias("coordinator_norm"), F.col("tokens").alias("project_tokens"), F.col("title_norm").alias("project_title_norm"))
    year = F.when(F.col("o_orderkey") % 50 != 0, F.col("year"))
    authored = named.where("o_orderstatus = 'O'").select(
        F.col("name_norm").alias("author_name_norm"), F.col("c_name").alias("author_name_raw"), F.col("o_orderkey").alias("auth_seq"), F.col("o_orderkey").alias("publication_id"), year.alias("publication_year"), F.col("tokens").alias("publication_tokens"), F.col("title_norm").alias("publication_title_norm"), "ri", "scopus", "wos",
    )
    return ln.candidate_links(projects, authored)


@_query
def candidates(spark, d):
    return _candidates(spark, d).select("project_id", "publication_id", "project_year", "publication_year", "matched_author", "year_delta", "title_similarity", "score", "confidence", "evidence").orderBy(F.desc("score"), "project_id", "publication_id")


def _declared(spark, d):
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    orders = _t(spark, d, "orders").where("o_orderstatus in ('F', 'O')").select("o_orderkey", "o_custkey", "o_orderstatus")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    closed = both.where("o_orderstatus = 'F'").select("o_custkey", "l_partkey", F.col("o_orderkey").alias("project_id"))
    opened = both.where("o_orderstatus = 'O'").select("o_custkey", "l_partkey", F.col("o_orderkey").alias("publication_id"))
    return closed.join(opened, ["o_custkey", "l_partkey"]).select("project_id", "publication_id").distinct()


@_query
def link_quality(spark, d):
    return mt.link_quality(_candidates(spark, d), _declared(spark, d))


@_query
def value_counts(spark, d):
    return mt.value_counts(_t(spark, d, "orders"), "o_orderpriority")


@_query
def top_values(spark, d):
    return mt.top_values(_t(spark, d, "part"), "p_type", 10)


@_query
def links_per_project(spark, d):
    return mt.group_size_stats(_candidates(spark, d), "project_id")


@_query
def score_stats(spark, d):
    return mt.score_stats(_candidates(spark, d))


@_query
def confidence_counts(spark, d):
    return mt.value_counts(_candidates(spark, d), "confidence").orderBy("value")


@_query
def evidence_topk(spark, d):
    top = mt.top_values(_candidates(spark, d), "evidence", 5)
    return top.select(tx.snippet("value", 65).alias("pattern"), "n", "pct")


@_query
def source_combos(spark, d):
    label = mt.source_label(F.col("ri"), F.col("scopus"), F.col("wos"))
    return mt.value_counts(_candidates(spark, d).withColumn("label", label), "label")


@_query
def delta_buckets(spark, d):
    return mt.delta_buckets(_candidates(spark, d))


@_query
def source_shares(spark, d):
    return mt.source_shares(_candidates(spark, d))


@_query
def coverage(spark, d):
    projects = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("project_id"))
    return mt.coverage(projects, _candidates(spark, d))


@_query
def overlap_v1_v2(spark, d):
    return mt.overlap(_candidates(spark, d), _declared(spark, d))


@_query
def direct_links(spark, d):
    results = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 3000).cast("string").alias("code"), F.concat(F.lit("p"), F.col("l_partkey") % 700).alias("doi"))
    projects = _t(spark, d, "orders").where("o_orderstatus = 'F'").select((F.col("o_orderkey") % 3000).cast("string").alias("code"), F.col("o_orderkey").alias("project_id"))
    pubs = _t(spark, d, "part").where("p_partkey % 4 > 0").select(F.concat(F.lit("p"), F.col("p_partkey") % 700).alias("doi"), F.col("p_partkey").alias("publication_id"))
    return ln.direct_links(results, projects, pubs)


def _keys(spark, d):
    lines = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("doi"), "l_orderkey", "l_quantity")
    return lines, _t(spark, d, "part").where("p_size < 20").select(F.col("p_partkey").alias("doi"))


@_query
def dois_matched(spark, d):
    lines, known = _keys(spark, d)
    return lines.join(known, "doi", "left_semi")


@_query
def dois_unmatched(spark, d):
    lines, known = _keys(spark, d)
    return lines.join(known, "doi", "left_anti")


@_query
def funnel(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return mt.funnel(_t(spark, d, "events"), [("all rows", F.lit(True)), ("with code", F.col("user_id") % 10 != 0), ("maps", F.col("event_type") != "click"), ("with key", k > 20), ("matched", F.col("value") > 10.0)])


@_query
def identifier_coverage(spark, d):
    e = _t(spark, d, "events")
    a, b = F.get_json_object("props", "$.k").cast("int") > 50, F.col("value") > 20.0
    return e.agg(F.count("*").alias("n"), F.count_if(a).alias("with_a"), F.count_if(b).alias("with_b"), F.count_if(a & b).alias("with_both"))


@_query
def partial_containment(spark, d):
    probes = _t(spark, d, "benchmark").select(F.col("text").alias("probe"))
    masters = _t(spark, d, "documents").select(F.col("text").alias("master"), F.col("doc_id").alias("seq"))
    return ln.containment(probes, masters, "probe", "master", "seq").select("probe", F.col("seq").alias("doc_id"))


@_query
def abstracts_merge(spark, d):
    doi = lambda c: F.concat(F.lit("https://doi.org/10.1/X"), c)
    main = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("doi: 10.1/x"), F.col("doc_id")).alias("doi_norm"), F.lit("old").alias("abs_quality"))
    labels = _t(spark, d, "labels").select(F.col("doc_id").alias("seq"), doi(F.col("doc_id") % 300).alias("doi"), F.when(F.col("doc_id") % 2 == 0, F.col("quality").cast("string")).otherwise(" ").alias("quality"), F.col("toxic").cast("string").alias("toxic"))
    merged = en.merge_abstracts(main, labels, "doi_norm", "doi", {"quality": "abs_quality", "toxic": "abs_toxic", "absent": "abs_absent"}, "seq")
    return merged.select("doc_id", "abs_quality", "abs_toxic")


def _payloads(spark, d):
    """A work's JSON for each conversation: turns are authorships."""
    turn = F.struct("turn", F.struct(F.struct(F.concat(F.col("role"), F.lit(" "), F.col("turn")).alias("display_name")).alias("author"), F.array(F.struct(F.col("role").alias("display_name"), F.when(F.col("turn") % 2 == 0, "es").otherwise("pe").alias("country_code"))).alias("institutions")).alias("a"))
    grouped = _t(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["a"]).alias("authorships"))
    c = F.col("conv_id")
    place = lambda s: F.struct((c % 3 == 0).alias("is_oa"), F.concat(F.lit(s), c).alias("landing_page_url"), F.struct(F.concat(F.lit("J"), c % 7).alias("display_name")).alias("source"))
    work = F.struct(F.concat(F.lit("W"), c).alias("id"), F.concat(F.lit("10.1/"), c).alias("doi"), (2000 + c % 20).alias("publication_year"), (c % 13).alias("cited_by_count"), F.when(c % 4 == 0, F.struct((c % 2 == 0).alias("is_oa"), F.lit("gold").alias("oa_status"))).alias("open_access"), place("http://p/").alias("primary_location"), F.when(c % 5 == 0, place("http://b/")).alias("best_oa_location"), "authorships")
    text = F.to_json(work)
    return grouped.select("conv_id", F.when(c % 6 == 1, F.concat(F.lit('{"results":['), text, F.lit("]}"))).when(c % 6 == 2, '{"results":[]}').when(c % 6 == 3, "[]").otherwise(text).alias("payload"))


@_query
def work_extract(spark, d):
    work = en.parse_work("payload")
    return _payloads(spark, d).withColumn("w", work).select("conv_id", *en.extract_work(F.col("w")))


@_query
def json_extract(spark, d):
    p = F.from_json("props", "k int")
    return _t(spark, d, "events").select("event_id", p["k"].alias("k"), F.coalesce(p["k"].cast("string"), F.lit("")).alias("k_text"))


def _changed(events):
    key = F.concat_ws(":", F.col("user_id").cast("string"), "event_type")
    error = F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "HTTP Error 429: Too Many Requests").otherwise("HTTP Error 404")).otherwise("")
    return events.select(key.alias("key"), F.col("event_id").alias("seq"), "value", error.alias("error"))


def _changes(spark, d):
    return _changed(_t(spark, d, "events"))


@_query
def cache_compact(spark, d):
    return en.compact_cache(en.cacheable(_changes(spark, d), "error"), "key", "seq", ["value", "seq"])


@_query
def cache_stream(spark, d):
    """``cache_compact`` by a stream over the events, the last record of each key being its state."""
    folder = new_folder(spark, "cache-stream")
    events = spark.readStream.schema(_t(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    query = cache.latest_stream(_changed(events), f"{folder}/answers", f"{folder}/checkpoint", "key", "seq", ["value", "seq"], "error")
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    rows = spark.read.schema("key string, value double, seq long, batch long").parquet(f"{folder}/answers")
    return en.compact_cache(rows, "key", "batch", ["value", "seq"])


@_query
def cache_pending(spark, d):
    changes = _changes(spark, d)
    return en.pending(changes, en.cacheable(changes.where("seq % 5 = 0"), "error"), "key")


@_query
def repair_overlay(spark, d):
    changes = _changes(spark, d)
    fresh = changes.where("seq % 3 = 0").groupBy("key").agg(F.max("value").alias("value"), F.lit("").alias("error"))
    return en.overlay(changes, fresh, "key", ["value", "error"], "error").select("seq", "key", "value", "error")


@_query
def column_classes(spark, d):
    """Classes of column names that are made of the events' kinds, users and numbers."""
    k, kind = F.col("user_id") % 9, F.col("event_type")
    name = F.when(k == 0, F.concat(F.lit("openalex_"), kind)).when(k == 1, F.concat(F.lit("resumen_"), F.col("event_id"))).when(k == 2, "palabras_clave").when(k == 3, F.concat(F.lit("fuente_"), kind))
    name = name.when(k == 4, "project_title").when(k == 5, "result_type").when(k == 6, "match_method").when(k == 7, F.concat(kind, F.lit("_resumen"))).otherwise(kind)
    return _t(spark, d, "events").select("event_id", name.alias("name")).select("event_id", "name", tx.column_class("name").alias("kind"))


@_query
def project_text(spark, d):
    blank = F.when(F.col("p_partkey") % 3 == 0, "  ").otherwise(F.col("p_brand"))
    return _t(spark, d, "part").select("p_partkey", tx.join_text("p_name", blank, "p_type").alias("project_text"), tx.join_keywords(F.col("p_type"), F.when(F.col("p_partkey") % 4 == 0, "-").otherwise(F.col("p_name"))).alias("keywords"))


@_query
def tfidf_relational(spark, d):
    return sm.tfidf(_t(spark, d, "documents"), "doc_id", "text").select("doc_id", "term", F.round("weight", 6).alias("weight"))


@_query
def length_histogram(spark, d):
    return mt.histogram(_t(spark, d, "documents"), "n_chars", 30)


@_query
def cluster_counts(spark, d):
    return _t(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n")).orderBy("label")


@_query
def cluster_examples(spark, d):
    return first_n(_t(spark, d, "embeddings").select("label", "vec_id"), ["label"], 2, "vec_id")


@_query
def dataset_summary(spark, d):
    both = _t(spark, d, "documents").agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_sources"), F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("n_blank"), F.max(F.length("text")).alias("max_length"))
    return both


@_query
def number_publications(spark, d):
    return number_rows(_t(spark, d, "documents").select("doc_id"), "publication_id", F.desc("doc_id"))


@_query
def pca_variance(spark, d):
    _, shares = sm.with_pca(_t(spark, d, "embeddings"), "embedding", 3)
    return spark.range(1).select(F.posexplode(F.array(*(F.lit(round(s, 9)) for s in shares))).alias("component", "share"))


@_query
def kmeans_sizes(spark, d):
    return sm.with_clusters(_t(spark, d, "embeddings"), "embedding", 8).groupBy("cluster_label").agg(F.count("*").alias("n"))


@_query
def title_scores(spark, d):
    return _candidates(spark, d).select("project_id", "publication_id", "title_similarity")


@_query
def sequence_ratios(spark, d):
    """Names of every hundredth part against all names."""
    part = _t(spark, d, "part")
    asked = part.where("p_partkey % 100 = 0").select("p_name").distinct()
    return asked.crossJoin(part.select(F.col("p_name").alias("other")).distinct()).select("p_name", "other", sequence_ratio(F.col("p_name"), F.col("other")).alias("ratio"))


@_query
def similar_names(spark, d):
    """Part names with their types of a ratio of 0.9 or more."""
    return sl.similar_names(_t(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name")), "name", 0.9)
