"""Projects, persons, publications, ground truth and candidate links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import similarity as sim
from rillstone.functions import text as tx
from rillstone.operators.numbering import digest, first_nonblank, head, keep_first, last_value, number_rows, number_texts
from rillstone.storage import materialize

#: Kinds of declared results that are publications.
PUBLICATION_TYPES = [
    "Artículo indizado", "Artículo arbitrado", "Capítulo de libro arbitrado", "Capítulo de libro indizado", "Libro arbitrado",
    "Libro indizado", "Editor de libro", "Memoria en anales de congreso arbitrado", "Memoria en anales de congreso indizado",
]
#: Bibliographic sources in order of trust for a master's texts.
SOURCES = ["SCOPUS", "WOS", "RI"]


def closed_projects(projects: DataFrame, year: str, status: str, closed: str, since: int, *order: str) -> DataFrame:
    """Projects of the closed status since a year (a null year is none), numbered ``project_id`` in ``order``."""
    return number_rows(projects.where((F.col(year).try_cast("double") >= since) & (tx.strip(status) == closed)), "project_id", *order)


def persons_master(first: DataFrame, second: DataFrame, name: str = "name_original", key: str = "seq") -> DataFrame:
    """All persons of ``first``, then those distinct ones of ``second`` whose normalized names ``first`` lacks.

    Both have the columns name and key; the result has ``investigator_id``, ``name_original``, ``name_norm``, ``source_seed``.
    """
    one = first.select(F.lit(0).alias("block"), F.col(key).cast("long").alias("seq"), F.col(name).alias("name_original"), tx.normalize_text(name).alias("name_norm"))
    two = second.select(F.lit(1).alias("block"), F.col(key).cast("long").alias("seq"), F.col(name).alias("name_original"), tx.normalize_text(name).alias("name_norm"))
    two = keep_first(two.join(one.select("name_norm").distinct(), "name_norm", "left_anti").select(*one.columns), ["name_original"], "seq")
    both = one.unionByName(two)
    seed = F.when(F.col("block") == 0, "ORCID").otherwise("RI")
    return number_rows(both, "investigator_id", "block", "seq").select("investigator_id", "name_original", "name_norm", seed.alias("source_seed"))


def person_aliases(persons: DataFrame, name: str = "name_original", key: str = "investigator_id") -> DataFrame:
    """``key``, ``alias_original``, ``alias_norm``: every spelling of every person once."""
    return persons.select(key, F.col(name).alias("alias_original"), F.explode(tx.name_aliases(name)).alias("alias_norm")).distinct()


def lookup_last(df: DataFrame, left: str, lookup: DataFrame, key: str, value: str, seq: str, default: Column | None = None) -> DataFrame:
    """``df`` with ``value`` of the lookup row of largest ``seq`` for ``left``; blank keys find nothing."""
    table = last_value(lookup.where(F.col(key).isNotNull() & (F.col(key) != "")), [key], value, seq, "__value").withColumnRenamed(key, "__key")
    found = F.col("__value") if default is None else F.coalesce("__value", default)
    return df.join(table, F.col(left) == F.col("__key"), "left").withColumn(value, found).drop("__key", "__value")


def source_records(streams: dict[str, DataFrame]) -> DataFrame:
    """All source records in one shape.

    Each stream has seq, doi, title, year, journal, abstract, keywords; missing ones are null. Adds ``source``,
    ``source_record_id``, ``title_norm``, ``doi`` (normalized), ``master_key`` and ``rank`` (order of trust, then row).
    """
    fields = ["doi", "title", "year", "journal", "abstract", "keywords"]
    out = None
    for source, df in streams.items():
        have = [F.col(c) if c in df.columns else F.lit(None).cast("int" if c == "year" else "string").alias(c) for c in fields]
        one = df.select(F.lit(source).alias("source"), F.col("seq").cast("long").alias("seq"), *have)
        out = one if out is None else out.unionByName(one)
    out = out.withColumn("doi", tx.normalize_doi("doi")).withColumn("title_norm", tx.normalize_text("title")).withColumn("title", F.coalesce("title", F.lit("")))
    trust = F.coalesce(F.array_position(F.lit(SOURCES), F.col("source")), F.lit(9))
    order = F.struct(trust.alias("t"), F.col("seq").alias("s"))
    return out.withColumn("master_key", tx.publication_key("doi", "title_norm", "year")).withColumn("source_record_id", F.concat("source", F.lit(":"), "seq")).withColumn("rank", order)


def consolidate(records: DataFrame) -> DataFrame:
    """One publication per master key, numbered by the key: first non-blank texts by rank, first year, source counts.

    Groups meet as digests of their keys. Sources and years are counted beside the texts, since counting distinct
    sources takes two shuffles, and numbers come from digests and heads of keys, so whole texts are shuffled once.
    """
    texts = [first_nonblank(c, "rank").alias(c) for c in ("doi", "title", "title_norm", "journal", "abstract", "keywords")]
    keyed = records.withColumn("__digest", digest("master_key"))
    by_source = keyed.groupBy("__digest", head("master_key").alias("head"), "source").agg(F.count("*").alias("n"), F.min("year").alias("year"))
    narrow = materialize(by_source, "sources")
    counts = [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("RI", "SCOPUS", "WOS")]
    counted = narrow.groupBy("__digest").agg(F.min("year").alias("year"), F.count("source").alias("source_count"), *counts)
    numbers = number_texts(records, "master_key", "publication_id", narrow.select(F.col("__digest").alias("digest"), "head").distinct())
    masters = keyed.groupBy("__digest").agg(F.first("master_key").alias("master_key"), *texts)
    for more in (counted.withColumnRenamed("__digest", "digest"), numbers):
        masters = masters.join(more, F.col("__digest").eqNullSafe(F.col("digest")), "left").drop("digest")
    return masters.drop("__digest").withColumns({f"found_in_{s}": F.col(s) > 0 for s in ("RI", "SCOPUS", "WOS")})


def authorships(records: DataFrame, authors: str, ids: str, key: str = "master_key") -> DataFrame:
    """A row per author of each record: ``key``, source, author_order (from 1), raw and normalized name, id at the same place."""
    rows = records.select(key, "source", "seq", F.posexplode(tx.aligned_pairs(authors, ids)).alias("p", "x"))
    named = rows.select(key, "source", "seq", (F.col("p") + 1).alias("author_order"), tx.aligned_name(F.col("x")).alias("author_name_raw"), tx.aligned_id(F.col("x")).alias("external_author_id"))
    return named.select(key, "source", "seq", "author_order", "author_name_raw", tx.normalize_text("author_name_raw").alias("author_name_norm"), "external_author_id")


def publication_ids(records: DataFrame) -> DataFrame:
    """``digest`` of the master key, ``publication_id`` as ``consolidate`` numbers them, from the keys alone."""
    return number_texts(records.where("master_key IS NOT NULL"), "master_key", "publication_id")


def attach_publications(df: DataFrame, publications: DataFrame) -> DataFrame:
    """``df`` with ``publication_id`` by master key; rows without one stay. Keys, which hold whole titles, meet as digests.

    ``publications`` come from ``consolidate`` or ``publication_ids``.
    """
    known = publications.select((F.col("digest") if "digest" in publications.columns else digest("master_key")).alias("__known"), "publication_id")
    return df.withColumn("__key", digest("master_key")).join(known, F.col("__key") == F.col("__known"), "left").drop("__key", "__known")


def join_key(c: str, blank_keys: str) -> Column:
    """A code for joining: 'exclude' drops blanks and '-', 'match' lets missing codes meet as 'nan'."""
    text = tx.strip(F.col(c).cast("string"))
    if blank_keys == "match":
        return F.coalesce(text, F.lit("nan"))
    if blank_keys != "exclude":
        raise ValueError("blank_keys is 'match' or 'exclude'")
    return F.when(~text.isin("", "-", "nan"), text)


def results_truth(projects: DataFrame, results: DataFrame, publications: DataFrame, code: str, result_code: str, blank_keys: str = "exclude") -> DataFrame:
    """Declared results of projects (many to many by code) with the smallest publication of their DOI, or none.

    ``results`` has ``doi_norm``; adds ``publication_id``, ``match_method``.
    """
    p = projects.withColumn("__code", join_key(code, blank_keys))
    r = results.withColumn("__rcode", join_key(result_code, blank_keys))
    dois = publications.where(F.coalesce(F.col("doi"), F.lit("")) != "").groupBy(F.col("doi").alias("__doi")).agg(F.min("publication_id").alias("publication_id"))
    both = p.join(r, F.col("__code") == F.col("__rcode")).drop("__code", "__rcode")
    found = both.join(dois, F.col("doi_norm") == F.col("__doi"), "left").drop("__doi")
    return found.withColumn("match_method", F.when(F.col("publication_id").isNotNull(), "doi").otherwise(""))


def candidate_links(projects: DataFrame, authored: DataFrame, horizon: int = sim.WEIGHTS.horizon) -> DataFrame:
    """Publications whose author is a project's coordinator, from its year to ``horizon`` years on; scored.

    ``projects``: project_id, project_year, coordinator_norm, project_tokens. ``authored``: one row per authorship with
    author_name_norm, author_name_raw, auth_seq, publication_id, publication_year, publication_tokens, ri, scopus, wos.
    A missing year passes and earns no points. Each pair comes once, with the author row of smallest ``auth_seq``.

    ``title_similarity`` is the larger of half the sequence ratio of project_title_norm and publication_title_norm and
    the word overlap. Inputs that both lack a title column are compared by their words alone; one title alone raises.
    """
    titled = ("project_title_norm" in projects.columns, "publication_title_norm" in authored.columns)
    if any(titled) and not all(titled):
        raise ValueError("titles are compared if both project_title_norm and publication_title_norm are given")
    pairs = _same_name_and_years(projects.where(F.col("coordinator_norm") != ""), authored.where(F.col("publication_id").isNotNull()), horizon)
    keep = [c for c in pairs.columns if c not in ("project_id", "publication_id", "author_name_raw", "auth_seq", "author_name_norm")]
    once = pairs.groupBy("project_id", "publication_id").agg(F.min_by("author_name_raw", "auth_seq").alias("matched_author"), *(F.first(c).alias(c) for c in keep))
    dated = once.withColumn("year_delta", F.col("publication_year") - F.col("project_year"))
    if not all(titled):
        return with_score(dated.withColumn("title_similarity", sim.jaccard_4(F.col("project_tokens"), F.col("publication_tokens"))))
    return with_score(sim.with_title_score(dated, "project_title_norm", "publication_title_norm", "project_tokens", "publication_tokens"))


def _same_name_and_years(projects: DataFrame, authored: DataFrame, horizon: int) -> DataFrame:
    """Pairs of one name, the publication from the project's year to ``horizon`` years on, or one of them undated.

    Years are cut into bands of ``horizon`` + 1; a project looks into its own, the next and the undated publications'
    band. So a common name's pairs meet within the years only, and its rows are dealt by name and band.
    """
    band = lambda c: F.floor(F.col(c) / F.lit(horizon + 1)).cast("int")
    undated = F.lit(-1 << 30)
    published = authored.withColumn("__band", F.coalesce(band("publication_year"), undated))
    dated = projects.where("project_year IS NOT NULL")
    looked = dated.withColumn("__look", F.explode(F.array(band("project_year"), band("project_year") + 1, undated)))
    near = F.col("publication_year").isNull() | (F.col("publication_year") - F.col("project_year")).between(0, horizon)
    same = F.col("coordinator_norm") == F.col("author_name_norm")
    pairs = looked.join(published, same & (F.col("__look") == F.col("__band")) & near).drop("__look", "__band")
    return pairs.unionByName(projects.where("project_year IS NULL").join(authored, same))


def with_score(pairs: DataFrame) -> DataFrame:
    """``pairs`` (year_delta, ri, scopus, wos, title_similarity) with score, confidence and evidence."""
    args = [F.col(c) for c in ("year_delta", "ri", "scopus", "wos", "title_similarity")]
    return pairs.withColumn("score", sim.candidate_score(*args)).withColumn("confidence", sim.confidence(F.col("score"))).withColumn("evidence", sim.evidence(*args))


def direct_links(results: DataFrame, projects: DataFrame, publications: DataFrame) -> DataFrame:
    """Pairs by code (last project wins) and DOI (last publication wins): ``project_id, publication_id``."""
    by_code = last_value(projects.where("code is not null"), ["code"], "project_id", "project_id")
    by_doi = last_value(publications.where("doi <> ''"), ["doi"], "publication_id", "publication_id")
    return results.join(by_code, "code").join(by_doi, "doi").select("project_id", "publication_id").distinct()


#: Bytes of probes that one pass over the masters searches for; they are broadcast. More make further passes.
PASS_BYTES = 16 << 20
#: Characters by whose first ones a master inside a probe is looked up.
GRAM = 8


def containment(probes: DataFrame, masters: DataFrame, a: str, b: str, order: str, most: int | None = None) -> DataFrame:
    """For each probe: the first master (by ``order``) that contains the probe or is contained in it.

    Probes are found in the masters by an automaton, masters in the probes by their first characters and a comparison;
    no pair of texts is formed that has nothing in common. ``most`` takes the first probes only, as a report may; blank
    texts match nothing.
    """
    spark = masters.sparkSession
    wanted = probes.where(F.col(a) != "").select(F.col(a).alias("probe")).distinct()
    wanted = wanted.orderBy("probe").limit(most) if most is not None else wanted
    size = wanted.agg(F.sum(F.octet_length("probe"))).first()[0] or 0
    passes = -(-size // PASS_BYTES)
    texts = masters.where(F.col(b) != "").select(F.col(b).alias("master"), F.col(order).alias("place"))
    kind = texts.schema["place"].dataType.simpleString()
    hits = None
    for k in range(passes):
        few = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("probe"), F.lit(passes)) == k)
        known = spark.sparkContext.broadcast(sorted(r.probe for r in few.collect()))  # about PASS_BYTES
        found = texts.mapInArrow(_contained(known), f"probe string, master string, place {kind}")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = texts.limit(0).select(F.lit("").alias("probe"), "master", "place")
    return hits.groupBy(F.col("probe").alias(a)).agg(F.min_by("master", "place").alias(b), F.min("place").alias(order))


def _contained(known: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: (master, place) to (probe, master, place) of the probes that it contains or that contain it."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        probes = known.value
        inside = ahocorasick.Automaton()
        holders: dict[str, set[int]] = {}
        for k, probe in enumerate(probes):
            inside.add_word(probe, k)
            for i in range(len(probe) - GRAM + 1):
                holders.setdefault(probe[i : i + GRAM], set()).add(k)
        inside.make_automaton()
        longest = max(map(len, probes), default=0)
        for batch in batches:
            rows, which = [], []
            for at, master in enumerate(batch.column("master").to_pylist()):
                found = {k for _, k in inside.iter(master)}
                if len(master) < GRAM:
                    found |= {k for k, probe in enumerate(probes) if master in probe}
                elif len(master) <= longest:
                    found |= {k for k in holders.get(master[:GRAM], ()) if master in probes[k]}
                rows += [at] * len(found)
                which += [probes[k] for k in found]
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.string()), taken.column("master"), taken.column("place")], names=["probe", "master", "place"])

    return find
