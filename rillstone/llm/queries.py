"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.chunk_store import read_store, write_store
from rillstone.llm.common import materialize, new_folder, spread
from rillstone.llm.conversations import repair_report
from rillstone.llm.decontaminate import hit_words, with_hits
from rillstone.llm import license_scan as ls
from rillstone.llm.knn_join import top_k
from rillstone.llm.license_texts import TEXTS, notices
from rillstone.llm.near_dup import near_duplicates
from rillstone.llm.packing import cut_documents, pack
from rillstone.llm.quality import held_out, scorer, train
from rillstone.llm.rule_forest import counted, fit, rule_verdicts
from rillstone.llm.runs import periodic_runs
from rillstone.llm.sharding import lookup_table, place
from rillstone.llm.token_counts import token_counts
from rillstone.llm.warc import read_archive, write_archive


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

SHARDS = [f"shard-{i:02d}" for i in range(64)]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document's whole text and the notices among its lines."""
    return ls.license_scan(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard among SHARDS."""
    return place(_table(spark, sf_dir, "documents").select("doc_id"), lookup_table(SHARDS), "doc_id")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every vector whose id is divisible by 100."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    pieces = cut_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    pieces = materialize(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, ["doc_id", "piece"], capacity=1024)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records to seekable bundles and read back."""
    path = new_folder(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by two-word shingles at 0.8."""
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


def op8_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to a content-addressed store of ids and read back."""
    store = new_folder(spark, "chunk-store")
    write_store(_table(spark, sf_dir, "documents"), store, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_store(spark, store)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a benchmark window of ten words."""
    docs = with_hits(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("hits.items", lambda i: i.cast("string"))), ",")
    hit = hit_words(F.col("hits"))
    return docs.select("doc_id", F.col("hits.n_words").alias("n_words"), hit.alias("n_hit"), F.size("hits.items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from a field trained on the labels that are not held out."""
    docs = spread(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    score = scorer(train(docs, _table(spark, sf_dir, "labels")))
    return docs.select("doc_id", held_out().alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, the base rules' and the forest's verdict."""
    docs = counted(_table(spark, sf_dir, "documents"))
    found = rule_verdicts(docs, fit(docs, _table(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~F.col("unusual")).alias("kept"), "anomaly")


def made_periodic(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of all documents, of which one in ten goes round in a circle from some word on.

    With h the crc32 of the id and g = h div 10, a text of n words with h % 10 = 0 repeats, from word a = g % n on, its
    words a to a + p, where p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1).cast("long"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.expr("nullif(size(words), 0)"))
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("int(g % n)")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    head, circle = F.slice("words", F.lit(1), F.col("a")), F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(circle, F.expr("int((n - a + p - 1) div p)"))), F.lit(1), F.col("n") - F.col("a"))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, a tenth of which is made periodic, and what is left without repetitions."""
    found = periodic_runs(made_periodic(_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    digested = F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), digested.alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    longest = [(-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period")]
    return rows.select("doc_id", "n_runs", *longest, F.expr("1000 * b.length div -b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: conversations with faults, one row in four or so; dropped rows aren't ``present``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    known = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    hurt = known.select("conv_id", "turn", role.alias("role"), changed.alias("text"), "fault", (F.col("fault") != 0).alias("present"))
    return hurt.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fault", "copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    return repair_report(damaged(_table(spark, sf_dir, "conversations")), present=F.col("present"))


QUERIES = {"op1_license_scan": op1_license_scan, "op2_token_counts": op2_token_counts, "op3_sharding": op3_sharding, "op4_exact_top_k": op4_exact_top_k, "op5_best_fit_packing": op5_best_fit_packing, "op6_warc": op6_warc, "op7_near_duplicates": op7_near_duplicates, "op8_chunk_store": op8_chunk_store, "op9_quality": op9_quality, "op10_decontamination": op10_decontamination, "op11_quality_rules": op11_quality_rules, "op12_periodic_runs": op12_periodic_runs, "op13_conversation_repair": op13_conversation_repair}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """Canonical form, digests and both lookups once more, in DuckDB's functions."""
    spelt = "line"
    for a, b in ls.SPELLINGS:
        spelt = f"replace({spelt}, {_quoted(a)}, {_quoted(b)})"
    form = f"CASE WHEN regexp_matches(line, {_quoted(ls.COPYRIGHT)}) THEN '' ELSE trim(regexp_replace({spelt}, '[^a-z0-9]+', ' ', 'g')) END"
    lines = f"[c FOR c IN [{form} FOR line IN string_split(lower(replace(coalesce(text, ''), 'İ', 'i')), chr(10))] IF c <> '']"

    def known(rows: list[tuple[str, str]]) -> str:
        values = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in rows)
        return f"SELECT min(id) AS id, sha256(array_to_string({lines}, ' ')) AS digest FROM (VALUES {values}) AS v(id, text) GROUP BY 2"

    return f"""
        WITH texts AS MATERIALIZED ({known(TEXTS)}), notes AS MATERIALIZED ({known(notices())}),
        d AS MATERIALIZED (SELECT doc_id, {lines} AS lines FROM documents),
        found AS (SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT notes.id)), ',') AS names
                  FROM (SELECT doc_id, unnest(lines) AS line FROM d) AS l JOIN notes ON notes.digest = sha256(l.line) GROUP BY doc_id)
        SELECT d.doc_id, sha256(array_to_string(lines, ' ')) AS digest, texts.id AS license_id,
               CAST(coalesce(n, 0) AS BIGINT) AS n_notices, coalesce(names, '') AS notice_licenses
        FROM d LEFT JOIN texts ON texts.digest = sha256(array_to_string(lines, ' ')) LEFT JOIN found ON found.doc_id = d.doc_id"""


def _sharding_sql() -> str:
    table = lookup_table(SHARDS)
    return f"""
        WITH d AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {len(table)} AS INTEGER) AS slot FROM documents)
        SELECT doc_id, slot, CAST({table}[slot + 1] AS INTEGER) AS shard FROM d"""


_LOWERED = f"translate(coalesce(text, ''), '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
_NEAR_SQL = f"""
    WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array({_LOWERED}, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS a FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(a) > 1 THEN [a[i] || ' ' || a[i + 1] FOR i IN range(1, len(a))] ELSE a END) AS sh FROM w)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    e AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM s AS x JOIN n AS nx ON nx.doc_id = x.doc_id JOIN s AS y ON y.sh = x.sh AND y.doc_id <> x.doc_id JOIN n AS ny ON ny.doc_id = y.doc_id
        WHERE 100 * least(nx.n, ny.n) >= 80 * greatest(nx.n, ny.n) GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(nx.n) + any_value(ny.n) - count(*))),
    r AS (SELECT doc_id, doc_id AS o FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.o)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o) AS component_id, r.doc_id = min(o) AS kept FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""
_PLAIN = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
_LEAK_SQL = f"""
    WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWERED}, {_PLAIN}) AS a FROM documents),
    b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_PLAIN}) AS a FROM benchmark),
    p AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(a[i:i + n - 1], ' ') AS t FROM (SELECT item_id, a, least(10, len(a)) AS n, unnest(range(1, len(a) - least(10, len(a)) + 2)) AS i FROM b WHERE len(a) > 0)),
    m AS (SELECT doc_id, n, i, array_to_string(a[i:i + n - 1], ' ') AS t FROM (SELECT doc_id, a, n, unnest(range(1, len(a) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) AS q)),
    h AS MATERIALIZED (SELECT doc_id, i, m.n, item_id FROM m JOIN p ON p.n = m.n AND p.t = m.t),
    k AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
    g AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN g ON g.doc_id = d.doc_id"""


_CRC_SQL = """list_reduce([4294967295] || [ord(c)::BIGINT FOR c IN string_split({text}, '')],
        lambda crc, byte: xor(crc >> 8, list_reduce([xor(crc, byte) & 255] || range(8), lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_REPAIR_SQL = f"""
    WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor({_CRC_SQL.format(text="concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")}, 4294967295) % 20 AS f FROM conversations),
    d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE f <> 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
    e AS (SELECT *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, substr(role, 1, 1) AS c,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS c0 FROM o),
    g AS MATERIALIZED (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM e),
    n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
        count_if(c0 IS NOT NULL AND concat(c0, c) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows FROM g GROUP BY conv_id),
    p AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {{'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS b FROM n
        UNION ALL
        SELECT conv_id, i, s, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS b FROM (
            SELECT m.conv_id, g.i, x.cost + y[1]::INT AS cost, x.audit || y[2] AS audit, CASE WHEN y[4] = '-' THEN x.lines ELSE list_append(x.lines, y[4] || ':' || g.text) END AS lines, y[3]::INT AS s
            FROM (SELECT conv_id, i, unnest([{{'s': s, 'cost': b.cost, 'audit': b.audit, 'lines': b.lines}},
                        {{'s': [2, 2, 3, 2][s + 1], 'cost': b.cost + 2, 'audit': b.audit || 'I', 'lines': list_append(b.lines, CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END)}},
                        {{'s': [3, 3, 2, 3][s + 1], 'cost': b.cost + 4, 'audit': b.audit || 'II', 'lines': b.lines || CASE WHEN s = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END}}]) AS x FROM p) AS m
            JOIN g ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND g.i = m.i + 1,
            unnest([['3', 'D', CAST(x.s AS VARCHAR), '-']]
                || CASE WHEN fault IN ('blank', 'duplicate') THEN [] ELSE [[CAST(2 + CAST(fault = 'truncated' AS INT) AS VARCHAR), 'R', CASE WHEN x.s = 2 THEN '3' ELSE '2' END, CASE WHEN x.s = 2 THEN 'assistant' ELSE 'user' END]] END
                || CASE WHEN fault IN ('blank', 'duplicate') OR NOT ((c = 's' AND x.s = 0) OR (c = 'u' AND x.s <> 2) OR (c = 'a' AND x.s = 2)) THEN []
                   ELSE [[CAST(CAST(fault = 'truncated' AS INT) AS VARCHAR), 'K', CASE c WHEN 's' THEN '1' WHEN 'u' THEN '2' ELSE '3' END, role]] END) AS z(y)) AS options
        GROUP BY conv_id, i, s),
    w AS (SELECT p.conv_id, min({{'cost': b.cost + [0, 4, 2, 0][s + 1], 'audit': b.audit || ['', 'II', 'I', ''][s + 1],
        'lines': b.lines || [CAST([] AS VARCHAR[]), ['user:', 'assistant:'], ['assistant:'], CAST([] AS VARCHAR[])][s + 1]}}) AS b
        FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = n.rows GROUP BY p.conv_id)
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
        CAST(coalesce(w.b.cost, 0) AS BIGINT) AS cost, coalesce(w.b.audit, '') AS audit, sha256(coalesce(array_to_string(w.b.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM a.conv_id"""


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op7_near_duplicates": _NEAR_SQL,
    "op10_decontamination": _LEAK_SQL,
    "op13_conversation_repair": _REPAIR_SQL,
    "op1_license_scan": _license_sql(),
    "op3_sharding": _sharding_sql(),
    "op4_exact_top_k": """
        WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
              FROM v AS q JOIN v AS d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
        FROM f""",
}
