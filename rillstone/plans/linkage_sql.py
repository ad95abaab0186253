"""The linkage queries once more, as DuckDB SQL."""

from __future__ import annotations

from rillstone.functions.text import STOPWORDS
from rillstone.operators.linkage import PUBLICATION_TYPES


def _norm(x: str) -> str:
    return f"trim(regexp_replace(strip_accents(replace(upper(coalesce({x}, '')), 'ẞ', 'SS')), '[^A-Z0-9]+', ' ', 'g'))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _pct(n: str, d: str) -> str:
    return f"CASE WHEN {d} = 0 THEN 0.0::DOUBLE ELSE ((20000 * {n} + {d}) // (2 * {d}))::DOUBLE / 100.0::DOUBLE END"


_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_WORDS = "list_distinct([w FOR w IN string_split(title_norm, ' ') IF length(w) > 2 AND NOT list_contains([" + _STOP + "], w)])"
_RAW = """CASE page_id % 5 WHEN 0 THEN 'https://doi.org/10.1/AB' || page_id WHEN 1 THEN ' HTTP://dx.doi.org/10.2/x' || page_id || '. '
    WHEN 2 THEN 'DOI: 10.3/Y' || page_id || ' ;,' WHEN 3 THEN '-' ELSE 'https://doi.org/https://doi.org/10.4/' || page_id END"""


def _doi(x: str) -> str:
    low = f"lower({_strip(x)})"
    return f"CASE WHEN {low} IN ('', '-', 'nan', 'none') THEN '' ELSE regexp_replace({_strip(f"regexp_replace({low}, '^(?:https?://(?:dx\\.)?doi\\.org/)+', '')")}, '\\.+$', '') END"


def _doi_wide(x: str) -> str:
    low = f"lower({_strip(x)})"
    return f"CASE WHEN {low} IN ('', '-', 'nan', 'none') THEN '' ELSE regexp_replace({_strip(f"regexp_replace({low}, '^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)+', '')")}, '[ .;,]+$', '') END"


_RECORDS = f"""
base AS (SELECT doc_id AS seq, ['SCOPUS', 'WOS', 'RI'][doc_id % 3 + 1] AS source, doc_id % 3 + 1 AS trust,
    CASE WHEN doc_id % 5 = 0 THEN '10.1/' || (doc_id % 40) ELSE '' END AS doi, text AS title,
    CASE WHEN doc_id % 11 <> 0 THEN CAST(2000 + doc_id % 20 AS INTEGER) END AS year,
    CASE WHEN doc_id % 7 = 0 THEN '-' ELSE source END AS journal, CASE WHEN doc_id % 6 = 0 THEN '' ELSE text END AS abstract,
    CASE WHEN doc_id % 4 <> 0 THEN lang END AS keywords, text FROM documents),
normed AS (SELECT *, {_norm("title")} AS title_norm FROM base),
records AS (SELECT *, CASE WHEN doi <> '' THEN 'doi:' || doi ELSE 'titleyear:' || title_norm || '|' || coalesce(CAST(year AS VARCHAR), '') END AS master_key FROM normed)"""


def _first(c: str) -> str:
    return f"coalesce(arg_min({c}, trust * 1000000000 + seq) FILTER (WHERE {c} IS NOT NULL AND {_strip(c)} NOT IN ('', '-', 'nan')), '')"


_MASTERS = f"""
masters AS (SELECT master_key, {_first("doi")} AS doi, {_first("title")} AS title, min(year) AS year, {_first("journal")} AS journal, {_first("abstract")} AS abstract,
    {_first("keywords")} AS keywords, count(DISTINCT source) AS source_count, count(*) FILTER (source = 'RI') AS "RI", count(*) FILTER (source = 'SCOPUS') AS "SCOPUS", count(*) FILTER (source = 'WOS') AS "WOS"
    FROM records GROUP BY master_key),
pubs AS (SELECT row_number() OVER (ORDER BY master_key) AS publication_id, * FROM masters)"""


def _truth(policy: str, every: int) -> str:
    code = lambda c: f"CASE WHEN {c} % {every} <> 0 THEN CAST({c} AS VARCHAR){' ELSE ' + chr(39) + 'nan' + chr(39) if policy == 'match' else ''} END"
    kinds = "'R'" if "Artículo indizado" in PUBLICATION_TYPES else "''"
    return f"""
WITH p AS (SELECT o_orderkey AS project_id, {code("o_orderkey")} AS cod FROM orders WHERE o_orderstatus = 'F'),
r AS (SELECT {code("l_orderkey")} AS rcod, l_partkey AS cod_prod, l_linenumber, '10.1/p' || (l_partkey % 1500) AS doi_norm FROM lineitem WHERE l_returnflag = {kinds}),
k AS (SELECT '10.1/p' || (p_partkey % 1500) AS doi, min(p_partkey) AS publication_id FROM part WHERE p_partkey % 3 > 0 GROUP BY 1)
SELECT project_id, cod_prod, l_linenumber, doi_norm, publication_id, CASE WHEN publication_id IS NULL THEN '' ELSE 'doi' END AS match_method
FROM p JOIN r ON p.cod = r.rcod LEFT JOIN k ON k.doi = r.doi_norm"""


def _rounded(x: str, scale: int) -> str:
    """Whole ``scale``-ths of a double below 2**60, as Python rounds: by its exact value, halves to even."""
    exact = f"CAST(({x})::DOUBLE * 18446744073709551616::DOUBLE AS HUGEINT) * {scale}"  # times 2**64: no bit is lost
    return f"(({exact}) // 18446744073709551616 + CASE WHEN ({exact}) % 18446744073709551616 + ({exact}) // 18446744073709551616 % 2 > 9223372036854775808 THEN 1 ELSE 0 END)"


def _matched(pairs: str) -> str:
    """CTEs from ``pairs`` (ta, tb) to ``ratios`` (ta, tb, matched): letters in the longest common runs, taken recursively.

    Runs are cut to the segment at hand; the longest wins, then the first in ta, then in tb. Titles of 200 letters and
    more would also need the rule for popular letters, which these tables don't reach.
    """
    return f"""
tp AS MATERIALIZED (SELECT row_number() OVER () AS id, ta, tb FROM (SELECT DISTINCT ta, tb FROM {pairs} WHERE ta <> '' AND tb <> '')),
ca AS (SELECT id, i, substr(ta, i, 1) AS x FROM (SELECT id, ta, unnest(range(1, length(ta) + 1)) AS i FROM tp)),
cb AS (SELECT id, i AS j, substr(tb, i, 1) AS x FROM (SELECT id, tb, unnest(range(1, length(tb) + 1)) AS i FROM tp)),
cells AS (SELECT id, i, i - j AS d, i - row_number() OVER (PARTITION BY id, i - j ORDER BY i) AS island FROM ca JOIN cb USING (id, x)),
runs AS MATERIALIZED (SELECT id, d, min(i) AS lo, max(i) + 1 AS hi FROM cells GROUP BY id, d, island),
seg AS (SELECT id, 1::BIGINT AS a0, (length(ta) + 1)::BIGINT AS a1, 1::BIGINT AS b0, (length(tb) + 1)::BIGINT AS b1, 0::BIGINT AS k FROM tp
    UNION ALL
    SELECT id, CASE WHEN side = 0 THEN a0 ELSE i + n END, CASE WHEN side = 0 THEN i ELSE a1 END, CASE WHEN side = 0 THEN b0 ELSE i - d + n END, CASE WHEN side = 0 THEN i - d ELSE b1 END, CASE WHEN side = 0 THEN n ELSE 0 END
    FROM (SELECT id, a0, a1, b0, b1, key // 100000000 AS n, 9999 - key // 10000 % 10000 AS i, (9999 - key // 10000 % 10000) - (9999 - key % 10000) AS d
          FROM (SELECT seg.id, a0, a1, b0, b1, max((least(hi, a1, b1 + d) - greatest(lo, a0, b0 + d)) * 100000000 + (9999 - greatest(lo, a0, b0 + d)) * 10000 + 9999 - greatest(lo, a0, b0 + d) + d) AS key
                FROM seg JOIN runs ON runs.id = seg.id AND least(hi, a1, b1 + d) > greatest(lo, a0, b0 + d) WHERE a1 > a0 AND b1 > b0 GROUP BY ALL)), (VALUES (0), (1)) AS v(side)),
ratios AS MATERIALIZED (SELECT ta, tb, CAST(sum(k) AS BIGINT) AS matched FROM seg JOIN tp USING (id) GROUP BY ta, tb)"""


_PAIRS = f"""
titles AS (SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT p_name)), ' ') AS title, bool_or(l_returnflag = 'R') AS ri, bool_or(l_returnflag = 'A') AS scopus, bool_or(l_returnflag = 'N') AS wos
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
named AS (SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr, c_name, {_norm("c_name")} AS name_norm, {_norm("title")} AS title_norm,
    coalesce(ri, false) AS ri, coalesce(scopus, false) AS scopus, coalesce(wos, false) AS wos
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN titles ON l_orderkey = o_orderkey),
worded AS (SELECT *, {_WORDS} AS words FROM named),
p AS (SELECT o_orderkey AS project_id, yr AS project_year, name_norm, title_norm AS ta, words AS pw FROM worded WHERE o_orderstatus = 'F' AND name_norm <> ''),
b AS (SELECT o_orderkey AS publication_id, CASE WHEN o_orderkey % 50 <> 0 THEN yr END AS publication_year, name_norm, c_name, title_norm AS tb, words AS bw, ri, scopus, wos FROM worded WHERE o_orderstatus = 'O'),
j AS MATERIALIZED (SELECT project_id, publication_id, project_year, publication_year, c_name AS matched_author, publication_year - project_year AS year_delta, ri, scopus, wos, ta, tb,
    len(list_intersect(pw, bw)) AS both_n, len(list_distinct(list_concat(pw, bw))) AS all_n, len(pw) AS np, len(bw) AS nb
    FROM p JOIN b USING (name_norm) WHERE publication_year IS NULL OR publication_year - project_year BETWEEN 0 AND 5)"""
#: Links whose score doesn't matter.
_LINKS = f"{_PAIRS}, cand AS (SELECT * FROM j)"
_CANDIDATES = f"""{_PAIRS}, {_matched("j")},
v AS (SELECT j.*, greatest(CASE WHEN np > 0 AND nb > 0 THEN both_n::DOUBLE / all_n ELSE 0.0::DOUBLE END, coalesce(matched::DOUBLE / (length(ta) + length(tb)), 0.0::DOUBLE)) AS larger FROM j LEFT JOIN ratios USING (ta, tb)),
s AS (SELECT *, {_rounded("larger", 10_000)}::DOUBLE / 10000 AS title_similarity FROM v),
c AS (SELECT *, {_rounded("title_similarity * 25", 100)}::DOUBLE / 100 AS title_points, {_rounded("title_similarity", 100)}::INTEGER AS shown FROM s),
g AS (SELECT *,
    round(50.0::DOUBLE + CASE WHEN year_delta = 0 THEN 20 WHEN year_delta IN (1, 2) THEN 18 WHEN year_delta IN (3, 4, 5) THEN 12 ELSE 0 END + CASE WHEN ri THEN 15 ELSE 0 END + CASE WHEN scopus THEN 10 ELSE 0 END
        + CASE WHEN wos THEN 10 ELSE 0 END + title_points, 2) AS score,
    concat_ws(' | ', 'responsable_autor', CASE WHEN year_delta = 0 THEN 'publicado_mismo_anio' WHEN year_delta IN (1, 2) THEN 'publicado_1_2_anios_despues' WHEN year_delta IN (3, 4, 5) THEN 'publicado_3_5_anios_despues' END,
        CASE WHEN ri THEN 'fuente_RI' END, CASE WHEN scopus THEN 'fuente_SCOPUS' END, CASE WHEN wos THEN 'fuente_WOS' END,
        CASE WHEN title_similarity >= 0.2::DOUBLE THEN 'similitud_tematica_' || (shown // 100) || '.' || lpad(CAST(shown % 100 AS VARCHAR), 2, '0') END) AS evidence FROM c),
cand AS (SELECT *, CASE WHEN score >= 85 THEN 'Alta' WHEN score >= 65 THEN 'Media' ELSE 'Baja' END AS confidence FROM g)"""
_DECLARED = """
l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, l_partkey FROM orders JOIN l ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O')),
declared AS (SELECT DISTINCT f.o_orderkey AS project_id, x.o_orderkey AS publication_id FROM o AS f JOIN o AS x USING (o_custkey, l_partkey) WHERE f.o_orderstatus = 'F' AND x.o_orderstatus = 'O')"""
_COUNTS = lambda value, table: f"SELECT coalesce(CAST({value} AS VARCHAR), 'NA') AS value, count(*) AS n FROM {table} GROUP BY 1"


def _shares(value: str, table: str, head: str = "") -> str:
    return f"{head or 'WITH'} k AS ({_COUNTS(value, table)}) SELECT value, n, {_pct('n', 'CAST(sum(n) OVER () AS BIGINT)')} AS pct FROM k"


_CHANGES = """
changes AS (SELECT CAST(user_id AS VARCHAR) || ':' || event_type AS key, event_id AS seq, value,
    CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'HTTP Error 429: Too Many Requests' ELSE 'HTTP Error 404' END ELSE '' END AS error FROM events)"""
_STAGES = ["true", "user_id % 10 <> 0", "event_type <> 'click'", "CAST(json_extract_string(props, '$.k') AS INTEGER) > 20", "value > 10.0"]
_LABELS = ["all rows", "with code", "maps", "with key", "matched"]
_FUNNEL = " UNION ALL ".join(f"SELECT {k} AS stage, '{_LABELS[k]}' AS label, count(*) FILTER ({' AND '.join(f'coalesce({c}, false)' for c in _STAGES[: k + 1])}) AS n FROM events" for k in range(5))
_LEVELS = {"overall": "c IS NOT NULL", "high": "c = 'Alta'", "medium": "c = 'Media'", "high_medium": "c IN ('Alta', 'Media')"}
ORACLE_SQL: dict[str, str] = {
    "text_normalize": f"SELECT doc_id, {_norm('text')} AS text_norm FROM documents",
    "identifier_normalize": f"WITH r AS (SELECT page_id, {_RAW} AS raw FROM pages) SELECT page_id, {_doi('raw')} AS doi_norm FROM r",
    "identifier_normalize_wide": f"WITH r AS (SELECT page_id, {_RAW} AS raw FROM pages) SELECT page_id, {_doi_wide('raw')} AS doi_norm FROM r",
    "work_queries": f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '10.1/ab' || doc_id ELSE '' END AS doi, {_strip("coalesce(text, '')")} AS bare, lower(regexp_replace({_strip("coalesce(text, '')")}, '\\s+', ' ', 'g')) AS t FROM documents)
        SELECT doc_id, CASE WHEN doi <> '' THEN 'doi:' || doi WHEN t NOT IN ('', '-', 'nan', 'none') THEN 'title:' || t ELSE '' END AS key,
        CASE WHEN doi <> '' THEN 'https://api.openalex.org/works/doi:' || doi WHEN bare <> '' THEN 'https://api.openalex.org/works?search.exact=' || replace(url_encode(bare), '%2F', '/') || '&per-page=1' ELSE '' END AS url FROM r""",
    "name_aliases": f"""SELECT c_custkey, {_norm("c_mktsegment || ', ' || c_name")} AS alias_norm FROM customer UNION SELECT c_custkey, {_norm("c_name || ' ' || c_mktsegment")} FROM customer""",
    "split_authors": f"""WITH w AS (SELECT doc_id, [x FOR x IN [{_strip('y')} FOR y IN string_split(replace(text, ' ', '|'), '|')] IF x <> ''] AS a FROM documents),
        e AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS i, a FROM w) SELECT doc_id, CAST(i AS INTEGER) AS author_order, a[i] AS author FROM e""",
    "closed_projects": "SELECT row_number() OVER (ORDER BY o_orderkey) AS project_id, o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1996",
    "persons_master": f"""WITH a AS (SELECT 0 AS block, c_custkey AS seq, c_name AS name_original FROM customer),
        b AS (SELECT 1 AS block, min(s_suppkey) AS seq, name_original FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') ELSE s_name END AS name_original FROM supplier) GROUP BY 3),
        u AS (SELECT *, {_norm("name_original")} AS name_norm FROM (SELECT * FROM a UNION ALL SELECT * FROM b)),
        f AS (SELECT * FROM u WHERE block = 0 OR name_norm NOT IN (SELECT {_norm("c_name")} FROM customer))
        SELECT row_number() OVER (ORDER BY block, seq) AS investigator_id, name_original, name_norm, CASE block WHEN 0 THEN 'ORCID' ELSE 'RI' END AS source_seed FROM f""",
    "person_lookup_last_wins": "SELECT p_name AS wanted, arg_max(p_brand, p_partkey) AS p_brand FROM part GROUP BY 1",
    "publication_master": f"""WITH {_RECORDS}, {_MASTERS} SELECT publication_id, master_key, doi, title, year, journal, abstract, keywords, source_count, "RI", "SCOPUS", "WOS",
        "RI" > 0 AS "found_in_RI", "SCOPUS" > 0 AS "found_in_SCOPUS", "WOS" > 0 AS "found_in_WOS" FROM pubs""",
    "source_pivot_flags": """WITH c AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS "RI", count(*) FILTER (l_returnflag = 'A') AS "SCOPUS", count(*) FILTER (l_returnflag = 'N') AS "WOS" FROM lineitem GROUP BY 1)
        SELECT *, "RI" > 0 AS "found_in_RI", "SCOPUS" > 0 AS "found_in_SCOPUS", "WOS" > 0 AS "found_in_WOS" FROM c""",
    "authorships_attach": f"""WITH {_RECORDS}, {_MASTERS},
        w AS (SELECT seq, source, master_key, string_split(replace(text, ' ', '|'), '|') AS raw, len(string_split(text, ' ')) AS ids FROM records),
        x AS (SELECT *, [v FOR v IN [{{'r': r, 'v': {_strip('raw[r]')}}} FOR r IN range(1, len(raw) + 1)] IF v.v <> ''] AS a FROM w),
        e AS (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM x)
        SELECT publication_id, source, seq AS doc_id, CAST(i AS INTEGER) AS author_order, {_norm("a[i].v")} AS author_name_norm, CASE WHEN a[i].r > ids OR (a[i].r - 1) % 3 = 0 THEN '' ELSE 'id' || (a[i].r - 1) END AS external_author_id
        FROM e JOIN pubs USING (master_key)""",
    "results_truth": _truth("exclude", 7),
    "results_truth_blank_match": _truth("match", 3001),
    "candidates": f"WITH RECURSIVE {_CANDIDATES} SELECT project_id, publication_id, project_year, publication_year, matched_author, year_delta, title_similarity, score, confidence, evidence FROM cand",
    "link_quality": f"WITH RECURSIVE {_CANDIDATES}, {_DECLARED}, f AS (SELECT confidence AS c, declared.project_id IS NOT NULL AS t FROM cand FULL JOIN declared USING (project_id, publication_id)), k AS ("
    + " UNION ALL ".join(f"SELECT '{k}' AS level, count(*) FILTER ({c}) AS candidates, count(*) FILTER (t) AS truth, count(*) FILTER ({c} AND t) AS matched FROM f" for k, c in _LEVELS.items())
    + f") SELECT *, {_pct('matched', 'candidates')} AS precision_pct, {_pct('matched', 'truth')} AS recall_pct FROM k",
    "value_counts": _shares("o_orderpriority", "orders"),
    "top_values": _shares("p_type", "part") + " ORDER BY n DESC, value LIMIT 10",
    "links_per_project": f"WITH {_LINKS}, z AS (SELECT count(*) AS n FROM cand GROUP BY project_id) SELECT count(*) AS groups, coalesce(avg(n), 0.0) AS mean_size, coalesce(median(n), 0.0)::DOUBLE AS median_size, coalesce(max(n), 0) AS max_size FROM z",
    "score_stats": f"""WITH RECURSIVE {_CANDIDATES} SELECT round(avg(score), 6) AS mean_score, median(score) AS median_score, min(score) AS min_score, max(score) AS max_score, round(stddev_samp(score), 6) AS std_score,
        round(avg(title_similarity), 6) AS mean_similarity, median(title_similarity) AS median_similarity, count(*) FILTER (title_similarity > 0.3) AS over_30, count(*) FILTER (title_similarity > 0.5) AS over_50 FROM cand""",
    "confidence_counts": _shares("confidence", "cand", f"WITH RECURSIVE {_CANDIDATES},"),
    "evidence_topk": f"WITH RECURSIVE {_CANDIDATES}, q AS (SELECT * FROM ({_shares('evidence', 'cand')}) ORDER BY n DESC, value LIMIT 5) SELECT substr(value, 1, 65) AS pattern, n, pct FROM q",
    "source_combos": _shares("label", "lab", f"WITH {_LINKS}, lab AS (SELECT coalesce(nullif(concat_ws('+', CASE WHEN ri THEN 'RI' END, CASE WHEN scopus THEN 'SCOPUS' END, CASE WHEN wos THEN 'WOS' END), ''), 'none') AS label FROM cand),"),
    "delta_buckets": f"WITH {_LINKS} SELECT year_delta, count(*) AS n, CASE WHEN year_delta = 0 THEN 'same' WHEN year_delta <= 2 THEN '1-2' ELSE '3-5' END AS bucket FROM cand WHERE year_delta IS NOT NULL GROUP BY 1",
    "source_shares": f"""WITH {_LINKS}, z AS (SELECT count(*) AS n, count(*) FILTER (ri OR scopus OR wos) AS a, count(*) FILTER (CAST(ri AS INT) + CAST(scopus AS INT) + CAST(wos AS INT) > 1) AS m, count(*) FILTER (year_delta IN (0, 1, 2)) AS y FROM cand)
        SELECT {_pct('a', 'n')} AS any_source_pct, {_pct('m', 'n')} AS multi_source_pct, {_pct('y', 'n')} AS within_two_years_pct FROM z""",
    "coverage": f"""WITH {_LINKS}, z AS (SELECT count(*) AS covered, sum(n) AS links, max(n) AS max_links FROM (SELECT count(*) AS n FROM cand GROUP BY project_id)), q AS (SELECT count(*) AS projects FROM orders WHERE o_orderstatus = 'F')
        SELECT projects, covered, projects - covered AS uncovered, {_pct('covered', 'projects')} AS coverage_pct, round(links::DOUBLE / covered, 6) AS mean_links, max_links FROM z, q""",
    "overlap_v1_v2": f"""WITH {_LINKS}, {_DECLARED}, f AS (SELECT cand.matched_author IS NOT NULL AS x, declared.tag IS NOT NULL AS y FROM cand FULL JOIN (SELECT *, 1 AS tag FROM declared) AS declared USING (project_id, publication_id)),
        k AS (SELECT count(*) FILTER (x) AS n_one, count(*) FILTER (y) AS n_two, count(*) FILTER (x AND y) AS n_both, count(*) FILTER (x AND NOT y) AS only_one, count(*) FILTER (y AND NOT x) AS only_two FROM f)
        SELECT *, {_pct('only_two', 'greatest(n_one, 1)')} AS gain_pct FROM k""",
    "direct_links": """WITH p AS (SELECT CAST(o_orderkey % 3000 AS VARCHAR) AS code, max(o_orderkey) AS project_id FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT 'p' || (p_partkey % 700) AS doi, max(p_partkey) AS publication_id FROM part WHERE p_partkey % 4 > 0 GROUP BY 1)
        SELECT DISTINCT project_id, publication_id FROM lineitem JOIN p ON p.code = CAST(l_orderkey % 3000 AS VARCHAR) JOIN b ON b.doi = 'p' || (l_partkey % 700)""",
    "dois_matched": "SELECT l_partkey AS doi, l_orderkey, l_quantity FROM lineitem WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 20)",
    "dois_unmatched": "SELECT l_partkey AS doi, l_orderkey, l_quantity FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 20)",
    "funnel": f"""WITH s AS ({_FUNNEL}), b AS (SELECT *, CASE WHEN stage = 0 THEN n ELSE (SELECT n FROM s WHERE stage = 1) END AS base, lag(n) OVER (ORDER BY stage) AS prev FROM s)
        SELECT stage, label, n, {_pct('n', 'base')} AS pct, prev - n AS loss, CASE WHEN prev IS NOT NULL THEN {_pct('(prev - n)', 'prev')} END AS loss_pct FROM b""",
    "identifier_coverage": """WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 AS a, value > 20.0 AS b FROM events)
        SELECT count(*) AS n, count(*) FILTER (a) AS with_a, count(*) FILTER (b) AS with_b, count(*) FILTER (a AND b) AS with_both FROM e""",
    "partial_containment": """WITH p AS (SELECT DISTINCT probe FROM (SELECT text AS probe FROM benchmark WHERE text <> ''))
        SELECT probe, min(doc_id) AS doc_id FROM p JOIN documents ON text <> '' AND (contains(text, probe) OR contains(probe, text)) GROUP BY 1""",
    "abstracts_merge": """WITH a AS (SELECT '10.1/x' || (doc_id % 300) AS k, arg_min(CAST(quality AS VARCHAR), doc_id) FILTER (doc_id % 2 = 0 AND quality IS NOT NULL) AS q, arg_min(CAST(toxic AS VARCHAR), doc_id) AS t FROM labels GROUP BY 1)
        SELECT doc_id, coalesce(q, '') AS abs_quality, coalesce(t, '') AS abs_toxic FROM documents LEFT JOIN a ON k = '10.1/x' || doc_id""",
    "work_extract": """WITH g AS (SELECT conv_id AS c, array_to_string(list(role || ' ' || turn ORDER BY turn), '; ') AS authors, list(role ORDER BY turn) AS roles, list(CASE WHEN turn % 2 = 0 THEN 'ES' ELSE 'PE' END ORDER BY turn) AS codes FROM conversations GROUP BY 1),
        u AS (SELECT *, c % 6 NOT IN (2, 3) AS good, c % 6 = 3 AS gone, c % 3 = 0 OR (c % 4 = 0 AND c % 2 = 0) AS oa FROM g)
        SELECT c AS conv_id, CASE WHEN good THEN 'W' || c ELSE '' END AS work_work_id, CASE WHEN good THEN '10.1/' || c ELSE '' END AS work_doi, CASE WHEN gone THEN NULL ELSE good AND oa END AS work_is_oa,
        CASE WHEN gone THEN 'unknown' WHEN NOT good THEN 'closed' WHEN c % 4 = 0 THEN 'gold' WHEN oa THEN 'green' ELSE 'closed' END AS work_oa_status,
        CASE WHEN NOT good THEN '' WHEN c % 5 = 0 THEN 'http://b/' || c ELSE 'http://p/' || c END AS work_oa_url, CASE WHEN good THEN CAST(2000 + c % 20 AS INTEGER) END AS work_publication_year, CASE WHEN good THEN CAST(c % 13 AS INTEGER) END AS work_cited_by_count,
        CASE WHEN good THEN 'J' || (c % 7) ELSE '' END AS work_source_display_name, CASE WHEN good THEN authors ELSE '' END AS work_authors,
        CASE WHEN good THEN array_to_string([x FOR x, i IN roles IF list_position(roles, x) = i], '; ') ELSE '' END AS work_institution_names,
        CASE WHEN good THEN array_to_string([x FOR x, i IN codes IF list_position(codes, x) = i], '; ') ELSE '' END AS work_institution_country_codes,
        CASE WHEN gone THEN 'empty response' WHEN NOT good THEN 'not_found' ELSE '' END AS work_enrichment_error FROM u""",
    "json_extract": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.k'), '') AS k_text FROM events",
    "cache_compact": f"WITH {_CHANGES} SELECT key, arg_max(value, seq) AS value, max(seq) AS seq FROM changes WHERE NOT contains(error, '429') GROUP BY key",
    "cache_stream": f"WITH {_CHANGES} SELECT key, arg_max(value, seq) AS value, max(seq) AS seq FROM changes WHERE NOT contains(error, '429') GROUP BY key",
    "cache_pending": f"WITH {_CHANGES} SELECT DISTINCT key FROM changes WHERE key NOT IN (SELECT key FROM changes WHERE seq % 5 = 0 AND NOT contains(error, '429'))",
    "repair_overlay": f"""WITH {_CHANGES}, f AS (SELECT key, max(value) AS v FROM changes WHERE seq % 3 = 0 GROUP BY 1)
        SELECT seq, key, CASE WHEN contains(error, '429') AND v IS NOT NULL THEN v ELSE value END AS value, CASE WHEN contains(error, '429') AND v IS NOT NULL THEN '' ELSE error END AS error FROM changes LEFT JOIN f USING (key)""",
    "column_classes": """WITH n AS (SELECT event_id, CASE user_id % 9 WHEN 0 THEN 'openalex_' || event_type WHEN 1 THEN 'resumen_' || event_id WHEN 2 THEN 'palabras_clave' WHEN 3 THEN 'fuente_' || event_type
        WHEN 4 THEN 'project_title' WHEN 5 THEN 'result_type' WHEN 6 THEN 'match_method' WHEN 7 THEN event_type || '_resumen' ELSE event_type END AS name FROM events)
        SELECT event_id, name, CASE WHEN name LIKE 'openalex\\_%' ESCAPE '\\' THEN 'openalex' WHEN regexp_matches(name, '^(resumen|palabras_clave|fuente_)') THEN 'resumenes' WHEN name = 'project_title' THEN 'proyecto'
            WHEN name = 'result_type' THEN 'vri' WHEN name = 'match_method' THEN 'matching' ELSE 'otro' END AS kind FROM n""",
    "project_text": """SELECT p_partkey, concat_ws(' ', p_name, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END, p_type) AS project_text, concat_ws(' | ', p_type, CASE WHEN p_partkey % 4 <> 0 THEN p_name END) AS keywords FROM part""",
    "tfidf_relational": """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM documents), t AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE length(term) > 1 GROUP BY 1, 2),
        v AS (SELECT term, count(*) AS df FROM t GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 2000), n AS (SELECT count(*) AS n FROM documents),
        x AS (SELECT doc_id, term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS w FROM t JOIN v USING (term), n)
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""",
    "length_histogram": """WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents) SELECT CAST(least(coalesce(floor((n_chars - lo) * 30 / nullif(hi - lo, 0)) + 1, 1), 30) AS INTEGER) AS bin, count(*) AS n FROM documents, s GROUP BY 1""",
    "cluster_counts": "SELECT label, count(*) AS n FROM embeddings GROUP BY 1",
    "cluster_examples": "SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 2",
    "dataset_summary": "SELECT count(*) AS n_rows, count(DISTINCT source) AS n_sources, count(*) FILTER (coalesce(trim(text), '') = '') AS n_blank, CAST(max(length(text)) AS INTEGER) AS max_length FROM documents",
    "title_scores": f"WITH RECURSIVE {_CANDIDATES} SELECT project_id, publication_id, title_similarity FROM cand",
    "sequence_ratios": f"""WITH RECURSIVE q AS (SELECT x.p_name AS ta, y.p_name AS tb FROM (SELECT DISTINCT p_name FROM part WHERE p_partkey % 100 = 0) AS x, (SELECT DISTINCT p_name FROM part) AS y), {_matched("q")}
        SELECT ta AS p_name, tb AS other, 2.0::DOUBLE * coalesce(matched, 0) / (length(ta) + length(tb)) AS ratio FROM q LEFT JOIN ratios USING (ta, tb)""",
    "number_publications": "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS publication_id FROM documents",
}
