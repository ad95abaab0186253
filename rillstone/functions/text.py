"""Normalization of titles, names and identifiers as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Letters and digits behind characters beyond ASCII, by compatibility decomposition without combining marks.

    Characters to replace (those without counterpart go) and their replacements, and characters that stand for several.
    """
    one, gone, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        parts = [p for p in unicodedata.normalize("NFKD", c) if not unicodedata.combining(p)]
        plain = "".join(p if p.isascii() and (p.isupper() or p.isdigit()) else " " for p in parts)
        if not plain:
            gone.append(c)
        elif len(plain) == 1 and plain != " ":
            one.append((c, plain))
        elif plain.strip():
            many[c] = plain
    return "".join(c for c, _ in one) + "".join(gone), "".join(p for _, p in one), many


@cache
def _latin_folds() -> tuple[str, str]:
    """The part of ``_folds`` for Latin letters and common punctuation, which turns into spaces: most texts need no more."""
    old, new, many = _folds()
    table = {c: new[k : k + 1] for k, c in enumerate(old)}
    some = [c for c in map(chr, [*range(0x80, 0x250), *range(0x2000, 0x2070)]) if c not in many]
    some.sort(key=lambda c: table.get(c, " ") == "")  # those that go come last
    return "".join(some), "".join(table.get(c, " ") for c in some)


#: Words of no weight in titles (Spanish and English).
STOPWORDS = """
de del la el los las y e en para por con sin un una unos unas the and of in on for to a an from via as at into
sobre entre hacia desde mediante frente al ante que se su sus or o
""".upper().split()


#: White space as in Java's expressions, and the no-break space.
SPACES = " \t\n\x0b\f\r\u00a0"


def strip(c: ColumnLike) -> Column:
    """The text without white space at its ends (all kinds, while ``trim`` knows spaces only)."""
    return F.btrim(_col(c), F.lit(SPACES))


def blank_to_null(c: ColumnLike, placeholders: Iterable[str] = ("",)) -> Column:
    """Null for placeholders (compared after stripping, ignoring case), else the text as it is."""
    return F.when(~F.lower(strip(c)).isin([p.lower() for p in placeholders]), _col(c))


def normalize_text(c: ColumnLike) -> Column:
    """Upper case without accents; all but A-Z, 0-9 becomes single spaces; null becomes ''.

    Accents and other forms fold by a table built by rule, so that no text leaves the JVM. Characters that stand for
    several (fractions, numbers in circles) are looked up one by one, in the texts that have other letters left.
    """
    old, new, many = _folds()
    upper = F.upper(F.coalesce(_col(c), F.lit("")))
    table = F.str_to_map(F.lit(";".join(f"{a}:{b}" for a, b in many.items())), F.lit(";"), F.lit(":"))  # folded when planned
    beyond = lambda x: F.octet_length(x) > F.char_length(x)
    latin = F.translate(upper, *_latin_folds())
    spelt = F.array_join(F.transform(F.split(upper, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    plain = F.when(beyond(upper), F.when(beyond(latin), F.translate(spelt, old, new)).otherwise(latin)).otherwise(upper)
    return F.trim(F.regexp_replace(plain, "[^A-Z0-9]+", " "))


def normalize_doi(c: ColumnLike, wide: bool = False) -> Column:
    """A DOI without address and case; placeholders become ''.

    ``wide`` also takes off a ``doi:`` mark and spaces, semicolons and commas at the end. Repeated addresses go in one
    step, so that normalizing twice changes nothing.
    """
    lowered = F.lower(strip(F.coalesce(_col(c), F.lit(""))))
    known = F.when(lowered.isin("", "-", "nan", "none"), "").otherwise(lowered)
    if wide:
        return F.regexp_replace(strip(F.regexp_replace(known, r"^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)+", "")), r"[ .;,]+$", "")
    return F.regexp_replace(strip(F.regexp_replace(known, r"^(?:https?://(?:dx\.)?doi\.org/)+", "")), r"\.+$", "")


def name_aliases(c: ColumnLike) -> Column:
    """Distinct non-blank spellings of a name: as it stands, and 'Last, First' turned round."""
    parts = F.split(_col(c), ",", 2)
    turned = F.when(F.instr(_col(c), ",") > 0, normalize_text(F.concat_ws(" ", F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))).otherwise("")
    return F.array_distinct(F.filter(F.array(normalize_text(c), turned), lambda x: x != ""))


def split_list(c: ColumnLike, sep: str = "|", drop: Iterable[str] = ()) -> Column:
    """Stripped, non-blank parts of a list in text; parts in ``drop`` go, too."""
    gone = ["", *drop]
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), f"[{sep}]"), strip), lambda x: ~x.isin(gone))


def aligned_pairs(names: ColumnLike, ids: ColumnLike, sep: str = "|") -> Column:
    """The non-blank parts of a list of names, each with the part at its place in a list of ids, both as they stand."""
    texts = [F.coalesce(_col(c), F.lit("")) for c in (names, ids)]
    pairs = F.arrays_zip(*(F.split(t, f"[{sep}]") for t in texts))  # fields by position
    blank = texts[0].rlike(rf"(?:^|[{sep}])[{SPACES}]*+(?:[{sep}]|\z)")  # filters evaluate element by element, so only where needed
    beyond = F.size(F.split(texts[1], f"[{sep}]")) > F.size(F.split(texts[0], f"[{sep}]"))
    return F.when(blank | beyond, F.filter(pairs, lambda x: strip(F.coalesce(x["0"], F.lit(""))) != "")).otherwise(pairs)


def aligned_name(pair: Column) -> Column:
    """The name of an element of ``aligned_pairs``."""
    return strip(pair["0"])


def aligned_id(pair: Column) -> Column:
    """The id of an element of ``aligned_pairs``."""
    found = strip(pair["1"])
    return F.when(found.isNull() | found.isin("-", ""), "").otherwise(found)


def split_aligned(names: ColumnLike, ids: ColumnLike, sep: str = "|") -> tuple[Column, Column]:
    """The non-blank parts of a list of names, and for each the part at its place in a list of ids; '-' and blanks there are ''."""
    pairs = aligned_pairs(names, ids, sep)
    return F.transform(pairs, aligned_name), F.transform(pairs, aligned_id)


def at(array: Column, position: ColumnLike) -> Column:
    """Element at a position from 0, '' beyond the end."""
    return F.coalesce(F.get(array, _col(position)), F.lit(""))


def publication_key(doi: ColumnLike, title_norm: ColumnLike, year: ColumnLike) -> Column:
    """'doi:...' where there is a DOI, else 'titleyear:<title>|<year>'."""
    return F.when(_col(doi) != "", F.concat(F.lit("doi:"), _col(doi))).otherwise(F.concat(F.lit("titleyear:"), _col(title_norm), F.lit("|"), F.coalesce(_col(year).cast("string"), F.lit(""))))


def cache_key(doi: ColumnLike, title: ColumnLike) -> Column:
    """Key of a lookup request: by DOI, else by title with single spaces, else ''."""
    d = F.lower(strip(F.coalesce(_col(doi), F.lit(""))))
    t = F.lower(F.regexp_replace(strip(F.coalesce(_col(title), F.lit(""))), r"\s+", " "))
    missing = ["", "-", "nan", "none"]
    return F.when(~d.isin(missing), F.concat(F.lit("doi:"), d)).when(~t.isin(missing), F.concat(F.lit("title:"), t)).otherwise("")


def percent_encode(c: ColumnLike) -> Column:
    """Percent-encoding that keeps letters, digits, '_.-~/'."""
    out = F.url_encode(_col(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def work_query(doi: ColumnLike, title: ColumnLike, base: str = "https://api.openalex.org/works", extra: str = "") -> Column:
    """Address of one work: by DOI, else by exact title; '' without either. ``extra``: further encoded parameters."""
    d, t = F.lower(strip(F.coalesce(_col(doi), F.lit("")))), strip(F.coalesce(_col(title), F.lit("")))
    by_doi = F.concat(F.lit(f"{base}/doi:"), d, F.lit(f"?{extra}" if extra else ""))
    by_title = F.concat(F.lit(f"{base}?search.exact="), percent_encode(t), F.lit("&per-page=1" + (f"&{extra}" if extra else "")))
    return F.when(~d.isin("", "-", "nan", "none"), by_doi).when(t != "", by_title).otherwise("")


def tokens(title_norm: ColumnLike) -> Column:
    """Distinct words of a normalized title, of three letters or more and no stopwords."""
    return F.array_distinct(F.filter(F.split(_col(title_norm), " "), lambda t: (F.length(t) > 2) & ~t.isin(STOPWORDS)))


def join_text(*cols: ColumnLike) -> Column:
    """Stripped non-blank parts joined by a space."""
    return F.concat_ws(" ", *(F.nullif(strip(c), F.lit("")) for c in cols))


def join_keywords(*cols: ColumnLike) -> Column:
    """Non-blank parts joined by ' | '."""
    return F.concat_ws(" | ", *(blank_to_null(strip(c), ("", "-", "nan")) for c in cols))


def hint(c: ColumnLike) -> Column:
    """A title or DOI for a lookup: placeholders give ''."""
    return F.when(F.upper(strip(F.coalesce(_col(c), F.lit("")))).isin("", "-", "NO APLICA"), "").otherwise(strip(c))


def map_level(c: ColumnLike) -> Column:
    """Confidence labels in English: Alta, Media, Baja."""
    level = F.lower(strip(c))
    return F.when(level == "alta", "high").when(level == "media", "medium").when(level == "baja", "low").otherwise(level)


def snippet(c: ColumnLike, n: int) -> Column:
    """The first ``n`` characters in one line."""
    return F.substring(F.regexp_replace(_col(c), r"\r?\n", " "), 1, n)


def serialize(c: ColumnLike, kind: str) -> Column:
    """A value for a text file: nested values as JSON, others as text; ``kind`` is the column's type."""
    return F.to_json(_col(c)) if kind.startswith(("struct", "array", "map")) else _col(c).cast("string")


#: Beginnings of column names and the class of their source, tried in order.
COLUMN_PREFIXES = [("openalex_", "openalex"), ("resumen", "resumenes"), ("palabras_clave", "resumenes"), ("fuente_", "resumenes")]
#: Column names by class.
COLUMN_CLASSES = {
    "proyecto": ["project_id", "cod_aeri", "codigo_campus", "project_year", "project_title", "coordinator_original"],
    "vri": ["cod_prod", "result_type", "result_category", "result_title", "result_other", "result_year", "equivalencia", "doi_raw", "doi_norm", "issn_raw", "isbn_raw", "result_status", "result_evidence", "scopus_eid", "journal_raw", "quartile_raw", "citation_raw", "citation_fw_raw", "citation_fa_raw", "citation_policy_raw", "call_name", "result_idperson", "result_coordinator", "result_is_publication_like"],
    "matching": ["publication_id", "match_method"],
}


def column_class(name: ColumnLike) -> Column:
    """Class of a column by its name: prefixes first, then whole names, else 'otro'."""
    out = None
    for prefix, kind in COLUMN_PREFIXES:
        out = F.when(_col(name).startswith(prefix), kind) if out is None else out.when(_col(name).startswith(prefix), kind)
    for kind, names in COLUMN_CLASSES.items():
        out = out.when(_col(name).isin(names), kind)
    return out.otherwise("otro")
