"""Text functions and scores against plain Python restatements and asserted examples."""

import random
import re
import sys
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from rillstone.functions import similarity as sim
from rillstone.functions import text as tx


def rows(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expression.alias("x")).orderBy("i").select("x").collect()]


def plain(x):
    folded = "".join(c for c in unicodedata.normalize("NFKD", (x or "").strip().upper()) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub("[^A-Z0-9 ]+", " ", folded)).strip()


def test_normalize_text(spark):
    pick = random.Random(1)
    letters = "aáàâäãåçéèêëíìîïñóòôöõúùûüýÿžšćßøœ ABZ09-–.,;:!?\t\n ´`^~¡¿é"
    values = [None, "", "  ", "Straße", "Áéí Ñandú", "a.b,c"] + ["".join(pick.choices(letters, k=pick.randint(0, 30))) for _ in range(400)]
    values = [v for v in values if v is None or not set(v) & set("´`")]  # stand-alone accents decompose to a space and a mark
    assert rows(spark, values, tx.normalize_text("v")) == [plain(v) for v in values]


def test_identifiers(spark):
    values = ["https://doi.org/10.1/ABC", "doi: 10.2/x ", "-", None, " HTTP://DX.DOI.ORG/10.3/y. ", "https://doi.org/https://doi.org/10.4/z", "nan", " 10.5/q;"]
    assert rows(spark, values, tx.normalize_doi("v", wide=True)) == ["10.1/abc", "10.2/x", "", "", "10.3/y", "10.4/z", "", "10.5/q"]
    assert rows(spark, values, tx.normalize_doi("v"))[:6] == ["10.1/abc", "doi: 10.2/x", "", "", "10.3/y", "10.4/z"]
    once = tx.normalize_doi("v")
    assert rows(spark, values, once) == rows(spark, rows(spark, values, once), once)


def test_every_character_folds_as_in_python(spark):
    codes = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    pick = random.Random(8)
    shown = [chr(c) for c in codes if plain(chr(c))]
    names = ["Nguyễn Văn Thắng", "Ａ２", "CO² m³", "½ ⑩ №5 ŉ Straße ǅ"] + ["".join(pick.choice(shown) if pick.random() < 0.5 else pick.choice("abc  1-é") for _ in range(12)) for _ in range(10_000)]
    texts = ["a" + chr(c) + "b" for c in codes] + names
    got = spark.createDataFrame([(t,) for t in texts], "v string").select("v", tx.normalize_text("v").alias("n")).collect()
    assert [(r.v, r.n) for r in got if r.n != plain(r.v)] == []


def test_names_lists_and_keys(spark):
    assert rows(spark, ["Pérez, Ana", "Ana", "", None, ",", "A, B, C"], tx.name_aliases("v")) == [["PEREZ ANA", "ANA PEREZ"], ["ANA"], [], [], [], ["A B C", "B C A"]]
    assert rows(spark, ["a| b ||-", None, ""], tx.split_list("v")) == [["a", "b", "-"], [], []]
    assert rows(spark, ["a| b ||-"], tx.split_list("v", drop=["-"])) == [["a", "b"]]
    both = spark.createDataFrame([("A||B", "1||3"), ("A|B|C", "-| 2 "), (None, "1"), ("A", None)], "n string, i string").select(*tx.split_aligned("n", "i"))
    assert [tuple(r) for r in both.collect()] == [(["A", "B"], ["1", "3"]), (["A", "B", "C"], ["", "2", ""]), ([], []), (["A"], [""])]
    assert rows(spark, ["1|-|3"], tx.at(tx.split_list("v"), F.lit(9))) == [""]
    df = spark.createDataFrame([("10.1/ABC", "x"), ("", "Hello   World"), ("-", ""), (None, None)], "d string, t string")
    assert [r[0] for r in df.select(tx.cache_key("d", "t")).collect()] == ["doi:10.1/abc", "title:hello world", "", ""]
    urls = [r[0] for r in spark.createDataFrame([(None, "A study about open science"), ("10.1/A", "x"), (None, "A b/c~*")], "d string, t string").select(tx.work_query("d", "t")).collect()]
    assert "search.exact" in urls[0] and "A%20study%20about%20open%20science" in urls[0] and urls[1].endswith("doi:10.1/a") and "A%20b/c~%2A" in urls[2]
    assert rows(spark, ["", "-", "no aplica", " T "], tx.hint("v")) == ["", "", "", "T"]
    assert rows(spark, ["Alta", " media", "BAJA", "x"], tx.map_level("v")) == ["high", "medium", "low", "x"]
    names = ["project_id", "result_title", "publication_id", "openalex_cited_by_count", "resumen", "palabras_clave", "totally_unknown"]
    assert rows(spark, names, tx.column_class("v")) == ["proyecto", "vri", "matching", "openalex", "resumenes", "resumenes", "otro"]


def test_publication_key(spark):
    df = spark.createDataFrame([("10.1/a", "T", 2000), ("", "T", None), ("", "", 7)], "d string, t string, y int")
    assert [r[0] for r in df.select(tx.publication_key("d", "t", "y")).collect()] == ["doi:10.1/a", "titleyear:T|", "titleyear:|7"]


def test_title_score(spark):
    pick = random.Random(2)
    words = ["DATA", "OPEN", "SCIENCE", "RIVER", "FLOW", "THE", "AN", "MODEL", "TIDE", "DIET"]
    titles = ["", "TIDE", "DIET"] + [" ".join(pick.choices(words, k=pick.randint(1, 40))) for _ in range(60)]
    pairs = [(pick.choice(titles), pick.choice(titles)) for _ in range(150)] + [("TIDE", "DIET"), ("DIET", "TIDE"), ("", "X")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").withColumn("ta", tx.tokens("a")).withColumn("tb", tx.tokens("b"))
    got = {r.i: r.title_similarity for r in sim.with_title_score(df, "a", "b", "ta", "tb").collect()}
    keep = lambda t: {w for w in t.split() if len(w) > 2 and w not in tx.STOPWORDS}
    for i, (a, b) in enumerate(pairs):
        x, y = keep(a), keep(b)
        jac = len(x & y) / len(x | y) if x and y else 0.0
        seq = SequenceMatcher(None, a, b).ratio() if a and b else 0.0
        assert got[i] == round(max(0.5 * seq, jac), 4)


def test_score_confidence_and_evidence(spark):
    df = spark.createDataFrame([(0, True, True, True, 1.0), (4, False, False, False, 0.0), (None, False, False, False, 0.5), (2, True, False, False, 0.125)], "d int, r boolean, s boolean, w boolean, t double")
    args = [F.col(c) for c in "drswt"]
    out = df.select(sim.candidate_score(*args).alias("score"), sim.evidence(*args).alias("e")).withColumn("c", sim.confidence(F.col("score"))).collect()
    assert [(r.score, r.c) for r in out] == [(130.0, "Alta"), (62.0, "Baja"), (62.5, "Baja"), (86.12, "Alta")]
    assert out[0].e == "responsable_autor | publicado_mismo_anio | fuente_RI | fuente_SCOPUS | fuente_WOS | similitud_tematica_1.00"
    assert out[2].e == "responsable_autor | similitud_tematica_0.50"


def test_points_and_labels_round_as_python_does(spark):
    df = spark.range(10_001).select((F.col("id") / 10_000).alias("t")).withColumns({"d": F.lit(None).cast("int"), "f": F.lit(False)})
    got = df.select("t", sim.candidate_score(F.col("d"), *[F.col("f")] * 3, F.col("t")).alias("s"), sim.evidence(F.col("d"), *[F.col("f")] * 3, F.col("t")).alias("e")).collect()
    assert [(r.s, r.e) for r in got] == [(round(50 + round(r.t * 25, 2), 2), "responsable_autor" + (f" | similitud_tematica_{r.t:.2f}" if r.t >= 0.2 else "")) for r in got]


def test_percent_rounds_halves_up(spark):
    df = spark.createDataFrame([(1, 800), (250, 8782), (250, 382), (0, 0), (1, 3)], "n long, d long")
    assert [r[0] for r in df.select(sim.half_up_percent(F.col("n"), F.col("d"))).collect()] == [0.13, 2.85, 65.45, 0.0, 33.33]
