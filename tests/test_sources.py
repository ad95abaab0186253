"""Files, workbooks, the service client and the streaming cache."""

import json
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from rillstone.sources import files, rest, xlsx
from rillstone.streaming import cache, progress


def test_csv_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b', [1, 2]), (2, "", None)], "id int, t string, l array<int>")
    files.write_csv(df, str(tmp_path / "c"))
    back = {r.id: r for r in files.read_csv_text(spark, str(tmp_path / "c")).collect()}
    assert back["1"].t == 'a "q", b' and back["1"].l == "[1,2]" and back["2"].t == ""
    assert files.csv_columns(spark, str(tmp_path / "c")) == ["id", "t", "l"] and dict(files.read_csv(spark, str(tmp_path / "c")).dtypes)["id"] == "int"
    assert files.resolve_column(df, " ID ") == "id" and files.resolve_column(df, "none") is None
    files.write_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception, match="exist"):
        files.write_table(df, str(tmp_path / "t"))
    files.write_table(df.limit(1), str(tmp_path / "t"), replace=True)
    assert files.read_table(spark, str(tmp_path / "t"), ["id"], "id > 0").count() == 1


def test_discovery_env_and_summary(tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "other.csv").write_text("Resumen,DOI\n")
    assert files.find_abstracts(str(tmp_path)).endswith("other.csv")
    (tmp_path / "x" / "doi-resultados-1.csv").write_text("a\n")
    assert files.find_abstracts(str(tmp_path)).endswith("doi-resultados-1.csv")
    (tmp_path / ".env").write_text("# c\nA=1\nB='2'\n")
    assert files.load_env(str(tmp_path / ".env"), {"A": "0"}) == {"A": "0", "B": "2"}
    files.update_summary(str(tmp_path / "s.json"), {"a": 1, "b": 2})
    assert files.update_summary(str(tmp_path / "s.json"), {"b": 3}) == {"a": 1, "b": 3}


def test_typed_csv_knows_missing_values(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a,b,c,d\n1,NA,x,true\n,2.5,NULL,\nnan,3,None,false\n")
    for multi_line in (True, False):
        df = files.read_csv(spark, str(tmp_path / "n.csv"), multi_line=multi_line)
        assert dict(df.dtypes) == {"a": "int", "b": "double", "c": "string", "d": "boolean"}
        assert [tuple(r) for r in df.collect()] == [(1, None, "x", True), (None, 2.5, None, None), (None, 3.0, None, False)]
    assert files.read_csv(spark, str(tmp_path / "n.csv"), "a long, b double, c string, d string").first().a == 1


def test_summary_and_reports_on_sparks_file_systems(spark, tmp_path):
    path = f"file://{tmp_path}/new/s.json"
    files.update_summary(path, {"a": "é"}, spark)
    assert files.update_summary(path, {"b": 1}, spark) == {"a": "é", "b": 1} == json.loads((tmp_path / "new" / "s.json").read_text())
    df = spark.range(30)
    assert files.markdown_report("t", [("s", df)]).count("| ") == 31 and "The first 3 of 30 rows." in files.markdown_report("t", [("s", df)], 3)


def test_pacing_from_the_environment():
    assert rest.Pacing.from_env({"OPENALEX_MAX_RETRIES": "7", "OPENALEX_RATE_LIMIT_SECONDS": "0.5"}) == rest.Pacing(rate=0.5, attempts=7)
    assert rest.Pacing.from_env({}) == rest.Pacing()


def test_changelogs_over_several_files(spark, tmp_path):
    for name, x in (("b", 2), ("a", 1), ("c", 3)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(f'{{"key": "k", "result": {{"x": {10 * x + i}}}}}' for i in range(3)) + "\n" * (50 * (4 - x)))
    rows = files.read_jsonl_cache(spark, str(tmp_path), "struct<x: int>").orderBy("seq").collect()
    assert [r.result.x for r in rows] == [10, 11, 12, 20, 21, 22, 30, 31, 32]


def test_jsonl_cache_skips_what_it_cannot_use(spark, tmp_path):
    lines = ['{"key": "a", "result": {"x": 1}}', "", "{broken", '{"result": {"x": 5}}', '{"key": "a", "result": {"x": 2}}']
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    rows = files.read_jsonl_cache(spark, str(tmp_path / "c.jsonl"), "struct<x: int>").orderBy("seq").collect()
    assert [(r.key, r.result.x) for r in rows] == [("a", 1), ("a", 2)]
    files.write_jsonl(spark.createDataFrame([(1, "é")], "k int, v string"), str(tmp_path / "o"))
    assert [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "o")).collect()] == [{"k": 1, "v": "é"}]


def test_workbooks(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    df = spark.createDataFrame([(1, "t & <x>", True, None), (2, "é", None, "r")], "project_id int, result_title string, openalex_is_oa boolean, resumen string")
    classes = {"project_id": "proyecto", "result_title": "vri", "openalex_is_oa": "openalex", "resumen": "resumenes"}
    xlsx.write_styled(df, path, classes, "A title that is much longer than a sheet may have")
    with zipfile.ZipFile(path) as z:
        styles, sheet, book = (z.read(f"xl/{n}").decode() for n in ("styles.xml", "worksheets/sheet1.xml", "workbook.xml"))
    assert all(f"FF{xlsx.STYLES[c][0]}" in styles for c in classes.values()) and "Leyenda" in book and 'state="frozen"' in sheet and "autoFilter" in sheet
    assert len({sheet.split(f'r="{c}1"')[1].split('s="')[1].split('"')[0] for c in "ABCD"}) == 4
    spark.dataSource.register(xlsx.XlsxSource)
    back = spark.read.format("xlsx").load(path).orderBy("row_index").collect()
    assert [(r.project_id, r.result_title, r.openalex_is_oa, r.resumen) for r in back] == [("1", "t & <x>", "True", None), ("2", "é", None, "r")]
    assert spark.read.format("xlsx").option("sheet", "Leyenda").load(path).count() == len(xlsx.STYLES) - 1
    with pytest.raises(ValueError):
        xlsx.write_styled(df, path, classes, most=1)


def test_client_waits_and_gives_up():
    waits, calls = [], []

    def answers(*script):
        left = list(script)

        def get(url, timeout):
            calls.append(url)
            step = left.pop(0)
            if isinstance(step, Exception):
                raise step
            return step

        return get

    error = lambda code, told=None: urllib.error.HTTPError("u", code, "m", {"Retry-After": told} if told else {}, None)
    pace = rest.Pacing(rate=1, jitter=0)
    assert rest.fetch_one("u", answers(error(429, "7"), TimeoutError("timed out"), "ok"), pace, waits.append) == ("ok", "") and waits == [7, 2, 1]
    assert rest.fetch_one("u", answers(error(404)), pace, waits.append) == (None, "HTTP Error 404: m")
    assert rest.fetch_one("u", answers(*[error(429)] * 4), pace, waits.append)[1].endswith("after retries") and len(calls) == 8


def test_fetch_runs_in_tasks(spark):
    got = rest.fetch(spark.createDataFrame([("k", "u"), ("l", "")], "key string, url string"), get=lambda u, t: "{}", pacing=rest.Pacing(0, 0))
    assert {(r.key, r.payload, r.error) for r in got.collect()} == {("k", "{}", ""), ("l", None, "no query")}


def test_streamed_cache_resumes(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "cache", "mark"))
    seen = []

    def fetch(df):
        keys = sorted(r.key for r in df.collect())
        seen.append(keys)
        return df.select("key", F.lit("{}").alias("payload"), F.when(F.col("key") == "bad", "HTTP Error 429").otherwise("").alias("error"))

    for keys in (["a", "bad", "a"], ["a", "b", "bad"]):
        spark.createDataFrame([(k,) for k in keys], "key string").coalesce(1).write.mode("append").parquet(source)
        query = cache.enrich_stream(spark.readStream.schema("key string").parquet(source), table, mark, fetch)
        assert query.awaitTermination(120) and query.exception() is None
    assert seen == [["a", "bad"], ["b", "bad"]]
    assert {r.key for r in cache.read_cache(spark, table).collect()} == {"a", "b"}


def test_windows(spark):
    events = spark.createDataFrame([("2024-01-01 00:10:00", "x"), ("2024-01-01 00:50:00", "x"), ("2024-01-01 01:10:00", "y")], "ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in cache.windowed_counts(events).collect()) == [1, 2]


def test_report(spark):
    text = files.markdown_report("T", [("S", spark.createDataFrame([(1, None)], "a int, b string"))])
    assert "# T" in text and "| 1 |  |" in text


def test_progress_counts_in_tasks(spark):
    now = [0.0]
    bar = progress.Progress(spark, 10, lambda: now[0])

    def work(frames):
        for f in frames:
            for k in f["id"]:
                bar.add(cached=k % 2 == 0, error=k == 3)
            yield f

    spark.range(5).mapInPandas(work, "id long").write.format("noop").mode("overwrite").save()
    now[0] = 5.0
    assert bar.line() == "5/10 (50 %), cached 3, errors 1, 5 s left"


def test_folders_are_made_anew(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f").write_text("x")
    files.recreate_folder(spark, str(tmp_path / "d"))
    assert list((tmp_path / "d").iterdir()) == []


def test_enrichment_goes_on_where_it_was_killed(spark, tmp_path):
    """Answers of finished batches stand; passing errors are asked for again, lasting ones aren't."""
    folder, log = str(tmp_path / "enrichment"), tmp_path / "asked"
    log.mkdir()
    requests = spark.createDataFrame([(f"k{i}", f"u{i}") for i in range(6)] + [("k0", "u0"), ("", "x"), ("none", "")], "key string, url string")

    def get(url, timeout):
        n = len(list(log.iterdir()))
        (log / f"{n:03d}-{url}").touch()
        if n == 3:
            raise RuntimeError("killed")  # no error of the service: the task and the run end
        if url == "u1" and n < 6:
            raise TimeoutError("timed out")
        if url == "u5":
            raise urllib.error.HTTPError(url, 404, "gone", None, None)
        return "{}"

    ask = cache.durable_fetch(folder, get, rest.Pacing(0, 0, attempts=1), batch=1)
    with pytest.raises(Exception, match="killed"):
        ask(requests)
    before = [p.name[4:] for p in sorted(log.iterdir())]
    got = {r.key: (r.payload, r.error) for r in ask(requests).collect()}
    after = [p.name[4:] for p in sorted(log.iterdir())][4:]
    assert len(before) == 4 and before[:3] == ["u0", "u1", "u2"]
    assert sorted(set(after)) == ["u1", "u3", "u4", "u5"] and len(after) == 4  # u1's error was passing
    assert got == {"k0": ("{}", ""), "k1": ("{}", ""), "k2": ("{}", ""), "k3": ("{}", ""), "k4": ("{}", ""), "k5": (None, "HTTP Error 404: gone"), "none": (None, "no query")}
    more = requests.unionByName(spark.createDataFrame([("k9", "u9")], "key string, url string"))
    assert len(ask(more).collect()) == 8 and [p.name[4:] for p in sorted(log.iterdir())][8:] == ["u9"]
