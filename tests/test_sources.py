"""Readers, writers and streams, by round trip."""

import datetime

from pyspark.sql import functions as F

from lodestream.functions import vocabulary as V
from lodestream.plans import catalog
from lodestream.sources import sinks, tables
from lodestream.streaming import state


def test_headers():
    assert tables.resolve_header(["KEYID", "COMPANY_NAME", "COUNTRY", "ENTITY_TYPE", "WEBSITE"]) == (1, 4, 2, True)
    assert tables.resolve_header(["Acme", "acme.com", "USA"]) == (0, 1, 2, False)
    assert tables.resolve_header(["foo", "Web Site URL"]) == (0, 1, None, True)


def test_companies(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Company Name,Website,Country\n"Acme, Inc",acme.com,USA\n,x.com,USA\nBeta,,\n', encoding="utf-8")
    (tmp_path / "b.tsv").write_text("Acme\tacme.com\tUSA\n")
    (tmp_path / "c.csv").write_text("")
    rows = tables.read_companies(spark, str(tmp_path / "a.csv")).orderBy("row_idx").collect()
    assert [(r.name, r.website, r.country) for r in rows] == [("Acme, Inc", "acme.com", "USA"), ("Beta", "", "")]
    assert tables.read_companies(spark, str(tmp_path / "b.tsv")).first().name == "Acme"
    assert tables.read_companies(spark, str(tmp_path / "c.csv")).count() == 0


def test_xlsx_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.xlsx")
    df = spark.createDataFrame([("Acme & Co", "acme.com", "USA"), ("Beta", None, "Spain")], "company_name string, website string, country string")
    sinks.write_xlsx({"first": df, "second": df}, path)
    rows = tables.read_companies(spark, path).orderBy("row_idx").collect()
    assert [(r.name, r.website, r.country) for r in rows] == [("Acme & Co", "acme.com", "USA"), ("Beta", "", "Spain")]


def test_append_migrate_purge(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"c{i}", ["Active", "Unreachable"][i % 2], "extra") for i in range(40)], "company_name string, job_status string, other string")
    sinks.append(rows, path)
    got = tables.read_strings(spark, path)
    assert got.columns == V.OUTPUT_COLUMNS and got.count() == 40
    assert sinks.purge_file(spark, path) == 20 and tables.read_strings(spark, path).count() == 20
    assert sinks.purge_file(spark, path) == 0
    assert sinks.migrate_file(spark, path, ["company_name", "new"]) and not sinks.migrate_file(spark, path, ["company_name", "new"])
    assert tables.read_strings(spark, path).columns == ["company_name", "new"]
    assert tables.read_snapshot(spark, str(tmp_path / "absent"))[0] is None


def test_result_log(spark, tmp_path):
    log, mark, bad = (str(tmp_path / x) for x in ("log", "mark", "bad"))
    for batch in ([("a", "1", None), ("b", None, "boom")], [("a", "2", None)]):
        sinks.append_results(spark.createDataFrame(batch, "row_id string, result string, error string").coalesce(1), log, mark, bad)
    (tmp_path / "log" / "broken.txt").write_text("not json\n")
    assert [r.row_id for r in tables.read_results(spark, log).collect()] == ["a"]
    assert [r.row_id for r in tables.read_checkpoint(spark, mark).collect()] == ["a"]
    assert tables.read_strings(spark, bad).first().error == "boom"
    xml = F.lit("<item><title>x</title><link> https://a </link></item><item><link>b</link></item>")
    assert spark.range(1).select(tables.rss_links(xml).alias("x")).first().x == ["https://a", "b"]


def test_last_result_counts_whatever_the_files(spark, tmp_path):
    """The newer file is the larger one, which Spark reads first; and lines of before the time of batches was logged."""
    log, mark, bad = (str(tmp_path / x) for x in ("log", "mark", "bad"))
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part-z.json").write_text('{"row_id": "a", "result": "OLDEST"}\n{"row_id": "b", "result": "only"}\n')
    for result, n in (("OLD", 1), ("NEW", 20_000)):
        rows = spark.createDataFrame([("a", result, None)] + [(f"x{i}", "y" * 20, None) for i in range(n)], "row_id string, result string, error string").coalesce(1)
        sinks.append_results(rows, log, mark, bad)
    got = {r.row_id: r.result for r in tables.read_results(spark, log).where("row_id in ('a', 'b')").collect()}
    assert got == {"a": "NEW", "b": "only"}


def test_replacement_survives_a_crash(spark, tmp_path, monkeypatch):
    from lodestream import storage

    path = str(tmp_path / "out")
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "company_name string")
    names = lambda: sorted(r.company_name for r in tables.read_strings(spark, path).collect())
    sinks.replace(frame("a"), path)
    assert names() == ["a"]

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "swap", crash)  # before the commit: the old one stays
    for _ in range(2):
        try:
            sinks.replace(frame("b"), path)
        except RuntimeError:
            assert names() == ["a"]
    monkeypatch.undo()
    monkeypatch.setattr(storage, "settle", crash)  # after it: the next reader finds the new one
    try:
        sinks.replace(frame("c", "d"), path)
    except RuntimeError:
        assert names() == ["c", "d"]
    # between the removal of the old folder and the renaming of the new one
    try:
        sinks.replace(frame("e"), path)
    except RuntimeError:
        pass
    monkeypatch.undo()
    where, fs = storage.file_system(spark, path)
    fs.delete(where, True)
    assert names() == ["e"] and not (tmp_path / "out.swap").exists()


def test_command_lines(spark, tmp_path):
    """From a list and captured pages to rows, sheets, a second look and an audit; a second run adds nothing."""
    from lodestream.__main__ import main

    (tmp_path / "list.csv").write_text("KEYID,COMPANY_NAME,COUNTRY,WEBSITE,ID_Company,DUNS_NUMBER,PARTY_NAME\n1,Acme,Germany,https://a.com,i,d,P\n2,Beta,USA,https://b.com,i,d,P\n")
    ld = '<script type="application/ld+json">[{"@type": "JobPosting", "title": "Head of Sales", "url": "https://a.com/j/1"}]</script>'
    site = {"https://a.com": '<a href="/careers">Careers</a>', "https://a.com/careers": ld, "https://b.com": "hello"}
    spark.createDataFrame(list(site.items()), "url string, html string").write.parquet(str(tmp_path / "pages"))
    at = lambda name: str(tmp_path / name)
    for _ in range(2):
        main(["run", "--companies", at("list.csv"), "--pages", at("pages"), "--output", at("out")])
    rows = tables.read_strings(spark, at("out"))
    assert sorted((r.company_name, r.job_title, r.job_status) for r in rows.collect()) == [("Acme", "Head of Sales", "Active"), ("Beta", "", "Career Page Not Found")]
    main(["export", "--companies", at("list.csv"), "--scraped", at("out"), "--output", at("sheets"), "--workbook", at("book.xlsx")])
    assert {r.KEYID: r.status for r in tables.read_strings(spark, at("sheets/coverage")).collect()} == {"1": "Jobs Found", "2": "Career Page Not Found"}
    spark.createDataFrame([("https://a.com/j/1", 404, "https://a.com/j/1", "", False)], "job_url string, http_status int, final_url string, visible string, has_posting boolean").write.parquet(at("seen"))
    main(["recheck", "--rows", at("out"), "--responses", at("seen"), "--as-of", "2026-01-10"])
    assert {r.job_status for r in tables.read_strings(spark, at("out")).collect()} == {"Closed", "Career Page Not Found"}
    main(["audit", "--rows", at("out"), "--column", "job_status", "--counted", "company_name"])
    spark.createDataFrame([("1", "x", "{}"), ("2", "x", "no")], "row_id string, text string, answer string").write.parquet(at("answers"))
    main(["extract", "--answers", at("answers"), "--log", at("log"), "--checkpoint", at("mark"), "--errors", at("bad")])
    assert [r.row_id for r in tables.read_results(spark, at("log")).collect()] == ["1"]


def stream(spark, tmp_path, rows):
    """The rows as a stream of one file per batch."""
    schema = "key string, ts timestamp, event_id long, failed boolean"
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def drain(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_stateful_streams(spark, tmp_path):
    rows = [("a", at(i), i, True) for i in range(5)] + [("a", at(100), 5, False), ("a", at(400), 6, False), ("b", at(0), 7, False)]
    df = stream(spark, tmp_path, [rows])
    allowed = {r.event_id: r.allowed for r in drain(spark, state.breaker(df), "breaker").collect()}
    assert allowed == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False, 6: True, 7: True}
    skipped = {r.event_id: r.skipped for r in drain(spark, state.dead_hosts(df), "dead").collect()}
    assert skipped == {0: False, 1: False, 2: False, 3: True, 4: True, 5: True, 6: True, 7: False}
    hits = {r.event_id: r.hit for r in drain(spark, state.ttl_cache(df), "cache").collect()}
    assert hits == {0: False, 1: True, 2: True, 3: True, 4: True, 5: True, 6: False, 7: False}
    assert {r.failed: r.n for r in drain(spark, state.status_counts(df, "failed"), "counts", "complete").collect()} == {True: 5, False: 3}


def test_resumed_stream(spark, tmp_path):
    df = stream(spark, tmp_path, [[("a", at(0), 1, True), ("a", at(0), 1, True)], [("a", at(0), 1, True), ("b", at(1), 2, True)]])
    q = state.resume(df, str(tmp_path / "out"), "event_id", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_entry_module(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries()) and set(catalog.queries()) <= set(e.queries())
