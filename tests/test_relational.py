"""Properties of the relational operators, and every catalogued query against its SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestream.operators import attribution, incremental, relational
from lodestream.plans import catalog, export

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    return c


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_catalog(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = _norm(tuple(r[c] for c in columns) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = duck.execute(sql)
    at = [d[0] for d in want.description]
    assert sorted(at) == columns
    assert got == _norm(tuple(r[at.index(c)] for c in columns) for r in want.fetchall())


def test_shards_partition_exactly(spark):
    rows = relational.number_rows(spark.range(103).select((F.col("id") * 7).alias("k")), ["k"]).cache()
    assert [r.row_idx for r in rows.orderBy("k").collect()] == list(range(103))
    for n in (1, 4, 7):
        for parts in ([relational.shard_interleave(rows, i, n) for i in range(n)], [relational.shard_block(rows, i, n, 103) for i in range(n)]):
            ids = sorted(r.row_idx for p in parts for r in p.collect())
            assert ids == list(range(103))


def test_numbering_loses_nothing(spark):
    """Several partitions, ties in the first column, and a small advisory size, at which AQE coalesces as it likes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        n = 5_000_000
        df = spark.range(0, n, 1, 16).select((F.pmod(F.xxhash64("id"), F.lit(1000))).alias("k"), "id", F.lit("x").alias("__part"), F.lit(1).alias("__ORDER"))
        rows = relational.number_rows(df, ["k", "id"])
        assert rows.columns == [*df.columns, "row_idx"]
        got = rows.agg(F.count("*"), F.countDistinct("row_idx"), F.min("row_idx"), F.max("row_idx"), F.countDistinct("id")).first()
        assert tuple(got) == (n, n, 0, n - 1, n)
        ends = rows.groupBy("k").agg(F.min("row_idx").alias("a"), F.max("row_idx").alias("b")).orderBy("k").collect()
        assert all(x.b < y.a for x, y in zip(ends, ends[1:], strict=False))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_medians_and_frequencies(spark):
    values = [3, 1, 2, 2, 5, 9, -1, 0, None, 4]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    positive = sorted(v for v in values if v and v > 0)
    assert tuple(relational.upper_median(df, "v").first()) == (positive[len(positive) // 2], len(positive))
    assert tuple(relational.upper_median(df.limit(0), "v").first()) == (None, 0)
    assert {r.v: (r.n, r.percent) for r in relational.frequencies(df, "v").collect()}[2] == (2, 20.0)


def test_reachable(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (9, 1)], "src int, dst int")
    roots = spark.createDataFrame([(1,)], "node int")
    assert {r.node: r.depth for r in relational.reachable(spark, edges, roots, 3).collect()} == {1: 0, 2: 1, 3: 2, 4: 3}
    assert {r.node for r in relational.reachable(spark, edges, roots, 99).collect()} == {1, 2, 3, 4, 5}


def test_dedupe_ignores_the_order_of_input(spark):
    rows = [(k, i) for i, k in enumerate("abacabad")]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "k string, i int")
        assert {r.k: r.i for r in relational.keep_last(df, ["k"], "i").collect()} == {"a": 6, "b": 5, "c": 3, "d": 7}
        assert {r.k: r.i for r in relational.keep_first(df, ["k"], ["i"]).collect()} == {"a": 0, "b": 1, "c": 3, "d": 7}


def test_merge_overwrites_with_blanks(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "k string, v string")
    results = spark.createDataFrame([("a", "1", 0), ("a", "", 1), ("b", None, 0)], "k string, v string, n int")
    got = {r.k: r.v for r in relational.merge_results(rows, results, "k", "n", ["v"]).collect()}
    assert got == {"a": "", "b": None, "c": "z"}


def test_recheck(spark):
    rows = spark.createDataFrame([("u1", "Active", "", ""), ("u2", "Active", "", "2026-01-09T00:00:00Z"), ("u3", "Closed", "x", "")], "job_url string, job_status string, closed_date string, last_checked_at string")
    said = spark.createDataFrame([("u1", 404, "u1", "", False), ("u2", 404, "u2", "", False)], "job_url string, http_status int, final_url string, visible string, has_posting boolean")
    as_of = F.lit("2026-01-10").cast("timestamp")
    got = {r.job_url: (r.job_status, r.closed_date, r.last_checked_at) for r in incremental.recheck(rows, said, as_of, 7).collect()}
    assert got == {"u1": ("Closed", "2026-01-10", "2026-01-10T00:00:00Z"), "u2": ("Active", "", "2026-01-09T00:00:00Z"), "u3": ("Closed", "x", "")}
    assert tuple(incremental.recheck_stats(rows, said, as_of, 7).first()) == (1, 1, 2, 0)


def test_validation_and_fences(spark):
    s = "struct<seniority:string,min_years:int,max_years:int,salary_disclosed:boolean>"
    cases = [(("Senior", 1, 3, False), "", None), (("Boss", 1, 3, False), "", "seniority is not in the list"), ((None, 90, None, False), "", "min_years is out of range"), ((None, 5, 3, False), "", "min_years is above max_years"), ((None, None, None, True), "great job", "salary_disclosed has no evidence"), ((None, None, None, True), "salary 5", None), (None, "", "not an object")]
    df = spark.createDataFrame(cases, f"r {s}, t string, want string")
    assert df.where(~incremental.validate(F.col("r"), F.col("t")).eqNullSafe(F.col("want"))).count() == 0
    assert spark.range(1).select(incremental.unfence(F.lit("```json\n{}\n```")).alias("x")).first().x == "{}"


def test_export(spark):
    companies = spark.createDataFrame([("1", "Acme", "Germany", "acme.de", "i1", "d1", "P1"), ("2", "Beta", "USA", "", "i2", "d2", "P2"), ("3", "ACME ", "Germany", " Acme.de", "i3", "d3", "P3")], "KEYID string, COMPANY_NAME string, COUNTRY string, WEBSITE string, ID_Company string, DUNS_NUMBER string, PARTY_NAME string")
    job = {"job_title": "Chief Financial Officer", "job_location": "Berlin, Germany", "job_url": "u1", "salary": "$5", "min_salary": "5"}
    results = spark.createDataFrame(
        [("acme", "Germany", "acme.de", "ok", "jsonld", [job, job | {"job_url": "u2", "job_title": "Clerk", "job_location": "Paris, France"}]), ("Gamma", "", "", "no_jobs", "", [])],
        "company_name string, country string, website string, status string, source string, jobs array<struct<job_title:string,job_location:string,job_url:string,salary:string,min_salary:string>>",
    )
    rows = export.result_rows(results, F.lit("now"))
    assert rows.columns[:3] == ["company_name", "country", "website"] and len(rows.columns) == 39
    shown = {(r.company_name, r.job_title): (r.job_status, r.extraction_confidence, r.salary_disclosed, r.num_positions) for r in rows.collect()}
    assert shown[("Gamma", "")] == ("No Jobs Found", "High", "", 0) and shown[("acme", "Clerk")] == ("Active", "High", "True", 2)
    scraped = rows.withColumn("row_idx", F.monotonically_increasing_id())
    posted = export.postings(companies, scraped)
    assert posted.count() == 4  # two companies share the key, so both have both postings
    delivered = export.delivery(posted)
    assert [r["PARTY_NAME"] for r in delivered.collect()] == ["P1", "P3"]
    same, rest = export.split_same_country(delivered)
    assert same.count() + rest.count() == delivered.count() and rest.count() == 0
    covered = {r.KEYID: (r.status, r.postings, r.leadership_postings) for r in export.coverage(companies, scraped, posted).collect()}
    assert covered == {"1": ("Jobs Found", 2, 1), "2": ("NOT PROCESSED", 0, 0), "3": ("Jobs Found", 2, 1)}
    assert {r.metric: r.value for r in export.summary(companies, posted, export.coverage(companies, scraped, posted)).collect()}["leadership_postings"] == 2


def test_enrich_fills_blanks_only(spark):
    text = "Salary range $70,000 - $90,000. We need 3-5 years of Python and a bachelor's degree in engineering. Full-time."
    df = spark.createDataFrame([("Senior Software Engineer", text, "Contract")], "job_title string, plain_text string, employment_type string")
    r = export.enrich(df).first()
    assert (r.employment_type, r.seniority_level, r.job_category, r.education_type) == ("Contract", "Senior", "Information Technology", "Bachelor")
    assert (r.years_of_experience_min, r.years_of_experience_max, r.min_salary, r.max_salary, r.currency, r.skills, r.job_status) == ("3", "5", "70000", "90000", "USD", "Python", "Active")


def test_attribution(spark):
    c = spark.createDataFrame([("a", "https://a.com/x", "search", 0), ("a", "https://a.com/careers", "common_path", 1), ("a", "https://a.com/careers/#x", "homepage_link", 2)], "company string, url string, method string, ordinal int")
    assert [r.url for r in attribution.rank_candidates(c).orderBy(F.desc("base")).collect()] == ["https://a.com/careers", "https://a.com/x"]
    p = "company string, ordinal int, origin string, url string, alive boolean, parked boolean, evidence double, share double, n int"
    probes = spark.createDataFrame([("Eurofins", 0, "input", "https://x.com", True, False, 0.1, 0.0, 1), ("Eurofins", 1, "guess", "https://eurofins.com", True, False, 0.9, 0.0, 1), ("Beta Corp", 0, "input", "https://b.com", True, False, 0.0, 0.0, 1), ("Gone", 0, "input", "https://g.com", False, False, 1.0, 1.0, 1)], p)
    assert {r.company: (r.url, r.method) for r in attribution.resolve_homepage(probes).collect()} == {"Eurofins": ("https://eurofins.com", "guess"), "Beta Corp": ("https://b.com", "input_unverified")}
    s = spark.createDataFrame([("Eurofins", 1, 0, "https://jobs.other.com/careers", ""), ("Eurofins", 1, 1, "https://eurofins.recruitee.com/o/x", ""), ("Eurofins", 2, 0, "https://eurofins.com/careers", "")], "company string, query_no int, rank int, url string, website string")
    assert [r.url for r in attribution.accept_pages(s).collect()] == ["https://eurofins.recruitee.com/o/x"]
    assert [r.url for r in attribution.accept_boards(s).collect()] == ["https://eurofins.recruitee.com/o/x"]
    assert [r.website for r in attribution.website_candidates(s.where("query_no = 2")).collect()] == ["https://www.eurofins.com"]
