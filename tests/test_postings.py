"""Postings out of payloads and pages."""

import json

from pyspark.sql import functions as F

from lodestream.functions import html
from lodestream.operators import postings


def payload(spark, vendor, document, base="https://b.com"):
    df = spark.createDataFrame([(1, base, document if isinstance(document, str) else json.dumps(document))], "board long, base_url string, payload string")
    return postings.from_vendor(df, vendor) if vendor != "personio" else postings.from_personio(df)


def test_vendors(spark):
    g = payload(spark, "greenhouse", {"jobs": [{"title": "Dev", "absolute_url": "https://g/1", "updated_at": "2026-01-02T00:00:00Z", "location": {"name": "Oslo"}, "content": "x"}, {"title": ""}]}).collect()
    assert [(r.job_title, r.job_location, r.posted_date, r.job_url) for r in g] == [("Dev", "Oslo", "2026-01-02", "https://g/1")]
    lever = payload(spark, "lever", [{"text": "Ops", "hostedUrl": "https://l/1", "createdAt": 1767225600000, "categories": {"location": "Rome", "commitment": "Full-time"}}]).first()
    assert (lever.job_title, lever.posted_date, lever.employment_type) == ("Ops", "2026-01-01", "Full-time")
    ashby = payload(spark, "ashby", {"jobs": [{"title": "A", "isListed": True}, {"title": "B", "isListed": False}]}).collect()
    assert [r.job_title for r in ashby] == ["A"]
    sr = payload(spark, "smartrecruiters", {"content": [{"name": "X", "status": "ACTIVE"}, {"name": "Y", "status": "CANCELLED"}]}).collect()
    assert [r.job_title for r in sr] == ["X"]
    rec = payload(spark, "recruitee", {"offers": [{"title": "Dev", "slug": "dev-1"}]}).first()
    assert rec.job_url == "https://b.com/o/dev-1"
    breezy = payload(spark, "breezy", {"positions": [{"name": "Q"}]}).first()
    assert breezy.job_title == "Q"
    xml = "<workzag-jobs><position><id>7</id><office>Berlin</office><name>Intern</name><employmentType>intern</employmentType><jobDescriptions><jobDescription><name>T</name><value>V</value></jobDescription></jobDescriptions></position></workzag-jobs>"
    p = payload(spark, "personio", xml).first()
    assert (p.job_title, p.employment_type, p.job_url, p.job_description) == ("Intern", "Internship", "https://b.com/job/7", "T\nV")
    assert payload(spark, "greenhouse", "not json").count() == 0


def test_workday_details(spark):
    listing = payload(spark, "workday", {"total": 1, "jobPostings": [{"title": f"J{i}", "externalPath": f"/job/{i}", "postedOn": "Posted Today", "locationsText": "2 Locations"} for i in range(3)]}).withColumn("path", F.concat(F.lit("/job/"), F.substring("job_title", 2, 1)))
    assert listing.count() == 3  # the reported total is no limit
    details = spark.createDataFrame([("/job/1", "Full time", "2026-02-02")], "path string, kind string, start string")
    rows = {r.job_title: r for r in postings.with_details(listing, details, "path", {"kind": "employment_type", "start": "posted_date"}).collect()}
    assert (rows["J1"].employment_type, rows["J1"].posted_date, rows["J0"].employment_type) == ("Full time", "2026-02-02", "")
    where = postings.workday_location(F.lit("2 locations"), F.array(F.lit("Oslo"), F.lit("Rome"), F.lit("Oslo")))
    assert spark.range(1).select(where.alias("x")).first().x == "Oslo; Rome"


def test_unknown_json():
    jobs = [{"jobTitle": "A", "city": "X", "link": "/1"}, {"jobTitle": "B"}]
    assert [r["job_title"] for r in postings.probe(json.dumps(jobs))] == ["A", "B"]
    assert len(postings.probe(json.dumps({"data": jobs}))) == 2 and len(postings.probe(json.dumps({"data": {"results": jobs}}))) == 2 and len(postings.probe(json.dumps({"vagas": [{"cargo": "A"}, {"cargo": "B"}]}))) == 2
    assert postings.probe(json.dumps(jobs[:1])) == [] and postings.probe(json.dumps([{"x": 1}, {"x": 2}])) == [] and postings.probe("") == [] and postings.probe(None) == []
    deep = current = {}
    for _ in range(5000):  # deeper than any recursion
        current["x"] = {}
        current = current["x"]
    assert len(list(postings.walk(deep))) == 5001


LD = '<html><head><title>T</title><script type="application/ld+json">{"@graph": [{"@type": ["JobPosting"], "title": "Dev", "datePosted": "2026-01-02", "baseSalary": {"currency": "EUR", "value": {"minValue": 10, "maxValue": 20}}, "jobLocation": [{"address": {"addressLocality": "Oslo", "addressCountry": "NO"}}, {"address": {"addressLocality": "Oslo", "addressCountry": "NO"}}], "skills": ["b", {"name": "a"}]}]}</script></head><body></body></html>'
MICRO = '<div itemscope itemtype="https://schema.org/JobPosting"><h1 itemprop="title">Nurse</h1><span itemprop="datePosted">2026-03-04</span><div itemprop="jobLocation" itemscope itemtype="https://schema.org/Place"><span itemprop="addressLocality">Bonn</span></div></div>'
TABLE = "<table><tr><th>Position</th><th>Location</th></tr><tr><td>Cook</td><td>Rome</td></tr><tr><td></td><td>x</td></tr></table>"


def test_pages(spark):
    pages = spark.createDataFrame([("u1", LD), ("u2", MICRO), ("u3", TABLE), ("u4", None), ("u5", "")], "url string, html string").select("url", html.page(F.col("html")).alias("page"))
    rows = {r.url: r for r in postings.from_pages(pages).collect()}
    assert set(rows) == {"u1", "u2", "u3"}
    r = rows["u1"]
    assert (r.job_title, r.posted_date, r.job_location, r.salary, r.currency, r.skills, r.job_url, r.source) == ("Dev", "2026-01-02", "Oslo, NO", "10 - 20", "EUR", "a; b", "u1", "jsonld")
    assert (rows["u2"].job_title, rows["u2"].posted_date, rows["u2"].source) == ("Nurse", "2026-03-04", "microdata") and "Bonn" in rows["u2"].job_location
    assert (rows["u3"].job_title, rows["u3"].job_location) == ("Cook", "Rome")


def test_page_reading():
    p = html.read_page('<title>A &amp; B</title><meta property="og:site_name" content="S"><h1>H <b>x</b></h1><p>one</p><a href="/j">go <i>now</i></a><script>var x="</p>"</script>')
    assert (p["title"], p["h1"], p["metas"], p["links"], p["text"]) == ("A & B", ["H x"], {"og:site_name": "S"}, [{"text": "go now", "href": "/j"}], "H x one go now")
    assert html.read_page(None)["text"] == ""


def test_board_and_shell_signals(spark):
    board = "<html><body><h1>Open jobs</h1>" + "".join(f'<a href="/jobs/role-{i}">R{i}</a>' for i in range(9)) + "<p>Apply now for any of these roles, we would like to hear from you.</p>" + "x" * 400 + "</body></html>"
    shell = '<html><body><div id="root"></div><script src="a.js"></script></body></html>'
    df = spark.createDataFrame([("b", board), ("s", shell)], "k string, html string").select("k", "html", html.page(F.col("html")).alias("p"))
    got = {r.k: (r.a, r.b) for r in df.select("k", html.board_signals(F.col("html"), F.col("p")).alias("a"), html.is_script_shell(F.col("p")).alias("b")).collect()}
    assert got["b"][0] >= 2 and not got["b"][1] and got["s"] == (0, True)
