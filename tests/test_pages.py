"""Links, labelled values, details and whole runs over captured pages."""

import json

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestream.functions import html
from lodestream.operators import pages as P
from lodestream.plans import export, run


def captured(spark, site):
    return spark.createDataFrame(list(site.items()), "url string, html string").withColumn("page", html.page(F.col("html")))


def test_links(spark):
    body = '<a href="/jobs/dev-1">Software Engineer</a><a href="/jobs/dev-1#x">again</a><a href="?page=2">2</a><a href="/careers">View all jobs</a><a href="https://other.io/careers">Jobs</a><a href="https://linkedin.com/jobs">x</a><a href="mailto:x">m</a><iframe src="https://acme.recruitee.com/o"></iframe>'
    pages = captured(spark, {"https://a.com/x": body})
    found = P.links(pages).cache()
    assert {r.link for r in P.posting_links(found).collect()} == {"https://a.com/jobs/dev-1"}
    assert {r.link for r in P.pagination_links(found).collect()} == {"https://a.com/x?page=2"}
    assert {r.link for r in P.listing_links(found).collect()} == {"https://a.com/careers"}
    assert {r.link for r in P.career_branches(found).collect()} >= {"https://a.com/careers"}
    assert [r.link for r in P.handoff_candidates(found).collect()] == ["https://other.io/careers"]
    assert [(r.vendor, r.slug) for r in P.board_of(pages).collect()] == [("recruitee", "acme")]
    order = spark.range(1).select(P.group_order(F.lit("Brazil")).alias("a"), P.group_order(F.lit("Chad")).alias("b")).first()
    assert (order.a, order.b) == ([3, 0, 1, 2, 4], [0, 1, 2, 3, 4])


def test_structs_of_a_large_batch_are_made_a_few_at_a_time(spark):
    """What a task holds doesn't grow with the batches that pages come in; fields asked for are those of the whole struct."""
    whole = StructType.fromDDL(html.PAGE)
    made = list(html._structs(pa.array(["<a href=/x>x</a>"] * 1000 + [None] + ["<p>" + "x" * html.HELD_BYTES] * 3), whole))
    assert sum(map(len, made)) == 1004 and max(map(len, made)) <= html.HELD_PAGES and [len(x) for x in made[-2:]] == [1, 1]
    body = '<title>t</title><meta name="k" content="v"><h1>h</h1><a href="/a">A</a><div itemscope itemtype="T"><i itemprop="p">q</i></div><table><tr><td>c</td></tr></table><script>1</script>'
    df = spark.createDataFrame([(i, body if i % 3 else None) for i in range(200)], "i long, html string").repartition(1)
    rows = df.select("i", html.page(F.col("html")).alias("p"), html.page(F.col("html"), "links", "scripts").alias("few")).collect()
    assert all(r.p.asDict(True) == html.read_page(body if r.i % 3 else None) and (r.few.links, r.few.scripts, len(r.few)) == (r.p.links, r.p.scripts, 2) for r in rows) and len(rows) == 200


def test_details(spark):
    page = "<h1>Cook</h1><dl><dt>Location</dt><dd>Rome</dd></dl><p><b>Job type</b>: Full time</p><p>Deadline: 3/4/2026</p><p>" + "We cook good food here. " * 8 + "Apply now.</p>"
    df = captured(spark, {"u": page, "v": "<h1>Cook</h1>short", "hr": '<meta property="og:title" content="Chef"><meta name="keywords" content="a, Oslo, Norway, z"><p>Deadline: 05-06-2026</p>'})
    rows = {r.url: r.d for r in df.select("url", P.detail_posting(F.col("page"), F.col("url"), F.lit("2026-01-01")).alias("d")).collect()}
    d = rows["u"]
    assert (d.job_title, d.job_location, d.employment_type, d.application_deadline, d.source) == ("Cook", "Rome", "Full time", "2026-04-03", "generic-detail") and rows["v"] is None
    o = df.where("url = 'hr'").select(P.overlay(F.col("page"), F.lit("x"), F.lit("2026-01-01"), F.lit(""), F.lit("hr"), F.lit("2026-01-01")).alias("o")).first().o
    assert (o.job_title, o.job_location, o.application_deadline, o.posted_date) == ("Chef", "Oslo, Norway", "2026-06-05", "2026-01-01")
    text = "<h2>Nurse (m/w/d)</h2><p>" + "care " * 60 + "apply</p><h2>About us</h2><h2>Cook (m/f)</h2><p>short</p>"
    found = captured(spark, {"w": text}).select(P.inline_postings(F.col("page")).alias("x")).first().x
    assert [f.job_title for f in found] == ["Nurse (m/w/d)"]
    boxes = captured(spark, {"b": '<div class="job-item"><h4>Senior Accountant</h4> A role in our team in Oslo, with a deadline soon: please apply.</div><div class="job-item"><b>Jobs</b> a position in our team, apply before the deadline</div>'})
    assert [b.title for b in boxes.select(P.box_postings(F.col("page")).alias("x")).first().x] == ["Senior Accountant"]
    assert spark.range(1).select(P.fault_kind(F.lit("Read timed out")).alias("x")).first().x == "retryable"


def ld(titles):
    rows = [{"@type": "JobPosting", "title": t, "url": f"https://a.com/j/{t}"} for t in titles]
    return f'<script type="application/ld+json">{json.dumps(rows)}</script>'


def test_run_pages_through_a_site(spark):
    site = {"https://a.com": '<a href="/careers">Careers</a>'}
    for i in range(1, 6):
        site["https://a.com/careers" + ("" if i == 1 else f"?page={i}")] = ld([f"{i}-{k}" for k in range(30)]) + (f'<a href="/careers?page={i + 1}">Next</a>' if i < 5 else "")
    site |= {"https://b.com": '<a href="/jobs">Jobs</a>', "https://b.com/jobs": "We currently have no open positions", "https://c.com": "hello", "https://d.com": '<a href="/careers">Careers</a>', "https://d.com/careers": "something"}
    homes = spark.createDataFrame([(x, f"https://{x}.com") for x in "abcde"], "company string, home string")
    found = run.results(homes, captured(spark, site)).cache()
    got = {r.company: (r.status, len(r.jobs)) for r in found.collect()}
    assert got == {"a": ("ok", 150), "b": ("no_jobs", 0), "c": ("career_not_found", 0), "d": ("unsupported", 0), "e": ("unreachable", 0)}
    assert {r.status: r.jobs for r in run.counters(found).collect()}["ok"] == 150
    named = found.select(F.col("company").alias("company_name"), F.lit("").alias("country"), F.col("home").alias("website"), "status", "source", "jobs", "career_page_url")
    rows = export.result_rows(named, F.lit("now"))
    assert rows.count() == 154 and rows.where("num_positions = 150").count() == 150


def test_verified_search_results(spark):
    site = {"https://eurofins.com/j": "<title>Eurofins</title>apply " + ld(["A"]), "https://x.com/j": "apply " + ld(["A"]), "https://eurofins.com/k": "<title>Eurofins</title> apply here"}
    pages = captured(spark, site)
    from lodestream.operators import postings

    asked = spark.createDataFrame([("Eurofins", u, "https://eurofins.com") for u in [*site, "https://gone.com"]], "company string, url string, website string")
    got = {r.url: r.outcome for r in P.verified(asked, pages, postings.from_pages(pages)).collect()}
    assert got == {"https://eurofins.com/j": "accepted", "https://x.com/j": "no_evidence", "https://eurofins.com/k": "unparseable", "https://gone.com": "unfetchable"}


def test_selection(spark):
    rows = spark.createDataFrame([(f"n{i}", "w", ["USA", "Italy"][i % 2], i) for i in range(20)], "name string, website string, country string, row_idx long")
    done = spark.createDataFrame([("n2|w",)], "key string")
    assert sorted(r.name for r in run.select_companies(rows, done, ["USA"], (0, 2, "interleave")).collect()) == ["n0", "n12", "n16", "n4", "n8"]
    assert sorted(r.name for r in run.select_companies(rows, done, ["USA"], (0, 2, "block"), 1, 3).collect()) == ["n4", "n6"]
    assert run.select_companies(rows).count() == 20
