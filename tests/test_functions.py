"""Truth tables of the scalar functions; a table's cases run in one query."""

import pytest
from pyspark.sql import functions as F

from lodestream.functions import location, names, numbers, text, urls
from lodestream.operators import incremental

L = F.lit
TITLES = {"Recently Posted Jobs": False, "Open Positions": False, "Software Engineer (m/w/d)": True, "Pflegefachkraft": True, "Data Platform Lead": True, "hello there": False, "Why join us?": False, "abc": False}
LEADERS = {"Product Owner": False, "Business Process Owner": False, "Owner": True, "Chief Financial Officer": True, "Tax Senior Manager": True, "Head of Sales": True, "Engineer": False, "VP Operations": True, "": False}
LEVELS = {"CEO": "C-Level", "Vice President and Founder": "V-Level", "Director": "D-Level", "Head of X": "H-Level", "Sr. Manager": "M-Level", "Product Owner": "", "Clerk": ""}
DECIMALS = {"1.500": "1500", "0.125": "125", "1,234.50": "1234.5", "60.000,50": "60000", "1.234.567": "1234", "12,5": "12.5", "8,00,000": "", "abc": "", "-3": "-3", "USD 70,000": "70000"}
DATES = {"Posted Today": "2026-01-10", "Posted Yesterday": "2026-01-09", "Posted 30+ Days Ago": "2025-12-11", "2 weeks ago": "2025-12-27", "2026-13-45x": "2026-13-45", "3/4/2026": "2026-04-03", "3.4.2026": "2026-04-03", "3-4-2026": "2026-03-04", "March 5, 2026": "2026-03-05", "Jan 2 10:00:00 UTC 2026": "2026-01-02", "5 March 2026": "", "": ""}
BUCKETS = {"2500": "2000+", "1999": "1000+", "345": "300+", "47": "45+", "7": "7", "x": ""}
COUNTRIES = {"Lancaster, PA, United States": "USA", "Remote - USA": "USA", "London, GB": "United Kingdom", "Chicago, IL": "Israel", "Bengaluru, India": "India", "Los Angeles, CA": "USA", "Berlin, DE": "Germany", "Plano TX": "USA", "X (US152527)": "USA", "Remote-Germany": "Germany", "Georgia": "USA", "nowhere at all": "", "": ""}
BOARDS = {"https://www.icims.com/legal/privacy-notice": False, "https://cdn.phenompeople.com/x": False, "https://acme.recruitee.com/o/dev": True, "https://www.linkedin.com/jobs": False, "https://boards.greenhouse.io/acme": True, "https://acme.icims.com/servlet/x": False}
DOMAINS = {"www.a.b.co.uk": "b.co.uk", "jobs.acme.com": "acme.com", "acme.de": "acme.de", "x.y.com.br": "y.com.br", "localhost": "localhost"}
HOSTS = {"acme.com": True, "256.1.1.1": False, "10.0.0.1": True, "münchen.de": True, "no_dots": False, "a..com": False, "-a.com": False}
SITES = {"Acme.com": "https://acme.com", "http://acme.com:80/x": "https://acme.com", "acme.com:8443": "https://acme.com:8443", "not a host": "", "": ""}


def table(spark, cases, function):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, k string")
    return {r.k: r.v for r in rows.select("k", function(F.col("k")).alias("v")).collect()}


@pytest.mark.parametrize(
    "cases, function",
    [
        (TITLES, text.looks_like_title), (LEADERS, text.is_leader), (LEVELS, text.export_seniority), (DECIMALS, numbers.parse_decimal), (DATES, lambda c: numbers.parse_date(c, L("2026-01-10"))), (BUCKETS, numbers.openings_bucket),
        (COUNTRIES, location.country), (BOARDS, urls.is_probable_board), (DOMAINS, urls.registrable_domain), (HOSTS, urls.is_hostname), (SITES, urls.normalize_website),
        ({"full-time work": "Full Time", "Internal role": "Internship", "": "", "Something else": "Something else"}, text.export_employment),
        ({"smart recruiters": "smartrecruiters", "Greenhouse": "greenhouse", "Some ATS": "some_ats"}, urls.canonical_vendor),
        ({"EUROPE": "EUR", "$5": "USD", "12 CHF": "CHF", "x": ""}, numbers.currency), ({"node.js c++": "Node.Js C++", "éa b": "Éa B"}, text.title_case),
        ({"pay $70,000 - $90,000 ok": "$70,000 - $90,000", "costs $49 per month": "", "€55,000 per annum": "€55,000 per annum"}, numbers.salary_range),
        ({"Salary: competitive, up to $90,000 a year. Apply now.": "Salary: competitive, up to $90,000 a year.", "salary is good": "", "no pay. compensation 5 EUR": "compensation 5 EUR"}, numbers.salary_evidence),
    ],
)
def test_truth_tables(spark, cases, function):
    assert table(spark, cases, function) == cases


def test_structs(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert tuple(one(numbers.salary_breakdown(L("$120K - $150K")))) == ("120 - 150", "120", "150")
    assert tuple(one(numbers.salary_breakdown(L("0 - 0")))) == ("", "", "")
    assert tuple(one(numbers.experience_range(L("9-5 years")))) == ("", "")
    assert tuple(one(numbers.experience_range(L("at least 4 years of experience")))) == ("4", "")
    assert one(numbers.usd_salary(L("US$ 5"), L("5"), L(""), L("")))["text"] == ""
    assert tuple(one(numbers.usd_salary(L("x"), L("1,000"), L("2000.5"), L("USD")))) == ("$1000 - $2000.50", 1000.0, 2000.5)
    assert tuple(one(urls.vendor(L("https://acme.wd3.myworkdayjobs.com/en-US/Site/job/x")))) == ("workday", "acme")
    assert one(urls.workday(L("https://acme.wd3.myworkdayjobs.com/en-US/Site/job/x")))["site"] == "Site"
    assert one(urls.join(L("https://a.com/x/y?z"), L("../q"))) == "https://a.com/q"
    assert one(urls.join(L("https://a.com/x/"), L("mailto:x"))) == ""
    assert one(urls.unwrap(L("https://r.com/?uddg=https%3A%2F%2Fa.com%2Fb"))) == "https://a.com/b"
    assert one(text.labelled(L("Employment Type: Full Time Location: X")))["employment_type"] == "Full Time"
    assert one(text.skills(L("PYTHON, python; Node.js and AWS"))) == "PYTHON; Node.Js; AWS"
    assert one(text.clean_text(L(None).cast("string"))) == "" and one(text.to_list(L("a, ;b|"))) == ["a", "b"]
    assert "acmewidgets.de" in one(names.guess_hosts(L("Acme Widgets GmbH"), L("Germany")))


def test_ownership(spark):
    cases = [("accenture", "Accenture GmbH", True), ("eurofins", "County of Douglas", False), ("ngs", "National Geographic Society", True), (None, "Acme", False)]
    rows = spark.createDataFrame(cases, "slug string, name string, want boolean")
    assert rows.where(names.slug_matches(F.col("slug"), F.col("name")) != F.col("want")).count() == 0
    cases = [("eurofins-scientific.com", "Eurofins", True), ("state.gov", "State Street", False), ("boston.gov", "City of Boston", True), ("linkedin.com", "LinkedIn", False)]
    rows = spark.createDataFrame(cases, "domain string, name string, want boolean")
    assert rows.where(names.domain_matches(F.col("domain"), F.col("name")) != F.col("want")).count() == 0


def test_verdicts(spark):
    cases = [(None, "u", "", False, "request_failed"), (404, "u", "", True, "http_404"), (500, "u", "", False, "http_500"), (200, "u", "This job has expired", True, "closed_message"), (200, "https://a.com/careers", "", True, "redirected_to_listing_root"), (200, "https://a.com/jobs/dev/12", "", False, "active_or_inconclusive")]
    rows = spark.createDataFrame(cases, "status int, final string, visible string, closed boolean, reason string")
    said = incremental.verdict(F.col("status"), F.col("final"), L("https://a.com/jobs/dev/12"), F.col("visible"), L(False))
    got = {r.reason: (r.v["closed"], r.v["reason"]) for r in rows.select("reason", said.alias("v")).collect()}
    assert got == {c[4]: (c[3], c[4]) for c in cases}
