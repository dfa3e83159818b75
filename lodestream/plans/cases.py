"""Queries over stated cases: operators whose input (payloads, pages, files, feeds) no test table holds.

Each query runs the library's operator on a few rows that are written here; its SQL states
the rows that must come out.  ``_truth`` is for functions of one text, ``_expect`` for all else.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, location, names, numbers, text, urls
from ..operators import attribution, incremental, postings, relational
from ..operators import pages as P
from ..sources import sinks, tables
from ..storage import fresh_path
from ..streaming import state
from . import export, run

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_KINDS = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _literal(value, kind: str) -> str:
    shown = "NULL" if value is None else str(value) if kind != "string" else "'" + value.replace("'", "''") + "'"
    return f"CAST({shown} AS {_KINDS[kind]})"


def _expect(schema: str, rows: list[tuple]):
    """Register a function of the session whose result has these columns and rows."""
    columns = [c.split() for c in schema.split(", ")]

    def add(f):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(spark).select(*(F.col(n).cast(k).alias(n) for n, k in columns))
        listed = ", ".join("(" + ", ".join(_literal(v, k) for v, (_, k) in zip(row, columns, strict=True)) + ")" for row in rows)
        _SQL[f.__name__] = f"SELECT * FROM (VALUES {listed}) AS t({', '.join(n for n, _ in columns)})"
        return f

    return add


def _truth(name: str, function, cases: dict, kind: str = "string") -> None:
    """Register a function of one text: what it makes of each."""

    def f(spark):
        return spark.createDataFrame([(k,) for k in cases], "given string").select("given", function(F.col("given")).alias("said"))

    f.__name__ = name
    _expect(f"given string, said {kind}", list(cases.items()))(f)


def _frame(spark, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _pages(spark, site: dict[str, str | None]) -> DataFrame:
    return _frame(spark, list(site.items()), "url string, html string").withColumn("page", html.page(F.col("html")))


# ---- text ----

_truth("leader_titles", text.is_leader, {"Product Owner": False, "Business Process Owner": False, "Owner": True, "Chief Financial Officer": True, "Tax Senior Manager": True, "Head of Sales": True, "Engineer": False, "VP Operations": True, "": False}, "boolean")
_truth("export_seniority_levels", text.export_seniority, {"CEO": "C-Level", "Vice President and Founder": "V-Level", "Director": "D-Level", "Head of X": "H-Level", "Sr. Manager": "M-Level", "Product Owner": "", "Clerk": ""})
_truth("export_employment_kinds", text.export_employment, {"full-time work": "Full Time", "Internal role": "Internship", "": "", "Something else": "Something else"})
_truth("job_title_guard", text.looks_like_title, {"Recently Posted Jobs": False, "Open Positions": False, "Software Engineer (m/w/d)": True, "Pflegefachkraft": True, "Data Platform Lead": True, "hello there": False, "Why join us?": False, "abc": False}, "boolean")
_truth("no_openings_text", text.says_no_jobs, {"We currently have no open positions": True, "There are no vacancies at the moment": True, "We have 3 open positions": False, "": False}, "boolean")
_truth("parked_pages", text.is_parked, {"This domain is for sale": True, "Buy this domain today": True, "Welcome to our careers": False, "This domain is for sale " + "x" * 2000: False}, "boolean")
_truth("career_words", lambda c: text.is_career_link(c, F.lit("/x")), {"Careers": True, "Stellenangebote": True, "Contact": False, "Join our team": True}, "boolean")
_truth("joined_lists", text.join_list, {"a, b;c|d\n e ": "a; b; c; d; e", ", ;": "", "one": "one"})
_truth("plain_text_lines", html.plain_text, {"<p>a &amp;amp; b</p><p>c</p>": "a & b\nc", "x<script>var y=1</script><br>z": "x\nz", "": ""})
_truth("employment_of_text", lambda c: text.employment_type(F.lit("Cook"), c), {"This is a full-time role": "Full Time", "part time": "Part Time", "Internship in Rome": "Internship", "nothing": ""})
_truth("seniority_of_title", lambda c: text.seniority(c, F.lit("You report to the director")), {"Senior Engineer": "Senior", "Junior Clerk": "Junior", "Cook": "Executive"})
_truth("education_of_text", lambda c: F.concat_ws("|", text.education(c)["education_type"], text.education(c)["education_stream"]), {"a bachelor's degree in engineering": "Bachelor|Engineering", "PhD in physics": "Doctorate|Sciences", "no degree": "|"})
_truth("skills_of_text", text.skills, {"PYTHON, python; Node.js and AWS": "PYTHON; Node.Js; AWS", "We need Java, JavaScript and SQL.": "Java; Javascript; SQL", "none": ""})
_truth("labelled_employment", lambda c: text.labelled(c)["employment_type"], {"Employment Type: Full Time Location: X": "Full Time", "Job Type: Contract\nSalary: 5": "Contract", "nothing here": ""})
_truth("title_cased", text.title_case, {"node.js c++": "Node.Js C++", "éa b": "Éa B"})

# ---- numbers and dates ----

_truth("decimals_by_locale", numbers.parse_decimal, {"1.500": "1500", "0.125": "125", "1,234.50": "1234.5", "60.000,50": "60000", "1.234.567": "1234", "12,5": "12.5", "8,00,000": "", "abc": "", "-3": "-3", "USD 70,000": "70000"})
_truth("dates_in_many_forms", lambda c: numbers.parse_date(c, F.lit("2026-01-10")), {"Posted Today": "2026-01-10", "Posted Yesterday": "2026-01-09", "Posted 30+ Days Ago": "2025-12-11", "2 weeks ago": "2025-12-27", "2026-13-45x": "2026-13-45", "3/4/2026": "2026-04-03", "3.4.2026": "2026-04-03", "3-4-2026": "2026-03-04", "March 5, 2026": "2026-03-05", "Jan 2 10:00:00 UTC 2026": "2026-01-02", "5 March 2026": "", "": ""})
_truth("currencies", numbers.currency, {"EUROPE": "EUR", "$5": "USD", "12 CHF": "CHF", "x": ""})
_truth("salary_sentences", numbers.salary_evidence, {"Salary: competitive, up to $90,000 a year. Apply now.": "Salary: competitive, up to $90,000 a year.", "salary is good": "", "no pay. compensation 5 EUR": "compensation 5 EUR"})
_truth("salary_ranges", numbers.salary_range, {"pay $70,000 - $90,000 ok": "$70,000 - $90,000", "costs $49 per month": "", "€55,000 per annum": "€55,000 per annum"})
_truth("experience_years", lambda c: F.concat_ws("-", numbers.experience_range(c)["min"], numbers.experience_range(c)["max"]), {"3-5 years of experience": "3-5", "9-5 years": "-", "at least 4 years of experience": "4-", "none": "-"})
_truth("openings_in_buckets", numbers.openings_bucket, {"2500": "2000+", "1999": "1000+", "345": "300+", "47": "45+", "7": "7", "x": ""})
_truth("lenient_integers", numbers.to_int, {"7": 7, "7.9": 7, "x": 0, "": 0, "-3.5": -3}, "long")
_truth("durations", lambda c: numbers.duration(c.cast("long")), {"90061": "1d 1h", "3720": "1h 2m", "59": "0m", "300": "5m"})

# ---- addresses ----

_truth("locations_to_countries", location.country, {"Lancaster, PA, United States": "USA", "Remote - USA": "USA", "London, GB": "United Kingdom", "Chicago, IL": "Israel", "Bengaluru, India": "India", "Los Angeles, CA": "USA", "Berlin, DE": "Germany", "Plano TX": "USA", "X (US152527)": "USA", "Remote-Germany": "Germany", "Georgia": "USA", "nowhere at all": "", "": ""})
_truth("probable_boards", urls.is_probable_board, {"https://www.icims.com/legal/privacy-notice": False, "https://cdn.phenompeople.com/x": False, "https://acme.recruitee.com/o/dev": True, "https://www.linkedin.com/jobs": False, "https://boards.greenhouse.io/acme": True, "https://acme.icims.com/servlet/x": False}, "boolean")
_truth("host_names", urls.is_hostname, {"acme.com": True, "256.1.1.1": False, "10.0.0.1": True, "münchen.de": True, "no_dots": False, "a..com": False, "-a.com": False}, "boolean")
_truth("with_https", urls.ensure_https, {" acme.com ": "https://acme.com", "​http://a.b": "http://a.b", "": ""})
_truth("vendors_of_addresses", lambda c: F.concat_ws("|", urls.vendor(c)["vendor"], urls.vendor(c)["slug"]), {"https://acme.wd3.myworkdayjobs.com/en-US/Site/job/x": "workday|acme", "https://boards.greenhouse.io/acme/jobs/1": "greenhouse|acme", "https://jobs.lever.co/Acme": "lever|acme", "https://acme.recruitee.com/o/x": "recruitee|acme", "https://example.com/jobs": "|"})
_truth("vendor_spellings", urls.canonical_vendor, {"smart recruiters": "smartrecruiters", "Greenhouse": "greenhouse", "Some ATS": "some_ats", "Bamboo-HR": "bamboo", "SAP SuccessFactors": "successfactors"})
_truth("workday_sites", lambda c: F.concat_ws("|", urls.workday(c)["tenant"], urls.workday(c)["site"]), {"https://acme.wd3.myworkdayjobs.com/en-US/Site/job/x": "acme|Site", "https://acme.wd1.myworkdayjobs.com/": "acme|acme", "https://acme.com": "|"})
_truth("unwrapped_redirects", urls.unwrap, {"https://r.com/?uddg=https%3A%2F%2Fa.com%2Fb": "https://a.com/b", "https://r.com/?q=https://c.com": "https://c.com", "https://r.com/?q=word": "https://r.com/?q=word"})
_truth("generic_landings", lambda c: urls.is_generic_landing(c, F.lit("https://a.com/jobs/dev/12")), {"https://a.com/careers": True, "https://a.com/": True, "https://a.com/jobs/dev/12": False, "https://a.com/about": False}, "boolean")
_truth("same_registrable_domain", lambda c: urls.same_domain(c, F.lit("https://jobs.acme.co.uk/x")), {"https://www.acme.co.uk": True, "https://other.co.uk": False, "": False}, "boolean")
_truth("career_paths", lambda c: F.concat_ws("|", F.size(urls.common_career_urls(c)).cast("string"), urls.common_career_urls(c)[0]), {"https://a.com/": "17|https://a.com/careers"})
_truth("website_variants", lambda c: F.array_join(urls.variants(c), " "), {"www.acme.com": "https://www.acme.com http://www.acme.com https://acme.com", "": ""})
_truth("slugs", urls.slugify, {"Acme & Sons, Ltd.": "acme-sons-ltd", "--": ""})
_truth("shared_vendors", lambda c: urls.vendor(c)["vendor"].isin(urls.SHARED_VENDORS), {"https://www.welcometothejungle.com/acme": True, "https://acme.recruitee.com": False}, "boolean")
_truth("group_orders", lambda c: F.array_join(F.transform(P.group_order(c), lambda x: x.cast("string")), ","), {"Brazil": "3,0,1,2,4", "Germany": "4,0,1,2,3", "Chad": "0,1,2,3,4"})
_truth("guessed_hosts", lambda c: F.array_join(F.slice(names.guess_hosts(c, F.lit("Germany")), 1, 2), " "), {"Acme Widgets GmbH": "acmewidgets.de acmewidgets.com"})
_truth("domain_scores", lambda c: names.domain_score(c, F.lit("Acme Widgets")), {"acmewidgets.com": 60, "acme.org": 30, "linkedin.com": -1000, "other.com": 0}, "int")
_truth("retryable_faults", P.fault_kind, {"Read timed out": "retryable", "something else entirely": "other"})
_truth("fences", incremental.unfence, {"```json\n{}\n```": "{}", " {} ": "{}"})
_truth("feed_links", lambda c: F.array_join(tables.rss_links(c), " "), {"<item><title>x</title><link> https://a </link></item><item><link>b</link></item>": "https://a b", "<channel/>": ""})


@_expect("domain string, name string, matched boolean", [("eurofins-scientific.com", "Eurofins", True), ("state.gov", "State Street", False), ("boston.gov", "City of Boston", True), ("linkedin.com", "LinkedIn", False)])
def domain_ownership(spark):
    rows = _frame(spark, [("eurofins-scientific.com", "Eurofins"), ("state.gov", "State Street"), ("boston.gov", "City of Boston"), ("linkedin.com", "LinkedIn")], "domain string, name string")
    return rows.withColumn("matched", names.domain_matches(F.col("domain"), F.col("name")))


@_expect("slug string, name string, matched boolean", [("accenture", "Accenture GmbH", True), ("eurofins", "County of Douglas", False), ("ngs", "National Geographic Society", True), (None, "Acme", False)])
def slug_ownership(spark):
    rows = _frame(spark, [("accenture", "Accenture GmbH"), ("eurofins", "County of Douglas"), ("ngs", "National Geographic Society"), (None, "Acme")], "slug string, name string")
    return rows.withColumn("matched", names.slug_matches(F.col("slug"), F.col("name")))


@_expect("slug string, accepted boolean, reason string", [("accenture", True, "slug:accenture"), ("x1", True, "page_evidence=0.75"), ("x2", False, "no ownership evidence (slug=x2 evidence=0.10)"), ("x3", False, "shared vendor board without company evidence")])
def board_ownership(spark):
    rows = _frame(spark, [("lever", "accenture", 0.0), ("lever", "x1", 0.75), ("lever", "x2", 0.1), ("neogov", "x3", 0.1)], "vendor string, slug string, evidence double")
    said = names.ownership(F.col("vendor"), F.col("slug"), F.lit("Accenture GmbH"), F.col("evidence"), urls.SHARED_VENDORS)
    return rows.select("slug", said["accepted"].alias("accepted"), said["reason"].alias("reason"))


@_expect("body string, evidence double", [("welcome to eurofins scientific", 1.0), ("eurofins", 0.5), ("nothing", 0.0)])
def evidence_of_pages(spark):
    rows = _frame(spark, [("welcome to eurofins scientific",), ("eurofins",), ("nothing",)], "body string")
    return rows.withColumn("evidence", names.page_evidence(F.lit(""), F.col("body"), F.lit("Eurofins Scientific"), generic=[]))


@_expect("salary string, text string, lo double, hi double", [("x", "$1000 - $2000.50", 1000.0, 2000.5), ("US$ 5", "", None, None)])
def usd_only(spark):
    rows = _frame(spark, [("x", "1,000", "2000.5", "USD"), ("US$ 5", "5", "", "")], "salary string, low string, high string, code string")
    u = numbers.usd_salary(F.col("salary"), F.col("low"), F.col("high"), F.col("code"))
    return rows.select("salary", u["text"].alias("text"), u["lo"].alias("lo"), u["hi"].alias("hi"))


# ---- sources and sinks ----


def _written(spark, name: str, lines: list[str]) -> str:
    path = f"{fresh_path(spark, 'case')}/{name}"
    _frame(spark, [("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


@_expect("name string, website string, country string", [("Acme, Inc", "acme.com", "USA"), ("Beta", "", "")])
def companies_from_csv(spark):
    return tables.read_companies(spark, _written(spark, "list.csv", ["﻿Company Name,Website,Country", '"Acme, Inc",acme.com,USA', ",x.com,USA", "Beta,,"]))


@_expect("name string, website string, country string", [("Acme", "acme.com", "USA"), ("Beta", "beta.de", "Germany")])
def companies_from_tsv(spark):
    """No header is recognised: columns go by place, and the first row is data."""
    return tables.read_companies(spark, _written(spark, "list.tsv", ["Acme\tacme.com\tUSA", "Beta\tbeta.de\tGermany"]))


@_expect("name string, website string, country string", [("Acme & Co", "acme.com", "USA"), ("Beta", "", "Spain")])
def companies_from_workbook(spark):
    """Written as a workbook of two sheets, and read back from the first."""
    folder = fresh_path(spark, "case")
    df = _frame(spark, [("Acme & Co", "acme.com", "USA"), ("Beta", None, "Spain")], "company_name string, website string, country string")
    df.limit(0).write.parquet(folder)  # the folder
    sinks.write_xlsx({"first": df, "second": df.limit(1)}, f"{folder}/list.xlsx")
    return tables.read_companies(spark, f"{folder}/list.xlsx")


@_expect("a string, b string", [("1", ""), ("02", "x,y")])
def strings_from_csv(spark):
    """All columns strings: leading zeros and blanks stay."""
    return tables.read_strings(spark, _written(spark, "s.csv", ["a,b", "1,", '02,"x,y"']))


@_expect("found boolean, said boolean", [(False, True)])
def absent_snapshot(spark):
    rows, message = tables.read_snapshot(spark, fresh_path(spark, "absent"))
    return _frame(spark, [(rows is not None, message != "")], "found boolean, said boolean")


@_expect("key string", [("Acme|acme.com",), ("Beta|",)])
def finished_keys(spark):
    return tables.completed_keys(spark, _written(spark, "out.csv", ["company_name,website,x", "Acme,acme.com,1", "Acme,acme.com,2", "Beta,,3"]))


def _log(spark) -> tuple[str, str, str]:
    root = fresh_path(spark, "case")
    paths = (f"{root}/log", f"{root}/mark", f"{root}/bad")
    for batch in ([("a", "1", None), ("b", None, "boom")], [("a", "2", None), ("c", "3", None)]):
        sinks.append_results(_frame(spark, batch, "row_id string, result string, error string"), *paths)
    return paths


@_expect("row_id string, result string", [("a", "2"), ("c", "3")])
def last_results(spark):
    return tables.read_results(spark, _log(spark)[0])


@_expect("row_id string", [("a",), ("c",)])
def checkpoint_lines(spark):
    return tables.read_checkpoint(spark, _log(spark)[1])


@_expect("row_id string, error string", [("b", "boom")])
def errors_aside(spark):
    return tables.read_strings(spark, _log(spark)[2])


@_expect("company_name string, job_status string, columns int", [("a", "Active", 39), ("b", "Unreachable", 39)])
def appended_rows(spark):
    path = fresh_path(spark, "case")
    sinks.append(_frame(spark, [("a", "Active", "x")], "company_name string, job_status string, other string"), path)
    sinks.append(_frame(spark, [("b", "Unreachable")], "company_name string, job_status string"), path)
    rows = tables.read_strings(spark, path)
    return rows.select("company_name", "job_status", F.lit(len(rows.columns)).alias("columns"))


@_expect("company_name string, purged int", [("a", 1)])
def purged_file(spark):
    path = fresh_path(spark, "case")
    sinks.append(_frame(spark, [("a", "Active"), ("b", "Unreachable")], "company_name string, job_status string"), path)
    gone = sinks.purge_file(spark, path)
    return tables.read_strings(spark, path).select("company_name", F.lit(gone).alias("purged"))


@_expect("company_name string, new string, changed boolean, again boolean", [("a", "", True, False)])
def migrated_file(spark):
    path = fresh_path(spark, "case")
    sinks.append(_frame(spark, [("a",)], "company_name string"), path)
    changed = sinks.migrate_file(spark, path, ["company_name", "new"])
    again = sinks.migrate_file(spark, path, ["company_name", "new"])
    return tables.read_strings(spark, path).select("company_name", "new", F.lit(changed).alias("changed"), F.lit(again).alias("again"))


@_expect("value string", [("new",)])
def replaced_folder(spark):
    path = fresh_path(spark, "case")
    for value in ("old", "new"):
        sinks.replace(_frame(spark, [(value,)], "value string"), path)
    return tables.read_strings(spark, path)


@_expect("sheet string, n long", [("all", 2), ("leaders", 1)])
def output_sheets(spark):
    folder = fresh_path(spark, "case")
    df = _frame(spark, [("a", "CEO"), ("b", "Clerk")], "company string, title string")
    sinks.write_outputs({"all": df, "leaders": df.where(text.is_leader(F.col("title")))}, folder)
    rows = [tables.read_strings(spark, f"{folder}/{s}").agg(F.lit(s).alias("sheet"), F.count("*").alias("n")) for s in ("all", "leaders")]
    return rows[0].unionByName(rows[1])


# ---- vendors' payloads ----


def _payload(spark, vendor: str, document, base: str = "https://b.com") -> DataFrame:
    df = _frame(spark, [(base, document if isinstance(document, str) else json.dumps(document))], "base_url string, payload string")
    return postings.from_personio(df) if vendor == "personio" else postings.from_vendor(df, vendor)


_JOBS = "job_title string, job_url string, job_location string, posted_date string, employment_type string"


@_expect(_JOBS, [("Dev", "https://g/1", "Oslo", "2026-01-02", "")])
def vendor_greenhouse(spark):
    return _payload(spark, "greenhouse", {"jobs": [{"title": "Dev", "absolute_url": "https://g/1", "updated_at": "2026-01-02T00:00:00Z", "location": {"name": "Oslo"}, "content": "x"}, {"title": ""}]})


@_expect(_JOBS, [("Ops", "https://l/1", "Rome", "2026-01-01", "Full-time")])
def vendor_lever(spark):
    return _payload(spark, "lever", [{"text": "Ops", "hostedUrl": "https://l/1", "createdAt": 1767225600000, "categories": {"location": "Rome", "commitment": "Full-time"}}])


@_expect(_JOBS, [("X", "https://s/1", "Oslo", "2026-02-03", "Permanent"), ("Z", "", "", "", "")])
def vendor_smartrecruiters(spark):
    """Postings whose status is neither active, published nor blank are left out."""
    return _payload(spark, "smartrecruiters", {"content": [{"name": "X", "status": "ACTIVE", "ref": "https://s/1", "location": {"city": "Oslo"}, "releasedDate": "2026-02-03T09:00:00Z", "typeOfEmployment": {"label": "Permanent"}}, {"name": "Y", "status": "CANCELLED"}, {"name": "Z"}]})


@_expect(_JOBS, [("A", "https://b.com/j/AB12", "Athens, Greece", "2026-01-05", "Full-time")])
def vendor_workable(spark):
    return _payload(spark, "workable", {"jobs": [{"title": "A", "shortcode": "AB12", "location": {"location_str": "Athens, Greece"}, "published_on": "2026-01-05", "employment_type": "Full-time"}]})


@_expect("job_title string, job_url string", [("Dev", "https://b.com/o/dev-1")])
def vendor_recruitee(spark):
    return _payload(spark, "recruitee", {"offers": [{"title": "Dev", "slug": "dev-1"}]})


@_expect("job_title string", [("Q",)])
def vendor_breezy(spark):
    return _payload(spark, "breezy", {"positions": [{"name": "Q"}]})


@_expect("job_title string", [("A",), ("C",)])
def vendor_ashby(spark):
    """Only listed postings."""
    return _payload(spark, "ashby", {"jobs": [{"title": "A", "isListed": True}, {"title": "B", "isListed": False}, {"title": "C"}]})


@_expect("job_title string, employment_type string, job_url string, job_description string, job_location string", [("Intern", "Internship", "https://b.com/job/7", "T\nV", "Berlin")])
def vendor_personio(spark):
    return _payload(spark, "personio", "<workzag-jobs><position><id>7</id><office>Berlin</office><name>Intern</name><employmentType>intern</employmentType><jobDescriptions><jobDescription><name>T</name><value>V</value></jobDescription></jobDescriptions></position></workzag-jobs>")


@_expect("job_title string, employment_type string, posted_date string", [("J0", "", "2026-02-01"), ("J1", "Full time", "2026-02-02"), ("J2", "", "2026-02-01")])
def vendor_workday_details(spark):
    """A listing enriched by details; the reported total is no limit."""
    listing = _payload(spark, "workday", {"total": 1, "jobPostings": [{"title": f"J{i}", "externalPath": f"/job/{i}", "postedOn": "2026-02-01", "locationsText": "2 Locations"} for i in range(3)]}).withColumn("path", F.concat(F.lit("/job/"), F.substring("job_title", 2, 1)))
    details = _frame(spark, [("/job/1", "Full time", "2026-02-02")], "path string, kind string, start string")
    return postings.with_details(listing, details, "path", {"kind": "employment_type", "start": "posted_date"})


@_expect("said string", [("Oslo; Rome",), ("Paris",)])
def workday_places(spark):
    rows = _frame(spark, [("2 locations", ["Oslo", "Rome", "Oslo"]), ("Paris", ["Oslo"])], "text string, places array<string>")
    return rows.select(postings.workday_location(F.col("text"), F.col("places")).alias("said"))


@_expect("n int", [(0,)])
def vendor_broken_payload(spark):
    return _payload(spark, "greenhouse", "not json").agg(F.count("*").alias("n"))


def _vendor_named(vendor: str, document, title: str) -> None:
    def f(spark):
        return _payload(spark, vendor, document)

    f.__name__ = f"vendor_{vendor}"
    _expect("job_title string", [(title,)])(f)


_vendor_named("jazzhr", {"jobs": [{"title": "Cook"}]}, "Cook")
_vendor_named("bamboo", {"result": [{"jobOpeningName": "Guard"}]}, "Guard")
_vendor_named("eightfold", {"positions": [{"name": "Pilot"}]}, "Pilot")
_vendor_named("cornerstone", {"data": {"requisitions": [{"displayJobTitle": "Nurse"}]}}, "Nurse")

# ---- JSON and structured pages ----

_LD = '<html><head><title>T</title><script type="application/ld+json">{"@graph": [{"@type": ["JobPosting"], "title": "Dev", "datePosted": "2026-01-02", "baseSalary": {"currency": "EUR", "value": {"minValue": 10, "maxValue": 20}}, "jobLocation": [{"address": {"addressLocality": "Oslo", "addressCountry": "NO"}}, {"address": {"addressLocality": "Oslo", "addressCountry": "NO"}}], "skills": ["b", {"name": "a"}]}]}</script></head><body></body></html>'
_MICRO = '<div itemscope itemtype="https://schema.org/JobPosting"><h1 itemprop="title">Nurse</h1><span itemprop="datePosted">2026-03-04</span><div itemprop="jobLocation" itemscope itemtype="https://schema.org/Place"><span itemprop="addressLocality">Bonn</span></div></div>'
_TABLE = "<table><tr><th>Position</th><th>Location</th></tr><tr><td>Cook</td><td>Rome</td></tr><tr><td></td><td>x</td></tr></table>"


@_expect("url string, job_title string, posted_date string, job_location string, salary string, currency string, skills string, source string", [("u1", "Dev", "2026-01-02", "Oslo, NO", "10 - 20", "EUR", "a; b", "jsonld")])
def json_ld_postings(spark):
    return postings.from_pages(_pages(spark, {"u1": _LD, "u4": None, "u5": ""}))


@_expect("url string, job_title string, posted_date string, source string", [("u2", "Nurse", "2026-03-04", "microdata")])
def microdata_postings(spark):
    return postings.from_pages(_pages(spark, {"u2": _MICRO}))


@_expect("url string, job_title string, job_location string", [("u3", "Cook", "Rome")])
def table_postings(spark):
    return postings.from_pages(_pages(spark, {"u3": _TABLE}))


_SHAPES = {"list": [{"jobTitle": "A", "city": "X", "link": "/1"}, {"jobTitle": "B"}], "under data": {"data": [{"jobTitle": "A"}, {"jobTitle": "B"}]}, "two deep": {"data": {"results": [{"title": "A"}, {"title": "B"}]}}, "vagas": {"vagas": [{"cargo": "A"}, {"cargo": "B"}]}, "one": [{"jobTitle": "A"}], "other": [{"x": 1}, {"x": 2}]}


@_expect("shape string, titles string", [("list", "A B"), ("under data", "A B"), ("two deep", "A B"), ("vagas", "A B"), ("one", ""), ("other", "")])
def unknown_json(spark):
    """Lists of postings found in JSON of any shape."""
    rows = _frame(spark, [(k, json.dumps(v)) for k, v in _SHAPES.items()], "shape string, payload string")
    found = postings.probed_postings(F.col("payload"), F.lit("https://b.com"))
    return rows.select("shape", F.array_join(F.transform(found, lambda x: x["job_title"]), " ").alias("titles"))


@_expect("kind string, said string", [("salvage", "2"), ("salvage inner", "2"), ("words", "a b"), ("place", "Oslo, NO"), ("pay", "10|20|EUR"), ("skills", "a; b"), ("walk", "3")])
def json_pieces(spark):
    """The parts that structured postings are read with: broken JSON, texts, places, pay, skills, every dict of a tree."""
    made = [
        ("salvage", str(len(list(postings.walk(postings.salvage('{"a": {"b": 1}}')))))),
        ("salvage inner", str(len(list(postings.walk(postings.salvage('var x = {"a": {"b": 1}};')))))),
        ("words", postings.words(["a", {"name": "b"}])),
        ("place", postings.place({"address": {"addressLocality": "Oslo", "addressCountry": "NO"}})),
        ("pay", "|".join(postings.pay({"currency": "EUR", "value": {"minValue": 10, "maxValue": 20}}))),
        ("skills", postings.skill_list(["b", {"name": "a"}])),
        ("walk", str(len(list(postings.walk({"a": [{"b": 1}, {"c": {}}]}))) - 1)),
    ]
    return _frame(spark, made, "kind string, said string")


# ---- pages ----

_HUB = '<a href="/jobs/dev-1">Software Engineer</a><a href="/jobs/dev-1#x">again</a><a href="?page=2">2</a><a href="/careers">View all jobs</a><a href="https://other.io/careers">Jobs</a><a href="https://linkedin.com/jobs">x</a><a href="mailto:x">m</a><iframe src="https://acme.recruitee.com/o"></iframe>'


@_expect("kind string, link string", [("posting", "https://a.com/jobs/dev-1"), ("pagination", "https://a.com/x?page=2"), ("listing", "https://a.com/careers"), ("handoff", "https://other.io/careers"), ("board", "https://acme.recruitee.com/o")])
def links_by_kind(spark):
    pages = _pages(spark, {"https://a.com/x": _HUB})
    found = P.links(pages)
    kinds = {"posting": P.posting_links(found), "pagination": P.pagination_links(found), "listing": P.listing_links(found), "handoff": P.handoff_candidates(found), "board": P.board_of(pages)}
    rows = None
    for kind, df in kinds.items():
        part = df.select(F.lit(kind).alias("kind"), "link")
        rows = part if rows is None else rows.unionByName(part)
    return rows


@_expect("vendor string, slug string", [("recruitee", "acme")])
def vendor_links_of_page(spark):
    return P.vendor_links(_pages(spark, {"https://a.com/x": _HUB}))


@_expect("link string", [("https://a.com/careers",), ("https://a.com/jobs/dev-1",)])
def career_branches_of_hub(spark):
    return P.career_branches(P.links(_pages(spark, {"https://a.com/x": _HUB})))


@_expect("text string, href string, score int", [("View all jobs", "https://a.com/careers", 5), ("Software Engineer", "https://a.com/jobs/dev-1", 2)])
def career_links_scored(spark):
    return attribution.career_links(P.links(_pages(spark, {"https://a.com/x": _HUB})).drop("link"))


@_expect("url string, board string", [("https://a.com/x", "https://other.io/careers")])
def structural_handoff(spark):
    board = "<html><body><h1>Open jobs</h1>" + "".join(f'<a href="/jobs/role-{i}">R{i}</a>' for i in range(9)) + "<p>Apply now for any of these roles, we would like to hear from you.</p>" + "x" * 400 + "</body></html>"
    pages = _pages(spark, {"https://a.com/x": _HUB, "https://other.io/careers": board})
    return P.handoff(P.links(pages.where("url = 'https://a.com/x'")), pages, 2)


@_expect("k string, board boolean, shell boolean", [("b", True, False), ("s", False, True)])
def boards_and_shells(spark):
    board = "<html><body><h1>Open jobs</h1>" + "".join(f'<a href="/jobs/role-{i}">R{i}</a>' for i in range(9)) + "<p>Apply now for any of these roles, we would like to hear from you.</p>" + "x" * 400 + "</body></html>"
    df = _frame(spark, [("b", board), ("s", '<html><body><div id="root"></div><script src="a.js"></script></body></html>')], "k string, html string").withColumn("p", html.page(F.col("html")))
    return df.select("k", (html.board_signals(F.col("html"), F.col("p")) >= 2).alias("board"), html.is_script_shell(F.col("p")).alias("shell"))


_DETAIL = "<h1>Cook</h1><dl><dt>Location</dt><dd>Rome</dd></dl><p><b>Job type</b>: Full time</p><p>Deadline: 3/4/2026</p><p>" + "We cook good food here. " * 8 + "Apply now.</p>"


@_expect("url string, job_title string, job_location string, employment_type string, application_deadline string, source string", [("u", "Cook", "Rome", "Full time", "2026-04-03", "generic-detail"), ("v", None, None, None, None, None)])
def detail_pages(spark):
    df = _pages(spark, {"u": _DETAIL, "v": "<h1>Cook</h1>short"})
    return df.select("url", P.detail_posting(F.col("page"), F.col("url"), F.lit("2026-01-01")).alias("d")).select("url", "d.*")


@_expect("job_title string, job_location string, application_deadline string, posted_date string", [("Chef", "Oslo, Norway", "2026-06-05", "2026-01-01")])
def detail_overlay(spark):
    df = _pages(spark, {"hr": '<meta property="og:title" content="Chef"><meta name="keywords" content="a, Oslo, Norway, z"><p>Deadline: 05-06-2026</p>'})
    return df.select(P.overlay(F.col("page"), F.lit("x"), F.lit("2026-01-01"), F.lit(""), F.lit("hr"), F.lit("2026-01-01")).alias("o")).select("o.*")


@_expect("label string, said string", [("Location", "Rome"), ("Deadline", "3/4/2026"), ("Missing", "")])
def labelled_values(spark):
    df = _pages(spark, {"u": _DETAIL})
    rows = None
    for label in ("Location", "Deadline", "Missing"):
        part = df.select(F.lit(label).alias("label"), P.labelled_value(F.col("page.lines"), label).alias("said"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@_expect("job_title string", [("Nurse (m/w/d)",)])
def inline_vacancies(spark):
    body = "<h2>Nurse (m/w/d)</h2><p>" + "care " * 60 + "apply</p><h2>About us</h2><h2>Cook (m/f)</h2><p>short</p>"
    return _pages(spark, {"w": body}).select(F.explode(P.inline_postings(F.col("page"))).alias("x")).select("x.job_title")


@_expect("title string", [("Senior Accountant",)])
def boxed_vacancies(spark):
    body = '<div class="job-item"><h4>Senior Accountant</h4> A role in our team in Oslo, with a deadline soon: please apply.</div><div class="job-item"><b>Jobs</b> a position in our team, apply before the deadline</div>'
    return _pages(spark, {"b": body}).select(F.explode(P.box_postings(F.col("page"))).alias("x")).select("x.title")


@_expect("title string, site string, h1 string, text string", [("A & B", "S", "H x", "H x one go now")])
def page_parts(spark):
    p = _pages(spark, {"u": '<title>A &amp; B</title><meta property="og:site_name" content="S"><h1>H <b>x</b></h1><p>one</p><a href="/j">go <i>now</i></a><script>var x="</p>"</script>'})
    return p.select("page.title", F.col("page.metas")["og:site_name"].alias("site"), F.array_join("page.h1", " ").alias("h1"), "page.text")


# ---- attribution and acceptance ----

_SEARCH = [("Eurofins", 1, 0, "https://jobs.other.com/careers", ""), ("Eurofins", 1, 1, "https://eurofins.recruitee.com/o/x", ""), ("Eurofins", 2, 0, "https://eurofins.com/careers", "")]
_RESULTS = "company string, query_no int, rank int, url string, website string"


@_expect("url string, base int", [("https://a.com/careers", 90), ("https://a.com/x", 20)])
def ranked_candidates(spark):
    c = _frame(spark, [("a", "https://a.com/x", "search", 0), ("a", "https://a.com/careers", "common_path", 1), ("a", "https://a.com/careers/#x", "homepage_link", 2)], "company string, url string, method string, ordinal int")
    return attribution.rank_candidates(c)


@_expect("company string, url string, method string", [("Eurofins", "https://eurofins.com", "guess"), ("Beta Corp", "https://b.com", "input_unverified")])
def resolved_homepages(spark):
    p = "company string, ordinal int, origin string, url string, alive boolean, parked boolean, evidence double, share double, n int"
    rows = [("Eurofins", 0, "input", "https://x.com", True, False, 0.1, 0.0, 1), ("Eurofins", 1, "guess", "https://eurofins.com", True, False, 0.9, 0.0, 1), ("Beta Corp", 0, "input", "https://b.com", True, False, 0.0, 0.0, 1), ("Gone", 0, "input", "https://g.com", False, False, 1.0, 1.0, 1)]
    return attribution.resolve_homepage(_frame(spark, rows, p))


@_expect("url string", [("https://eurofins.recruitee.com/o/x",)])
def accepted_pages(spark):
    return attribution.accept_pages(_frame(spark, _SEARCH, _RESULTS))


@_expect("url string", [("https://eurofins.recruitee.com/o/x",)])
def accepted_boards(spark):
    return attribution.accept_boards(_frame(spark, _SEARCH, _RESULTS))


@_expect("website string, score int", [("https://www.eurofins.com", 30)])
def website_roots(spark):
    return attribution.website_candidates(_frame(spark, _SEARCH, _RESULTS).where("query_no = 2"))


@_expect("url string, outcome string", [("https://eurofins.com/j", "accepted"), ("https://x.com/j", "no_evidence"), ("https://eurofins.com/k", "unparseable"), ("https://gone.com", "unfetchable")])
def internet_fallback(spark):
    ld = '<script type="application/ld+json">[{"@type": "JobPosting", "title": "A", "url": "https://a.com/j/A"}]</script>'
    site = {"https://eurofins.com/j": "<title>Eurofins</title>apply " + ld, "https://x.com/j": "apply " + ld, "https://eurofins.com/k": "<title>Eurofins</title> apply here"}
    pages = _pages(spark, site)
    asked = _frame(spark, [("Eurofins", u, "https://eurofins.com") for u in [*site, "https://gone.com"]], "company string, url string, website string")
    return P.verified(asked, pages, postings.from_pages(pages))


_CHAIN = [("q", 1, 0, "https://a.com#x"), ("q", 2, 0, "https://a.com"), ("q", 2, 1, "https://b.com"), ("q", 3, 0, "https://c.com"), ("r", 2, 0, "https://d.com"), ("r", 3, 0, "https://e.com")]


@_expect("query string, engine int, url string", [("q", 1, "https://a.com"), ("q", 2, "https://b.com"), ("r", 2, "https://d.com"), ("r", 3, "https://e.com")])
def chained_search(spark):
    """Two results wanted: the first query stops after its second engine, the other after its third."""
    return attribution.search_chain(_frame(spark, _CHAIN, "query string, engine int, rank int, url string"), 2)


@_expect("page string, url string", [("p", "https://a.com/b"), ("q", "https://c.com")])
def first_selector_that_yields(spark):
    rows = [("p", 0, 0, "/relative"), ("p", 1, 0, "https://r.com/?uddg=https%3A%2F%2Fa.com%2Fb"), ("p", 2, 0, "https://z.com"), ("q", 0, 0, "https://c.com"), ("q", 1, 0, "https://d.com")]
    return attribution.first_selector(_frame(spark, rows, "page string, selector int, pos int, href string"))


_truth("resolvable_names", urls.looks_resolvable, {"acme.com": True, "localhost": True, "no dots": False, "a,b.com": False, "nodot": False, "": False}, "boolean")


@_expect("host string", [("a.com",), ("new.com",)])
def resolved_hosts(spark):
    rows, answers = _frame(spark, [("a.com",), ("gone.com",), ("new.com",), ("bad host",)], "host string"), _frame(spark, [("a.com", True), ("gone.com", False)], "host string, resolved boolean")
    return urls.resolvable(rows, "host", answers)


@_expect("vendor string, slug string", [("ownboard", "acme")])
def vendors_by_own_table(spark):
    v = urls.vendor(F.lit("https://jobs.ownboard.example/acme/1"), urls.board_hosts("ownboard.example ownboard path"))
    return spark.range(1).select(v["vendor"].alias("vendor"), v["slug"].alias("slug"))


_BOARDS = [("Acme Widgets", 0, "https://other.recruitee.com", 0.1, 5), ("Acme Widgets", 1, "https://acme.recruitee.com", 0.0, 0), ("Acme Widgets", 2, "https://x.recruitee.com", 0.9, 3), ("Acme Widgets", 3, "https://acme.breezy.hr", 0.0, 7), ("Beta Corp", 0, "https://nobody.com", 1.0, 9)]


@_expect("company string, url string, vendor string, jobs int", [("Acme Widgets", "https://x.recruitee.com", "recruitee", 3)])
def board_by_name(spark):
    """The first board that is the company's, by slug or page, and has postings."""
    return attribution.board_fallback(_frame(spark, _BOARDS, "company string, ordinal int, url string, evidence double, jobs int"))


@_expect("company string, status string, source string, jobs int", [("a", "ok", "internet-company-name-search", 2), ("b", "ok", "ats-board-name-search", 3), ("c", "no_jobs", "said so", 0), ("d", "unreachable", "internet-company-name-search:no-verified-results", 0)])
def terminal_choice(spark):
    ended = _frame(spark, [("a", "unreachable", ""), ("b", "unsupported", "x"), ("c", "no_jobs", "said so"), ("d", "unreachable", "")], "company string, status string, source string")
    jobs = lambda rows: _frame(spark, rows, "company string, jobs int")
    return attribution.terminal(ended, jobs([("a", 2), ("c", 0)]), jobs([("a", 9), ("b", 3)]))


# ---- runs, exports, incremental work ----


def _ld(titles: list[str]) -> str:
    return '<script type="application/ld+json">' + json.dumps([{"@type": "JobPosting", "title": t, "url": f"https://a.com/j/{t}"} for t in titles]) + "</script>"


def _site() -> dict[str, str]:
    site = {"https://a.com": '<a href="/careers">Careers</a>'}
    for i in range(1, 4):
        site["https://a.com/careers" + ("" if i == 1 else f"?page={i}")] = _ld([f"{i}-{k}" for k in range(5)]) + (f'<a href="/careers?page={i + 1}">Next</a>' if i < 3 else "")
    return site | {"https://b.com": '<a href="/jobs">Jobs</a>', "https://b.com/jobs": "We currently have no open positions", "https://c.com": "hello", "https://d.com": '<a href="/careers">Careers</a>', "https://d.com/careers": "something"}


def _found(spark) -> DataFrame:
    return run.results(_frame(spark, [(x, f"https://{x}.com") for x in "abcde"], "company string, home string"), _pages(spark, _site()))


@_expect("company string, status string, jobs int", [("a", "ok", 15), ("b", "no_jobs", 0), ("c", "career_not_found", 0), ("d", "unsupported", 0), ("e", "unreachable", 0)])
def run_results(spark):
    return _found(spark).select("company", "status", F.size("jobs").alias("jobs"))


@_expect("job_status string, extraction_status string, extraction_confidence string, n int", [("Active", "Job Detail Extracted", "High", 15), ("No Jobs Found", "Explicit No-Openings Evidence", "High", 1), ("Career Page Not Found", "Career Page Not Found", "Low", 1), ("Career Page Found - Extraction Unsupported", "Extraction Unsupported", "Low", 1), ("Unreachable", "Website Unreachable", "Low", 1)])
def result_rows_of_run(spark):
    """The 39 columns of a run's rows: a row a posting, or one of status."""
    named = _found(spark).select(F.col("company").alias("company_name"), F.lit("").alias("country"), F.col("home").alias("website"), "status", "source", "jobs", "career_page_url")
    rows = export.result_rows(named, F.lit("now"))
    return rows.groupBy("job_status", "extraction_status", "extraction_confidence").agg(F.count("*").alias("n"))


@_expect("company string, url string, depth int", [("a", "https://a.com/careers", 0), ("a", "https://a.com/careers?page=2", 1), ("a", "https://a.com/careers?page=3", 2)])
def pages_walked(spark):
    return run.crawl(_frame(spark, [("a", "https://a.com/careers")], "root string, url string"), _pages(spark, _site())).withColumnRenamed("root", "company")


@_expect("name string", [("n0",), ("n12",), ("n16",), ("n4",), ("n8",)])
def selected_companies(spark):
    rows = _frame(spark, [(f"n{i}", "w", ["USA", "Italy"][i % 2], i) for i in range(20)], "name string, website string, country string, row_idx long")
    return run.select_companies(rows, _frame(spark, [("n2|w",)], "key string"), ["USA"], (0, 2, "interleave"))


@_expect("name string", [("n4",), ("n6",)])
def selected_block(spark):
    rows = _frame(spark, [(f"n{i}", "w", ["USA", "Italy"][i % 2], i) for i in range(20)], "name string, website string, country string, row_idx long")
    return run.select_companies(rows, _frame(spark, [("n2|w",)], "key string"), ["USA"], (0, 2, "block"), 1, 3)


def _export(spark) -> tuple[DataFrame, DataFrame, DataFrame]:
    companies = _frame(spark, [("1", "Acme", "Germany", "acme.de", "i1", "d1", "P1"), ("2", "Beta", "USA", "", "i2", "d2", "P2"), ("3", "ACME ", "Germany", " Acme.de", "i3", "d3", "P3")], "KEYID string, COMPANY_NAME string, COUNTRY string, WEBSITE string, ID_Company string, DUNS_NUMBER string, PARTY_NAME string")
    job = {"job_title": "Chief Financial Officer", "job_location": "Berlin, Germany", "job_url": "u1", "salary": "$5", "min_salary": "5"}
    schema = "company_name string, country string, website string, status string, source string, jobs array<struct<job_title:string,job_location:string,job_url:string,salary:string,min_salary:string>>"
    found = _frame(spark, [("acme", "Germany", "acme.de", "ok", "jsonld", [job, job | {"job_url": "u2", "job_title": "Clerk", "job_location": "Paris, France"}]), ("Gamma", "", "", "no_jobs", "", [])], schema)
    scraped = export.result_rows(found, F.lit("now")).withColumn("row_idx", F.monotonically_increasing_id())
    return companies, scraped, export.postings(companies, scraped)


@_expect("KEYID string, job_url string, num_positions int", [("1", "u1", 2), ("1", "u2", 2), ("3", "u1", 2), ("3", "u2", 2)])
def joined_postings(spark):
    """Two companies share the key, so both have both postings; each carries the number of its company's."""
    return _export(spark)[2]


@_expect("KEYID string, title string, level string, country string", [("1", "Chief Financial Officer", "C-Level", "Germany"), ("3", "Chief Financial Officer", "C-Level", "Germany")])
def delivered_rows(spark):
    return export.delivery(_export(spark)[2]).select("KEYID", F.col("Job Title").alias("title"), F.col("Seniority Level").alias("level"), F.col("Country").alias("country"))


@_expect("KEYID string, status string, postings int, leadership_postings int", [("1", "Jobs Found", 2, 1), ("2", "NOT PROCESSED", 0, 0), ("3", "Jobs Found", 2, 1)])
def covered_companies(spark):
    return export.coverage(*_export(spark))


@_expect("metric string, value long", [("companies", 3), ("postings", 4), ("leadership_postings", 2), ("not_processed", 1)])
def export_summary(spark):
    c, s, p = _export(spark)
    return export.summary(c, p, export.coverage(c, s, p)).where(F.col("metric").isin("companies", "postings", "leadership_postings", "not_processed"))


@_expect("employment_type string, seniority_level string, job_category string, education_type string, years_of_experience_min string, years_of_experience_max string, min_salary string, max_salary string, currency string, skills string", [("Contract", "Senior", "Information Technology", "Bachelor", "3", "5", "70000", "90000", "USD", "Python")])
def enriched_posting(spark):
    """Blanks are filled; what a posting states stays."""
    body = "Salary range $70,000 - $90,000. We need 3-5 years of Python and a bachelor's degree in engineering. Full-time."
    return export.enrich(_frame(spark, [("Senior Software Engineer", body, "Contract")], "job_title string, plain_text string, employment_type string"))


_STATES = [("u1", "Active", "", ""), ("u2", "Active", "", "2026-01-09T00:00:00Z"), ("u3", "Closed", "x", "")]
_SEEN = [("u1", 404, "u1", "", False), ("u2", 404, "u2", "", False)]


def _recheck(spark) -> tuple[DataFrame, DataFrame]:
    return _frame(spark, _STATES, "job_url string, job_status string, closed_date string, last_checked_at string"), _frame(spark, _SEEN, "job_url string, http_status int, final_url string, visible string, has_posting boolean")


@_expect("job_url string, job_status string, closed_date string, last_checked_at string", [("u1", "Closed", "2026-01-10", "2026-01-10T00:00:00Z"), ("u2", "Active", "", "2026-01-09T00:00:00Z"), ("u3", "Closed", "x", "")])
def rechecked_rows(spark):
    return incremental.recheck(*_recheck(spark), F.lit("2026-01-10").cast("timestamp"), 7)


@_expect("checked long, closed long, skipped long, failed long", [(1, 1, 2, 0)])
def recheck_counts(spark):
    return incremental.recheck_stats(*_recheck(spark), F.lit("2026-01-10").cast("timestamp"), 7)


_VERDICTS = [(None, "u", "", False, "request_failed"), (404, "u", "", True, "http_404"), (500, "u", "", False, "http_500"), (200, "u", "This job has expired", True, "closed_message"), (200, "https://a.com/careers", "", True, "redirected_to_listing_root"), (200, "https://a.com/jobs/dev/12", "", False, "active_or_inconclusive")]


@_expect("closed boolean, reason string", [(v[3], v[4]) for v in _VERDICTS])
def page_verdicts(spark):
    rows = _frame(spark, [v[:3] for v in _VERDICTS], "status int, final string, visible string")
    said = incremental.verdict(F.col("status"), F.col("final"), F.lit("https://a.com/jobs/dev/12"), F.col("visible"), F.lit(False))
    return rows.select(said["closed"].alias("closed"), said["reason"].alias("reason"))


@_expect("row_id string, result string, error string", [("1", '{"seniority": "Senior", "min_years": 3}', None), ("2", None, "seniority is not in the list"), ("3", None, "not an object")])
def processed_answers(spark):
    rows = [("0", "x", "{}"), ("1", "x", '```json\n{"seniority": "Senior", "min_years": 3}\n```'), ("2", "x", '{"seniority": "Boss"}'), ("3", "x", "sorry")]
    return incremental.process(_frame(spark, rows, "row_id string, text string, answer string"), _frame(spark, [("0",)], "row_id string"))


# ---- streams over stated events ----

_AT = [("a", i, i, True) for i in range(5)] + [("a", 100, 5, False), ("a", 400, 6, False), ("b", 0, 7, False)]


def _stream(spark) -> DataFrame:
    path = fresh_path(spark, "case")
    rows = _frame(spark, _AT, "key string, at long, event_id long, failed boolean").select("key", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("at")).alias("ts"), "event_id", "failed").coalesce(1)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def _marks(said: dict[int, bool]) -> list[tuple]:
    return sorted(said.items())


@_expect("event_id long, allowed boolean", _marks({0: True, 1: True, 2: True, 3: True, 4: True, 5: False, 6: True, 7: True}))
def breaker_on_events(spark):
    return state.drain(state.breaker(_stream(spark)), "breaker")


@_expect("event_id long, skipped boolean", _marks({0: False, 1: False, 2: False, 3: True, 4: True, 5: True, 6: True, 7: False}))
def dead_hosts_on_events(spark):
    return state.drain(state.dead_hosts(_stream(spark)), "dead")


@_expect("event_id long, hit boolean", _marks({0: False, 1: True, 2: True, 3: True, 4: True, 5: True, 6: False, 7: False}))
def ttl_cache_on_events(spark):
    return state.drain(state.ttl_cache(_stream(spark)), "cache")


@_expect("event_id long", [(i,) for i in range(8)])
def resumed_append(spark):
    """Two runs over the same events add each once."""
    path = fresh_path(spark, "case")
    for _ in range(2):
        q = state.resume(_stream(spark), f"{path}/out", "event_id", fresh_path(spark, "case")).trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(f"{path}/out").select("event_id")


@_expect("node int, depth int", [(1, 0), (2, 1), (3, 2), (4, 3)])
def frontier_levels(spark):
    edges = _frame(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (9, 1)], "src int, dst int")
    return relational.reachable(spark, edges, _frame(spark, [(1,)], "node int"), 3)
