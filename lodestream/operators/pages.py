"""What pages link to and say: listings, pagination, postings, sub-pages, unknown boards, labelled values, details.

Inputs are pages (url, page) with the struct of ``functions.html.page``; every operator is
a select over it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, numbers, text, urls
from ..functions import vocabulary as V
from ..functions.html import board_signals
from ..functions.rules import filled, first_match, matches
from .relational import keep_first, top_per_key

# ---- fixed values: links to postings, listings and further pages; calls to apply ----
JOB_LINK = (
    r"(/job[s]?/[a-zA-Z0-9_\-]+|/jobdetail\b|jobdetail\.ftl|jobid\s*[=:]|job-req\b|/position[s]?/[a-zA-Z0-9_\-]+|/officerole|careers/\d+|/job[s]?\.php|/viewjob\b|/careers/[a-z0-9\-]+/job"
    r"|candidate\.hr-manager\.net/ApplicationInit\.aspx|/vacanc(?:y|ies)/[^/?#]+|/open(?:-)?positions?/[^/?#]+|[?&](?:job|jobid|job_id|position|vacancy)(?:id)?=)"
)
LISTING_TEXT = (
    r"\b(view|see|explore|search|browse|current|open|available|all)\b.{0,30}\b(jobs?|positions?|openings?|vacancies|opportunities)\b"
    r"|\b(jobs?|positions?|openings?|vacancies)\b.{0,20}\b(view|search|current|open|all)\b"
)
NEXT_TEXT = r"^(?:next|older|more|load more|»|›|>|\d{1,4}|weiter|suivant|siguiente)$"
NEXT_LINK = r"[?&](?:page|p|pg|start|offset|from)=\d+|/page/\d+"
NOT_A_POSTING = r"/wp-content/|/assets/|/static/|/img/|/images/|facebook|linkedin|twitter|instagram|youtube|\.xml$|/feed|/api/|/login|/signup|/admin|/news/|/blog|/about|/contact|/team|/events|/press|/faq"
NOT_A_BRANCH = r"/(?:how-to-apply|contact|faq|benefits|why-|about|privacy|terms|login|sign-?in)\b|\.(?:pdf|docx?|xlsx?|jpe?g|png|gif|zip)$"
APPLY = r"\b(?:apply|application|submit your cv|send your cv|ansøg|bewerb(?:en|ung|ungsunterlagen)|interessiert|lebenslauf|curriculum vitae)\b|\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"
INLINE_TITLE = r"\((?:m|w|d|f|x)(?:\s*[/|,\-]\s*(?:m|w|d|f|x)){1,}\)|\b(?:vacancy|open position|we are hiring|wir suchen)\s*[:\-]"
JOB_WORDS = r"\b(?:apply|job description|responsibilities|qualifications|vacancy|stellenangebot|aufgaben|bewerb(?:en|ung))\b"
HR_MANAGER = r"candidate\.hr-manager\.net/ApplicationInit\.aspx"
LABELS = {
    "job_location": "location|work location|workplace|arbejdssted|region|standort|arbeitsort",
    "job_category": "category|department|team|function|berufsfeld|bereich|abteilung",
    "employment_type": "employment type|job type|work type|schedule|arbejdstid|anstellungsart|beschäftigungsart",
    "application_deadline": "application deadline|closing date|deadline|ansøgningsfrist|bewerbungsfrist",
}
# ---- fixed values: which vendors to ask about first, by country ----
VENDOR_GROUPS = 5
FIRST_GROUP = {"brazil": 3, "portugal": 3, "argentina": 3, "chile": 3, "mexico": 3, "colombia": 3, "germany": 4, "austria": 4, "switzerland": 4, "india": 4}


def group_order(country: Column) -> Column:
    """Groups of vendors in the order to try them: the country's own first."""
    table = F.map_from_arrays(F.array(*map(F.lit, FIRST_GROUP)), F.array(*map(F.lit, FIRST_GROUP.values())))
    first = F.try_element_at(table, F.lower(F.trim(country)))
    every = F.sequence(F.lit(0), F.lit(VENDOR_GROUPS - 1))
    return F.when(first.isNull(), every).otherwise(F.concat(F.array(first), F.filter(every, lambda i: i != first)))


def links(pages: DataFrame) -> DataFrame:
    """(url, pos, text, href, link) of every link, resolved; those that resolve to nothing go."""
    rows = pages.select("url", F.posexplode("page.links").alias("pos", "a")).select("url", "pos", "a.text", "a.href")
    return rows.withColumn("link", urls.join(F.col("url"), F.col("href"))).where("link != ''")


def _once(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Each target of a page once, where it stands first; pages themselves are no targets."""
    rows = rows.withColumn("__id", urls.identity(F.col("link"))).where(F.col("__id") != urls.identity(F.col("url")))
    rows = keep_first(rows, ["url", "__id"], ["pos"])
    return (rows if most is None else top_per_key(rows, ["url"], ["pos"], most)).drop("__id")


def listing_links(found: DataFrame) -> DataFrame:
    return _once(found.where(matches(F.concat_ws(" ", "text", "href"), LISTING_TEXT) & ~matches(F.col("link"), NOT_A_POSTING)))


def pagination_links(found: DataFrame) -> DataFrame:
    """Links to further pages of the same site."""
    further = matches(F.trim("text"), NEXT_TEXT) & (matches(F.col("link"), NEXT_LINK) | F.trim("text").rlike(r"(?i)next|older|more|weiter"))
    return _once(found.where((further | matches(F.col("href"), NEXT_LINK)) & urls.same_domain(F.col("url"), F.col("link"))))


def posting_links(found: DataFrame) -> DataFrame:
    """Links to postings, those that read like titles first: (url, link, text, score)."""
    rows = _once(found.where(matches(F.col("link"), JOB_LINK) & ~matches(F.col("link"), NOT_A_POSTING)))
    return rows.withColumn("score", F.when(text.looks_like_title(F.col("text")), 2).otherwise(1))


def career_branches(found: DataFrame, most: int = 40) -> DataFrame:
    """Career pages of the same site that a hub links to, without pages that only inform."""
    career = text.is_career_link(F.col("text"), F.col("link"))
    return _once(found.where(career & urls.same_domain(F.col("url"), F.col("link")) & ~matches(F.col("link"), NOT_A_BRANCH)), most)


def vendor_links(pages: DataFrame) -> DataFrame:
    """(url, link, vendor, slug) of every vendor's address on a page: links, frames, scripts, forms."""
    sources = pages.select("url", F.posexplode("page.sources").alias("pos", "href")).withColumn("link", urls.join(F.col("url"), F.col("href")))
    every = links(pages).select("url", "pos", "link").unionByName(sources.select("url", (F.col("pos") + 100_000).alias("pos"), "link"))
    rows = every.withColumn("v", urls.vendor(F.col("link"))).where(F.col("v.vendor") != "")
    return _once(rows).select("url", "pos", "link", "v.vendor", "v.slug")


def board_of(pages: DataFrame) -> DataFrame:
    """(url, link, vendor, slug): the board that a page is or names, its own address first, then the best link."""
    own = pages.select("url", F.lit(-1).alias("pos"), F.col("url").alias("link"), urls.vendor(F.col("url")).alias("v")).where(F.col("v.vendor") != "").select("url", "pos", "link", "v.vendor", "v.slug")
    every = own.unionByName(vendor_links(pages)).where(urls.is_probable_board(F.col("link")))
    order = [F.col("pos") >= 0, F.col("slug") == "", F.length("link"), "vendor", "slug", "link"]
    return keep_first(every, ["url"], order).select("url", "link", "vendor", "slug")


def handoff_candidates(found: DataFrame, most: int = 2) -> DataFrame:
    """Links to other sites that look like boards by address (2) or by text (1): the best few per page."""
    away = ~urls.same_domain(F.col("url"), F.col("link")) & (urls.hostname(F.col("link")) != "") & ~matches(F.concat(urls.registrable_domain(urls.hostname(F.col("link"))), F.lit(".")), V.SOCIAL_HOST)
    by_url = matches(F.col("link"), r"/(?:jobs?|careers?|vacanc\w*|openings?|positions?|recruit\w*|stellen\w*|karriere|vagas?|empleos?|emplois?|apply)(?:/|$|\?)")
    by_text = matches(F.col("text"), r"job|caree?r|vacanc|position|opening|apply|stelle|vaga|emploi|empleo")
    rows = found.where(away).withColumn("score", F.when(by_url, 2).otherwise(0) + F.when(by_text, 1).otherwise(0)).where("score > 0")
    return top_per_key(_once(rows), ["url"], [F.desc("score"), F.length("link"), "link"], most)


def handoff(found: DataFrame, pages: DataFrame, least: int = 2) -> DataFrame:
    """(url, board): candidates whose captured page behaves like a board; pages has url, html, page."""
    boards = pages.where(board_signals(F.col("html"), F.col("page")) >= least).select(urls.identity(F.col("url")).alias("__id"))
    rows = handoff_candidates(found).withColumn("__key", urls.identity(F.col("link")))
    return rows.join(boards, F.col("__key") == F.col("__id"), "left_semi").select("url", F.col("link").alias("board"))


def labelled_value(lines: Column, labels: str) -> Column:
    """What follows a label on its line or on the next one."""
    found = F.regexp_extract(lines, rf"(?imuU)^(?:{labels})[ ]*(?::[ ]*|\n:?[ ]*)([^\n]+)$", 1)
    return text.clean_text(found, 500)


def detail_posting(p: Column, url: Column, as_of: Column) -> Column:
    """The posting of a conventional page: a title, 100 characters or more, a call to apply; null without."""
    title = text.clean_text(filled(F.try_element_at(p["metas"], F.lit("og:title")), F.get(p["h1"], 0)), 500)
    said = text.labelled(p["lines"])
    value = {name: labelled_value(p["lines"], labels) for name, labels in LABELS.items()}
    pay_text = filled(said["salary"], numbers.salary_evidence(p["text"]))
    pay = numbers.salary_breakdown(F.when(pay_text.rlike(r"\d"), pay_text).otherwise(""))
    good = (title != "") & (F.length(p["text"]) >= 100) & matches(p["text"], APPLY)
    row = F.struct(
        title.alias("job_title"), url.alias("job_url"), p["text"].alias("job_description"), value["job_location"].alias("job_location"), value["job_category"].alias("job_category"),
        filled(value["employment_type"], said["employment_type"]).alias("employment_type"), numbers.parse_date(value["application_deadline"], as_of).alias("application_deadline"),
        said["education_qualification"].alias("education_qualification"), said["seniority_level"].alias("seniority_level"), pay["salary"].alias("salary"), pay["min_salary"].alias("min_salary"), pay["max_salary"].alias("max_salary"), numbers.currency(pay_text).alias("currency"),
        F.lit("Active").alias("job_status"), F.lit("generic-detail").alias("source"),
    )
    return F.when(good, row)


def overlay(p: Column, job_title: Column, posted_date: Column, job_location: Column, job_url: Column, as_of: Column) -> Column:
    """What a page of the HR-Manager kind states over a listed row: title, date, place from its keywords, deadline day first."""
    meta = lambda k: F.coalesce(F.try_element_at(p["metas"], F.lit(k)), F.lit(""))
    parts = F.filter(F.transform(F.split(meta("keywords"), ","), lambda x: F.trim(x)), lambda x: x != "")
    place = F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), ", ")).otherwise("")
    d = r"\b(\d{1,2})-(\d{1,2})-(\d{4})\b"
    stated = labelled_value(p["lines"], LABELS["application_deadline"])
    day_first = F.concat_ws("-", F.regexp_extract(stated, d, 3), F.lpad(F.regexp_extract(stated, d, 2), 2, "0"), F.lpad(F.regexp_extract(stated, d, 1), 2, "0"))
    deadline = F.when(stated.rlike(d), day_first).otherwise(numbers.parse_date(stated, as_of))
    return F.struct(
        filled(meta("og:title"), meta("twitter:title"), job_title).alias("job_title"), filled(numbers.parse_date(meta("article:published_time"), as_of), posted_date).alias("posted_date"), filled(job_location, place).alias("job_location"),
        deadline.alias("application_deadline"), job_url.alias("job_url"), F.lit("Active").alias("job_status"), F.lit("hrmanager-detail").alias("source"),
    )


_INLINE = re.compile(INLINE_TITLE, re.I)
_APPLY = re.compile(APPLY, re.I)


def read_sections(lines: str, headings) -> list[dict]:
    """Vacancies written on a careers page: a heading with a vacancy's mark, and the text down to the next such heading."""
    rows = (lines or "").split("\n")
    marks = {h for h in (headings if headings is not None else []) if _INLINE.search(h)}
    starts = [i for i, line in enumerate(rows) if line in marks]
    found, seen = [], set()
    for k, i in enumerate(starts):
        body = " ".join(rows[i : starts[k + 1] if k + 1 < len(starts) else len(rows)])
        if rows[i].lower() not in seen and 200 <= len(body) <= 30000 and _APPLY.search(body):
            seen.add(rows[i].lower())
            found.append({"job_title": rows[i][:500], "job_description": body})
    return found


def inline_postings(p: Column) -> Column:
    """Vacancies written on a page itself, as an array of (job_title, job_description)."""

    @F.pandas_udf("array<struct<job_title:string,job_description:string>>")
    def read(lines: pd.Series, headings: pd.Series) -> pd.Series:
        return pd.Series([read_sections(x, h) for x, h in zip(lines, headings, strict=True)])

    return read(p["lines"], p["headings"])


BOX_TEXT = r"\b(?:vacancy|position|role|job)\b.*?(?:apply|deadline|location|department)|\b(?:we are hiring|join our team|career opportunity)\b"


def box_postings(p: Column, most: int = 25) -> Column:
    """The loosest reading, for pages where nothing else was found: containers named after jobs that read like one posting."""
    good = lambda b: (F.length(b["text"]) > 50) & (F.length(b["text"]) < 3000) & matches(b["text"], BOX_TEXT) & matches(b["text"], r"\b(?:apply|application|cv|resume|deadline)\b") & text.looks_like_title(b["title"])
    return F.slice(F.filter(p["boxes"], good), 1, most)


def verified(results: DataFrame, pages: DataFrame, postings: DataFrame) -> DataFrame:
    """Search results (company, url, website) with what became of them: accepted, unfetchable, no_evidence or unparseable.

    A page counts if it speaks of a job and is the company's own, or a board or page that names it.
    """
    p = pages.select(urls.identity(F.col("url")).alias("__p"), "page")
    yields = postings.select(urls.identity(F.col("url")).alias("__j")).distinct().withColumn("__yields", F.lit(True))
    rows = results.withColumn("__id", urls.identity(F.col("url")))
    rows = rows.join(p, F.col("__id") == F.col("__p"), "left").join(yields, F.col("__id") == F.col("__j"), "left")
    v = urls.vendor(F.col("url"))
    titles = F.concat_ws(" ", "page.title", F.array_join("page.headings", " "))
    owned = names.ownership(v["vendor"], v["slug"], F.col("company"), names.page_evidence(titles, F.col("page.text"), F.col("company")), urls.SHARED_VENDORS)["accepted"]
    own = (F.coalesce("website", F.lit("")) != "") & urls.same_domain(F.col("website"), F.col("url"))
    hopeless = (F.size(names.distinctive_tokens(F.col("company"))) == 0) & (F.coalesce("website", F.lit("")) == "")
    outcome = F.when(F.col("__p").isNull(), "unfetchable").when(hopeless | ~(matches(F.col("page.text"), JOB_WORDS) & (own | owned)), "no_evidence").when(F.col("__yields").isNull(), "unparseable").otherwise("accepted")
    return rows.select(*results.columns, outcome.alias("outcome"))


#: Kinds of network faults by what their messages say.
FAULTS = (("dns", r"name or service not known|nodename nor servname|getaddrinfo|nxdomain|no address"), ("retryable", r"timed? ?out|connection reset|connection aborted|temporarily|remote end closed|broken pipe"))


def fault_kind(message: Column) -> Column:
    return first_match(message, FAULTS, "other")
