"""Whose site and whose board: candidates, ranks, acceptance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, urls
from ..functions import vocabulary as V
from ..functions.rules import matches
from .relational import keep_first, top_per_key

#: Weight of how a candidate was found.
METHOD_WEIGHT = {"homepage_link": 100, "vendor_link": 90, "common_path": 40, "search": 20}


def _weight(method: Column) -> Column:
    table = F.map_from_arrays(F.array(*map(F.lit, METHOD_WEIGHT)), F.array(*map(F.lit, METHOD_WEIGHT.values())))
    return F.coalesce(F.try_element_at(table, method), F.lit(0))


def rank_candidates(candidates: DataFrame, most: int = 500) -> DataFrame:
    """Career pages to try per company, best first: (company, url, method, base, strong), each address once.

    base: the method's weight, 50 more for a root of careers, 35 for a vendor's host, 20
    less for a regional path; then strong words in the address; then short addresses.
    """
    known = keep_first(candidates.withColumn("__id", urls.identity(F.col("url"))), ["company", "__id"], ["ordinal"])
    path = F.lower(urls.path(F.col("url")))
    root = F.regexp_replace(path, "/+$", "").isin(*[r for r in V.LISTING_ROOTS if r])
    regional = path.rlike(r"^/[a-z]{2}(?:-[a-z]{2})?/")
    base = _weight(F.col("method")) + F.when(root, 50).otherwise(0) + F.when(urls.vendor(F.col("url"))["vendor"] != "", 35).otherwise(0) - F.when(regional, 20).otherwise(0)
    strong = F.regexp_count(path, F.lit(r"career|jobs?\b|vacanc|karriere|stellen|opening"))
    ranked = known.withColumn("base", base).withColumn("strong", strong)
    return top_per_key(ranked, ["company"], [F.desc("base"), F.desc("strong"), F.length("url"), "url"], most).drop("__id")


def career_links(links: DataFrame, most: int = 10) -> DataFrame:
    """(url, text, href, score) of links from pages to careers: on the page's own domain, or a vendor's."""
    full = urls.join(F.col("url"), F.col("href"))
    rows = links.withColumn("link", full).where((F.col("link") != "") & ~urls.excluded_link(F.col("href")))
    name = urls.vendor(F.col("link"))["vendor"]
    career = matches(F.lower(F.concat_ws(" ", "text", "href")), V.CAREER_WORDS)
    rows = rows.where((career & urls.same_domain(F.col("url"), F.col("link"))) | (name != ""))
    words = F.lower(F.concat_ws(" ", "text", "href"))
    score = F.when(words.rlike("career|karriere"), 3).otherwise(0) + F.when(words.rlike("job|stellen|vacanc"), 2).otherwise(0) + F.when(words.rlike("join|work"), 1).otherwise(0)
    once = keep_first(rows.withColumn("__id", urls.identity(F.col("link"))).withColumn("score", score), ["url", "__id"], ["pos"])
    return top_per_key(once, ["url"], [F.desc("score"), "pos"], most).select("url", "text", F.col("link").alias("href"), "score")


def website_candidates(results: DataFrame, most: int = 5, least: int = 20) -> DataFrame:
    """(company, domain, score, website) from search results (company, query_no, rank, url): the first query that yields any counts."""
    domain = urls.registrable_domain(urls.hostname(F.col("url")))
    rows = results.withColumn("domain", domain).where(F.col("domain") != "")
    rows = rows.withColumn("score", names.domain_score(F.col("domain"), F.col("company"))).where(F.col("score") >= least)
    first = F.min("query_no").over(Window.partitionBy("company"))
    rows = rows.withColumn("__first", first).where(F.col("query_no") == F.col("__first"))
    best = rows.groupBy("company", "domain").agg(F.max("score").alias("score"), F.min("rank").alias("rank"))
    best = top_per_key(best, ["company"], [F.desc("score"), "rank"], most)
    return best.select("company", "domain", "score", F.concat(F.lit("https://www."), F.col("domain")).alias("website"))


def accept_pages(results: DataFrame, official: str = "website", most: int = 15) -> DataFrame:
    """Career pages among search results: the company's own, its board by slug, or, without a site, a domain that matches."""
    own = (F.coalesce(F.col(official), F.lit("")) != "") & urls.same_domain(F.col(official), F.col("url"))
    career = matches(F.lower(F.col("url")), V.CAREER_WORDS)
    v = urls.vendor(F.col("url"))
    board = (v["vendor"] != "") & names.slug_matches(v["slug"], F.col("company"))
    free = (F.coalesce(F.col(official), F.lit("")) == "") & career & names.domain_matches(urls.registrable_domain(urls.hostname(F.col("url"))), F.col("company"))
    kept = results.where((own & career) | board | free)
    first = F.min("query_no").over(Window.partitionBy("company"))
    kept = kept.withColumn("__first", first).where(F.col("query_no") == F.col("__first")).drop("__first")
    return top_per_key(kept, ["company"], ["rank", "url"], most)


def accept_boards(results: DataFrame, most: int = 8) -> DataFrame:
    """Boards among search results: a vendor's, probable, with a slug of the name; names of common words alone find none."""
    v = urls.vendor(F.col("url"))
    kept = results.where((F.size(names.distinctive_tokens(F.col("company"))) > 0) & (v["vendor"] != "") & urls.is_probable_board(F.col("url")) & names.slug_matches(v["slug"], F.col("company")))
    first = F.min("query_no").over(Window.partitionBy("company"))
    kept = kept.withColumn("__first", first).where(F.col("query_no") == F.col("__first")).drop("__first")
    return top_per_key(kept, ["company"], ["rank", "url"], most)


def resolve_homepage(probes: DataFrame) -> DataFrame:
    """(company, url, method) of each company's site, from probes (company, ordinal, origin, url, alive, parked, evidence, share, n).

    In order: an address that was given, with evidence of 0.34; one guessed, with 0.6 and a
    domain that matches; one found by search, with a domain that matches and 0.5, or titles
    that hold 0.8 of two words or more; else the best weak one that was given, unverified.
    """
    domain = names.domain_matches(urls.registrable_domain(urls.hostname(F.col("url"))), F.col("company"))
    live = F.col("alive") & ~F.col("parked")
    no_words = F.size(names.all_tokens(F.col("company"))) == 0
    step = (
        F.when(live & (F.col("origin") == "input") & ((F.col("evidence") >= 0.34) | no_words), 1)
        .when(live & (F.col("origin") == "guess") & (F.col("evidence") >= 0.6) & domain, 2)
        .when(live & (F.col("origin") == "search") & ((domain & (F.col("evidence") >= 0.5)) | ((F.col("share") >= 0.8) & (F.col("n") >= 2))), 3)
        .when(live & (F.col("origin") == "input"), 4)
    )
    rows = probes.withColumn("step", step).where(F.col("step").isNotNull())
    order = ["step", F.when(F.col("step") == 4, -F.col("evidence")).otherwise(0.0), "ordinal", "url"]
    method = F.when(F.col("step") == 4, F.concat(F.col("origin"), F.lit("_unverified"))).otherwise(F.col("origin"))
    return keep_first(rows, ["company"], order).select("company", "url", method.alias("method"))


def once_per_key(rows: DataFrame, key: str, compute) -> DataFrame:
    """rows joined to what compute makes of each distinct key, so that shared sites and boards cost once; blank keys are not shared."""
    done = compute(rows.where(F.col(key) != "").select(key).distinct())
    return rows.join(done, key, "left")


def first_filled(rows: DataFrame, key: str, value: str, priority: str) -> DataFrame:
    """The value of the least priority that is not blank, per key: a ladder of fallbacks as one aggregate."""
    good = F.coalesce(F.trim(F.col(value)), F.lit("")) != ""
    return rows.where(good).groupBy(key).agg(F.min_by(value, priority).alias(value), F.min(priority).alias(priority))


def search_chain(results: DataFrame, least: int = 1, most: int = 25) -> DataFrame:
    """(query, engine, rank, url) that a chain of engines gives: each engine in turn, while those before gave fewer than ``least``.

    results holds what each engine would say (query, engine, rank, url); an address counts
    once a query, where it stands first, without its fragment; at most ``most`` a query.
    """
    plain = results.withColumn("url", F.split_part("url", F.lit("#"), F.lit(1)))
    once = keep_first(plain, ["query", "url"], ["engine", "rank"])
    counts = once.groupBy("query", "engine").agg(F.count("*").alias("__n"))
    w = Window.partitionBy("query").orderBy("engine").rowsBetween(Window.unboundedPreceding, -1)
    asked = counts.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))).where(F.col("__before") < least).select("query", "engine")
    return top_per_key(once.join(asked, ["query", "engine"], "left_semi"), ["query"], ["engine", "rank"], most).select("query", "engine", "rank", "url")


def first_selector(links: DataFrame) -> DataFrame:
    """(page, selector, pos, url) of result pages' links (page, selector, pos, href): those of the first selector that gives any http address, redirects unwrapped."""
    rows = links.withColumn("url", urls.unwrap(F.col("href"))).where(F.col("url").startswith("http"))
    first = rows.groupBy("page").agg(F.min("selector").alias("selector"))
    return rows.join(first, ["page", "selector"], "left_semi").select("page", "selector", "pos", "url")


def board_fallback(boards: DataFrame, shared: Sequence[str] = tuple(urls.SHARED_VENDORS)) -> DataFrame:
    """(company, url, vendor, jobs) of the first board found by name (company, ordinal, url, evidence, jobs) that is the company's and has postings.

    Its slug proves whose it is, else the evidence of its page; boards without a vendor,
    owner or postings are passed over.
    """
    v = urls.vendor(F.col("url"))
    known = boards.withColumn("vendor", v["vendor"]).withColumn("__slug", v["slug"]).where("vendor != ''")
    said = names.ownership(F.col("vendor"), F.col("__slug"), F.col("company"), F.col("evidence"), shared)
    own = known.where(said["accepted"] & (F.coalesce("jobs", F.lit(0)) > 0))
    return keep_first(own, ["company"], ["ordinal", "url"]).select("company", "url", "vendor", "jobs")


def terminal(ended: DataFrame, internet: DataFrame, boards: DataFrame) -> DataFrame:
    """(company, status, source, jobs) of companies whose own pages gave nothing (company, status, source).

    Postings found on the internet (company, jobs) win, then those of a board found by
    name (company, jobs); else the status stays, with the evidence for it.
    """
    of = lambda df, n: df.groupBy("company").agg(F.max("jobs").alias(n))
    rows = ended.join(of(internet, "__i"), "company", "left").join(of(boards, "__b"), "company", "left")
    web, board = F.coalesce("__i", F.lit(0)) > 0, F.coalesce("__b", F.lit(0)) > 0
    source = F.when(web, "internet-company-name-search").when(board, "ats-board-name-search").otherwise(F.coalesce(F.nullif("source", F.lit("")), F.lit("internet-company-name-search:no-verified-results")))
    return rows.select("company", F.when(web | board, "ok").otherwise(F.col("status")).alias("status"), source.alias("source"), F.when(web, F.col("__i")).when(board, F.col("__b")).otherwise(F.lit(0)).alias("jobs"))
