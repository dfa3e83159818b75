"""A run over captured pages: which companies, which pages, which postings, which status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import pages as P
from ..operators import postings as J
from ..operators.attribution import rank_candidates
from ..operators.relational import keep_first, not_done, number_rows, offset_limit, resume_key, shard_block, shard_interleave, top_per_key, union_rows
from ..storage import materialize


def select_companies(companies: DataFrame, done: DataFrame | None = None, countries: Sequence[str] = (), shard: tuple[int, int, str] | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Companies (name, website, country, row_idx) to work on: by country, then shard, then offset and limit, then those not done.

    shard is (index, count, "interleave" or "block"); rows are numbered again after each cut.
    """
    rows = companies.where(F.col("country").isin(*countries)) if countries else companies
    again = lambda df: number_rows(df.withColumnRenamed("row_idx", "__old"), ["__old"]).drop("__old")
    if shard:
        index, count, mode = shard
        rows = again(rows)
        rows = shard_block(rows, index, count, rows.count()) if mode == "block" else shard_interleave(rows, index, count)
    if offset or limit is not None:
        rows = offset_limit(again(rows), offset, limit)
    if done is None:
        return rows
    return not_done(rows.withColumn("key", resume_key(F.col("name"), F.col("website"))), done, "key").drop("key")


def crawl(start: DataFrame, pages: DataFrame, levels: int = 40) -> DataFrame:
    """(root, url, depth) of the captured pages reached from start (root, url) through pagination, each page once per root.

    Breadth-first by joins with the captured pages; it ends when a level adds nothing.
    """
    further = P.pagination_links(P.links(pages)).select(urls.identity(F.col("url")).alias("src"), urls.identity(F.col("link")).alias("dst"))
    known = pages.select(urls.identity(F.col("url")).alias("__k")).distinct()
    # links between captured pages, written once: every level joins with them alone
    further = materialize(further.join(known, F.col("dst") == F.col("__k"), "left_semi"), "further")
    fronts = [materialize(start.select("root", urls.identity(F.col("url")).alias("url"), F.lit(0).alias("depth")).dropDuplicates(["root", "url"]), "front")]
    for depth in range(1, levels + 1):
        seen = union_rows(*fronts)
        step = fronts[-1].join(further, F.col("url") == F.col("src")).select("root", F.col("dst").alias("url")).distinct()
        front = materialize(step.join(seen.select("root", "url"), ["root", "url"], "left_anti").withColumn("depth", F.lit(depth)), "front")
        if front.isEmpty():
            break
        fronts.append(front)
    return union_rows(*fronts)


def candidates(homes: DataFrame, pages: DataFrame, most: int = 500) -> DataFrame:
    """(company, url, method, ...) of career pages to look at, from homes (company, home): links of the home page, then common paths."""
    linked = homes.select("company", urls.identity(F.col("home")).alias("__h"), F.col("home").alias("home_url"))
    found = P.links(pages).withColumn("__id", urls.identity(F.col("url")))
    rows = linked.join(found, F.col("__h") == F.col("__id")).where(text.is_career_link(F.col("text"), F.col("href")) & ~urls.excluded_link(F.col("href")))
    method = F.when(urls.vendor(F.col("link"))["vendor"] != "", "vendor_link").otherwise("homepage_link")
    by_link = rows.where((method == "vendor_link") | urls.same_domain(F.col("home_url"), F.col("link"))).select("company", F.col("link").alias("url"), method.alias("method"), F.col("pos").alias("ordinal"))
    by_path = homes.select("company", F.posexplode(urls.common_career_urls(F.col("home"))).alias("n", "url")).select("company", "url", F.lit("common_path").alias("method"), (F.col("n") + 1_000_000).alias("ordinal"))
    return rank_candidates(by_link.unionByName(by_path), most)


def results(homes: DataFrame, pages: DataFrame, most_jobs: int = 10_000) -> DataFrame:
    """(company, status, source, jobs) per company: its career pages, those they page through, and the postings on them.

    Postings are kept once by address, else title, at most ``most_jobs`` a company.  Without
    any: no_jobs if a page says so, unsupported if there is a career page, else
    career_not_found; unreachable if not even the home page was captured.
    """
    key = lambda c: urls.identity(F.col(c))
    ranked = candidates(homes, pages).withColumn("url", key("url"))
    captured = pages.select(key("url").alias("__c"), "page")
    career = ranked.join(captured, F.col("url") == F.col("__c")).select("company", "url", "page")
    reached = crawl(career.select(F.col("company").alias("root"), "url").unionByName(homes.select(F.col("company").alias("root"), F.col("home").alias("url"))), pages)
    postings = J.from_pages(pages).withColumn("__u", key("url")).drop("url")
    jobs = reached.join(postings, F.col("url") == F.col("__u")).withColumn("__key", F.coalesce(F.nullif(F.trim("job_url"), F.lit("")), F.trim("job_title"))).where("__key != ''")
    once = top_per_key(keep_first(jobs, ["root", "__key"], ["depth", "url", "pos"]), ["root"], ["depth", "url", "pos"], most_jobs)
    fields = [f.split()[0] for f in J.JOB.split(", ")]
    per = once.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("depth", "url", "pos", F.struct(*fields).alias("job")))).alias("each"))
    per = per.select("root", F.transform("each", lambda x: x["job"]).alias("jobs"))
    about = career.groupBy("company").agg(F.max(text.says_no_jobs(F.col("page.text"))).alias("none"), F.min("url").alias("career_page_url")).withColumnRenamed("company", "__co")
    alive = captured.select("__c").distinct()
    rows = homes.withColumn("__h", key("home")).join(alive, F.col("__h") == F.col("__c"), "left").join(per, F.col("company") == F.col("root"), "left").join(about, F.col("company") == F.col("__co"), "left")
    status = F.when(F.size(F.coalesce("jobs", F.array())) > 0, "ok").when(F.col("none"), "no_jobs").when(F.col("__co").isNotNull(), "unsupported").when(F.col("__c").isNotNull(), "career_not_found").otherwise("unreachable")
    empty = F.array().cast(per.schema["jobs"].dataType)
    jobs_of: Column = F.coalesce("jobs", empty)
    return rows.select("company", "home", status.alias("status"), F.coalesce(F.get(jobs_of, 0)["source"], F.lit("")).alias("source"), F.coalesce("career_page_url", F.lit("")).alias("career_page_url"), jobs_of.alias("jobs"))


def counters(found: DataFrame) -> DataFrame:
    """(status, companies, jobs) of a run."""
    return found.groupBy("status").agg(F.count("*").alias("companies"), F.sum(F.size("jobs")).alias("jobs"))
