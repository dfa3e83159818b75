"""Command lines: run over captured pages, export, second look, extraction log, audit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import html
from .operators import incremental, relational
from .plans import export, run
from .sources import sinks, tables


def _run(spark: SparkSession, a) -> None:
    """Companies of a list against captured pages (url, html); rows are appended to the output, and those it holds are not done again."""
    companies = tables.read_companies(spark, a.companies)
    rows, _ = tables.read_snapshot(spark, a.output)
    done = tables.completed_keys(spark, a.output) if rows is not None else None
    shard = (*map(int, a.shard.split("/")), a.mode) if a.shard else None
    chosen = run.select_companies(companies, done, a.country or (), shard, a.offset, a.limit)
    pages = spark.read.parquet(a.pages).select("url", "html", html.page(F.col("html")).alias("page"))
    homes = chosen.select(relational.resume_key(F.col("name"), F.col("website")).alias("company"), "name", "website", "country", F.col("website").alias("home"))
    found = run.results(homes.select("company", "home"), pages)
    named = found.join(homes.select("company", "name", "website", "country"), "company").withColumnRenamed("name", "company_name")
    sinks.append(export.result_rows(named, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")), a.output)
    run.counters(found).show(truncate=False)


def _export(spark: SparkSession, a) -> None:
    """Delivery, coverage and summary of scraped rows, as a folder of sheets and, if asked for, a workbook."""
    companies = tables.read_strings(spark, a.companies)
    scraped = relational.number_rows(tables.read_strings(spark, a.scraped), ["scraped_at", "company_name", "job_url", "job_title"])
    posted = export.postings(companies, scraped)
    covered = export.coverage(companies, scraped, posted)
    same, rest = export.split_same_country(export.delivery(posted))
    sheets = {"same_country": same, "other_countries": rest, "coverage": covered, "summary": export.summary(companies, posted, covered)}
    sinks.write_outputs(sheets, a.output)
    if a.workbook:
        sinks.write_xlsx(sheets, a.workbook)


def _recheck(spark: SparkSession, a) -> None:
    rows, responses = tables.read_strings(spark, a.rows), spark.read.parquet(a.responses)
    as_of = F.lit(a.as_of).cast("timestamp")
    incremental.recheck_stats(rows, responses, as_of, a.days).show()
    sinks.replace(incremental.recheck(rows, responses, as_of, a.days), a.rows)


def _extract(spark: SparkSession, a) -> None:
    done, _ = tables.read_snapshot(spark, a.checkpoint)
    known = tables.read_checkpoint(spark, a.checkpoint) if done is not None else None
    sinks.append_results(incremental.process(spark.read.parquet(a.answers), known), a.log, a.checkpoint, a.errors)


def _audit(spark: SparkSession, a) -> None:
    rows = tables.read_strings(spark, a.rows)
    relational.frequencies(rows, a.column).orderBy(F.desc("n"), a.column).show(a.most, truncate=False)
    if a.counted:
        relational.fan_out(rows, a.column, a.counted).orderBy(F.desc("n"), a.column).show(a.most, truncate=False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestream", description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(name, function, *options, **more):
        c = sub.add_parser(name, help=function.__doc__)
        for o in options:
            c.add_argument(f"--{o}", required=True)
        for o, given in more.items():
            c.add_argument(f"--{o.replace('_', '-')}", **given)
        c.set_defaults(function=function)

    number = lambda default: {"type": int, "default": default}
    command("run", _run, "companies", "pages", "output", country={"action": "append"}, shard={"help": "index/count"}, mode={"choices": ["interleave", "block"], "default": "interleave"}, offset=number(0), limit=number(None))
    command("export", _export, "companies", "scraped", "output", workbook={})
    command("recheck", _recheck, "rows", "responses", "as-of", days=number(7))
    command("extract", _extract, "answers", "log", "checkpoint", "errors")
    command("audit", _audit, "rows", "column", counted={}, most=number(20))
    return p


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    a.function(SparkSession.builder.appName("lodestream").getOrCreate(), a)


if __name__ == "__main__":
    main()
