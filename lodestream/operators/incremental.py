"""Incremental work: what is due, what a second look says, and how state moves on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import vocabulary as V
from ..functions.rules import matches


def is_due(status: Column, url: Column, last_checked: Column, as_of: Column, days: int) -> Column:
    """Active postings with an address that were never checked, unreadably checked, or checked long enough ago."""
    checked = F.try_to_timestamp(last_checked)
    return (F.lower(F.trim(status)) == "active") & (F.trim(F.coalesce(url, F.lit(""))) != "") & (checked.isNull() | (as_of.cast("timestamp") - checked >= F.make_dt_interval(F.lit(days))))


def verdict(http_status: Column, final_url: Column, original_url: Column, visible: Column, has_posting: Column) -> Column:
    """A struct (closed, reason) of a response, from what can be observed; null status: the request failed."""
    moved = F.regexp_replace(final_url, "/+$", "") != F.regexp_replace(original_url, "/+$", "")
    http = F.concat(F.lit("http_"), http_status.cast("string"))
    say = lambda closed, reason: F.struct(F.lit(closed).alias("closed"), reason.alias("reason"))
    return (
        F.when(http_status.isNull(), say(False, F.lit("request_failed")))
        .when(http_status.isin(404, 410), say(True, http))
        .when(http_status >= 400, say(False, http))
        .when(matches(visible, V.CLOSED), say(True, F.lit("closed_message")))
        .when(moved & urls.is_generic_landing(final_url, original_url), say(True, F.lit("redirected_to_listing_root")))
        .when(has_posting, say(False, F.lit("active")))
        .otherwise(say(False, F.lit("active_or_inconclusive")))
    )


def recheck(rows: DataFrame, responses: DataFrame, as_of: Column, days: int) -> DataFrame:
    """rows after a second look at those that are due: closed ones are stamped, checked ones dated."""
    r = responses.select(F.col("job_url").alias("__url"), "http_status", "final_url", "visible", "has_posting")
    due = is_due(F.col("job_status"), F.col("job_url"), F.col("last_checked_at"), as_of, days)
    joined = rows.withColumn("__due", F.coalesce(due, F.lit(False))).join(r, F.col("job_url") == F.col("__url"), "left")
    said = verdict(F.col("http_status"), F.col("final_url"), F.col("job_url"), F.col("visible"), F.coalesce(F.col("has_posting"), F.lit(False)))
    joined = joined.withColumn("__said", F.when(F.col("__due"), said))
    closed = F.coalesce(F.col("__said.closed"), F.lit(False))
    stamp = F.date_format(as_of.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    moved = {
        "job_status": F.when(closed, "Closed").otherwise(F.col("job_status")), "closed_date": F.when(closed, F.date_format(as_of.cast("timestamp"), "yyyy-MM-dd")).otherwise(F.col("closed_date")),
        "last_checked_at": F.when(F.col("__due") & F.col("http_status").isNotNull(), stamp).otherwise(F.col("last_checked_at")),
    }
    return joined.select(*(moved[c].alias(c) if c in moved else F.col(c) for c in rows.columns))


def recheck_stats(rows: DataFrame, responses: DataFrame, as_of: Column, days: int) -> DataFrame:
    """One row (checked, closed, skipped, failed)."""
    due = F.coalesce(is_due(F.col("job_status"), F.col("job_url"), F.col("last_checked_at"), as_of, days), F.lit(False))
    r = responses.select(F.col("job_url").alias("__url"), "http_status", "final_url", "visible", "has_posting")
    joined = rows.withColumn("__due", due).join(r, F.col("job_url") == F.col("__url"), "left")
    said = verdict(F.col("http_status"), F.col("final_url"), F.col("job_url"), F.col("visible"), F.coalesce(F.col("has_posting"), F.lit(False)))
    failed = F.col("__due") & F.col("http_status").isNull()
    return joined.agg(F.count_if(F.col("__due")).alias("checked"), F.count_if(F.col("__due") & said["closed"]).alias("closed"), F.count_if(~F.col("__due")).alias("skipped"), F.count_if(failed).alias("failed"))


# ---- fixed values: what an extraction may say ----
LEVELS = "Entry Mid Senior Lead Manager Director Executive".split()
SALARY_SEEN = r"(?:[$€£₹¥]\s*\d|\b\d[\d.,]*\s*(?:usd|eur|gbp|inr)\b|\bsalary\b|\bcompensation\b|\bpay range\b)"


def validate(result: Column, source_text: Column) -> Column:
    """The first fault of an extraction struct (seniority, min_years, max_years, salary_disclosed), null where there is none."""
    level, low, high = result["seniority"], result["min_years"], result["max_years"]
    return (
        F.when(result.isNull(), "not an object")
        .when(level.isNotNull() & ~level.isin(LEVELS), "seniority is not in the list")
        .when(low.isNotNull() & ~low.between(0, 80), "min_years is out of range")
        .when(high.isNotNull() & ~high.between(0, 80), "max_years is out of range")
        .when(low > high, "min_years is above max_years")
        .when(result["salary_disclosed"] & ~matches(source_text, SALARY_SEEN), "salary_disclosed has no evidence")
    )


def unfence(text: Column) -> Column:
    """JSON without the fence of a code block around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?:json)?\s*", ""), r"\s*```$", ""))


EXTRACTION = "seniority string, min_years int, max_years int, salary_disclosed boolean"


def process(rows: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """(row_id, result, error) from rows (row_id, text, answer): answers without their fence, parsed and validated; ids that are done are left out.

    What ``sources.sinks.append_results`` writes: results, then their ids, errors aside.
    """
    todo = rows if done is None else rows.join(done.select("row_id").distinct(), "row_id", "left_anti")
    body = unfence(F.coalesce(F.col("answer"), F.lit("")))
    parsed = F.from_json(F.when(body.startswith("{"), body), EXTRACTION)
    told = todo.select("row_id", body.alias("result"), parsed.alias("__r"), "text")
    fault = validate(F.col("__r"), F.col("text"))
    return told.select("row_id", F.when(fault.isNull(), F.col("result")).alias("result"), fault.alias("error"))


def split_errors(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and those with one."""
    return rows.where(F.col(error).isNull()), rows.where(F.col(error).isNotNull())
