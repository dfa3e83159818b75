"""Delivery of postings: latest rows, joins with companies, coverage, summary; and the shaping of result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import location, numbers, text
from ..functions import vocabulary as V
from ..functions.rules import filled
from ..operators.relational import export_key, keep_first, keep_last


def result_rows(results: DataFrame, scraped_at: Column) -> DataFrame:
    """Output rows from results (company_name, country, website, status, source, jobs, discovery columns): a row per job, or one of status."""
    r = results.select("*", F.size(F.coalesce("jobs", F.array().cast(results.schema["jobs"].dataType))).alias("__n"), F.explode_outer("jobs").alias("job"))
    none = F.col("job").isNull()
    fields = results.schema["jobs"].dataType.elementType.fieldNames()
    job = {c: F.coalesce(F.col(f"job.{c}"), F.lit("")) if c in fields else F.lit("") for c in V.JOB_FIELDS}
    table = lambda d: F.map_from_arrays(F.array(*map(F.lit, d)), F.array(*map(F.lit, d.values())))
    named = F.initcap(F.replace(F.col("status"), F.lit("_"), F.lit(" ")))
    status = F.coalesce(F.try_element_at(table(V.JOB_STATUS), F.col("status")), named)
    extraction = F.coalesce(F.try_element_at(table(V.EXTRACTION_STATUS), F.col("status")), named)
    confident = F.when(F.col("source").isin(*V.HIGH_CONFIDENCE), "High").otherwise("Medium")
    stamped = {
        "job_status": F.when(none, status).otherwise(filled(job["job_status"], F.lit("Active"))), "extraction_status": F.when(none, extraction).otherwise("Job Detail Extracted"),
        "extraction_confidence": F.when(none, F.when(F.col("status") == "no_jobs", "High").otherwise("Low")).otherwise(filled(job["extraction_confidence"], confident)),
        "salary_disclosed": F.when(none, "").otherwise(F.when((job["salary"] != "") | (job["min_salary"] != "") | (job["max_salary"] != ""), "True").otherwise("False")),
        "num_positions": F.col("__n"), "scraped_at": scraped_at, "source": F.coalesce(F.col("source"), F.lit("")),
    }
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in results.columns else F.lit("")
    return r.select(*(stamped[c].alias(c) if c in stamped else job[c].alias(c) if c in job else own(c).alias(c) for c in V.OUTPUT_COLUMNS))


def enrich(jobs: DataFrame, plain: str = "plain_text") -> DataFrame:
    """Postings with every blank that title and text can fill; nothing that a posting states is overwritten."""
    t = text.clean_text(F.col(plain), 30000)
    title = F.col("job_title")
    df = jobs.withColumn("__t", t).withColumn("__l", text.labelled(F.col("__t"))).withColumn("__e", text.education(F.col("__t")))
    get = lambda c: F.col(c) if c in jobs.columns else F.lit("")
    for c in ("employment_type", "seniority_level", "education_qualification", "years_of_experience", "salary"):
        df = df.withColumn(c, filled(get(c), F.col(f"__l.{c}")))
    df = df.withColumn("employment_type", filled(F.col("employment_type"), text.employment_type(title, F.col("__t"))))
    df = df.withColumn("seniority_level", filled(F.col("seniority_level"), text.seniority(title, F.col("__t"))))
    df = df.withColumn("job_category", filled(get("job_category"), text.job_category(title, F.col("__t"))))
    for c in ("education_type", "education_stream", "education_qualification"):
        df = df.withColumn(c, filled(F.col(c) if c in df.columns else F.lit(""), F.col(f"__e.{c}")))
    df = df.withColumn("skills", filled(get("skills"), text.skills(F.col("__t"))))
    low, high = get("years_of_experience_min"), get("years_of_experience_max")
    years = numbers.experience_range(filled(F.col("years_of_experience"), F.col("__t")))
    blank = (filled(low) == "") & (filled(high) == "")
    df = df.withColumn("years_of_experience_min", F.when(blank, years["min"]).otherwise(filled(low))).withColumn("years_of_experience_max", F.when(blank, years["max"]).otherwise(filled(high)))
    df = df.withColumn("__pay", filled(F.col("salary"), numbers.salary_evidence(F.col("__t")), numbers.salary_range(F.col("__t"))))
    open_pay = (F.col("__pay") != "") & (filled(get("min_salary")) == "") & (filled(get("max_salary")) == "")
    df = df.withColumn("__b", numbers.salary_breakdown(F.col("__pay")))
    split = open_pay & (F.col("__b.salary") != "")
    df = df.withColumn("salary", F.when(split, F.col("__b.salary")).otherwise(F.col("__pay")))
    for c in ("min_salary", "max_salary"):
        df = df.withColumn(c, F.when(split, F.col(f"__b.{c}")).otherwise(filled(get(c))))
    money = filled(numbers.currency(F.col("__pay")), numbers.currency(F.substring("__t", 1, 4000)))
    df = df.withColumn("currency", F.when(open_pay, filled(get("currency"), money)).otherwise(filled(get("currency"))))
    df = df.withColumn("job_status", filled(get("job_status"), F.lit("Active")))
    return df.drop("__t", "__l", "__e", "__pay", "__b")


def postings(companies: DataFrame, scraped: DataFrame) -> DataFrame:
    """Titled postings of known companies, each (KEYID, job_url, job_title) once, the first by ordinal.

    The join is many to many on purpose: companies that share a key share its postings.
    """
    c = companies.withColumn("__key", export_key(F.col("COMPANY_NAME"), F.col("WEBSITE")))
    s = scraped.withColumn("__skey", export_key(F.col("company_name"), F.col("website"))).withColumnsRenamed({"company_name": "company_name_s", "country": "country_s", "website": "website_s"})
    joined = s.where(F.trim("job_title") != "").join(c, F.col("__skey") == F.col("__key"))
    return keep_first(joined, ["KEYID", "job_url", "job_title"], ["row_idx", "KEYID"]).drop("__key", "__skey")


def delivery(posted: DataFrame, places: location.Gazetteer | None = None) -> DataFrame:
    """The delivered columns of postings, those of leaders alone, in order of party and title."""
    where = location.country(F.col("job_location"), places)
    pay = numbers.usd_salary(F.col("salary"), F.col("min_salary"), F.col("max_salary"), F.col("currency"))
    rows = posted.select(
        "KEYID", "ID_Company", "DUNS_NUMBER", numbers.openings_bucket(F.col("num_positions").cast("string")).alias("Total openings"), "PARTY_NAME", F.col("job_title").alias("Job Title"), numbers.yyyymmdd(F.col("posted_date")).alias("Posted Date"),
        numbers.yyyymmdd(F.col("closed_date")).alias("Deleted/Closed Date"), F.col("education_stream").alias("Education Stream"), text.export_education(F.col("education_type")).alias("Education Type"), F.col("education_qualification").alias("Education Qualification"),
        numbers.experience_text(F.col("years_of_experience_min"), F.col("years_of_experience_max")).alias("Years of Experience"), text.export_seniority(F.col("job_title")).alias("Seniority Level"), text.export_employment(F.col("employment_type")).alias("Employment Type"),
        F.col("skills").alias("Skills"), F.col("job_description_clean").alias("Job Description"), filled(where, F.col("COUNTRY")).alias("Country"), F.col("job_status").alias("Job Status"), pay["text"].alias("Salary_USD"), pay["lo"].alias("Min_Salary_USD"), pay["hi"].alias("Max_Salary_USD"),
        F.col("job_location").alias("Job Location"), F.when(where != "", "job_location").otherwise("company").alias("Location Country Source"), F.col("COUNTRY").alias("Company Country"), F.col("job_url").alias("Job URL"), F.col("career_page_url").alias("Career Page URL"),
        F.col("source").alias("Career Page Source"), F.col("salary").alias("Salary (as posted)"), F.col("currency").alias("Currency"), F.col("scraped_at").alias("Scraped At"),
    )
    return rows.where(text.is_leader(F.col("Job Title"))).orderBy("PARTY_NAME", "Job Title")


def split_same_country(delivered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the company's own country (or whose place says nothing), and the rest: disjoint and complete."""
    same = F.coalesce((F.col("Country") == F.col("Company Country")) | (F.col("Location Country Source") != "job_location"), F.lit(False))
    return delivered.where(same), delivered.where(~same)


def coverage(companies: DataFrame, scraped: DataFrame, posted: DataFrame) -> DataFrame:
    """Every company with its latest status and counts of postings and of leaders' postings."""
    latest = keep_last(scraped.withColumn("__skey", export_key(F.col("company_name"), F.col("website"))), ["__skey"], "row_idx").select("__skey", "job_status", "career_page_url", "resolved_website")
    counts = posted.groupBy("KEYID").agg(F.count("*").alias("postings"), F.count_if(text.is_leader(F.col("job_title"))).alias("leadership_postings")).withColumnRenamed("KEYID", "__id")
    rows = companies.withColumn("__key", export_key(F.col("COMPANY_NAME"), F.col("WEBSITE")))
    rows = rows.join(latest, F.col("__key") == F.col("__skey"), "left").join(counts, F.col("KEYID") == F.col("__id"), "left")
    n = F.coalesce("postings", F.lit(0)).cast("int")
    status = F.when(n > 0, "Jobs Found").otherwise(F.coalesce("job_status", F.lit("NOT PROCESSED")))
    return rows.select("KEYID", "COMPANY_NAME", "WEBSITE", "COUNTRY", status.alias("status"), n.alias("postings"), F.coalesce("leadership_postings", F.lit(0)).cast("int").alias("leadership_postings"))


def summary(companies: DataFrame, posted: DataFrame, covered: DataFrame) -> DataFrame:
    """(metric, value) rows of an export."""
    a = companies.agg(F.count("*").alias("companies"), F.countDistinct("KEYID").alias("distinct_companies"))
    b = posted.agg(F.count("*").alias("postings"), F.countDistinct("KEYID").alias("companies_with_postings"), F.count_if(text.is_leader(F.col("job_title"))).alias("leadership_postings"), F.count_if(F.trim("job_description_clean") != "").alias("with_description"), F.count_if(F.col("salary") != "").alias("with_salary"), F.count_if(F.col("posted_date") != "").alias("with_date"))
    c = covered.agg(F.count_if(F.col("status") == "NOT PROCESSED").alias("not_processed"), F.count_if(F.col("status") == "No Jobs Found").alias("no_jobs"), F.count_if(F.col("status").rlike("(?i)unreachable")).alias("unreachable"), F.count_if(F.col("status").rlike("(?i)unsupported")).alias("unsupported"))
    rows = None
    for t in (a, b, c):  # one row each
        part = t.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in t.columns))).alias("m")).select("m.*")
        rows = part if rows is None else rows.unionByName(part)
    return rows
