"""Postings out of captured payloads and pages: vendors' JSON, unknown JSON, JSON-LD, microdata, tables, XML."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, urls
from ..functions.text import clean_text

JOB = "job_title string, job_url string, job_location string, job_description string, posted_date string, application_deadline string, employment_type string, job_category string, salary string, min_salary string, max_salary string, currency string, skills string, education_type string, source string"
_FIELDS = [f.split()[0] for f in JOB.split(", ")]

# ---- fixed values: where vendors keep their postings and what they call their fields ----
#: vendor: (paths of the list, {field: paths, first filled wins})
VENDORS: dict[str, tuple[list[str], dict[str, list[str]]]] = {
    "greenhouse": (["$.jobs"], {"job_title": ["$.title"], "job_url": ["$.absolute_url"], "job_location": ["$.location.name"], "job_description": ["$.content"], "posted_date": ["$.updated_at", "$.first_published"]}),
    "lever": (["$"], {"job_title": ["$.text"], "job_url": ["$.hostedUrl"], "job_location": ["$.categories.location"], "employment_type": ["$.categories.commitment"], "job_description": ["$.descriptionPlain", "$.description"], "posted_date": ["$.createdAt"]}),
    "smartrecruiters": (["$.content"], {"job_title": ["$.name"], "job_url": ["$.ref", "$.applyUrl"], "job_location": ["$.location.fullLocation", "$.location.city"], "employment_type": ["$.typeOfEmployment.label"], "job_category": ["$.function.label"], "posted_date": ["$.releasedDate"]}),
    "workable": (["$.jobs"], {"job_title": ["$.title"], "job_url": ["$.url", "$.shortlink"], "job_location": ["$.location.location_str", "$.city"], "employment_type": ["$.employment_type"], "job_description": ["$.description"], "posted_date": ["$.published_on", "$.created_at"]}),
    "recruitee": (["$.offers"], {"job_title": ["$.title"], "job_url": ["$.careers_url"], "job_location": ["$.location"], "employment_type": ["$.employment_type_code"], "job_description": ["$.description"], "posted_date": ["$.published_at", "$.created_at"]}),
    "breezy": (["$", "$.positions", "$.data"], {"job_title": ["$.name", "$.title"], "job_url": ["$.url"], "job_location": ["$.location.name"], "employment_type": ["$.type.name"], "job_description": ["$.description"], "posted_date": ["$.published_date", "$.creation_date"]}),
    "jazzhr": (["$", "$.jobs", "$.data", "$.results"], {"job_title": ["$.title"], "job_url": ["$.url", "$.board_url"], "job_location": ["$.city"], "employment_type": ["$.type"], "job_description": ["$.description"], "posted_date": ["$.original_open_date"]}),
    "workday": (["$.jobPostings"], {"job_title": ["$.title"], "job_url": ["$.externalPath"], "job_location": ["$.locationsText"], "posted_date": ["$.postedOn"]}),
    "ashby": (["$.jobs"], {"job_title": ["$.title"], "job_url": ["$.jobUrl"], "job_location": ["$.location"], "employment_type": ["$.employmentType"], "job_category": ["$.department"], "job_description": ["$.descriptionHtml"], "posted_date": ["$.publishedAt"], "salary": ["$.compensation.compensationTierSummary"]}),
    "eightfold": (["$.positions", "$.jobs"], {"job_title": ["$.name", "$.title"], "job_url": ["$.canonicalPositionUrl"], "job_location": ["$.location"], "job_category": ["$.department"], "job_description": ["$.job_description"], "posted_date": ["$.t_create"]}),
    "cornerstone": (["$.data.requisitions", "$.requisitions", "$.Requisitions"], {"job_title": ["$.displayJobTitle", "$.title"], "job_url": ["$.url"], "job_location": ["$.locations[0].city"], "posted_date": ["$.postingEffectiveDate"]}),
    "bamboo": (["$.result"], {"job_title": ["$.jobOpeningName"], "job_url": ["$.url"], "job_location": ["$.location.city"], "employment_type": ["$.employmentStatusLabel"]}),
}
#: Keys of postings in JSON of unknown shape, in order.
ALIASES = {
    "job_title": "title jobTitle job_title name position positionName vacancyName titulo cargo text displayName".split(),
    "job_url": "url jobUrl job_url link applyUrl absolute_url hostedUrl externalPath canonicalUrl permalink".split(),
    "job_location": "location jobLocation locations city cityName place local cidade fullLocation".split(),
    "job_description": "description jobDescription content descriptionHtml body summary descricao".split(),
    "posted_date": "datePosted postedDate publishedAt published_at createdAt created_at postedOn updated_at date".split(),
    "employment_type": "employmentType employment_type jobType type contractType workType commitment".split(),
    "job_category": "department category jobCategory team function area".split(),
}
LIST_KEYS = "jobs data results items positions vacancies postings openings offers jobPostings content requisitions vagas list records hits".split()


def first_value(item: Column, paths: list[str]) -> Column:
    """The first value of a variant, in the order of paths, that is neither null nor empty; else the empty string."""
    return F.coalesce(*(F.nullif(F.try_variant_get(item, p, "string"), F.lit("")) for p in paths), F.lit(""))


def from_vendor(payloads: DataFrame, vendor: str, payload_col: str = "payload", base_col: str = "base_url") -> DataFrame:
    """A row of ``JOB`` for each posting of a vendor's payloads, beside the columns of payloads; by select and explode alone."""
    paths, fields = VENDORS[vendor]
    document = F.try_parse_json(F.col(payload_col))
    lists = [F.try_variant_get(document, p, "array<variant>") for p in paths]
    filled = F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists))
    rows = payloads.withColumn("__item", F.explode(filled))
    item = F.col("__item")
    if vendor == "ashby":
        rows = rows.where(F.coalesce(F.try_variant_get(item, "$.isListed", "boolean"), F.lit(True)))
    if vendor == "smartrecruiters":
        status = F.lower(F.coalesce(F.try_variant_get(item, "$.status", "string"), F.lit("")))
        rows = rows.where(status.isin("", "active", "published"))
    value = {name: first_value(item, fields.get(name, [])) if fields.get(name) else F.lit("") for name in _FIELDS}
    if vendor in ("recruitee", "workable"):
        key = "slug" if vendor == "recruitee" else "shortcode"
        folder = "/o/" if vendor == "recruitee" else "/j/"
        part = F.coalesce(F.try_variant_get(item, f"$.{key}", "string"), F.try_variant_get(item, "$.id", "string"))
        value["job_url"] = F.when(value["job_url"] != "", value["job_url"]).otherwise(F.coalesce(F.concat(F.regexp_replace(F.col(base_col), "/+$", ""), F.lit(folder), part), F.lit("")))
    date = value["posted_date"]
    epoch = date.try_cast("double")
    shown = F.when(epoch.isNotNull() & (F.length(date) >= 9), numbers.epoch_date(epoch)).otherwise(numbers.parse_date(date, F.current_date()))
    value |= {
        "job_title": clean_text(value["job_title"], 500), "job_url": F.when(value["job_url"] == "", "").otherwise(urls.join(F.concat(F.regexp_replace(F.col(base_col), "/+$", ""), F.lit("/")), value["job_url"])), "posted_date": F.when(date == "", "").otherwise(shown), "source": F.lit(vendor),
    }
    keep = [F.col(f"`{c}`") for c in payloads.columns]
    return rows.select(*keep, *(v.alias(n) for n, v in value.items())).where(F.col("job_title") != "")


def with_details(listing: DataFrame, details: DataFrame, key: str, overrides: dict[str, str]) -> DataFrame:
    """listing left-joined to details on key; a detail column that is filled replaces the listing's (overrides: detail column to listing column)."""
    told = details.select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in overrides))
    joined = listing.join(told, F.col(key) == F.col("__key"), "left")
    by_target = {target: source for source, target in overrides.items()}
    return joined.select(*(F.coalesce(F.nullif(F.col(f"__{by_target[c]}"), F.lit("")), F.col(c)).alias(c) if c in by_target else F.col(c) for c in listing.columns))


def workday_location(text: Column, places: Column) -> Column:
    """ "3 locations" gives way to the first of the places and up to four more, each once."""
    listed = F.array_join(F.slice(F.array_distinct(places), 1, 5), "; ")
    return F.when(text.rlike(r"^\d+ locations?$") & (F.size(places) > 0), listed).otherwise(text)


PERSONIO = "position array<struct<id:string,name:string,office:string,department:string,employmentType:string,schedule:string,createdAt:string,additionalOffices:struct<office:array<string>>,jobDescriptions:struct<jobDescription:array<struct<name:string,value:string>>>>>"


def from_personio(payloads: DataFrame, payload_col: str = "payload", base_col: str = "base_url") -> DataFrame:
    """Postings of a Personio feed: offices joined by commas, sections of the description by blank lines."""
    p = F.col("__p")
    rows = payloads.withColumn("__p", F.explode(F.from_xml(F.col(payload_col), F.lit(PERSONIO))["position"]))
    offices = F.filter(F.concat(F.array(p["office"]), F.coalesce(p["additionalOffices"]["office"], F.array().cast("array<string>"))), lambda x: F.coalesce(x, F.lit("")) != "")
    text = F.array_join(F.transform(p["jobDescriptions"]["jobDescription"], lambda d: F.concat_ws("\n", d["name"], d["value"])), "\n\n")
    kind = F.when(F.lower(p["employmentType"]).contains("intern"), "Internship").otherwise(F.coalesce(F.nullif(p["schedule"], F.lit("")), p["employmentType"], F.lit("")))
    value = {"job_title": clean_text(p["name"], 500), "job_url": F.concat(F.regexp_replace(F.col(base_col), "/+$", ""), F.lit("/job/"), p["id"]), "job_location": F.array_join(F.array_distinct(offices), ", "), "job_description": F.coalesce(text, F.lit("")), "posted_date": F.substring(F.coalesce(p["createdAt"], F.lit("")), 1, 10), "employment_type": kind, "job_category": F.coalesce(p["department"], F.lit("")), "source": F.lit("personio")}
    return rows.select(*(F.col(f"`{c}`") for c in payloads.columns), *(value.get(n, F.lit("")).alias(n) for n in _FIELDS)).where(F.col("job_title") != "")


# ---- trees of arbitrary shape: Arrow-batched functions ----


def walk(value):
    """Every object of a JSON tree, parents before children; without recursion, so depth is no limit."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            yield v
            stack.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            stack.extend(reversed(v))


def walked(payloads: Column) -> Column:
    """Every dict of each JSON text, parents first, as maps of texts; none for what is no JSON."""

    @F.pandas_udf("array<map<string,string>>")
    def run(texts: pd.Series) -> pd.Series:
        dicts = lambda t: [{k: v if isinstance(v, str) else json.dumps(v) for k, v in d.items()} for d in walk(salvage(t))] if t else []
        return texts.map(dicts)

    return run(payloads)


def salvage(text: str):
    """JSON of a script body: as it is, without line ends, or from the first brace to the last."""
    tries = (lambda: text, lambda: re.sub(r"[\r\n\t]+", " ", text), lambda: text[text.index("{") : text.rindex("}") + 1])
    for attempt in tries:
        try:
            return json.loads(attempt(), strict=False)
        except ValueError:
            continue
    return None


def words(value) -> str:
    """The text of a value: of an object its @value, name or text; of a list its items, joined."""
    if isinstance(value, dict):
        return words(next((value[k] for k in ("@value", "name", "text") if value.get(k)), ""))
    if isinstance(value, list):
        return " ".join(x for x in map(words, value) if x)
    return "" if value is None or isinstance(value, bool) else str(value)


def place(value) -> str:
    """A location: parts of an address once each, several locations joined by semicolons."""
    if isinstance(value, list):
        return "; ".join(dict.fromkeys(x for x in map(place, value) if x))
    if not isinstance(value, dict):
        return words(value)
    if value.get("@type") == "VirtualLocation":
        return "Remote"
    address = value.get("address", value)
    if isinstance(address, dict):
        parts = [words(address.get(k)) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry", "city", "region", "state", "country")]
        joined = ", ".join(dict.fromkeys(p for p in parts if p))
        return joined or words(value)
    return words(address)


def pay(value) -> tuple[str, str, str]:
    """(min, max, currency) of a baseSalary; zeros stand for nothing."""
    if not isinstance(value, dict):
        return "", "", ""
    inner = value.get("value") if isinstance(value.get("value"), dict) else value
    number = lambda v: "" if words(v) in ("", "0", "0.0") else words(v)
    low = number(inner.get("minValue")) or ("" if isinstance(inner.get("value"), dict) else number(inner.get("value")))
    return low, number(inner.get("maxValue")), words(value.get("currency") or inner.get("currency"))


def skill_list(value) -> str:
    items = value if isinstance(value, list) else re.split(r"[,;\n|]", value) if isinstance(value, str) else [value]
    return "; ".join(sorted({w for w in (" ".join(words(x).split()) for x in items) if w and len(w) <= 300}))


def ld_jobs(bodies, base: str = "") -> list[dict]:
    """Postings among the JSON-LD bodies of a page."""
    found = []
    for body in bodies if bodies is not None else []:
        for entry in walk(salvage(body or "")):
            kinds = entry.get("@type")
            if "JobPosting" not in (kinds if isinstance(kinds, list) else [kinds]):
                continue
            low, high, code = pay(entry.get("baseSalary"))
            shown = f"{low} - {high}" if low and high and low != high else low or high
            where = place(entry.get("jobLocation"))
            if entry.get("jobLocationType") == "TELECOMMUTE" and not where:
                where = "Remote"
            kind = entry.get("employmentType")
            education = entry.get("educationRequirements")
            level = education.get("credentialCategory") if isinstance(education, dict) else education
            row = dict.fromkeys(_FIELDS, "")
            row |= {"job_title": " ".join(words(entry.get("title") or entry.get("name")).split()), "job_url": words(entry.get("url")) or base, "job_location": where, "job_description": words(entry.get("description")), "posted_date": words(entry.get("datePosted"))[:10], "application_deadline": words(entry.get("validThrough"))[:10], "employment_type": ", ".join(map(words, kind)) if isinstance(kind, list) else words(kind), "salary": shown, "min_salary": low, "max_salary": high if high != low else "", "currency": code, "skills": skill_list(entry.get("skills")), "education_type": words(level), "source": "jsonld"}
            if row["job_title"]:
                found.append(row)
    return found


def micro_jobs(items, base: str = "") -> list[dict]:
    """Postings among the microdata items of a page."""
    found = []
    for item in items if items is not None else []:
        get = dict(item)
        if "JobPosting" in (get.get("@type") or "") and (get.get("title") or get.get("name")):
            row = dict.fromkeys(_FIELDS, "")
            where = ", ".join(dict.fromkeys(v for k, v in get.items() if k.split(".")[-1] in ("addressLocality", "addressRegion", "addressCountry") and v))
            row |= {"job_title": get.get("title") or get["name"], "job_url": get.get("url") or base, "job_location": where or get.get("jobLocation") or "", "job_description": get.get("description") or "", "posted_date": (get.get("datePosted") or "")[:10], "employment_type": get.get("employmentType") or "", "source": "microdata"}
            found.append(row)
    return found


_HEADERS = {"job_title": "title position job role vacancy stelle", "job_location": "location city place ort standort", "posted_date": "date posted published datum", "job_category": "department category team abteilung", "employment_type": "type employment schedule"}


def table_jobs(tables, base: str = "") -> list[dict]:
    """Postings in the rows of tables whose header names a title column."""
    found = []
    for table in tables if tables is not None else []:
        rows = [list(r) for r in table if len(r)]
        if len(rows) < 2:
            continue
        columns = {}
        for i, cell in enumerate(rows[0]):
            for name, keys in _HEADERS.items():
                if name not in columns and any(k in cell.lower() for k in keys.split()):
                    columns[name] = i
                    break
        if "job_title" not in columns:
            continue
        for cells in rows[1:]:
            row = dict.fromkeys(_FIELDS, "") | {n: cells[i] for n, i in columns.items() if i < len(cells)} | {"job_url": base, "source": "listing"}
            if row["job_title"]:
                found.append(row)
    return found


def find_list(value, depth: int = 4):
    """The list of postings in a JSON tree: two objects or more with a key of titles, at most four levels down."""
    level = [value]
    for _ in range(depth + 1):
        below = []
        for v in level:
            if isinstance(v, list):
                rows = [x for x in v if isinstance(x, dict)]
                if len(rows) >= 2 and all(any(k in x for k in ALIASES["job_title"]) for x in rows[:5]):
                    return rows
                below += v[:50]
            elif isinstance(v, dict):
                below += [v[k] for k in LIST_KEYS if k in v] + [x for k, x in v.items() if k not in LIST_KEYS]
        level = [x for x in below if isinstance(x, (dict, list))]
    return []


def probe(text: str | None, base: str = "") -> list[dict]:
    """Postings in JSON of unknown shape; fewer than two are none."""
    rows = []
    for item in find_list(salvage(text or "")):
        row = dict.fromkeys(_FIELDS, "")
        for name, keys in ALIASES.items():
            value = next((item[k] for k in keys if k in item and item[k] not in (None, "", [], {})), "")
            row[name] = place(value) if name == "job_location" else words(value)
        if row["job_title"] and len(row["job_title"]) <= 200:
            rows.append(row | {"source": "json"})
    return rows if len(rows) >= 2 else []


def _lists(read):
    """An Arrow-batched function (value, base) from a reader of one value; made when it is used, as it needs a session."""
    kind = "array<struct<" + ", ".join(f.replace(" ", ":") for f in JOB.split(", ")) + ">>"

    def batch(values: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([read(v, u) for v, u in zip(values, base, strict=True)])

    return F.pandas_udf(batch, kind)


def ld_json_postings(bodies: Column, base: Column) -> Column:
    return _lists(ld_jobs)(bodies, base)


def microdata_postings(items: Column, base: Column) -> Column:
    return _lists(micro_jobs)(items, base)


def table_postings(tables: Column, base: Column) -> Column:
    return _lists(table_jobs)(tables, base)


def probed_postings(payloads: Column, base: Column) -> Column:
    return _lists(probe)(payloads, base)


def from_pages(pages: DataFrame) -> DataFrame:
    """Postings of pages (url, page): JSON-LD, else microdata, else tables; the first that yields any wins."""
    p = F.col("page")
    found = pages.select("url", ld_json_postings(p["ld_json"], F.col("url")).alias("ld"), microdata_postings(p["items"], F.col("url")).alias("micro"), table_postings(p["tables"], F.col("url")).alias("listed"))
    chosen = F.coalesce(*(F.when(F.size(c) > 0, F.col(c)) for c in ("ld", "micro", "listed")))
    return found.select("url", F.posexplode(chosen).alias("pos", "job")).select("url", "pos", "job.*")
