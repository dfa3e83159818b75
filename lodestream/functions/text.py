"""Text functions: cleaning, lists, labelled fields, classifiers, skills, titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .rules import FLAGS, filled, first_contained, first_match, matches


def clean_text(text: Column, most: int = 20000) -> Column:
    """White space runs become one space; trimmed, cut to ``most`` code points, trimmed again; null is empty."""
    flat = F.regexp_replace(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\x00"), F.lit("")), r"(?U)\s+", " ")
    return F.rtrim(F.substring(F.trim(flat), 1, most))


def to_list(text: Column) -> Column:
    """Parts between commas, semicolons, bars and line ends, cleaned, without blanks."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[,;\n|]"), lambda x: clean_text(x, 500)), lambda x: x != "")


def join_list(text: Column, sep: str = "; ") -> Column:
    return F.array_join(to_list(text), sep)


def labelled(text: Column) -> Column:
    """A struct of the fields that a posting states under their labels; empty where it states none."""
    out = []
    for name, (label, stop) in V.LABELLED.items():
        found = F.regexp_extract(F.coalesce(text, F.lit("")), rf"{FLAGS}{label}([^|\n\r]+?)(?=\s*(?:{stop}))", 1)
        value = F.regexp_replace(clean_text(F.element_at(F.split(found, r"\r?\n|•|\|\||:"), 1), 300), "[,;]+$", "")
        good = F.length(value) >= 2
        if name == "years_of_experience":
            good = good & value.rlike(r"\d")
        if name == "salary":
            good = good & value.rlike(r"\d|€|\$|£|₹|¥")
        out.append(F.when(good, value).otherwise("").alias(name))
    return F.struct(*out)


def employment_type(title: Column, text: Column) -> Column:
    return first_match(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(F.coalesce(text, F.lit("")), 1, 4000)), V.EMPLOYMENT)


def seniority(title: Column, text: Column) -> Column:
    """The title decides; only a title that says nothing leaves it to the opening of the text."""
    return filled(first_match(title, V.SENIORITY), first_match(F.substring(text, 1, 1500), V.SENIORITY))


def job_category(title: Column, text: Column) -> Column:
    return filled(first_match(title, V.JOB_CATEGORY), first_match(F.substring(text, 1, 2000), V.JOB_CATEGORY))


def education(text: Column) -> Column:
    """A struct of education type, stream and qualification."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, 12000)
    return F.struct(
        first_match(head, V.EDUCATION_TYPE).alias("education_type"),
        first_match(head, V.EDUCATION_STREAM).alias("education_stream"),
        clean_text(F.regexp_extract(head, FLAGS + V.QUALIFICATION, 1), 160).alias("education_qualification"),
    )


def title_case(text: Column) -> Column:
    """A capital after every character that is no letter, small letters elsewhere."""
    return F.array_join(
        F.transform(F.split(F.regexp_replace(F.lower(text), r"(?U)(?<=^|[^\p{L}])(?=\p{L})", "\x01"), "\x01"), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))), ""
    )


def skills(text: Column, most: int = 25, vocabulary: str = V.SKILLS) -> Column:
    """Known skills in order of appearance, each once whatever its case, joined by "; "."""
    hits = F.regexp_extract_all(F.substring(F.coalesce(text, F.lit("")), 1, 20000), F.lit(rf"(?iu)(?<![a-z0-9])({vocabulary})(?![a-z0-9])"), F.lit(1))
    once = F.aggregate(hits, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)))
    shown = F.transform(F.slice(once, 1, most), lambda x: F.when((x == F.upper(x)) & x.rlike("[A-Za-z]"), x).otherwise(title_case(x)))
    return F.array_join(shown, "; ")


def is_leader(title: Column) -> Column:
    """Whether a title is one of leadership; owners of products, processes and the like are not."""
    t = F.regexp_replace(F.trim(F.coalesce(title, F.lit(""))), FLAGS + V.NOT_OWNER, " ")
    found = F.lit(False)
    for pattern in V.LEADERS:
        found = found | matches(t, pattern)
    level = matches(t, V.LEADER_LEVEL)
    for pattern in V.LEADER_FIELDS:
        found = found | (matches(t, pattern) & level)
    return found


def export_seniority(title: Column) -> Column:
    """C, V, D, H or M level; "vice president" anywhere rules out C."""
    t = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), FLAGS + V.NOT_OWNER, " ")
    top = matches(t, V.EXPORT_C_LEVEL) & ~matches(t, r"\bvice\s+president\b")
    return F.when(top, "C-Level").otherwise(first_match(t, V.EXPORT_SENIORITY))


def export_employment(value: Column) -> Column:
    v = F.trim(F.coalesce(value, F.lit("")))
    return F.when(v == "", "").otherwise(first_contained(F.lower(v), V.EXPORT_EMPLOYMENT, F.substring(v, 1, 40)))


def export_education(value: Column) -> Column:
    chain = F
    for given, shown in V.EXPORT_EDUCATION.items():
        chain = chain.when(value == given, F.lit(shown))
    return chain.otherwise(value)


def looks_like_title(title: Column) -> Column:
    """The guard of the loosest extraction: a heading is not a posting."""
    t = F.trim(F.coalesce(title, F.lit("")))
    words = F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")
    wordish = F.filter(words, lambda w: w.rlike(r"(?U)\p{L}"))
    capital = F.size(F.filter(wordish, lambda w: w.rlike(r"^\p{Lu}")))
    shape = F.length(t).between(4, 120) & ~matches(t, V.GENERIC_HEADING) & ~t.endswith("?") & (F.regexp_count(t, F.lit(r"\.")) <= 2) & (F.size(words) <= 14)
    named = matches(t, V.GENDER_MARK) | matches(t, V.ROLE_WORD)
    phrase = (F.size(wordish) >= 2) & (capital >= F.greatest(F.lit(2), F.size(wordish) - 1))
    return shape & (named | phrase)


def says_no_jobs(text: Column) -> Column:
    return matches(text, V.NO_JOBS)


def is_parked(visible: Column) -> Column:
    return (F.length(visible) < 2000) & matches(visible, V.PARKED)


def is_career_link(text: Column, href: Column) -> Column:
    return matches(F.lower(F.concat_ws(" ", text, href)), V.CAREER_WORDS)


#: Frequent short words by language; the language with most hits wins.
STOP_WORDS = {
    "en": "the and of to in is that for with was are this from".split(),
    "de": "der die das und ist nicht mit ein eine zu den von für".split(),
    "fr": "le la les des et est une dans pour que qui sur pas".split(),
    "es": "el los las una que por para con del como más este".split(),
}


def language(text: Column, least: int = 20) -> Column:
    """The language whose frequent words a text holds most of; empty below ``least`` characters or without any."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}]+"), F.lit(0))
    hits = lambda known: F.size(F.filter(words, lambda w: w.isin(known)))
    scores = [F.struct(hits(known).alias("n"), F.lit(code).alias("code")) for code, known in STOP_WORDS.items()]
    best = F.array_max(F.array(*scores))
    return F.when((F.length(F.trim(F.coalesce(text, F.lit("")))) < least) | (best["n"] == 0), "").otherwise(best["code"])
