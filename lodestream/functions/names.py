"""Company names: tokens, and evidence that a slug, a domain or a page is a company's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .rules import matches

#: Common words of organisations' names, by default; pass a fuller list as ``generic``.
GENERIC = (
    "academy advisory agency air america american asia associates association auto bank bio board book build business capital care center central centre chemical city clean clinic college commercial communications"
    " community construction consulting control council county credit data design development digital direct east education electric electronics energy engineering enterprise enterprises equipment europe european"
    " express federal finance financial first food foods foundation fund general global gold government green health healthcare high home hospital hotel house industrial industries industry information innovation"
    " institute insurance international investment investments labs law life logistics machine management manufacturing marine market marketing media medical metal metro mobile motor national network networks new north"
    " north oil one online pacific partners petroleum pharma plastics power press print products professional project properties public real research resources restaurant retail school science sciences security service"
    " services shop smart society software solar solutions south sport state steel store studio supply support system systems tech technical technologies technology telecom textile trade trading training transport"
    " travel trust union united university water web west wood works world"
).split()

_KEEP = "[^a-z0-9]+"


def all_tokens(name: Column) -> Column:
    """Words of more than one character in small letters, without legal forms and fillers; order and repeats kept."""
    words = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(V.NOISE))


def distinctive_tokens(name: Column, generic: Sequence[str] = GENERIC) -> Column:
    """Tokens of three characters or more that are no common words."""
    return F.filter(all_tokens(name), lambda w: (F.length(w) >= 3) & ~w.isin(list(generic)))


def _count(tokens: Column, test) -> Column:
    return F.size(F.filter(tokens, test))


def slug_matches(slug: Column, name: Column, least: int = 4, generic: Sequence[str] = GENERIC) -> Column:
    """Whether a board's slug carries a name: a distinctive word, the squeezed name, or its initials."""
    s = F.regexp_replace(F.lower(F.coalesce(slug, F.lit(""))), _KEEP, "")
    tokens, distinct = all_tokens(name), distinctive_tokens(name, generic)
    word = F.exists(distinct, lambda t: (F.length(t) >= least) & F.contains(s, t))
    squeezed = F.array_join(tokens, "")
    whole = (F.length(s) >= 5) & (squeezed.startswith(s) | (F.contains(squeezed, s) & (_count(tokens, lambda t: F.contains(s, t)) >= 2)))
    initials = (F.size(tokens) >= 3) & (F.length(s) >= 3) & (s == F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), ""))
    return (F.length(s) >= 2) & (F.size(tokens) > 0) & (word | whole | initials)


def domain_matches(domain: Column, name: Column, generic: Sequence[str] = GENERIC) -> Column:
    """Whether a registrable domain plausibly belongs to a name; one common word is never enough."""
    d = F.trim(F.lower(F.coalesce(domain, F.lit(""))))
    label = F.regexp_replace(F.split_part(d, F.lit("."), F.lit(1)), r"^www[-.]*", "")
    tokens, distinct = all_tokens(name), distinctive_tokens(name, generic)
    word = F.exists(distinct, lambda t: ((F.length(t) >= 5) & F.contains(label, t)) | ((F.length(t) >= 4) & label.startswith(t)) | (label == t))
    present = F.filter(tokens, lambda t: F.contains(label, t))
    covered = F.aggregate(present, F.lit(0), lambda acc, t: acc + F.length(t)) / F.length(label)
    several = (F.size(present) >= 2) & F.arrays_overlap(present, distinct) & (covered >= 0.6)
    plain = F.size(distinct) == 0
    every = plain & (F.size(present) >= 2) & (F.size(present) == F.size(tokens))
    longest = F.aggregate(tokens, F.lit(""), lambda acc, t: F.when(F.length(t) > F.length(acc), t).otherwise(acc))
    alone = plain & (F.size(tokens) >= 2) & (F.length(longest) >= 5) & (label == longest)
    usable = (d != "") & (label != "") & ~matches(F.concat(d, F.lit(".")), V.SOCIAL_HOST)
    return usable & F.coalesce(word | several | every | alone, F.lit(False))


def _flat(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _KEEP, " ")


def page_evidence(headings: Column, body: Column, name: Column, generic: Sequence[str] = GENERIC) -> Column:
    """The share of a name's words that a page's titles and first 12,000 characters hold; a name of common words is weak at best."""
    distinct, every = distinctive_tokens(name, generic), all_tokens(name)
    plain = F.size(distinct) == 0
    tokens = F.when(plain, every).otherwise(distinct)
    hay = _flat(F.concat_ws(" ", headings, F.substring(body, 1, 12000)))
    padded = F.concat(F.lit(" "), hay, F.lit(" "))
    found = _count(tokens, lambda t: F.when(F.length(t) <= 4, F.contains(padded, F.concat(F.lit(" "), t, F.lit(" ")))).otherwise(F.contains(hay, t)))
    score = found / F.size(tokens)
    return F.when(F.size(tokens) == 0, 0.0).when(plain, F.when(score >= 1, 0.5).otherwise(0.0)).otherwise(score)


def title_evidence(titles: Column, name: Column) -> Column:
    """A struct (share, n): the share of all of a name's words that stand whole in a page's own titles."""
    tokens = all_tokens(name)
    padded = F.concat(F.lit(" "), _flat(titles), F.lit(" "))
    found = _count(tokens, lambda t: F.contains(padded, F.concat(F.lit(" "), t, F.lit(" "))))
    return F.struct(F.when(F.size(tokens) == 0, 0.0).otherwise(found / F.size(tokens)).alias("share"), F.size(tokens).alias("n"))


def ownership(vendor: Column, slug: Column, name: Column, evidence: Column, shared: Sequence[str]) -> Column:
    """A struct (accepted, reason): the slug proves it, or the page; a shared vendor needs the page."""
    by_slug = (vendor != "") & (slug != "") & slug_matches(slug, name)
    by_page = F.coalesce(evidence, F.lit(0.0)) >= 0.5
    number = F.format_string("%.2f", F.coalesce(evidence, F.lit(0.0)))
    reason = (
        F.when(by_slug, F.concat(F.lit("slug:"), slug))
        .when(by_page, F.concat(F.lit("page_evidence="), number))
        .when(vendor.isin(list(shared)), "shared vendor board without company evidence")
        .otherwise(F.concat(F.lit("no ownership evidence (slug="), slug, F.lit(" evidence="), number, F.lit(")")))
    )
    return F.struct((by_slug | by_page).alias("accepted"), reason.alias("reason"))


#: Top levels to try by country, then com.
COUNTRY_LEVELS = {"Germany": ["de"], "France": ["fr"], "Spain": ["es"], "Italy": ["it"], "United Kingdom": ["co.uk", "uk"], "India": ["in", "co.in"], "Australia": ["com.au"], "Brazil": ["com.br"], "Canada": ["ca"], "Netherlands": ["nl"], "Switzerland": ["ch"], "Austria": ["at"], "Poland": ["pl"], "Sweden": ["se"], "Norway": ["no"], "Denmark": ["dk"], "Belgium": ["be"], "Mexico": ["com.mx"], "Japan": ["co.jp"], "USA": ["com", "org"]}


def guess_hosts(name: Column, country: Column, most: int = 6) -> Column:
    """Likely hosts of a company: stems of its name under its country's top levels, then com."""
    tokens = F.filter(all_tokens(name), lambda t: F.length(t) > 2)
    first_long = F.filter(tokens, lambda t: F.length(t) >= 5)
    stems = F.array(F.array_join(tokens, ""), F.array_join(tokens, "-"), F.array_join(F.slice(tokens, 1, 2), ""), F.coalesce(F.get(first_long, 0), F.lit("")))
    stems = F.array_distinct(F.filter(stems, lambda s: (F.length(s) > 3) & (F.length(s) <= 30)))
    levels = F.map_from_arrays(F.array(*map(F.lit, COUNTRY_LEVELS)), F.array(*(F.array(*map(F.lit, v)) for v in COUNTRY_LEVELS.values())))
    tops = F.array_distinct(F.concat(F.coalesce(F.try_element_at(levels, country), F.array().cast("array<string>")), F.array(F.lit("com"))))
    return F.slice(F.array_distinct(F.flatten(F.transform(stems, lambda s: F.transform(tops, lambda t: F.concat(s, F.lit("."), t))))), 1, most)


def domain_score(domain: Column, name: Column) -> Column:
    """20 for each word of a name that a domain holds, 10 more where a long one begins or ends it; social hosts far below."""
    label = F.split_part(domain, F.lit("."), F.lit(1))
    points = F.aggregate(
        all_tokens(name), F.lit(0), lambda acc, t: acc + F.when(F.contains(label, t), 20).otherwise(0) + F.when((F.length(t) >= 4) & (label.startswith(t) | label.endswith(t)), 10).otherwise(0)
    )
    return F.when(matches(F.concat(domain, F.lit(".")), V.SOCIAL_HOST), -1000).otherwise(points)
