"""URLs: hosts, registrable domains, joins, identities, and what a URL is of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocabulary as V
from .rules import FLAGS, matches

# ---- fixed values: second levels below which names are registered ----
SECOND_LEVELS = "co com org net gov edu ac or ne go gob nom mil sch ltd plc me".split()
_LABEL = r"(?!-)[a-z0-9\p{L}-]{1,63}(?<!-)"


def ensure_https(url: Column) -> Column:
    """Trimmed, also of zero-width characters; https:// before an address without a scheme."""
    u = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "^[\\s​‌‍﻿]+|[\\s​‌‍﻿]+$", "")
    return F.when((u == "") | u.rlike(r"^[a-zA-Z][\w+.-]*://"), u).otherwise(F.concat(F.lit("https://"), u))


def hostname(url: Column) -> Column:
    """The host in small letters, without port or user; empty where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(rest, "^.*@", ""), r":\d*$", ""))


def is_hostname(host: Column) -> Column:
    """IPv4 with octets up to 255, or labels under a top level of two letters or more."""
    h = F.lower(F.coalesce(host, F.lit("")))
    octets = F.transform(F.split(h, r"\."), lambda x: x.try_cast("int"))
    numeric = h.rlike(r"^\d+(\.\d+){3}$") & F.forall(octets, lambda x: x <= 255)
    named = h.rlike(rf"^(?:{_LABEL}\.)+(?:[a-z\p{{L}}]{{2,63}}|xn--[a-z0-9-]{{2,59}})$") & (F.length(h) <= 253)
    return numeric | named


def looks_resolvable(host: Column) -> Column:
    """Whether a name could resolve at all: no spaces, brackets or commas, a dot (or localhost), at most 253 characters."""
    h = F.coalesce(host, F.lit(""))
    return (h == "localhost") | (~h.rlike(r"[ (),]") & (F.length(h) <= 253) & h.contains("."))


def resolvable(rows: DataFrame, host: str, answers: DataFrame) -> DataFrame:
    """rows whose host could resolve and, where a table of answers (host, resolved) says so, does."""
    known = answers.select(F.col("host").alias("__host"), "resolved")
    joined = rows.where(looks_resolvable(F.col(host))).join(known, F.col(host) == F.col("__host"), "left")
    return joined.where(F.coalesce("resolved", F.lit(True))).drop("__host", "resolved")


def normalize_website(url: Column) -> Column:
    """https://host, with a port unless it is 80 or 443; empty for what is no host."""
    full = ensure_https(url)
    host = hostname(full)
    port = F.regexp_extract(full, r"^[a-zA-Z][\w+.-]*://[^/?#]*:(\d+)(?:[/?#]|$)", 1)
    shown = F.when((port == "") | port.isin("80", "443"), "").otherwise(F.concat(F.lit(":"), port))
    return F.when(is_hostname(host), F.concat(F.lit("https://"), host, shown)).otherwise("")


def registrable_domain(host: Column) -> Column:
    """Two labels, or three below a second level that registers names under a short top level."""
    labels = F.split(F.regexp_replace(F.lower(F.coalesce(host, F.lit(""))), r"^www\.", ""), r"\.")
    n = F.size(labels)
    deep = (n >= 3) & F.element_at(labels, -2).isin(SECOND_LEVELS) & (F.length(F.element_at(labels, -1)) <= 3)
    return F.when(n <= 2, F.array_join(labels, ".")).otherwise(F.array_join(F.slice(labels, F.when(deep, n - 2).otherwise(n - 1), F.lit(3)), "."))


def identity(url: Column) -> Column:
    """Without fragment and trailing slashes: equal for equal pages."""
    return F.regexp_replace(F.split_part(F.coalesce(url, F.lit("")), F.lit("#"), F.lit(1)), "/+$", "")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)


def join(base: Column, href: Column) -> Column:
    """A reference resolved against the page that holds it; empty for fragments, mail and telephone."""
    h = F.trim(F.coalesce(href, F.lit("")))
    root = F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)
    folder = F.concat(root, F.when(path(base) == "", "/").otherwise(F.regexp_replace(path(base), r"[^/]*$", "")))
    query = F.regexp_extract(base, r"^([^?#]*)", 1)
    joined = (
        F.when(h.rlike(r"(?i)^(#|mailto:|tel:|javascript:)") | (h == ""), "")
        .when(h.startswith("//"), F.concat(F.lit("https:"), h))
        .when(h.rlike(r"^[a-zA-Z][\w+.-]*:"), h)
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(query, h))
        .otherwise(F.concat(folder, h))
    )
    return _without_dots(joined)


def _without_dots(url: Column) -> Column:
    """Dot segments of a path removed."""
    head, rest, tail = (F.regexp_extract(url, r"^([a-zA-Z][\w+.-]*://[^/?#]*)([^?#]*)(.*)$", i) for i in (1, 2, 3))
    parts = F.split(rest, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).when(x == ".", acc).otherwise(F.array_append(acc, x)),
    )
    ends = rest.rlike(r"/\.{1,2}$")
    return F.when(rest.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(head, F.array_join(kept, "/"), F.when(ends, "/").otherwise(""), tail)).otherwise(url)


def unwrap(url: Column) -> Column:
    """The http address that a redirector carries in a parameter, else the address itself."""
    chain = F
    for name in ("uddg", "u", "url", "q"):
        value = F.try_url_decode(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1))
        chain = chain.when(value.rlike("^https?://"), value)
    return chain.otherwise(url)


def same_domain(a: Column, b: Column) -> Column:
    x = registrable_domain(hostname(a))
    return (x != "") & (x == registrable_domain(hostname(b)))


def slugify(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def is_generic_landing(final: Column, original: Column) -> Column:
    """Whether a redirect led from a posting to the root of a listing."""
    clean = lambda u: F.regexp_replace(F.lower(path(u)), "/+$", "")
    segments = F.size(F.filter(F.split(clean(original), "/"), lambda x: x != ""))
    specific = ~clean(original).isin(*V.LISTING_ROOTS) & ((segments >= 2) | clean(original).rlike(r"\d"))
    return specific & clean(final).isin(*V.LISTING_ROOTS)


# ---- fixed values: where vendors host boards (host suffix, vendor, where the tenant stands) ----
BOARD_HOSTS = """
greenhouse.io greenhouse path|lever.co lever path|smartrecruiters.com smartrecruiters path|workable.com workable path|recruitee.com recruitee host|breezy.hr breezy host|applytojob.com jazzhr host|bamboohr.com bamboo host
personio.de personio host|personio.com personio host|myworkdayjobs.com workday host|myworkdaysite.com workday host|ashbyhq.com ashby path|eightfold.ai eightfold host|csod.com cornerstone host|successfactors.com successfactors host
successfactors.eu successfactors host|icims.com icims host|jobvite.com jobvite path|taleo.net taleo host|teamtailor.com teamtailor host|softgarden.io softgarden host|pinpointhq.com pinpoint host|zohorecruit.com zoho host
freshteam.com freshteam host|jobadder.com jobadder path|rippling.com rippling path|dayforcehcm.com dayforce path|phenompeople.com phenom host|paylocity.com paylocity path|paycomonline.net paycom path|ultipro.com ultipro path
adp.com adp path|isolvedhire.com isolved host|homerun.co homerun host|occupop.com occupop host|tribepad.com tribepad host|jobylon.com jobylon path|reachmee.com reachmee host|factorialhr.com factorial host
keka.com keka host|darwinbox.in darwinbox host|manatal.com manatal path|avature.net avature host|talentsoft.com talentsoft host|gupy.io gupy host|kenoby.com kenoby host|solides.jobs solides host|inhire.app inhire host|pandape.com.br pandape host
dvinci-hr.com dvinci host|rexx-systems.com rexx host|umantis.com umantis host|onlyfy.jobs onlyfy host|concludis.de concludis host|greythr.com greythr host|turbohire.co turbohire host|peoplestrong.com peoplestrong host|ceipal.com ceipal path
pageuppeople.com pageup host|elmotalent.com.au elmo host|employmenthero.com employmenthero path|webcruiter.no webcruiter path|jobbnorge.no jobbnorge path|varbi.com varbi host|hr-manager.net hrmanager host|flatchr.io flatchr host|taleez.com taleez path
digitalrecruiters.com digitalrecruiters host|traffit.com traffit host|erecruiter.pl erecruiter host|applicantpro.com applicantpro host|clearcompany.com clearcompany host|brassring.com brassring host|silkroad.com silkroad host|catsone.com cats host
fountain.com fountain path|hireology.com hireology path|interfolio.com interfolio path|peopleadmin.com peopleadmin host|governmentjobs.com neogov path|schooljobs.com neogov path|welcometothejungle.com wttj path|jobs.ch jobsch path
"""
#: Vendors that host many employers under one roof: an address alone proves no owner.
SHARED_VENDORS = "neogov wttj jobsch interfolio adp".split()
# ---- fixed values: spellings of vendors ----
VENDOR_ALIASES = {"workday hcm": "workday", "my workday": "workday", "smart recruiters": "smartrecruiters", "bamboo hr": "bamboo", "bamboohr": "bamboo", "jazz hr": "jazzhr", "jazz": "jazzhr", "green house": "greenhouse", "sap successfactors": "successfactors", "success factors": "successfactors", "cornerstone ondemand": "cornerstone", "oracle taleo": "taleo", "zoho recruit": "zoho", "ashby hq": "ashby", "ukg": "ultipro", "ukg pro": "ultipro", "adp workforce now": "adp", "pinpoint hq": "pinpoint", "breezy hr": "breezy", "hr manager": "hrmanager"}


def board_hosts(table: str = BOARD_HOSTS) -> list[tuple[str, str, str]]:
    """(host suffix, vendor, place of the tenant) from a table of that form: entries between bars or line ends."""
    return [tuple(x.split()) for line in table.strip().split("\n") for x in line.split("|")]


def _host_map(pairs: Sequence[tuple[str, str, str]], column: int) -> Column:
    return F.map_from_arrays(F.array(*(F.lit(p[0]) for p in pairs)), F.array(*(F.lit(p[column]) for p in pairs)))


def vendor(url: Column, hosts: Sequence[tuple[str, str, str]] | None = None) -> Column:
    """A struct (vendor, slug) of a board address; empty where its host is no vendor's.

    One lookup per host suffix takes the place of a pattern per vendor, so the plan does
    not grow with the table; pass a longer one as ``hosts`` (``board_hosts`` reads it).
    """
    pairs = board_hosts() if hosts is None else hosts
    host = hostname(url)
    labels = F.split(host, r"\.")
    suffixes = F.array(*(F.array_join(F.slice(labels, F.greatest(F.size(labels) - k, F.lit(1)), F.lit(k + 1)), ".") for k in (1, 2)))
    known = F.get(F.filter(suffixes, lambda s: F.map_contains_key(_host_map(pairs, 1), s)), 0)
    name, place = F.try_element_at(_host_map(pairs, 1), known), F.try_element_at(_host_map(pairs, 2), known)
    first = F.regexp_extract(path(url), r"^/(?:(?:embed|job_board|en|en-us|j|jobs|careers|o)/)*([^/]+)", 1)
    tenant = F.regexp_extract(host, r"^([^.]+)\.", 1)
    slug = F.when(place == "host", F.when(tenant.isin("www", "jobs", "careers"), "").otherwise(tenant)).otherwise(F.lower(first))
    return F.when(name.isNull(), F.struct(F.lit("").alias("vendor"), F.lit("").alias("slug"))).otherwise(F.struct(name.alias("vendor"), F.coalesce(slug, F.lit("")).alias("slug")))


def canonical_vendor(name: Column) -> Column:
    """The vendor that a spelling stands for: as given, with spaces, or squeezed; else underscored."""
    raw = F.trim(F.lower(F.coalesce(name, F.lit(""))))
    spaced = F.regexp_replace(raw, "[_-]+", " ")
    squeezed = F.regexp_replace(raw, "[^a-z0-9]+", "")
    aliases = F.map_from_arrays(F.array(*map(F.lit, VENDOR_ALIASES)), F.array(*map(F.lit, VENDOR_ALIASES.values())))
    names = sorted({p[1] for p in board_hosts()})
    known = lambda c: F.when(c.isin(names), c)
    return F.coalesce(known(raw), F.try_element_at(aliases, raw), F.try_element_at(aliases, spaced), known(squeezed), F.regexp_replace(raw, "[^a-z0-9]+", "_"))


def is_probable_board(url: Column) -> Column:
    """Whether an address may be a job board: no asset, no page about the vendor, no delivery host, no aggregator."""
    host, low = hostname(url), F.lower(F.coalesce(url, F.lit("")))
    name = vendor(url)["vendor"]
    corporate = (name != "") & host.rlike(r"^(?:www\.)?[^.]+\.[^.]+$")
    return (
        F.when(host == "", F.lit(False))
        .when(matches(low, V.ASSET_URL), F.lit(False))
        .when(matches(path(low), V.NON_BOARD_PATH), F.lit(False))
        .when(matches(host, V.CDN_HOST), F.lit(False))
        .when(matches(host, V.AGGREGATOR_HOST), F.lit(False))
        .when(name.isin(SHARED_VENDORS), F.lit(False))
        .when(corporate, matches(low, V.BOARDISH_PATH))
        .otherwise(F.lit(True))
    )


def workday(url: Column) -> Column:
    """A struct (tenant, site, base) of a Workday address; the site is the tenant where the path names none."""
    host = hostname(url)
    tenant = F.regexp_extract(host, r"^([a-z0-9_-]+)\.wd\d+\.myworkday(?:jobs|site)\.com$", 1)
    parts = F.filter(F.split(path(url), "/"), lambda x: (x != "") & ~x.rlike(r"^[a-z]{2}(?:-[A-Za-z]{2})?$"))
    stop = F.array_position(F.transform(parts, lambda x: F.lower(x).isin("job", "jobs", "details", "apply", "login", "search")), F.lit(True))
    ahead = F.when(stop > 0, F.slice(parts, F.lit(1), (stop - 1).cast("int"))).otherwise(parts)
    site = F.coalesce(F.get(F.filter(ahead, lambda x: ~F.lower(x).isin("recruiting", "wday", "cxs")), 0), tenant)
    return F.struct(tenant.alias("tenant"), F.when(tenant == "", "").otherwise(site).alias("site"), F.when(tenant == "", "").otherwise(F.concat(F.lit("https://"), host)).alias("base"))


#: Paths where careers pages often live.
COMMON_PATHS = "careers career jobs job careers/jobs about/careers company/careers join-us work-with-us vacancies employment en/careers karriere stellenangebote emploi empleo open-positions".split()


def common_career_urls(base: Column) -> Column:
    root = F.regexp_replace(base, "/+$", "")
    return F.array(*(F.concat(root, F.lit(f"/{p}")) for p in COMMON_PATHS))


def variants(site: Column) -> Column:
    """Addresses to try for a site: https and http, with and without www, each once."""
    full = ensure_https(site)
    host, rest = hostname(full), F.regexp_replace(path(full), "/+$", "")
    bare = F.regexp_replace(host, r"^www\.", "")
    tries = F.array(full, F.concat(F.lit("https://"), host, rest), F.concat(F.lit("http://"), host, rest), F.concat(F.lit("https://www."), bare, rest), F.concat(F.lit("https://"), bare, rest))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(tries, lambda u: F.regexp_replace(u, "/+$", ""))))


def excluded_link(href: Column) -> Column:
    return matches(href, V.EXCLUDED_LINK, FLAGS)
