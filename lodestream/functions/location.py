"""Countries of job locations: a cascade of look-ups, from explicit names to loose words."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: names of countries that results agree on, and their other spellings ----
SHOWN = {"US": "USA", "GB": "United Kingdom", "VN": "Vietnam", "KR": "South Korea", "RU": "Russia", "CZ": "Czech Republic", "AE": "United Arab Emirates"}
SPELLINGS = {"usa": "USA", "u.s": "USA", "u.s.a": "USA", "united states": "USA", "united states of america": "USA", "us": "USA", "uk": "United Kingdom", "great britain": "United Kingdom", "england": "United Kingdom", "scotland": "United Kingdom", "wales": "United Kingdom", "northern ireland": "United Kingdom", "deutschland": "Germany", "españa": "Spain", "italia": "Italy", "brasil": "Brazil", "méxico": "Mexico", "schweiz": "Switzerland", "suisse": "Switzerland", "österreich": "Austria", "nederland": "Netherlands", "holland": "Netherlands", "uae": "United Arab Emirates", "korea": "South Korea", "viet nam": "Vietnam", "czechia": "Czech Republic", "türkiye": "Turkey", "polska": "Poland", "danmark": "Denmark", "sverige": "Sweden", "norge": "Norway"}
#: Two-letter codes that are also states or words.
AMBIGUOUS = "in co de ca pa id no is it at be se sa ma my".split()
# ---- fixed values: states, provinces and regions ----
US_STATES = "alabama alaska arizona arkansas california colorado connecticut delaware florida georgia hawaii idaho illinois indiana iowa kansas kentucky louisiana maine maryland massachusetts michigan minnesota mississippi missouri montana nebraska nevada new_hampshire new_jersey new_mexico new_york north_carolina north_dakota ohio oklahoma oregon pennsylvania rhode_island south_carolina south_dakota tennessee texas utah vermont virginia washington west_virginia wisconsin wyoming district_of_columbia puerto_rico".replace(" ", "|").replace("_", " ").split("|")
US_CODES = "al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy dc pr".split()
CA_PROVINCES = "ontario|quebec|québec|british columbia|alberta|manitoba|saskatchewan|nova scotia|new brunswick|newfoundland|newfoundland and labrador|prince edward island".split("|")
CA_CODES, CA_CLASHES = "on qc bc ab mb sk ns nb nl pe yt nt nu".split(), "on nl pe ab sk mb ns nb".split()
AU_STATES = "new south wales|victoria|queensland|western australia|south australia|tasmania|nsw|vic|qld".split("|")
IN_STATES = "karnataka|maharashtra|tamil nadu|telangana|gujarat|haryana|uttar pradesh|west bengal|kerala|rajasthan|punjab|delhi|andhra pradesh|madhya pradesh|bihar|odisha".split("|")
DE_STATES = "bayern|bavaria|baden-württemberg|hessen|hesse|nordrhein-westfalen|north rhine-westphalia|niedersachsen|sachsen|saxony|thüringen|brandenburg|rheinland-pfalz|schleswig-holstein|saarland|sachsen-anhalt".split("|")
BR_STATES = "são paulo|sao paulo|rio de janeiro|minas gerais|paraná|parana|bahia|santa catarina|rio grande do sul|sp|rj|mg|pr|rs|sc".split("|")
UK_REGIONS = "greater london|west midlands|east midlands|greater manchester|yorkshire|west yorkshire|kent|surrey|essex|berkshire|hampshire|lancashire|merseyside".split("|")
_REMOTE = r"(?i)\b(remote|hybrid|virtual|work from home|wfh|home[- ]based|telecommute|anywhere)\b"
_SPLIT = r"\s*(?:,|;|/|\||–|—|\s-\s|\(|\)|\n)\s*"


def _default_countries() -> dict[str, str]:
    """Names and codes of countries, from the time zone database's list, under the names shown."""
    import pytz

    found = {}
    for code, name in pytz.country_names.items():
        shown = SHOWN.get(code, name)
        found[name.lower()] = found[shown.lower()] = found[code.lower()] = shown
    found.pop("georgia")  # always read as the state
    return found | SPELLINGS


def _default_cities() -> dict[str, str]:
    """Cities that name a time zone, by country."""
    import pytz

    names = _default_countries()
    return {zone.rsplit("/", 1)[1].replace("_", " ").lower(): names[code.lower()] for code, zones in pytz.country_timezones.items() for zone in zones}


@dataclass
class Gazetteer:
    """What places are called: lower-case names to countries."""

    countries: dict[str, str] = field(default_factory=_default_countries)
    cities: dict[str, str] = field(default_factory=_default_cities)


def _lookup(names: dict[str, str]):
    table = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.lit, names.values())))
    return lambda key: F.try_element_at(table, key)


def country(location: Column, places: Gazetteer | None = None) -> Column:
    """The country of a location, or the empty string."""
    places = places or Gazetteer()
    by_name, by_city = _lookup(places.countries), _lookup(places.cities)
    text = F.trim(F.coalesce(location, F.lit("")))
    low = F.lower(text)
    strip = lambda c: F.regexp_replace(c, r"^[ ,-]+|[ ,-]+$", "")
    plain = lambda c: strip(F.regexp_replace(F.regexp_replace(c, _REMOTE, " "), r"\s+", " "))
    norm = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", " "), r"^[.\s]+|[.\s]+$", ""))
    parts = F.reverse(F.filter(F.transform(F.split(text, _SPLIT), norm), lambda p: p != ""))
    first = lambda array: F.get(F.filter(array, lambda x: x.isNotNull()), 0)
    explicit = first(F.transform(parts, lambda p: F.coalesce(F.when(~plain(p).isin(AMBIGUOUS), by_name(plain(p))), F.when(plain(p).rlike(r"^(?:united states|usa|u\.s\.)\b"), F.lit("USA")))))
    last, ahead = plain(F.get(parts, 0)), F.get(parts, 1)
    city = by_city(ahead)
    confirmed = (
        F.when((last == "de") & (ahead.isin(DE_STATES) | (city == "Germany")), "Germany")
        .when((last == "in") & (ahead.isin(IN_STATES) | (city == "India")), "India")
        .when((last == "it") & (city == "Italy"), "Italy")
        .when((last == "ca") & (ahead.isin(CA_PROVINCES) | (city == "Canada")), "Canada")
        .when(last == "ca", "USA")
        .when((last == "be") & (city == "Belgium"), "Belgium")
        .when((last == "at") & (city == "Austria"), "Austria")
        .when((last == "se") & (city == "Sweden"), "Sweden")
        .when((last == "no") & (city == "Norway"), "Norway")
    )
    region = first(
        F.transform(
            parts,
            lambda p: F.when(p.isin(US_STATES) | p.isin(US_CODES), "USA")
            .when(p.isin(CA_PROVINCES) | (p.isin(CA_CODES) & ~p.isin(CA_CLASHES)), "Canada")
            .when(p.isin(AU_STATES), "Australia")
            .when(p.isin(IN_STATES), "India")
            .when(p.isin(DE_STATES), "Germany")
            .when(p.isin(BR_STATES) & (F.length(p) > 2), "Brazil")
            .when(p.isin(UK_REGIONS), "United Kingdom"),
        )
    )
    late = first(F.transform(parts, lambda p: F.when(p.isin(CA_CODES), "Canada").when(p.isin(BR_STATES), "Brazil")))
    long_names = sorted((n for n in places.countries if len(n) >= 5), key=lambda n: (-len(n), n))
    quoted = "|".join(n.replace("\\", "").replace("(", "\\(").replace(")", "\\)").replace(".", "\\.").replace("&", "\\&") for n in long_names)
    within = by_name(F.regexp_extract(low, rf"(?<![a-z])({quoted})(?![a-z])", 1))
    loose = F.filter(F.split(F.regexp_replace(low, r"[(),;|]", " "), r"[\s\-_/]+"), lambda t: t != "")
    coded = F.when((F.size(loose) >= 2) & F.try_element_at(loose, F.lit(-1)).isin(US_CODES), "USA")
    words = first(
        F.transform(
            F.reverse(loose),
            lambda t: F.when(t.isin(US_STATES), F.lit("USA")).when((F.length(t) >= 5) & by_city(t).isNotNull(), by_city(t)).when(t.isin(DE_STATES), "Germany").when(t.isin(IN_STATES), "India").when(t.isin(CA_PROVINCES), "Canada").when(t.isin(AU_STATES), "Australia"),
        )
    )
    numbered = F.when(low.rlike(r"\bus\d{5,}\b"), "USA")
    found = F.coalesce(by_name(plain(low)), explicit, confirmed, region, first(F.transform(parts, by_city)), late, within, coded, words, numbered, F.lit(""))
    return F.when(text == "", "").otherwise(found)
