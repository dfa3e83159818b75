"""Numbers, money, experience and dates, as canonical strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V
from .rules import FLAGS, let
from .text import clean_text


def _plain(number: Column) -> Column:
    """A double as text: integers without a fraction."""
    whole = number == F.floor(number)
    return F.when(number.isNull(), "").when(whole & (F.abs(number) < 1e18), number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))


def parse_decimal(text: Column) -> Column:
    """The first number of a text: commas that set off three digits group, as does a lone point before three."""

    def read(found: Column) -> Column:
        commas, point = found.contains(","), found.contains(".")
        number = (
            F.when(commas & point, F.replace(found, F.lit(","), F.lit("")))
            .when(commas & found.rlike(r"^-?\d*(?:,\d{3})*$"), F.replace(found, F.lit(","), F.lit("")))
            .when(commas, F.replace(found, F.lit(","), F.lit(".")))
            .when(found.rlike(r"^-?\d+\.\d{3}$"), F.replace(found, F.lit("."), F.lit("")))
            .otherwise(found)
        )
        return let(number.try_cast("double"), _plain)

    return let(F.regexp_extract(clean_text(text, 50), r"-?\d[\d,]*\.?\d*", 0), read)


def currency(text: Column) -> Column:
    """The first known code that occurs anywhere in a text, in order of the list; else by symbol."""
    t = clean_text(text, 500)
    chain = F
    for code in V.CURRENCIES:
        chain = chain.when(F.upper(t).contains(code), F.lit(code))
    symbol = F.regexp_extract(t, "[€$£¥₹]", 0)
    for sign, code in V.SYMBOLS.items():
        chain = chain.when(symbol == sign, F.lit(code))
    return chain.otherwise("")


def salary_breakdown(text: Column) -> Column:
    """A struct (salary, min_salary, max_salary): the first two numbers of a text."""

    def read(v: Column) -> Column:
        found, t = v["found"], v["t"]
        zero = (F.size(found) > 0) & F.forall(found, lambda x: x.cast("double") <= 0)
        low, high = F.coalesce(F.get(found, 0), F.lit("")), F.coalesce(F.get(found, 1), F.lit(""))
        pair = (low != "") & (high != "") & (low != high)
        shown = F.when(zero, "").when(pair, F.concat(low, F.lit(" - "), high)).when(low != "", low).otherwise(t)
        return F.struct(shown.alias("salary"), F.when(zero, "").otherwise(low).alias("min_salary"), F.when(~zero & pair, high).otherwise("").alias("max_salary"))

    numbers = lambda t: F.filter(F.transform(F.regexp_extract_all(t, F.lit(r"\d[\d,.]*"), F.lit(0)), parse_decimal), lambda x: x != "")
    return let(let(clean_text(text, 200), lambda t: F.struct(t.alias("t"), numbers(t).alias("found"))), read)


def salary_evidence(text: Column) -> Column:
    """From the first word of pay that has an amount within 350 characters, up to the end of the amount's sentence."""
    t = F.coalesce(text, F.lit(""))
    # the tails that begin at a word of pay, each cut to its window
    marked = F.split(F.regexp_replace(t, rf"{FLAGS}(?={V.SALARY_WORD})", "\x01"), "\x01")
    n = F.size(marked)
    tails = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(i < n, F.substring(F.array_join(F.slice(marked, i + 1, F.lit(12)), ""), 1, 350)))
    windows = F.transform(tails, lambda x: clean_text(x, 350))
    good = F.filter(windows, lambda x: x.rlike(FLAGS + V.SALARY_AMOUNT))
    window = F.get(good, 0)
    cut = F.regexp_extract(window, rf"{FLAGS}^(.*?{V.SALARY_AMOUNT}.*?[.!?](?=\s|$))", 1)
    return F.trim(F.coalesce(F.when(cut != "", cut), window, F.lit("")))


def salary_range(text: Column) -> Column:
    """A range with a currency, else a rate per period, in the first 20,000 characters."""
    t = F.substring(F.coalesce(text, F.lit("")), 1, 20000)
    found = F.regexp_extract(t, FLAGS + V.SALARY_RANGE, 0)
    return clean_text(F.when(found != "", found).otherwise(F.regexp_extract(t, FLAGS + V.SALARY_RATE, 0)), 120)


def experience_range(text: Column) -> Column:
    """A struct (min, max) of stated years; a range that makes no sense leaves it to a single number."""
    t = clean_text(text, 500)
    low, high = (F.regexp_extract(t, FLAGS + V.YEARS_RANGE, i).try_cast("int") for i in (1, 2))
    one = F.coalesce(F.regexp_extract(t, FLAGS + V.YEARS_LEAST, 1).try_cast("int"), F.regexp_extract(t, FLAGS + V.YEARS_LEAST, 2).try_cast("int"))
    pair = F.coalesce((low <= high) & (high <= 80), F.lit(False))
    least = F.when(pair, low).when(one <= 80, one)
    return F.struct(F.coalesce(least.cast("string"), F.lit("")).alias("min"), F.when(pair, high.cast("string")).otherwise("").alias("max"))


def _positive(value: Column) -> Column:
    number = F.trim(value.cast("string")).try_cast("double")
    return F.when(number > 0, number)


def _general(number: Column) -> Column:
    """Six significant digits, no trailing zeros."""
    text = F.format_string("%.6g", number)
    return F.when(text.contains("e"), text).otherwise(F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def experience_text(low: Column, high: Column) -> Column:
    """ "n Years": the mean of both bounds where they make sense, else the one that is positive."""
    a, b = _positive(low), _positive(high)
    value = F.when(b >= a, (a + b) / 2).otherwise(F.coalesce(a, b))
    return F.when(value.isNull(), "").when(value == F.floor(value), F.concat(value.cast("bigint").cast("string"), F.lit(" Years"))).otherwise(F.concat(_general(value), F.lit(" Years")))


def openings_bucket(n: Column) -> Column:
    v = F.floor(n.try_cast("double")).cast("bigint")
    step = lambda k: F.concat((F.floor(v / k) * k).cast("string"), F.lit("+"))
    return F.when(v.isNull(), "").when(v >= 2000, "2000+").when(v >= 1000, "1000+").when(v >= 100, step(100)).when(v >= 10, step(5)).otherwise(v.cast("string"))


def usd_salary(salary: Column, low: Column, high: Column, code: Column) -> Column:
    """A struct (text, lo, hi) of pay in US dollars; blank for other currencies."""
    c = F.upper(F.trim(F.coalesce(code, F.lit(""))))
    s = F.coalesce(salary, F.lit(""))
    dollars = c.isin("USD", "US$", "$") | ((c == "") & s.contains("$") & ~s.rlike(r"(?:A|C|S|NZ|HK|R|MX)\$"))
    a, b = (_positive(F.replace(x.cast("string"), F.lit(","), F.lit(""))) for x in (low, high))
    lo, hi = F.when(dollars, F.coalesce(a, b)), F.when(dollars, F.coalesce(b, a))
    shown = lambda v: F.when(v == F.floor(v), v.cast("bigint").cast("string")).otherwise(F.format_string("%.2f", v))
    return F.struct(F.when(lo.isNull(), "").otherwise(F.concat(F.lit("$"), shown(lo), F.lit(" - $"), shown(hi))).alias("text"), lo.alias("lo"), hi.alias("hi"))


def to_int(value: Column) -> Column:
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))


def row_id(*columns: Column) -> Column:
    """SHA-256 over values joined by the unit separator; nulls are empty."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256)


def duration(seconds: Column) -> Column:
    """Days and hours, hours and minutes, or minutes."""
    s = F.floor(seconds).cast("bigint")
    d, h, m = F.floor(s / 86400), F.floor(F.pmod(s, F.lit(86400)) / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    text = lambda a, x, b, y: F.concat(a.cast("string"), F.lit(x), b.cast("string"), F.lit(y))
    return F.when(d > 0, text(d, "d ", h, "h")).when(h > 0, text(h, "h ", m, "m")).otherwise(F.concat(m.cast("string"), F.lit("m")))


def parse_date(text: Column, as_of: Column) -> Column:
    """An ISO date from many forms, else the empty string; relative forms count back from as_of."""
    return let(clean_text(text, 200), lambda t: _date(t, as_of))


def _date(t: Column, as_of: Column) -> Column:
    low = F.lower(t)
    back = lambda days: F.date_format(F.date_sub(as_of.cast("date"), days), "yyyy-MM-dd")
    unit = r"\s*\+?\s*(minute|hour|day|week|month|year)s?"
    ago, posted = rf"(\d+){unit}\s*ago", rf"posted\s+(\d+){unit}"
    amount = F.when(low.rlike(ago), F.regexp_extract(low, ago, 1)).otherwise(F.regexp_extract(low, posted, 1)).try_cast("int")
    kind = F.when(low.rlike(ago), F.regexp_extract(low, ago, 2)).otherwise(F.regexp_extract(low, posted, 2))
    days = amount * F.when(kind == "day", 1).when(kind == "week", 7).when(kind == "month", 30).when(kind == "year", 365).otherwise(0)
    iso = F.regexp_extract(t, r"\d{4}-\d{2}-\d{2}", 0)
    part = lambda p, i: F.regexp_extract(t, p, i)
    joined = lambda y, m, d: F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    day_first, month_first = r"(\d{1,2})[/.](\d{1,2})[/.](\d{4})", r"(\d{1,2})-(\d{1,2})-(\d{4})"
    named, stamped = r"([A-Za-z]{3,9})\s+(\d{1,2}),?\s+(\d{4})", r"([A-Za-z]{3})\s+(\d{1,2})\s+\d{1,2}:\d{2}:\d{2}\s+[A-Z]{2,4}\s+(\d{4})"
    months = F.array(*map(F.lit, V.MONTHS))
    month = lambda p: F.array_position(months, F.lower(F.substring(part(p, 1), 1, 3))).cast("string")
    return (
        F.when(t == "", "")
        .when(low.rlike(r"\b(today|just posted|posted today)\b"), back(F.lit(0)))
        .when(low.contains("yesterday"), back(F.lit(1)))
        .when(days.isNotNull(), back(days))
        .when(iso != "", iso)
        .when(t.rlike(day_first), joined(part(day_first, 3), part(day_first, 2), part(day_first, 1)))
        .when(t.rlike(month_first), joined(part(month_first, 3), part(month_first, 1), part(month_first, 2)))
        .when(t.rlike(named) & (month(named) != "0"), joined(part(named, 3), month(named), part(named, 2)))
        .when(t.rlike(stamped) & (month(stamped) != "0"), joined(part(stamped, 3), month(stamped), part(stamped, 2)))
        .otherwise("")
    )


def epoch_date(value: Column) -> Column:
    """An ISO date from epoch seconds, or milliseconds where larger than 1e11; in UTC."""
    seconds = F.when(value > 1e11, value / 1000).otherwise(value)
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"), F.lit(""))


def yyyymmdd(value: Column) -> Column:
    v = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    dashed = F.regexp_replace(F.regexp_extract(v, r"^\d{4}-\d{2}-\d{2}", 0), "-", "")
    return F.coalesce(dashed.try_cast("int"), F.regexp_extract(v, r"^(\d{8})$", 1).try_cast("int"))
