"""The rule compiler: ordered (label, pattern) tables become one CASE over a text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Case-insensitive, with Unicode classes: what the rule tables assume.
FLAGS = "(?iuU)"
#: Case-insensitive, with words and white space of ASCII only: how DuckDB's SQL reads the rule tables.
SQL_FLAGS = "(?iu)"


def matches(text: Column, pattern: str, flags: str = FLAGS) -> Column:
    """Whether a pattern occurs in a text; false for null."""
    return F.coalesce(F.regexp_like(text, F.lit(flags + pattern)), F.lit(False))


def _for_sql(pattern: str, small: bool) -> str:
    r"""A pattern that finds here what the given one finds in SQL: \b and \s know ASCII only, and a dot is all but a line feed.

    For texts in small letters, none of which folds to ASCII, a word that begins with a
    plain letter needs a look behind it only.
    """
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        i += len(c)
        if c == r"\s":
            c = r"\t\n\f\r " if inside else r"[\t\n\f\r ]"
        elif c == r"\b":
            plain = small and re.match(r"[A-Za-z0-9](?![?*{])", pattern[i:])
            c = r"(?<!\w)" if plain else r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
        elif c == "." and not inside:
            c = r"[^\n]"
        elif small and not c.isascii():
            c = c.lower()
        inside = c == "[" or (inside and c != "]")
        out.append(c)
    return "".join(out)


def _alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between its outermost bars."""
    parts, depth, at, i = [], 0, 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        elif c == "|" and not depth:
            parts.append(pattern[at:i])
            at = i + 1
        i += 1
    return [*parts, pattern[at:]]


def leads(pattern: str) -> list[str] | None:
    """What a match of a pattern must begin with, at the start of a word, in small letters; none if a part doesn't say."""
    found = []
    for part in _alternatives(pattern):
        lead = re.match(r"\\b([^\W_]+)(?=(.?))", part)
        lead = lead and (lead[1][:-1] if lead[2] in ("?", "*", "{") and lead[2] else lead[1])
        if not lead:
            return None
        found.append(lead.lower())
    return found


def _folded(text: Column) -> Column:
    """Small letters, also of the three characters that match a letter of a pattern in any case but are no capitals of it."""
    return F.lower(F.translate(text, "\u0130\u017f\u212a", "isk"))


def first_match(text: Column, table: Iterable[tuple[str, str]], default: str = "", flags: str = FLAGS) -> Column:
    """The label of the first rule whose pattern occurs in a text, else default.

    One pass over the text finds which of the rules' first letters occur at the start of
    a word; a rule is tried only if one of its own does.  With ``SQL_FLAGS`` labels are
    those of SQL, where letters beyond ASCII end words.
    """
    table = list(table)
    if flags == SQL_FLAGS:
        return _first_in_sql(text, table, default)
    known = [leads(p) for _, p in table] if "i" in flags else [None] * len(table)
    guard = _Guard(known)
    if not guard.leads:
        return _first_of(text, table, default, flags, lambda _: None)
    hits = F.regexp_extract_all(F.coalesce(_folded(text), F.lit("")), F.lit(rf"(?U)\b({guard.pattern})"), F.lit(1))
    return let(F.array_distinct(hits), lambda found: guard.chosen(found, text, table, default, flags))


class _Guard:
    """What rules' matches must begin with; a lead that begins with another stands for it, so no two begin at the same place."""

    def __init__(self, known: list[list[str] | None]):
        every = sorted({x for ls in known for x in ls or ()})
        short = [x for x in every if not any(x != y and x.startswith(y) for y in every)]
        self.known, self.leads = known, short if len(short) >= 4 else []
        self.pattern = "|".join(f"{c}(?:{'|'.join(x[1:] for x in short if x[0] == c)})" for c in sorted({x[0] for x in short}))
        self.begin = {x: next(y for y in short if x.startswith(y)) for x in every}

    def chosen(self, hits: Column, text: Column, table: list[tuple[str, str]], default: str, flags: str) -> Column:
        def here(i: int) -> Column | None:
            ls = self.known[i]
            return None if ls is None else F.arrays_overlap(hits, F.array(*(F.lit(x) for x in sorted({self.begin[y] for y in ls}))))

        rest = [r for r, k in zip(table, self.known, strict=True) if k is None]
        return F.when(F.size(hits) == 0, _first_of(text, rest, default, flags, lambda _: None)).otherwise(_first_of(text, table, default, flags, here))


def _first_in_sql(text: Column, table: list[tuple[str, str]], default: str) -> Column:
    """The label that SQL gives: most texts match no rule, which one pass over the text in small letters finds out."""
    text = F.replace(text, F.lit("\u0130"), F.lit("\u00b7"))  # in SQL it is no capital of i, and no part of a word
    known = [ls if ls and all(x[0].isascii() for x in ls) else None for ls in (leads(p) for _, p in table)]
    guard, small = _Guard(known), [(label, _for_sql(p, True)) for label, p in table]

    def label(low: Column) -> Column:
        if not guard.leads:
            return _first_of(low, small, default, "(?i)", lambda _: None)
        parts = [x for (_, p), ls in zip(table, known, strict=True) if ls for x in _alternatives(p)]
        letters = sorted({x[2].lower() for x in parts})
        begun = "|".join(f"{c}(?:{'|'.join(_for_sql(x[3:], True) for x in parts if x[2].lower() == c)})" for c in letters)
        every = rf"(?<!\w)(?=[{''.join(letters)}])(?:{begun})"
        every = "|".join([every, *(p for (_, p), ls in zip(small, known, strict=True) if not ls)])
        hits = F.regexp_extract_all(low, F.lit(rf"(?<!\w)(?=({guard.pattern}))"), F.lit(1))
        return F.when(matches(low, every, "(?i)"), let(F.array_distinct(hits), lambda found: guard.chosen(found, low, small, default, "(?i)"))).otherwise(F.lit(default))

    # two letters fold to ASCII but are no part of a word, so a match may begin or end beside them: such texts are read as they are
    plain = [(name, _for_sql(p, False)) for name, p in table]
    odd = _first_of(F.replace(text, F.lit("\u0131"), F.lit("\u00b7")), plain, default, SQL_FLAGS, lambda _: None)
    return F.when(text.rlike("[\u017f\u212a]"), odd).otherwise(let(F.coalesce(F.lower(text), F.lit("")), label))


def _first_of(text: Column, table: list[tuple[str, str]], default: str, flags: str, guard) -> Column:
    chain = None
    for i, (label, pattern) in enumerate(table):
        test, first = matches(text, pattern, flags), guard(i)
        test = test if first is None else first & test
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def first_contained(text: Column, table: Iterable[tuple[str, str]], default: Column) -> Column:
    """The label of the first key that a text contains, else default."""
    chain = None
    for key, label in table:
        test = text.contains(key)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain.otherwise(default)


def filled(*choices: Column) -> Column:
    """The first choice that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in choices), F.lit(""))


def let(value: Column, body) -> Column:
    """body of a value that is computed once a row, however often body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), 0)
