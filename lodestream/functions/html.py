"""One reading of a page: everything that extraction and evidence need, as one struct.

A page is parsed once, by the standard library's parser in an Arrow-batched function, and
later steps are Columns over the struct.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

PAGE = (
    "title string, h1 array<string>, headings array<string>, metas map<string,string>, links array<struct<text:string,href:string>>, sources array<string>, items array<map<string,string>>,"
    " tables array<array<array<string>>>, ld_json array<string>, text string, lines string, scripts int, forms int, app_root boolean, main_links array<struct<text:string,href:string>>, boxes array<struct<title:string,text:string>>"
)
#: Pages whose structs a task holds at once, at most, and bytes of html after which it holds no more.
HELD_PAGES, HELD_BYTES = 64, 1 << 20
_BLOCK = frozenset("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th thead tr ul".split())
_HIDDEN = frozenset(("script", "style", "noscript", "template"))
_HEADED = frozenset("title h1 h2 h3 h4 h5 strong b td th".split())
_BOX = re.compile("job|position|vacancy|career|opening", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.h1, self.headings, self.metas, self.links, self.sources = "", [], [], {}, [], []
        self.tables, self.ld, self.items, self.main_links = [], [], [], []
        self.pieces: list[str] = []
        self.scripts = self.forms = self.main = 0
        self.app_root = False
        self.hidden: str | None = None
        self.ld_open = False
        self.open: list[list] = []  # [tag, pieces] of titles, headings, cells and links that are being read
        self.href: list[str] = []
        self.scopes: list[list] = []  # [depth, properties] of open item scopes
        self.boxes: list[tuple] = []
        self.box: list[list] = []  # [depth, pieces, title] of open containers whose class speaks of jobs
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag not in _VOID:
            self.depth += 1
        if tag in _BLOCK:
            self.pieces.append("\n")
        if tag == "script":
            self.scripts += 1
            self.ld_open = "ld+json" in a.get("type", "").lower()
            if self.ld_open:
                self.ld.append("")
        if tag in _HIDDEN:
            self.hidden = tag
        if tag == "form":
            self.forms += 1
        if tag in ("main", "article"):
            self.main += 1
        if a.get("id", "").lower() in ("root", "app", "__next", "__nuxt"):
            self.app_root = True
        if tag == "meta" and (a.get("property") or a.get("name")):
            self.metas.setdefault((a.get("property") or a["name"]).lower(), a.get("content", ""))
        for name in ("src", "data-src", "action"):
            if tag in ("iframe", "script", "embed", "form") and a.get(name):
                self.sources.append(a[name])
        if "itemscope" in a:
            self.scopes.append([self.depth, {"@type": a.get("itemtype", "")}])
        if tag in ("div", "li", "tr", "section", "article") and _BOX.search(a.get("class", "")):
            self.box.append([self.depth, [], ""])
        if tag in _HEADED:
            self.open.append([tag, []])
        if tag == "a" and a.get("href"):
            self.href.append(a["href"])
            self.open.append(["a", []])
        if "itemprop" in a and self.scopes:
            value = a.get("content") or a.get("datetime") or (a.get("href") if tag in ("a", "link") else None)
            if value:
                self.scopes[-1][1].setdefault(a["itemprop"], value)
            elif "itemscope" not in a:
                self.open.append(["@" + tag + "\0" + a["itemprop"], []])
        if tag == "table":
            self.tables.append([])
        if tag == "tr" and self.tables:
            self.tables[-1].append([])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.pieces.append("\n")
        if tag in ("main", "article"):
            self.main = max(0, self.main - 1)
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name == tag or name.startswith(f"@{tag}\0"):
                text = " ".join("".join(self.open.pop(i)[1]).split())
                self._read(name, text)
                if name == tag:
                    break
        if tag == self.hidden:
            self.hidden, self.ld_open = None, False
        while self.scopes and self.scopes[-1][0] >= self.depth and tag not in _VOID:
            self._close_scope()
        while self.box and self.box[-1][0] >= self.depth and tag not in _VOID:
            _, pieces, title = self.box.pop()
            self.boxes.append((title, " ".join("".join(pieces).split())))
        if tag not in _VOID:
            self.depth = max(0, self.depth - 1)

    def _close_scope(self):
        _, item = self.scopes.pop()
        if self.scopes and "JobPosting" not in item["@type"]:
            kind = item["@type"].rsplit("/", 1)[-1].lower()
            for k, v in item.items():
                self.scopes[-1][1].setdefault(f"{kind}.{k}", v)
        else:
            self.items.append(item)

    def _read(self, name, text):
        if name in _HEADED and self.box and not self.box[-1][2]:
            self.box[-1][2] = text
        if name == "title":
            self.title = self.title or text
        elif name in ("h1", "h2", "h3"):
            self.headings.append(text)
            if name == "h1":
                self.h1.append(text)
        elif name in ("td", "th"):
            if self.tables and self.tables[-1]:
                self.tables[-1][-1].append(text)
        elif name == "a":
            link = (text, self.href.pop() if self.href else "")
            self.links.append(link)
            if self.main:
                self.main_links.append(link)
        elif self.scopes:
            self.scopes[-1][1].setdefault(name.split("\0")[1], text)

    def handle_data(self, data):
        if self.ld_open:
            self.ld[-1] += data
        if self.hidden:
            return
        if not any(o[0] == "title" for o in self.open):
            self.pieces.append(data)
        for o in (*self.open, *self.box):
            o[1].append(data)


def read_page(html: str | None) -> dict:
    """What a page holds, as a dict with the fields of ``PAGE``."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    while reader.scopes:
        reader._close_scope()
    lines = "\n".join(x for x in (re.sub(r"[ \t\r\f\v\xa0]+", " ", line).strip() for line in "".join(reader.pieces).split("\n")) if x)
    pairs = lambda links: [{"text": t, "href": h} for t, h in links]
    return {
        "title": reader.title, "h1": reader.h1, "headings": reader.headings, "metas": reader.metas, "links": pairs(reader.links), "sources": reader.sources, "items": reader.items, "tables": reader.tables, "ld_json": reader.ld,
        "text": " ".join(lines.split()), "lines": lines, "scripts": reader.scripts, "forms": reader.forms, "app_root": reader.app_root, "main_links": pairs(reader.main_links),
        "boxes": [{"title": t, "text": x} for t, x in reader.boxes],
    }


def page(html: Column, *fields: str) -> Column:
    """The struct of a page, or some fields of it; of a null page, the empty one.

    Structs are made and sent a few at a time, whatever the size of the batch that the
    pages come in, so memory doesn't grow with it.
    """
    whole = StructType.fromDDL(PAGE)
    kept = StructType([f for f in whole if f.name in fields or not fields])

    @F.arrow_udf(kept)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from _structs(batch, kept)

    return read(html)


def _structs(pages: pa.Array, kept: StructType) -> Iterator[pa.Array]:
    """The structs of pages in arrays of a bounded size."""
    kind, names = to_arrow_type(kept), kept.names

    held, size = [], 0
    for html in pages:
        found = read_page(html.as_py())
        held.append({n: list(found[n].items()) if n == "metas" else [list(x.items()) for x in found[n]] if n == "items" else found[n] for n in names})
        size += len(html.as_buffer()) if html.is_valid else 0
        if len(held) >= HELD_PAGES or size >= HELD_BYTES:
            yield pa.array(held, kind)
            held, size = [], 0
    if held or not len(pages):
        yield pa.array(held, kind)


def plain_text(html: Column) -> Column:
    """Text of a fragment, a line per block; entities that were escaped twice are decoded twice."""

    @F.pandas_udf("string")
    def read(values: pd.Series) -> pd.Series:
        return values.map(lambda v: re.sub(r"<[^>]{1,200}>", "", read_page(unescape(v or ""))["lines"]))

    return read(html)


def is_script_shell(p: Column) -> Column:
    """Whether a page shows next to nothing until its scripts run."""
    n = F.length(p["text"])
    return ((n < 200) & (p["scripts"] > 0)) | (p["app_root"] & (n < 500) & (F.size(p["links"]) == 0))


def board_signals(html: Column, p: Column) -> Column:
    """Points for signs of a job board: structured postings, many posting links, headings with a call to apply."""
    ld = F.size(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'"@type"\s*:\s*"JobPosting"'), F.lit(0)))
    micro = F.regexp_count(F.coalesce(html, F.lit("")), F.lit(r"itemtype=\"[^\"]*JobPosting"))
    posts = F.size(F.filter(p["links"], lambda a: a["href"].rlike(r"(?i)/(?:jobs?|positions?|vacanc\w*|openings?|stellen|careers?|o|j)/[^/?#]*[\w-]{4,}")))
    boxes = F.regexp_count(F.coalesce(html, F.lit("")), F.lit(r"(?i)class=\"[^\"]*\b(?:job|position|vacancy|opening|posting)"))
    heading = F.exists(p["headings"], lambda h: h.rlike(r"(?i)\b(?:jobs?|careers?|openings?|vacancies|positions?|karriere|stellen)\b")) & F.lower(p["text"]).rlike(r"\b(?:apply|bewerben|postuler|solicitar)")
    one = lambda test, n=1: F.when(test, n).otherwise(0)
    score = one(ld >= 2, 2) + one(micro >= 2, 2) + one(posts >= 3) + one(posts >= 8) + one(boxes >= 4) + one(heading)
    return F.when(F.length(html) < 400, 0).otherwise(score)


def is_career_page(url: Column, p: Column, home: Column, vendor: Column, same_domain: Column) -> Column:
    """A page of the site itself or of a vendor's board that speaks of careers and is no error page."""
    missing = F.concat_ws(" ", p["title"], F.array_join(p["h1"], " ")).rlike(r"(?i)\b404\b|not found|page introuvable|nicht gefunden")
    spoken = F.exists(F.concat(F.array(p["title"]), p["headings"]), lambda t: t.rlike(r"(?i)career|jobs?\b|vacanc|karriere|stellen|emploi|empleo"))
    posting = F.exists(p["ld_json"], lambda t: t.contains("JobPosting"))
    link = F.exists(p["main_links"], lambda a: a["href"].rlike(r"(?i)/(?:jobs?|positions?|vacanc)"))
    return ~missing & (same_domain | (vendor != "")) & ((vendor != "") | spoken | posting | link)
