"""Main-text extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks (runs of text between block-level tags) with the tags and
the class words of their ancestors.  A chain over the blocks of a page, with features of
ancestors and of text, is trained on labelled pages by gradient steps on its exact
likelihood; Viterbi decodes the blocks of a page that are its article.  Training is on
the driver over a bounded set of labelled pages; pages are then read in Arrow batches,
each in one pass over its whole html.

Defined cases: a null or empty html has no blocks and an empty text; cut-off pages,
unclosed tags and stray end tags are read as browsers do, near enough; pages that repeat
are extracted each; an empty table gives no rows; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is never text of the page.
_RAW = frozenset("script style template noscript iframe svg canvas audio video head title textarea".split())
#: Those of them that browsers read to the end of the page where the end tag is missing.
_TO_THE_END = frozenset("script style iframe title textarea".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mfrac mi mn mo mrow ms msqrt msub msup mtext semantics".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_ALIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th")}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",)}

#: Words in a class, an id or a role, by the kind of block that they speak of.
_KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs skip",
    "head": "header masthead banner logo topbar branding",
    "foot": "footer copyright colophon legal contentinfo bottom imprint",
    "side": "sidebar side aside widget related recommended recommendations trending popular complementary more rail teaser",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp outbrain taboola",
    "notice": "cookie cookies consent notice gdpr newsletter subscribe subscription popup modal overlay alert paywall signup disclaimer",
    "remark": "comment comments commentlist reply replies respond discussion disqus reactions",
    "form": "form search searchform login register input",
    "share": "share sharing social follow buttons toolbar tools meta tags tag byline",
    "text": "article content post entry story main maincontent body text page prose hentry articlebody",
}
_KIND_OF = {word: kind for kind, words in _KINDS.items() for word in words.split()}
_HINTS = {
    "h:legal": re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved|privacy policy|terms of|impressum|datenschutz|mentions légales|aviso legal", re.I),
    "h:cookie": re.compile(r"\bcookies?\b|\bconsent\b|we use|nous utilisons|wir verwenden|utilizamos", re.I),
    "h:call": re.compile(r"subscribe|sign up|log ?in|newsletter|follow us|share|abonn|anmelden|s'inscrire|suscr[ií]b|read more|click here|buy now|advertisement|sponsored", re.I),
    "h:reply": re.compile(r"\breply\b|\bcomments?\b|antworten|répondre|responder|\bwrote\b|\bsays:", re.I),
}


class _Element:
    __slots__ = ("tag", "block", "features")

    def __init__(self, tag: str, block: str, features: frozenset):
        self.tag, self.block, self.features = tag, block, features


_STATES: dict[tuple, frozenset] = {}


def _inherit(parent: frozenset, tag: str, attributes: str) -> frozenset:
    """The features that an element hands to the blocks below it; kept, as pages share templates."""
    key = (parent, tag, attributes)
    found = _STATES.get(key)
    if found is None:
        own = {f"a:{tag}"}
        if tag in ("header", "footer") and ("a:article" in parent or "k:text" in parent):
            own = {f"a:inner-{tag}"}
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id", "role"):
                for word in re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value)):
                    if word in _KIND_OF:
                        own.add(f"k:{_KIND_OF[word]}")
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                own.add("k:hidden")
        found = parent | own
        if len(_STATES) > 20_000:
            _STATES.clear()
        _STATES[key] = found
    return found


def blocks(page: str) -> Iterator[tuple[frozenset, str, str, int]]:
    """(features of ancestors, nearest block tag, text, characters in links) of each leaf block, in page order."""
    root = _Element("html", "body", frozenset())
    stack, text, linked, in_link = [root], [], 0, 0
    at, end, match = 0, len(page), _TOKEN.match

    def flush():
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            n, linked = linked, 0
            if joined:
                top = stack[-1]
                return top.features, top.block, joined, n
        linked = 0
        return None

    def close(upto: int):
        nonlocal in_link
        for e in stack[upto:]:
            in_link -= e.tag == "a"
        del stack[upto:]

    while at < end:
        m = match(page, at)
        at = m.end()
        token = m[0]
        if token[0] != "<" or token == "<":
            piece = entities.unescape(token) if "&" in token else token
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
            continue
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), bool(m[1] or m[4])
        if tag in _RAW and not closing:
            if token.endswith("/>") and tag == "svg":
                continue
            if tag == "head":  # its text elements are raw themselves; it ends where the body starts
                continue
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end if tag in _TO_THE_END else at
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in _VOID and tag != "hr":
            continue
        inline = tag in _INLINE
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if not inline and (found := flush()):
                        yield found
                    close(i)
                    break
                if inline and stack[i].tag not in _INLINE:
                    break
            continue
        if not inline:
            if found := flush():
                yield found
            if tag in _CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag not in _INLINE:
                        break
            if tag in _ALIKE:
                deepest = None
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in _SCOPES[tag]:
                        break
                    if stack[i].tag in _ALIKE[tag]:
                        deepest = i
                if deepest:
                    close(deepest)
            if tag == "hr":
                continue
        top = stack[-1]
        if inline:
            features, block = top.features, top.block
        else:
            features, block = _inherit(top.features, tag, m[3] or m[6] or ""), tag
        if tag in ("html", "body"):
            features, block = top.features, "body"
        stack.append(_Element(tag, block, features))
        in_link += tag == "a"
    if found := flush():
        yield found


def _text_features(block: str, text: str, linked: int, first: bool) -> list[str]:
    n, words = len(text), text.count(" ") + 1
    out = [f"t:{block}", f"w:{min(words, 200).bit_length()}", f"l:{min(4, int(5 * linked / n))}"]
    if text[-1] in ".!?…:;\"”»)":
        out.append("e:stop")
    if first:
        out.append("p:first")
    if n < 400:
        out += [name for name, pattern in _HINTS.items() if pattern.search(text)]
    if words > 12 and linked * 4 < n:
        out.append("s:prose")
    return out


def features(page: str) -> tuple[list[str], list[list[str]]]:
    """The texts of the blocks of a page, and the features of each."""
    texts, rows = [], []
    for inherited, block, text, linked in blocks(page):
        rows.append([*inherited, *_text_features(block, text, linked, not rows)])
        texts.append(text)
    return texts, rows


class Chain:
    """A trained chain: a weight per feature, four weights of transitions, one of the start."""

    def __init__(self, weights: dict[str, float], moves: list[list[float]], start: float):
        self.weights, self.moves, self.start = weights, moves, start

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """Viterbi: the likeliest labels of the blocks of one page."""
        (a, b), (c, d) = self.moves
        no, yes, back, get = 0.0, self.start, [], self.weights.get
        for i, row in enumerate(rows):
            score = 0.0
            for name in row:
                score += get(name, 0.0)
            if i:
                from_no, from_yes = no + a >= yes + c, no + b >= yes + d
                no, yes = (no + a if from_no else yes + c), (no + b if from_yes else yes + d)
                back.append((from_no, from_yes))
            yes += score
        label = yes > no
        out = [label]
        for from_no, from_yes in reversed(back):
            label = not (from_yes if label else from_no)
            out.append(label)
        return out[::-1] if rows else []


def train(pages: list[tuple[list[list[str]], list[bool]]], rounds: int = 250, rate: float = 0.15, ridge: float = 1e-3) -> Chain:
    """Weights that maximise the penalised likelihood of labelled pages, by forward-backward and Adam."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for rows, _ in pages for row in rows for f in row})
    at, n, longest = {f: i for i, f in enumerate(names)}, len(pages), max(len(r) for r, _ in pages)
    design = np.zeros((n, longest, len(names)), np.float32)
    y, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (rows, labels) in enumerate(pages):
        mask[i, : len(rows)] = True
        y[i, : len(rows)] = labels
        for j, row in enumerate(rows):
            for f in row:
                design[i, j, at[f]] += 1
    flat = design.reshape(-1, len(names))
    theta = np.zeros(len(names) + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    pair = mask[:, 1:]
    for step in range(1, rounds + 1):
        emit = (flat @ theta[:-5].astype(np.float32)).reshape(n, longest).astype(float)
        moves, start = theta[-5:-1].reshape(2, 2), theta[-1]
        score = np.stack([np.zeros_like(emit), emit], -1)
        score[:, 0, 1] += start
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(alpha[:, t - 1, 0, None] + moves[0], alpha[:, t - 1, 1, None] + moves[1]) + score[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            ahead = score[:, t + 1] + beta[:, t + 1]
            new = np.logaddexp(ahead[:, 0, None] + moves[:, 0], ahead[:, 1, None] + moves[:, 1])
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        likely = np.exp(alpha[..., 1] + beta[..., 1] - total[:, None]) * mask
        off = ((y - likely) * mask).astype(np.float32)
        grad = np.zeros_like(theta)
        grad[:-5] = off.reshape(-1) @ flat
        grad[-1] = off[:, 0].sum()
        joint = alpha[:, :-1, :, None] + moves + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(joint, 0)) * pair[..., None, None]).sum((0, 1))
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][pair], y[:, 1:][pair]), 1)
        grad[-5:-1] = (seen - expected).ravel()
        grad = grad / n - ridge * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    kept = {f: round(float(theta[i]), 5) for f, i in at.items()}
    return Chain(kept, [[float(v) for v in row] for row in theta[-5:-1].reshape(2, 2)], float(theta[-1]))


#: Marks text of the article in labelled pages.
MARK = "\x01"


def labelled_pages(n: int = 360, seed: int = 5) -> list[str]:
    """Pages whose article text carries MARK: many layouts, four made-up languages."""
    r = random.Random(seed)
    tongues = ["an en er th the ing ion re he of st ed ti".split(), "eau ou le de la que en é tion ment è".split(), "en er sch ein ung ge be ä und ver ch keit".split(), "os la ción de que ar el mente ñ ado es".split()]

    def words(k: int, tongue: list[str]) -> str:
        return " ".join("".join(r.choices(tongue, k=r.randint(1, 4))) for _ in range(k))

    def sentence(tongue, low=4, high=30) -> str:
        s = words(r.randint(low, high), tongue).capitalize()
        return s + r.choice([".", ".", ".", "!", "?", "…", ""])

    def page() -> str:
        tongue, maybe = r.choice(tongues), lambda p: r.random() < p
        prose = lambda k=None: " ".join(sentence(tongue) for _ in range(k or r.randint(1, 6)))
        link = lambda: f'<a href="/{words(1, tongue)}">{words(r.randint(1, 4), tongue)}</a>'
        links = lambda k=6: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(2, k))) + "</ul>"
        box = lambda inner, *names: f'<{(t := r.choice(["div", "div", "section", "aside"]))} {r.choice(["class", "id"])}="{r.choice(names)}">{inner}</{t}>'
        m = MARK

        def menu():
            return r.choice([f"<nav>{links(9)}</nav>", box(links(9), "nav", "menu", "main-menu", "navbar"), f'<div role="navigation">{links()}</div>', f"<nav><p>{' | '.join(link() for _ in range(5))}</p></nav>"])

        def top():
            inner = r.choice([f'<a href="/">{words(2, tongue)}</a>', f"<h1>{words(2, tongue)}</h1><p>{words(5, tongue)}</p>", f"<div>{words(2, tongue)}</div>{menu()}"])
            return r.choice([f"<header>{inner}</header>", box(inner, "header", "site-header", "masthead", "banner")])

        def advert():
            inner = r.choice([prose(1), f"<p>{prose(1)}</p>", link(), f"<b>{words(3, tongue)}</b><br>{prose(2)}"])
            return box(inner, "ad", "ads", "ad-slot", "advert", "advertisement", "sponsored", "promo")

        def notice():
            inner = r.choice([f"<p>We use cookies. {prose(1)}</p><button>OK</button>", f"{prose(2)} {link()}", f"<p>{prose(1)}</p>"])
            return box(inner, "cookie-notice", "cookie-banner", "consent", "notice", "gdpr", "newsletter", "popup")

        def form():
            return f'<form action="/s"><label>{words(2, tongue)}</label><input name="q"><select><option>{words(1, tongue)}<option>{words(1, tongue)}</select><button>{words(1, tongue)}</button></form>'

        def side():
            inner = f"<h3>{words(2, tongue)}</h3>" + r.choice([links(), f"<p>{prose(2)}</p>", f"<p>{prose(1)}</p>{links(4)}"])
            return r.choice([f"<aside>{inner}</aside>", box(inner, "sidebar", "widget", "related", "side", "trending")])

        def remarks():
            one = lambda: r.choice([f'<div class="comment"><b>{words(1, tongue)}</b><p>{prose(2)}</p></div>', f"<li><p>{words(2, tongue)}: {prose(1)}</p><a href='#'>Reply</a></li>", f'<article class="comment"><p>{prose(2)}</p></article>'])
            inner = f"<h3>{r.choice(['Comments', words(1, tongue)])}</h3>" + "".join(one() for _ in range(r.randint(1, 4)))
            return box(inner, "comments", "comment-list", "discussion", "replies")

        def foot():
            inner = r.choice([f"&copy; {words(2, tongue)} &middot; {prose(1)}", f"<p>{words(4, tongue)}</p>{links(4)}", f"<p>&copy; 2024 {words(2, tongue)}</p><p>{prose(1)}</p>"])
            return r.choice([f"<footer>{inner}</footer>", box(inner, "footer", "site-footer", "bottom", "copyright"), f"<footer>{inner}</footer>"])

        def body():
            parts = [f"<h1>{m}{words(r.randint(3, 12), tongue)}</h1>"]
            if maybe(0.2):
                parts = [f"<header>{parts[0]}</header>"]
            for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
                parts.append(r.choice([
                    lambda: f"<p>{m}{prose()}</p>", lambda: f"<p>{m}{prose()}</p>", lambda: f"<p>{m}{prose()}", lambda: f"<p><b>{m}{prose(1)}<br><p>{m}{prose()}", lambda: f"<p>{m}{sentence(tongue, 1, 3)}</p>", lambda: f"<h2>{m}{words(r.randint(1, 6), tongue)}</h2><p>{m}{prose()}</p>",
                    lambda: "<ul>" + "".join(f"<li>{m}{sentence(tongue, 2, 14)}</li>" for _ in range(3)) + "</ul>", lambda: f"<blockquote><p>{m}{prose(2)}</p></blockquote>", lambda: f"<pre>{m}{words(12, tongue)}</pre>", lambda: f"<p>{m}{sentence(tongue)} {link()} {prose(1)}</p>", lambda: f"<div>{m}{prose()}</div>",
                    lambda: f"<table><tr><td>{m}{words(2, tongue)}</td><td>{m}{words(2, tongue)}</td></tr></table>", lambda: f"<figure><img src='x.png'><figcaption>{m}{sentence(tongue, 3, 9)}</figcaption></figure>", lambda: f"<ol><li>{m}{sentence(tongue, 2, 9)}<li>{m}{sentence(tongue, 2, 9)}</ol>",
                ])())
                if maybe(0.06):
                    parts.append(r.choice([advert, form, notice])())
            if maybe(0.15):
                parts.append(box(" ".join(link() for _ in range(3)), "share", "social-share", "tags"))
            return "".join(parts)

        inner = body()
        article = r.choice([
            lambda: f"<article>{inner}</article>", lambda: f"<article>{inner}</article>", lambda: f"<main>{inner}</main>", lambda: f"<main><article class='post'>{inner}</article></main>", lambda: f'<div class="{r.choice(["content", "article-body", "post", "entry-content", "story"])}">{inner}</div>',
            lambda: f'<div id="{r.choice(["content", "main"])}"><div>{inner}</div></div>', lambda: f"<section>{inner}</section>", lambda: f"<div>{inner}</div>", lambda: f'<div role="main">{inner}</div>',
        ])()
        before = [x() for x, p in ((notice, 0.25), (top, 0.4), (menu, 0.8), (form, 0.15), (advert, 0.5), (side, 0.1)) if maybe(p)]
        after = [x() for x, p in ((advert, 0.15), (remarks, 0.35), (side, 0.4), (form, 0.2), (notice, 0.1), (foot, 0.85)) if maybe(p)]
        if maybe(0.3):
            r.shuffle(before)
        tail = r.choice(["</body></html>", "</body></html>", ""])
        return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{words(5, tongue)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>{''.join(before)}{article}{''.join(after)}{tail}"

    return [page() for _ in range(n)]


def labelled(page: str) -> tuple[list[list[str]], list[bool]]:
    """Features and labels of a page whose article text carries MARK."""
    rows, labels = [], []
    for inherited, block, text, linked in blocks(page):
        label = MARK in text
        rows.append([*inherited, *_text_features(block, text.replace(MARK, "") or "-", linked, not rows)])
        labels.append(label)
    return rows, labels


_TRAINED: dict[str, Chain] = {}


def default_chain() -> Chain:
    """The chain of the pages labelled here; trained once in a process, always the same."""
    if "chain" not in _TRAINED:
        _TRAINED["chain"] = train([labelled(p) for p in labelled_pages()])
    return _TRAINED["chain"]


def main_text(page: str | None, chain: Chain) -> str:
    """The article of a page: its blocks in order, joined by one newline."""
    texts, rows = features(page or "")
    return "\n".join(t for t, keep in zip(texts, chain.decode(rows), strict=True) if keep)


def extract(pages: DataFrame, chain: Chain | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    chain = chain or default_chain()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(page, chain) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_extract(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
