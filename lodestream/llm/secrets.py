"""Secret scans with DataFrame functions alone: candidates, features, a random forest.

One pattern finds candidates in a text and splits it into the gaps between them, so
offsets are sums of lengths.  Features (length, character transitions, dictionary
coverage, path marks, neighbouring words) are Columns over arrays of candidates, and the
forest is compiled to Columns too: a scan is a projection, without a shuffle, Python or a
row leaving its document.  The forest is trained from labelled findings; where none are
given, from the findings that ``labelled_findings`` makes.

Defined cases: a null or empty text holds no secrets, and ``redact`` keeps it as it is;
texts are scanned whole; rows that repeat an id are scanned each; an empty table gives no
rows; other columns pass through ``redact`` untouched, whatever their names.
"""

from __future__ import annotations

import random
import string
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

TREES, DEPTH, SEED, THRESHOLD = 20, 5, 11, 0.5
MASK = "[SECRET]"

_NAMES = "pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|[_-]key|auth(?:orization)?|credentials?|bearer"
#: What may stand between a name and its sign.
_SUFFIX = "(?:[_-](?:id|key|value|string|base64))?"
#: What stands between the name of a secret and its value.
_LEAD = r"(?:=>|:=|[:=])\x20{0,3}[\"'`]?(?:(?i:bearer|basic)\x20)?"
#: It begins at the sign, which is rare in prose, and only then looks back for the name.
_ASSIGNED = rf"(?=[:=])(?<=(?i:(?:{_NAMES}){_SUFFIX})[\"']?\x20{{0,3}}){_LEAD}[^\s\"'`,;<>]{{6,}}+"
_KEY = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"
#: The password of user:password@host in an address; it begins at the colon, too.
_LOGIN = r"(?=:)(?<=://[^\s:@/]{1,60}):[^\s:@/]{3,200}+(?=@)"
#: How keys begin that their issuers mark.
_PREFIX = "AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|[sr]k_(?:live|test)_|sk-|xox[abeprs]-|AIza|SG\\.|npm_|hf_|eyJ"
#: Runs of 16 or more characters that hold a digit, begin as an issuer's keys do, or change from small to capital letters three times.
_RUN = rf"(?<![A-Za-z0-9_+/~.-])(?=[A-Za-z_+/~.-]*+[0-9]|{_PREFIX}|(?:[A-Z_+/~.-]*+[a-z][a-z_+/~.-]*+[A-Z]){{3}})[A-Za-z0-9_+/~.-]{{16,}}+={{0,2}}"
#: Candidates, by one pass over the text.
CANDIDATE = f"{_LOGIN}|{_ASSIGNED}|{_KEY}|{_RUN}"

#: Forms of keys that their issuers publish.
ISSUED = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,}"
    r"|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_-]{20,}|xox[abeprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}"
    r"|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*|-----BEGIN [\s\S]*)$"
)
#: Words that make a candidate look like language or code rather than chance.
DICTIONARY = (
    "about account action address admin after api app archive article asset auth average back base before block blog body branch browser build button cache"
    " call category change check class client cloud code color column com comment common company config contact content control copy core country create data"
    " date default delete demo detail device direct document domain download draft email end error event example export field file filter final first folder font form"
    " frame from function game group guide handler header help home host html http icon image img import index info input item jpeg json key label language large last layout level"
    " library line link list local login mail main manager map media member menu message method mobile model module month name network news node note number object office"
    " order page param part path photo play plugin point policy post press price print process product profile project public query read record region release report request result"
    " return role root rule sample save schema script search section select send server service session set settings site size source state static status store string style"
    " support system table tag task team template test text theme time title type update upload user value version video view web window word work"
).split()
_PLACEHOLDER = r"(?i)^password$|example|sample|x{4,}|your|change.?me|placeholder|dummy|redacted|insert|\*{3,}|\$\{|\{\{|0{8,}|12345678|none$|null$|undefined"
_BENIGN = r"(?i)\b(?:sha-?\d*|md5|commit|checksum|digest|uuid|guid|integrity|hash|isbn|doi|version|build|etag|revision|trace|request|order|invoice|serial|phone|card|iban)\b[^\n]{0,12}$"


def _features(raw: Column, before: Column, after: Column, dictionary: Sequence[str]) -> dict[str, Column]:
    """Features of a candidate from its match and the text on both sides."""
    value = F.regexp_replace(raw, f"^{_LEAD}", "")
    n = F.greatest(F.length(value), F.lit(1))
    count = lambda pattern, of=value: F.regexp_count(of, F.lit(pattern))
    share = lambda pattern: count(pattern) / n
    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    lower = F.lower(value)
    return {
        "length": F.length(value),
        "transitions": count("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])") / n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "marks": share("[^A-Za-z0-9]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "hex": flag(value.rlike("^[0-9a-fA-F]{16,}$")),
        "dictionary": (F.length(value) - F.length(F.regexp_replace(lower, "(?:" + "|".join(sorted(dictionary, key=len, reverse=True)) + ")", ""))) / n,
        "vowels": share("[aeiouAEIOU]"),
        "path": count(r"[/\\]") + 2 * count(r"(?i)\.(?:com|org|net|io|html?|png|jpe?g|gif|css|js|py|json|xml|pdf|txt|zip|gz|md)(?![A-Za-z0-9])"),
        "dots": count(r"\."),
        "uuid": flag(value.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")),
        "named": flag(raw.rlike(f"^{_LEAD}") | before.rlike(rf"(?i)(?:{_NAMES}){_SUFFIX}[\"']?\W{{0,6}}$")),
        "near": flag(F.concat(before, F.lit(" "), after).rlike(rf"(?i)\b(?:{_NAMES}|aws|key|login|credential)")),
        "benign": flag(before.rlike(_BENIGN)),
        "address": flag(before.rlike(r"(?:@|://|www\.)[^\s]{0,40}$") | after.rlike("^@")),
        "login": flag(raw.startswith(":") & after.startswith("@")),
        "placeholder": flag(value.rlike(_PLACEHOLDER)),
        "issued": flag(value.rlike(ISSUED)),
    }


FEATURES = ("length", "transitions", "digits", "upper", "lower", "marks", "distinct", "hex", "dictionary", "vowels", "path", "dots", "uuid", "named", "near", "benign", "address", "login", "placeholder", "issued")


def _own(docs: DataFrame) -> tuple[str, str, str, str]:
    """Names that no column of docs has: of gaps, of findings, of judged findings, of bare candidates."""
    return tuple(free_name(n, docs.columns) for n in ("gaps", "found", "judged", "raw"))


def candidates(docs: DataFrame, text_col: str = "text", dictionary: Sequence[str] = DICTIONARY) -> DataFrame:
    """docs with the texts between candidates and the candidates with offset and features, named as ``_own`` says."""
    gaps, found, _, raw = _own(docs)
    text, kept = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), [F.col(f"`{c}`") for c in docs.columns]
    held = docs.select(*kept, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias(raw))
    held = held.select(*kept, raw, F.when(F.size(raw) > 0, F.split(text, CANDIDATE, -1)).otherwise(F.array(text)).alias(gaps))
    n = F.size(raw)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), n).alias("gap"), F.col(raw).alias("raw"))
    start = F.aggregate(
        pairs,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + F.length(x["gap"]) + F.length(x["raw"])).alias("at"), F.array_append(acc["out"], acc["at"] + F.length(x["gap"])).alias("out")),
        lambda acc: acc["out"],
    )
    zipped = F.arrays_zip(F.col(raw).alias("raw"), F.slice(gaps, F.lit(1), n).alias("before"), F.slice(gaps, F.lit(2), n).alias("after"), start.alias("start"))

    def one(x: Column) -> Column:
        before, after = F.right(x["before"], F.lit(60)), F.left(x["after"], F.lit(40))
        lead = F.length(x["raw"]) - F.length(F.regexp_replace(x["raw"], f"^{_LEAD}", ""))
        columns = [c.cast("double").alias(name) for name, c in _features(x["raw"], before, after, dictionary).items()]
        return F.struct(x["raw"].alias("raw"), (x["start"] + lead).alias("start"), lead.alias("lead"), F.struct(*columns).alias("f"))

    return held.select(*kept, gaps, F.transform(zipped, one).alias(found))


class Forest:
    """Trees as nested tuples (feature, threshold, low, high) or leaf shares."""

    def __init__(self, trees: list):
        self.trees = trees

    def column(self, features: Column) -> Column:
        def build(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, at, low, high = node
            return F.when(features[name] <= at, build(low)).otherwise(build(high))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + build(tree)
        return total / F.lit(float(len(self.trees)))


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int):
    if depth == 0 or len(y) < 8 or y.min() == y.max():
        return round(float((y.sum() + 0.5) / (len(y) + 1)), 4)
    best = (0.0, None)
    parent = y.mean() * (1 - y.mean())
    for j in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5) + 1), replace=False):
        values = np.unique(x[:, j])
        if len(values) < 2:
            continue
        cuts = (values[1:] + values[:-1]) / 2
        if len(cuts) > 24:
            cuts = np.quantile(x[:, j], np.linspace(0.02, 0.98, 24))
        for at in np.unique(cuts):
            low = x[:, j] <= at
            k = low.sum()
            if 3 <= k <= len(y) - 3:
                a, b = y[low].mean(), y[~low].mean()
                gain = parent - (k * a * (1 - a) + (len(y) - k) * b * (1 - b)) / len(y)
                if gain > best[0]:
                    best = (gain, (j, at))
    if best[1] is None:
        return round(float((y.sum() + 0.5) / (len(y) + 1)), 4)
    j, at = best[1]
    low = x[:, j] <= at
    return (FEATURES[j], float(at), _grow(x[low], y[low], rng, depth - 1), _grow(x[~low], y[~low], rng, depth - 1))


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
    """A random forest of bagged trees, each split on the best of a few features."""
    rng, grown = np.random.default_rng(seed), []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        grown.append(_grow(x[rows], y[rows], rng, depth))
    return Forest(grown)


def labelled_findings(n: int = 3000, seed: int = SEED, words: Sequence[str] = DICTIONARY, without: Sequence[tuple[str, int]] = ()) -> list[tuple[str, int]]:
    """Texts of one candidate each, and whether it is a secret.

    ``words`` are those that clean findings are made of; ``without`` leaves out forms,
    ("secret", k) or ("clean", k), so that a forest can be held against forms it never saw.
    """
    r = random.Random(seed)
    pick = lambda alphabet, k: "".join(r.choices(alphabet, k=k))
    hexa, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    upper, b64 = string.ascii_uppercase + string.digits, string.ascii_letters + string.digits + "+/"
    syllables = "an en er ing ion th re le de ou ch el la es ci ar os da que men".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    prose = lambda k: " ".join(word() for _ in range(r.randint(0, k)))
    name = lambda: r.choice(["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "API-KEY", "access_key", "client_secret", "auth", "Secret", "PASSWORD", "db_password", "my_token"])
    sign = lambda: r.choice(["=", " = ", ": ", ":", "=\"", " = \"", ": '", "='", " := "])
    issued = [
        lambda: "AKIA" + pick(upper, 16), lambda: "ASIA" + pick(upper, 16), lambda: "ghp_" + pick(alnum, 36), lambda: "glpat-" + pick(alnum, 20), lambda: "sk_live_" + pick(alnum, 24), lambda: "sk-" + pick(alnum, 48),
        lambda: f"xoxb-{pick(string.digits, 12)}-{pick(alnum, 24)}", lambda: "AIza" + pick(alnum + "_-", 35), lambda: f"eyJ{pick(alnum, 30)}1.eyJ{pick(alnum, 60)}.{pick(alnum, 43)}", lambda: f"SG.{pick(alnum, 21)}1.{pick(alnum, 43)}", lambda: "npm_" + pick(alnum, 35) + "7",
        lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(pick(b64, 64) for _ in range(4)) + "\n-----END RSA PRIVATE KEY-----",
    ]
    english = lambda k: [r.choice(words) for _ in range(k)]
    benign_name = lambda: r.choice(["sha256:", "sha1 ", "commit ", "checksum: ", "md5=", "digest ", "ETag: ", "revision ", "trace ", "hash: "])
    secret = [
        lambda: name() + sign() + pick(hexa, r.choice([16, 18, 20, 24, 32, 40, 64])), lambda: name() + sign() + pick(alnum, r.randint(10, 44)), lambda: name() + sign() + pick(alnum + "!#%*_-", r.randint(9, 24)), lambda: name() + sign() + pick(b64, 40), lambda: name() + sign() + pick(upper, r.randint(12, 30)),
        lambda: r.choice(["postgres", "mysql", "https", "amqp", "redis"]) + f"://{word()}:{r.choice([pick(alnum + '!#%*_-', r.randint(6, 24)), word() + word() + str(r.randint(1, 99)), word() + str(r.randint(1, 9)) + word()])}@{word()}.{r.choice(['internal', 'example.com', 'net'])}:{r.randint(1000, 9999)}/{word()}",
        *(lambda f=f: r.choice(["", "", name() + sign(), "key "]) + f() for f in issued),
    ]
    clean = [
        lambda: benign_name() + pick(hexa, r.choice([32, 40, 64])), lambda: r.choice(["", "id ", "uuid "]) + "-".join(pick(hexa, k) for k in (8, 4, 4, 4, 12)), lambda: pick(string.digits, r.randint(16, 19)), lambda: "+" + pick(string.digits, 16),
        lambda: f"{word()}.{r.randint(1, 99)}@mail{r.randint(1, 9)}.{r.choice(['example.com', 'example.org', word() + '.net'])}", lambda: f"https://{word()}{r.randint(1, 99)}.example.com/{'/'.join(english(3))}/{r.randint(1, 9999)}.html",
        lambda: f"{'/'.join(english(4))}{r.randint(1, 99)}.{r.choice(['png', 'js', 'py', 'html', 'json'])}", lambda: "_".join(english(3)) + f"_{r.randint(1, 9999)}", lambda: "".join(w.title() for w in english(3)) + str(r.randint(1, 99)), lambda: "-".join(english(4)) + f"-{r.randint(1, 2030)}",
        lambda: f"2024-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}:00:00.000Z"[:10] + "T" + pick(string.digits, 8) + "Z", lambda: f"{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}-{word()}.{r.randint(1, 9)}-snapshot", lambda: name() + sign() + r.choice(["changeme", "your_password", "YOUR_API_KEY", "xxxxxxxxxxxx", "example1", "placeholder", "********", "${SECRET}", "undefined", "12345678"]),
        lambda: name() + r.choice([" = ", ": "]) + r.choice([word() + word() + word(), "get_" + "_".join(english(2)), "request." + r.choice(words) + ".token", "required", "optional", "string"]) + "  ", lambda: "".join(word() for _ in range(6)) + str(r.randint(0, 9)), lambda: "isbn 978-" + "-".join(pick(string.digits, k) for k in (1, 4, 4, 1)), lambda: "=".join(["x", pick(string.digits, 16)]),
        lambda: ".".join(str(r.randint(100, 255)) for _ in range(5)), lambda: f"invoice {pick(upper[:26], 4)}-{pick(string.digits, 12)}", lambda: word() + ("-" * 3).join(word() for _ in range(4)) + "1",
        lambda: f"{r.choice(['postgres', 'mysql', 'https'])}://{word()}:{r.choice(['password', '${PASSWORD}', 'changeme', 'xxxxxx', 'your_password', '********'])}@{word()}.example.com/{word()}",
        lambda: "".join(word().title() for _ in range(r.randint(4, 7))), lambda: word() + "".join(word().title() for _ in range(r.randint(3, 6))) + r.choice(["", "", "2", "V3"]), lambda: "/".join(word().title() for _ in range(5)),
    ]
    found = []
    secret, clean = ([f for k, f in enumerate(forms) if (kind, k) not in without] for kind, forms in (("secret", secret), ("clean", clean)))
    for i in range(n):
        tail = r.choice([" ", "\" ", "' ", "\n", ", "]) + prose(6)
        # of secrets half are named, half issued; forms of either by turns of chance
        forms = (secret[:6] if r.random() < 0.55 else secret[6:] or secret) if i % 2 and not without else secret if i % 2 else clean
        # words that speak of secrets stand near clean findings, too
        about = r.choice(["", "", "", "the key of ", "login and token: see ", "password below, "])
        found.append((about + prose(6) + r.choice([" ", "\n"]) + r.choice(forms)() + tail, i % 2))
    return found


def train(spark: SparkSession, findings: list[tuple[str, int]] | None = None, dictionary: Sequence[str] = DICTIONARY) -> Forest:
    """The forest that labelled findings (text, is_secret) teach, with the features that scans use."""
    findings = labelled_findings() if findings is None else findings
    table = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(findings)], "i long, text string, y int")
    rows = candidates(table.coalesce(2), dictionary=dictionary).select("i", "y", F.explode("found").alias("c")).select("i", "y", *(f"c.f.{n}" for n in FEATURES)).collect()
    rows.sort(key=lambda r: (r.i, [r[n] for n in FEATURES]))
    if not rows:
        return Forest([0.0])
    return grow_forest(np.array([[r[n] for n in FEATURES] for r in rows]), np.array([float(r.y) for r in rows]))


_TRAINED: dict[str, Forest] = {}


def default_forest(spark: SparkSession) -> Forest:
    """The forest of the findings made here; trained once in a process, always the same."""
    if "forest" not in _TRAINED:
        _TRAINED["forest"] = train(spark)
    return _TRAINED["forest"]


def _judged(docs: DataFrame, forest: Forest, text_col: str, dictionary: Sequence[str]) -> DataFrame:
    gaps, found, judged, _ = _own(docs)
    held = candidates(docs, text_col, dictionary)
    judge = lambda c: F.struct(c["raw"].alias("raw"), c["start"].alias("start"), c["lead"].alias("lead"), c["f"]["issued"].alias("issued"), c["f"]["named"].alias("named"), forest.column(c["f"]).alias("score"))
    return held.select(*(F.col(f"`{c}`") for c in docs.columns), gaps, F.transform(found, judge).alias(judged))


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, dictionary: Sequence[str] = DICTIONARY) -> DataFrame:
    """(doc_id, start, length, kind, secret_sha256, score) of each secret; offsets in code points from 0."""
    rows = _judged(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), forest, "text", dictionary)
    # explode() would put a filter on the array below, and find all candidates once more for it
    found = rows.select("doc_id", F.explode_outer(F.filter("judged", lambda c: c["score"] >= threshold)).alias("c")).where(F.col("c.raw").isNotNull())
    value = F.substring("c.raw", F.col("c.lead") + 1, F.length("c.raw"))
    kind = F.when(F.col("c.raw").startswith("-----BEGIN"), "private_key").when(F.col("c.issued") > 0, "issued_key").when(F.col("c.named") > 0, "assigned").otherwise("high_entropy")
    return found.select("doc_id", F.col("c.start").alias("start"), F.length(value).cast("long").alias("length"), kind.alias("kind"), F.sha2(value.cast("binary"), 256).alias("secret_sha256"), F.col("c.score").alias("score"))


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", length_col: str | None = None, threshold: float = THRESHOLD, mask: str = MASK, dictionary: Sequence[str] = DICTIONARY) -> DataFrame:
    """docs with each secret replaced by the mask; length_col, if given, gets the new length."""
    gaps, _, judged, _ = _own(docs)
    rows = _judged(docs, forest, text_col, dictionary)
    shown = F.transform(judged, lambda c: F.when(c["score"] >= threshold, F.concat(F.substring(c["raw"], F.lit(1), c["lead"]), F.lit(mask))).otherwise(c["raw"]))
    joined = F.array_join(F.flatten(F.zip_with(gaps, F.concat(shown, F.array(F.lit(""))), lambda g, s: F.array(g, s))), "")
    hit = (F.size(judged) > 0) & F.exists(judged, lambda c: c["score"] >= threshold)
    text = F.when(hit, joined).otherwise(F.col(f"`{text_col}`"))
    rows = rows.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
    if length_col:
        kind = docs.schema[length_col].dataType
        rows = rows.withColumn(length_col, F.coalesce(F.length(f"`{text_col}`"), F.lit(0)).cast(kind))
    return rows


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Every secret in ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs, default_forest(spark))
