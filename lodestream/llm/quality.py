"""A quality classifier made of sparse rules over text statistics.

Boosted shallow trees over statistics of labelled texts give paths; each path is a
conjunctive rule.  A lasso logistic regression over the rules and the clipped linear
statistics keeps few of them, and the kept rules are compiled into one Column: scoring
is a projection in the JVM, without Python or a shuffle.

The fit takes a bounded sample of labelled rows: at most ``SAMPLE`` rows, those whose
ids hash lowest, so reruns agree.  Rows held out never enter it.

Defined cases: a null text is an empty one, and an empty one gets a score like any other;
a label that is null is not learned from; without labels of both kinds every score is
the share of ones (0.5 without any); rows that repeat an id are scored each; an empty
table gives no rows; other columns pass through ``score`` untouched, unless they have the
name of the score itself, which is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import let

#: Largest number of labelled rows that a fit sees.
SAMPLE = 20_000
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32
LASSO = 0.002
#: Labels of one id in three (remainder 1) are held out.
FOLDS, HELD_OUT = 3, 1


def _counts(text: Column) -> Column:
    """What the statistics of a text are made of, each counted once.

    Words come from one split, and marks from what one pattern leaves of the text: digits
    and ASCII punctuation, a small part of it.
    """
    marks = {"digits": "0123456789", "symbols": "#$%&*+<=>@[\\]^_{|}~/", "bars": "|", "bangs": "!", "stops": ".", "commas": ",;:"}

    def words(p: Column) -> Column:
        blank = lambda at: F.when(F.element_at(p, at) == "", 1).otherwise(0)
        return F.struct(
            (F.size(p) - blank(1) - F.when(F.size(p) > 1, blank(-1)).otherwise(0)).alias("all"),
            F.length(F.array_join(p, "")).alias("chars"),
            (F.size(F.array_distinct(p)) / F.size(p)).alias("distinct"),
        )

    def counted(t: Column) -> Column:
        return F.struct(
            F.length(t).alias("chars"),
            F.regexp_count(t, F.lit("\\p{Lu}")).alias("upper"),
            let(F.split(t, "[\\x20\\x09-\\x0D]+"), words).alias("words"),
            let(F.split(t, "\n"), lambda p: F.struct(F.size(p).alias("all"), F.size(F.array_distinct(p)).alias("distinct"))).alias("lines"),
            let(F.regexp_replace(t, "[^0-9!-/:-@\\[-`{-~]+", ""), lambda m: F.struct(*((F.length(m) - F.length(F.translate(m, of, ""))).alias(n) for n, of in marks.items()))).alias("marks"),
        )

    return let(F.coalesce(text, F.lit("")), counted)


def statistics(text: Column) -> Column:
    """A struct of the statistics of a text, as doubles named in ``NAMES``; none of them is null, for any text.

    Counts are bound once by ``let``, so that whatever uses the struct (a filter that the
    optimizer pushes below a projection, too) reads a text once for each of them.
    """

    def made(c: Column) -> Column:
        per_word = lambda n: n / F.greatest(c["words"]["all"], F.lit(1))
        share = lambda n: n / F.greatest(c["chars"], F.lit(1))
        found = {
            "log_words": F.log2(c["words"]["all"] + F.lit(1)),
            "word_length": per_word(c["words"]["chars"]),
            "distinct_words": c["words"]["distinct"],
            "distinct_lines": c["lines"]["distinct"] / c["lines"]["all"],
            "line_words": per_word(c["lines"]["all"]),
            "upper": share(c["upper"]),
            "digits": share(c["marks"]["digits"]),
            **{n: per_word(c["marks"][n]) for n in ("symbols", "bars", "bangs", "stops", "commas")},
        }
        return F.struct(*(found[n].cast("double").alias(n) for n in NAMES))

    return let(_counts(text), made)


NAMES = ("log_words", "word_length", "distinct_words", "distinct_lines", "line_words", "upper", "digits", "symbols", "bars", "bangs", "stops", "commas")


@dataclass
class Rules:
    """A fitted ensemble: bias, rules as ((statistic, above, threshold), ...) with weights, linear terms."""

    bias: float
    rules: list[tuple[tuple[tuple[str, bool, float], ...], float]] = field(default_factory=list)
    linear: list[tuple[str, float, float, float]] = field(default_factory=list)

    def column(self, stat) -> Column:
        """The score as a Column; ``stat`` gives the Column of a statistic by name."""
        total = F.lit(self.bias)
        for name, low, high, weight in self.linear:
            total = total + F.least(F.greatest(stat(name), F.lit(low)), F.lit(high)) * F.lit(weight)
        for tests, weight in self.rules:
            both = F.lit(True)
            for name, above, at in tests:
                both = both & ((stat(name) > at) if above else (stat(name) <= at))
            total = total + F.when(both, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(x: np.ndarray, y: np.ndarray) -> list[tuple[tuple[int, bool, float], ...]]:
    """Paths of boosted trees over quantile bins, each once."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
    f, found = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        nodes = [(np.arange(len(y)), ())]
        for _ in range(DEPTH):
            below = []
            for rows, path in nodes:
                best = (1e-3, None)
                if len(rows) >= 10:
                    g, h = grad[rows], hess[rows]
                    for j, c in enumerate(cuts):
                        if not len(c):
                            continue
                        gs = np.cumsum(np.bincount(binned[rows, j], g, len(c) + 1))
                        hs = np.cumsum(np.bincount(binned[rows, j], h, len(c) + 1))
                        ns = np.cumsum(np.bincount(binned[rows, j], minlength=len(c) + 1))
                        gl, hl, n = gs[:-1], hs[:-1], ns[:-1]
                        gain = gl**2 / (hl + 1) + (gs[-1] - gl) ** 2 / (hs[-1] - hl + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                        gain[(n < 5) | (len(rows) - n < 5)] = 0
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], (j, k))
                if best[1] is None:
                    f[rows] += RATE * grad[rows].sum() / (hess[rows].sum() + 1)
                    continue
                j, k = best[1]
                left = binned[rows, j] <= k
                for above, part in ((False, rows[left]), (True, rows[~left])):
                    step = (*path, (j, above, float(cuts[j][k])))
                    found[step] = None
                    below.append((part, step))
            nodes = below
        for rows, _ in nodes:
            f[rows] += RATE * grad[rows].sum() / (hess[rows].sum() + 1)
    return list(found)


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradient steps; the bias is free."""
    n, d = x.shape
    scale = 0.25 * (np.linalg.norm(x, 2) ** 2 / n + 1)
    w, b = np.zeros(d), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, t = w, b, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(x @ vw + vb))) - y
        nw = vw - x.T @ r / n / scale
        nw = np.sign(nw) * np.maximum(np.abs(nw) - penalty / scale, 0)
        nb, nt = vb - r.mean() / scale, (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def fit_rows(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules from a matrix of statistics (columns as NAMES) and labels 0 and 1."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Rules(float(np.log(share / (1 - share))))
    paths = _paths(x, y)
    fires = np.stack([np.all([(x[:, j] > at) == above for j, above, at in p], 0) for p in paths], 1).astype(float) if paths else np.zeros((len(y), 0))
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    spread = clipped.std(0)
    scaled = np.where(spread > 0, 0.4 / np.where(spread > 0, spread, 1), 0)
    w, b = _lasso(np.hstack([fires, clipped * scaled]), y, LASSO)
    rules = [(tuple((NAMES[j], above, at) for j, above, at in p), float(v)) for p, v in zip(paths, w, strict=False) if abs(v) > 1e-6]
    linear = [(NAMES[j], float(low[j]), float(high[j]), float(v * scaled[j])) for j, v in enumerate(w[len(paths) :]) if abs(v) > 1e-6]
    return Rules(b, rules, linear)


def held_out(doc_id: Column) -> Column:
    """Whether the label of an id is held out: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rules:
    """Fit to the labelled rows of docs (doc_id, text) that are not held out.

    The labelled rows are joined before any statistic is computed; at most ``sample`` of
    them, lowest hash first, reach the driver, as rows of twelve numbers.
    """
    marked = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = marked.count()
    # a share of ids by hash first, so that texts that can't be in the sample are not shuffled
    step = 1 << 20
    keep = F.pmod(F.xxhash64("doc_id"), F.lit(step)) < F.lit(min(step, int(1.2 * step * sample / max(total, 1)) + 1))
    texts = docs.where(keep).select(F.col("doc_id").alias("_id"), "text")
    seen = texts.join(marked.where(keep), F.col("_id") == F.col("doc_id"))
    seen = seen.select(F.pmod(F.xxhash64("doc_id"), F.lit(step)).alias("_at"), "doc_id", F.col("quality").cast("double").alias("quality"), statistics(F.col("text")).alias("_stats"))
    seen = seen.select("_at", "doc_id", "quality", "_stats.*")
    rows = seen.orderBy("_at", "doc_id", *NAMES).limit(sample).toPandas()
    return fit_rows(rows[list(NAMES)].to_numpy(float), rows["quality"].to_numpy(float))


def score(docs: DataFrame, rules: Rules, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the score of each text in the column ``name``."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != name]
    return docs.select(*keep, let(statistics(F.col(f"`{text_col}`")), lambda s: rules.column(lambda n: s[n])).alias(name))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, rules)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
