"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact verification.

A text is the multiset of its five-word shingles.  Weights are discretised into unit
levels, grouped into the dyadic blocks [0, 1), [1, 2), [2, 4), [4, 8) ...; each block of
an element is a Poisson process of a rate equal to its width, whose points are dealt to
the signature's components and, within a block, to its unit levels, so that a point
counts for an element exactly if its level lies below the element's weight.  The smallest
point of each component is its signature: two texts agree there with a probability equal
to their weighted Jaccard similarity.  Only points below a bound set by the total weight
are made, about a thousand a text whatever its length.

32 bands of 4 components find pairs at 0.8 but for a chance of 5e-8.  Equal texts are one
vertex.  Then, without ever forming all pairs of a bucket:

1. each member of a bucket is verified against the bucket's smallest id (a star, each pair
   once for all bands) on the full multisets, and links are joined into components;
2. only buckets whose other members still lie in several components are looked at again:
   their members meet in cells of two blocks, where every pair that no earlier band has
   and that lies in two components is verified.  That is the exact way for the rest; no
   bucket is capped.

Defined cases: a null text is an empty one; texts without words are one class; a text of
one to four words is one shingle; rows that share an id are one document; rows without
an id are one document, whose class is null where it is the smallest; an empty table
gives no rows; other columns are ignored by ``classes`` and kept by ``keep_first``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, free_name, materialize, mix64, utf8, window_hashes, word_hashes

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 4
#: Members of a block; a cell holds two blocks, a star's share one.
BLOCK = 128
_LOWEST = -(1 << 63)
_GOLD, _STEP, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def shingles(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of a text, and how often each occurs."""
    words = word_hashes(text)
    if not len(words):
        return words, np.zeros(0, np.int64)
    return np.unique(window_hashes(words, min(WORDS, len(words)), len(words) if len(words) < WORDS else 0), return_counts=True)


def elements(text: bytes) -> np.ndarray:
    """The multiset of shingles as a set: the k-th of equal shingles is an element of its own."""
    h, n = shingles(text)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(mix64(np.repeat(h, n) + nth.astype(np.uint64) * _GOLD))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The weighted Jaccard similarity of two texts' ``elements``."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
    return both / (len(a) + len(b) - both)


def _points(h: np.ndarray, w: np.ndarray, low: int, width: int, upto: float, m: int):
    """Points below ``upto`` of the processes of one dyadic block: places, components, names."""
    seed = mix64(h + np.uint64((low + 1) * int(_GOLD) % (1 << 64)))
    expect = width * upto
    columns = int(expect + 6 * expect**0.5) + 8
    if expect < 1:  # most processes have no point at all: look at the first alone
        first = mix64(seed + _STEP)
        near = -np.log(((first >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53) <= expect
        seed, w = seed[near], w[near]
    while True:
        z = mix64(seed[:, None] + np.arange(1, columns + 1, dtype=np.uint64) * _STEP)
        x = np.cumsum(-np.log(((z >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53), 1)
        if not len(x) or x[:, -1].min() > expect:
            break
        columns *= 2
    hit = x <= expect
    z, place = mix64(z[hit] ^ _TURN), x[hit] / width
    if width > 1:
        level = low + (mix64(z + _STEP) % np.uint64(width)).astype(np.int64)
        inside = level < np.repeat(w, hit.sum(1))
        z, place = z[inside], place[inside]
    return place, (z % np.uint64(m)).astype(np.int64), mix64(z)


def bag_minhash(h: np.ndarray, w: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    """The signature of a multiset of at least one element: the name of the smallest point of each component."""
    upto = (np.log(m) + 4) * m / float(w.sum())
    while True:
        made, low = [], 0
        top = int(w.max())
        while low < top:
            width = max(1, low)
            here = w > low
            made.append(_points(h[here], w[here], low, width, upto, m))
            low += width
        place, component, name = (np.concatenate(x) for x in zip(*made, strict=True))
        least = np.full(m, np.inf)
        np.minimum.at(least, component, place)
        if np.isfinite(least).all():
            out = np.zeros(m, np.uint64)
            first = place == least[component]
            out[component[first]] = name[first]
            return out
        upto *= 2


def bands(signature: np.ndarray) -> np.ndarray:
    """A key per band; the band's number is part of it."""
    rows = signature.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
    for i in range(ROWS):
        key = mix64(key ^ rows[:, i]) + _STEP
    return key


def _sign(batches):
    import pyarrow as pa

    for batch in batches:
        sizes, keys = [], []
        for text in utf8(batch.column(2)):
            h, w = shingles(text)
            sizes.append(int(w.sum()))
            keys.append(bands(bag_minhash(h, w)).view(np.int64) if len(h) else np.zeros(0, np.int64))
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), listed], names=["id", "digest", "size", "bands"])


def _star(batches):
    """Links of members to their leader, from rows sorted so that the leader comes first."""
    import pyarrow as pa

    at, leader = None, None
    for batch in batches:
        a, b = [], []
        for lead, block, member, text in zip(batch.column("lead").to_pylist(), batch.column("block").to_pylist(), batch.column("id").to_pylist(), utf8(batch.column("text")), strict=True):
            if (lead, block) != at:
                at, leader = (lead, block), []
            if member == lead:
                leader.append(elements(text))
            else:
                own = elements(text)
                if any(_may(len(own), len(x)) and similarity(own, x) >= SIMILAR for x in leader):
                    a.append(lead)
                    b.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _may(m: int, n: int) -> bool:
    return min(m, n) >= SIMILAR * max(m, n)


class _Roots(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            self[x] = self[self[x]]
            x = self[x]
        return x


def _cell(rows: list, cell: int) -> list[tuple[int, int]]:
    """Links between the components that the rows of a cell (block, label, id, bands, key, text) lie in."""
    roots, links, sets = _Roots(), [], {}
    split = cell >> 31 != cell & ((1 << 31) - 1)
    if split and len({r[0] for r in rows}) == 1:
        return links
    keys = np.array([r[3] for r in rows], np.int64).reshape(len(rows), BANDS)
    band = np.flatnonzero((keys == rows[0][4]).all(0))
    band = int(band[0]) if len(band) else 0

    def own(i):
        if i not in sets:
            sets[i] = elements(rows[i][5])
        return sets[i]

    sizes = np.array([r[6] for r in rows])
    for i in range(len(rows)):
        small, large = np.minimum(sizes[i], sizes[i + 1 :]), np.maximum(sizes[i], sizes[i + 1 :])
        new = ~(keys[i + 1 :, :band] == keys[i, :band]).any(1) if band else np.ones(len(rows) - i - 1, bool)
        for j in np.flatnonzero(new & (small >= SIMILAR * large)) + i + 1:
            if split and rows[i][0] == rows[j][0]:
                continue
            a, b = rows[i][1], rows[j][1]
            if a != b and roots.find(a) != roots.find(b) and similarity(own(i), own(j)) >= SIMILAR:
                roots[roots.find(a)] = roots.find(b)
                links.append((a, b))
    return links


def _cells(batches):
    import pyarrow as pa

    names = ("cell", "block", "label", "id", "bands", "key", "text", "size")
    at, held, links = None, [], []
    for batch in batches:
        columns = [utf8(batch.column(c)) if c == "text" else batch.column(c).to_pylist() for c in names]
        for cell, block, label, doc, keys, key, text, size in zip(*columns, strict=True):
            if (key, cell) != at:
                if held:
                    links += _cell(held, at[1])
                at, held = (key, cell), []
            held.append((block, label, doc, keys, key, text, size))
    if held:
        links += _cell(held, at[1])
    a, b = ([x[i] for x in links] for i in (0, 1))
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, label) of each vertex in links (a, b): label is the smallest id that it is joined to.

    Large and small stars by turns, each a minimum per vertex and an equi-join; every
    round is written to the shared folder, so lineage stays short.
    """
    edges, before = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"), None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "_a")
        large = both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("m").alias("a"), "b").where("a < b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "_b")
        small = large.join(least, F.col("b") == F.col("_b"))
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(small.select("m", "b")).where("a < b").distinct()
        after = materialize(small, "edges")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(edges)
        edges = after
        if seen == before:
            # every edge now points at the smallest id of its component
            return edges.select(F.col("b").alias("id"), F.col("a").alias("label"))
        before = seen


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) of each row: documents of a class are linked by similarities of at least 0.8."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("id"), F.sha2(text.cast("binary"), 256).alias("digest"), text.alias("text"))
    signed = texts.select("id", "digest", "text").mapInArrow(_sign, "id long, digest string, size long, bands array<long>")
    # texts without words are equal, whatever white space they have; ids that repeat are one vertex
    signed = signed.withColumn("digest", F.when(F.col("size") == 0, "").otherwise(F.col("digest")))
    signed = materialize(signed, "signed")
    vertices = signed.groupBy("digest").agg(F.min("id").alias("vertex"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
    vertices = materialize(vertices.withColumn("print", F.xxhash64("digest")), "vertices")
    copied = vertices.where("copies > 1").select(F.col("digest").alias("_digest"), "vertex")
    copies = signed.select("id", "digest").join(copied, F.col("digest") == F.col("_digest")).where("id != vertex").select(F.col("vertex").alias("a"), F.col("id").alias("b"))
    buckets = vertices.select("vertex", "print", "size", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("vertex").alias("lead"), F.min_by("size", "vertex").alias("lead_size"), F.count("*").alias("n"))
    # written, so that the join below is one of its own: Spark knows its size, and AQE may split a key that many share
    leaders = materialize(leaders.where("n > 1").withColumnRenamed("key", "_key"), "leaders")
    hits = buckets.join(leaders, F.col("key") == F.col("_key")).where("vertex != lead")
    hits = materialize(hits.select("key", "vertex", "print", "size", "lead", "lead_size", "n"), "hits")
    discard(leaders)
    near = F.least("size", "lead_size") >= SIMILAR * F.greatest("size", "lead_size")
    pairs = hits.where(near).select("lead", "vertex").distinct()
    counts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).withColumnRenamed("lead", "_lead")
    spread = materialize(pairs.join(counts, F.col("lead") == F.col("_lead")).select("lead", F.pmod(F.xxhash64("vertex"), F.col("blocks")).alias("block"), "vertex"), "pairs")
    # whole texts of the vertices that share a bucket: taken from the table once, for both rounds
    wanted = hits.select("vertex").union(hits.select("lead")).distinct().withColumnRenamed("vertex", "_w")
    wanted = vertices.join(wanted, F.col("vertex") == F.col("_w"), "left_semi").select(F.col("vertex").alias("_v"), F.col("digest").alias("_d"), F.col("print").alias("_print"))
    chosen = texts.join(wanted, (F.col("id") == F.col("_v")) & (F.col("digest") == F.col("_d"))).select(F.col("id").alias("_id"), "_print", "text")
    chosen = materialize(chosen, "texts")
    need = spread.select("lead", "block", F.col("vertex").alias("id")).union(spread.select("lead", "block", F.col("lead")).distinct())
    told = need.join(chosen, F.col("id") == F.col("_id")).select("lead", "block", "id", "text")
    told = told.repartition("lead", "block").sortWithinPartitions("lead", "block", F.col("id") != F.col("lead"), "id")
    links = materialize(told.mapInArrow(_star, "a long, b long"), "links")
    discard(spread)
    labels = components(links)
    # buckets whose members, but for the leader that all were held against, are still apart
    known = labels.select(F.col("id").alias("_id"), "label")
    apart = hits.where("n > 2").join(known, F.col("vertex") == F.col("_id"), "left").select("key", "vertex", "print", "size", F.coalesce("label", "vertex").alias("label"))
    apart = materialize(apart, "apart")
    discard(hits)
    split = apart.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low < high")
    split = materialize(split.select(F.col("key").alias("_key"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "split")
    again = apart.join(split, F.col("key") == F.col("_key")).withColumn("block", F.pmod(F.xxhash64("vertex", "key"), F.col("blocks")).cast("int"))
    keyed = vertices.select(F.col("vertex").alias("_v"), F.col("print").alias("_p"), "bands")
    again = again.join(keyed, (F.col("vertex") == F.col("_v")) & (F.col("print") == F.col("_p"))).join(chosen, (F.col("vertex") == F.col("_id")) & (F.col("print") == F.col("_print")))
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.least("block", "other").cast("long") * F.lit(1 << 31) + F.greatest("block", "other")
    again = again.select("key", cell.alias("cell"), "block", "label", F.col("vertex").alias("id"), "bands", "text", "size")
    again = again.repartition("key", "cell").sortWithinPartitions("key", "cell", "id")
    more = again.mapInArrow(_cells, "a long, b long")
    final = components(labels.select(F.col("label").alias("a"), F.col("id").alias("b")).union(more).union(copies))
    for done in (vertices, chosen, links, apart, split, labels):
        discard(done)
    final = final.select(F.col("id").alias("_id"), "label")
    found = signed.select("id").join(final, F.col("id") == F.col("_id"), "left").select("id", F.coalesce("label", "id").alias("label"))
    blank = lambda c: F.when(F.col(c) != _LOWEST, F.col(c))
    return found.select(blank("id").alias("doc_id"), blank("label").alias("class_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those whose class has a smaller id; of rows that share an id all stay or go."""
    later = free_name("later", docs.columns)
    found = classes(docs, id_col, text_col)
    # a row without id is the smallest of its class
    found = found.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(later)).distinct()
    return docs.join(found, F.col(f"`{id_col}`").cast("long") == F.col(later), "left_anti")


def op2_neardup(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
