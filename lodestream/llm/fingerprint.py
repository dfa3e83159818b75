"""Context-triggered piecewise hashing of texts, and their likeness by edit distance.

A rolling hash over seven bytes triggers boundaries wherever its low bits are all ones, so
boundaries depend on content alone.  Each piece between them becomes one character; a
fingerprint holds the signature at a block size and at twice that size, the sizes being
powers of two.  Two fingerprints are compared at the block size they share.  Everything
in a text is vectorised over its bytes.

Defined cases: a null text is an empty one; an empty text has the fingerprint ``4::`` and
is like another empty one alone; texts are read whole; rows that repeat an id follow each
other in order of their texts; a row without id comes last; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, prefix_hash, span_hash

#: Bytes that the rolling hash sees.
WINDOW = 7
#: Pieces that a signature should have, about; and block sizes as powers of two.
PIECES, LEAST, MOST = 48, 2, 31
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_LETTERS = np.frombuffer(ALPHABET.encode(), np.uint8)
_STEP = np.uint32(0x01000193)
#: A run of characters that two long signatures share, lest chance look like likeness.
COMMON = 4
#: Bytes of text in one task's share, about, and ids looked at to set bounds, at most.
SHARE_BYTES, SAMPLE = 32 << 20, 50_000


def _rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash that ends at each byte, finalised: a boundary is where its low bits are all ones."""
    padded = np.zeros(len(data) + WINDOW - 1, np.uint32)
    padded[WINDOW - 1 :] = data
    padded[WINDOW - 1 :] += np.uint32(1)
    h = padded[: len(data)].copy()
    for i in range(1, WINDOW):
        h *= _STEP
        h += padded[i : i + len(data)]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def _signature(prefix: np.ndarray, ends: np.ndarray, n: int) -> str:
    edges = np.concatenate(([0], ends, [n])) if not len(ends) or ends[-1] != n else np.concatenate(([0], ends))
    pieces = span_hash(prefix, edges[:-1], edges[1:])
    return _LETTERS[(mix64(pieces) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: bytes) -> str:
    """``size:signature:signature at twice the size`` of a UTF-8 text."""
    n = len(text)
    if not n:
        return f"{1 << LEAST}::"
    data = np.frombuffer(text, np.uint8)
    h, prefix = _rolling(data), prefix_hash(data)
    bits = max(LEAST, min(MOST, (n // PIECES).bit_length()))
    low = max(LEAST, bits - 2)
    # positions that trigger at the smallest size tried; larger sizes trigger at some of them
    least = np.uint32((1 << low) - 1)
    small = np.flatnonzero((h & least) == least)
    held = h[small].astype(np.uint64)

    def ends(b: int) -> np.ndarray:
        m = np.uint64((1 << b) - 1)
        return small[(held & m) == m] + 1

    while bits > low and len(ends(bits)) < PIECES // 2:
        bits -= 1
    while bits < MOST and len(ends(bits)) > 2 * PIECES:
        bits += 1
    return f"{1 << bits}:{_signature(prefix, ends(bits), n)}:{_signature(prefix, ends(bits + 1), n)}"


def _common_run(a: str, b: str, k: int) -> bool:
    seen = {a[i : i + k] for i in range(len(a) - k + 1)}
    return any(b[i : i + k] in seen for i in range(len(b) - k + 1))


def _alike(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) over the lengths; 0 if no run is shared."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if not _common_run(a, b, min(COMMON, max(1, min(len(a), len(b)) // 3))):
        return 0.0
    # longest common subsequence, a bit per character of b
    where: dict[str, int] = {}
    for i, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << i
    full = row = (1 << len(b)) - 1
    get = where.get
    for c in a:
        u = row & get(c, 0)
        row = (row + u | row - u) & full
    return 2 * (len(b) - row.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """How alike two fingerprints are, 0 to 1, at the block size that they share."""
    if x == y:
        return 1.0
    (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")
    bx, by = int(bx), int(by)
    if bx == by:
        return max(_alike(x1, y1), _alike(x2, y2))
    if bx == 2 * by:
        return _alike(x1, y2)
    if by == 2 * bx:
        return _alike(x2, y1)
    return 0.0


def _worker(batches):
    import pyarrow as pa

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    held, known = None, None  # the row before, which waits for its next, and its fingerprint

    def finish(row, own, following, theirs):
        doc_id, text = row
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        data = edited.encode("utf-8", "surrogatepass")
        changed = fingerprint(data)
        return doc_id, len(text), hashlib.sha256(data).hexdigest(), own, changed, likeness(own, changed), likeness(own, theirs)

    for batch in batches:
        out = []
        for doc_id, text, carried in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("carried").to_pylist(), strict=True):
            text = text or ""
            own = fingerprint(text.encode("utf-8", "surrogatepass"))
            if held is not None:
                out.append(finish(held, known, text, own))
            held, known = (None, None) if carried else ((doc_id, text), own)
            if carried:  # what follows are repeats of the carried row
                break
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _bounds(docs: DataFrame, share_bytes: int, sample: int) -> list[int]:
    """Ids at which shares begin, ascending, from a sample by hash of a bounded number of ids."""
    ids = docs.where(F.col("doc_id").isNotNull())
    step = max(1, -(-ids.count() // sample))
    found = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).groupBy("doc_id").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n")).orderBy("doc_id").collect()
    total = sum(r.n for r in found) * step
    shares, bounds, so_far = max(1, -(-total // share_bytes)), [], 0
    for r in found:
        if len(bounds) < shares - 1 and so_far * shares > total * (len(bounds) + 1):
            bounds.append(r.doc_id)
        so_far += r.n * step
    return bounds


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share_bytes: int = SHARE_BYTES, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The next document is the one that follows by descending id; the last is followed by
    the first.  Texts are dealt in one pass and shuffled once, into ranges of ids.  The first row
    of each range goes to the range before it as well, so that its last row meets its
    next: one row per range, told by the highest id of each range.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounds = np.array(_bounds(rows, share_bytes, sample), "int64")
    n = len(bounds) + 1
    key, missing = F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()

    def shares(key, missing):
        # the highest ids come first
        return np.where(missing, n - 1, n - 1 - np.searchsorted(bounds, key, "right"))

    @F.pandas_udf("int")
    def share_of(key, missing):
        import pandas as pd

        return pd.Series(shares(key.to_numpy(), missing.to_numpy()))

    # one row per range: as few as there are tasks
    found = rows.groupBy(share_of(key, missing).alias("share")).agg(F.max("doc_id").alias("top")).orderBy("share").collect()
    tops, nameless, before = np.zeros(n, "int64"), np.zeros(n, bool), np.zeros(n, "int64")
    for i, r in enumerate(found):
        tops[r.share], nameless[r.share], before[r.share] = r.top or 0, r.top is None, found[i - 1].share

    @F.pandas_udf("share int, before int")
    def places(key, missing):
        import pandas as pd

        missing = missing.to_numpy()
        share = shares(key.to_numpy(), missing)
        first = (key.to_numpy() == tops[share]) & (missing == nameless[share])
        return pd.DataFrame({"share": share, "before": np.where(first, before[share], -1)})

    own, ahead = (F.struct(F.col(f"at.{c}").alias("share"), F.lit(c == "before").alias("carried")) for c in ("share", "before"))
    spots = F.when(F.col("at.before") < 0, F.array(own)).otherwise(F.array(own, ahead))
    both = rows.withColumn("at", places(key, missing)).select("doc_id", "text", F.explode(spots).alias("spot")).select("doc_id", "text", "spot.share", "spot.carried")
    both = both.repartitionById(n, F.col("share")).sortWithinPartitions("carried", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    kinds = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return both.select("doc_id", "text", "carried").mapInArrow(_worker, kinds)


def op5_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likenesses."""
    return compare(spark.read.parquet(f"{sf_dir}/documents.parquet"))
