"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Large-item matching: pieces above one third of the capacity fit at most twice in a
sequence, so they are matched greedily, the largest first, each with the largest partner
that fits.  Smaller pieces then best-fit into the smallest gap that holds them, by
descending length.  Only lengths matter for that, and there are at most ``capacity`` of
them: the plan is made on the driver from the histogram of lengths, in runs of equal
sequences, so its size is bounded by the capacity however many documents there are.

Ranks of pieces within a length come from counters per task and a prefix sum over
(length, task); no window or task ever holds all pieces of one length.

Defined cases: a null text is an empty one, and an empty one is the end id alone; rows
that repeat an id are packed once per row; an empty table packs into nothing; columns
other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
#: Texts of these characters alone split alike in both libraries, so the faster may encode them.
_COMMON = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ‐-―‘-”•…€]*")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids as ``tokenizers`` gives them for a byte-level vocabulary.

    The rank file of the same vocabulary gives equal ids four times as fast where a text
    has common characters alone and no special token; other texts take the slower way.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if _SPECIAL not in text and _COMMON.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def _cutter(capacity: int, end_id: int, vocabulary: str):
    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, seen, encoder = TaskContext.get().partitionId(), defaultdict(int), None
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                encoder = encoder or Encoder(vocabulary)
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                start, piece, end = 0, 0, min(first, len(ids))
                while start < len(ids):
                    n = end - start
                    for column, value in zip(out, (doc_id, piece, start, n, zlib.crc32(ids[start:end].tobytes()), task, seen[n]), strict=True):
                        column.append(value)
                    seen[n] += 1
                    start, end, piece = end, min(end + capacity, len(ids)), piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "rank")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=list(names))

    return cut


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Where the pieces of each length go, and the number of sequences.

    A row (length, low, high, first, per, offset) says: the piece of that length with rank
    r in [low, high) goes to sequence first + (r - low) // per, at
    offset + ((r - low) % per) * length.
    """
    left, rows, used, next_rank = dict(histogram), [], 0, defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def put(length: int, first: int, bins: int, per: int, offset: int) -> None:
        low = next_rank[length]
        next_rank[length] = low + bins * per
        rows.append((length, low, low + bins * per, first, per, offset))
        left[length] -= bins * per

    large = sorted((s for s in left if s > capacity / 3), reverse=True)
    for s in large:
        while left[s]:
            mate = next((t for t in large if t <= min(s, capacity - s) and left[t] > (t == s)), None)
            if mate is None:
                bins, gap = left[s], capacity - s
                put(s, used, bins, 1, 0)
            elif mate == s:
                bins, gap = left[s] // 2, capacity - 2 * s
                put(s, used, bins, 2, 0)
            else:
                bins, gap = min(left[s], left[mate]), capacity - s - mate
                put(s, used, bins, 1, 0)
                put(mate, used, bins, 1, s)
            gaps[gap].append((used, bins))
            used += bins
    for s in sorted((s for s in left if s <= capacity / 3), reverse=True):
        while left[s]:
            gap = next((g for g in range(s, capacity + 1) if gaps.get(g)), None)
            if gap is None:
                bins = -(-left[s] // (capacity // s))
                gaps[capacity].append((used, bins))
                used += bins
                gap = capacity
            first, bins = gaps[gap].pop()
            per = min(gap // s, left[s])
            take = min(bins, left[s] // per)
            put(s, first, take, per, capacity - gap)
            gaps[gap - per * s].append((first, take))
            if take < bins:
                gaps[gap].append((first + take, bins - take))
    return rows, used


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    The pieces are written to the shared folder once: what follows needs them twice, and
    ranks counted in a task must not be counted anew after an executor is lost.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(texts.mapInArrow(_cutter(capacity, end_id, vocabulary), _PIECES), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # one row per length, of which there are at most ``capacity``
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, capacity)
    kinds = [("p_length", T.LongType()), ("low", T.LongType()), ("high", T.LongType()), ("first", T.LongType()), ("per", T.LongType()), ("at", T.LongType())]
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds])
    places = spark.createDataFrame(rows, schema)
    # a row per length and task, never per piece
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    bases = counts.select(F.col("length").alias("b_length"), F.col("task").alias("b_task"), base.alias("base"))
    ranked = pieces.join(bases, (F.col("length") == F.col("b_length")) & (F.col("task") == F.col("b_task")))
    ranked = ranked.withColumn("place", F.col("rank") + F.col("base"))
    # the plan has a bounded number of rows, set by the capacity alone
    held = ranked.join(F.broadcast(places), (F.col("length") == F.col("p_length")) & (F.col("place") >= F.col("low")) & (F.col("place") < F.col("high")))
    nth = F.col("place") - F.col("low")
    sequence = F.col("first") + F.floor(nth / F.col("per"))
    offset = F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")
    return held.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def op6_pack(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 1024 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
