"""Exact removal of repeated passages, found by difference-cover anchors.

Two equal windows of ``WIDTH`` words, wherever they stand, share an anchor: the cover
{0, 1, 3, 9} modulo 13 holds, for any two positions, a shift below 13 that puts both on
it, and an anchor of 8 words shifted by at most 12 lies within 20 words.  So only
anchors at cover positions are hashed and shuffled (4 of 13 positions).  Those that
occur again mark where passages may repeat; around them the match is extended to whole
windows, which are hashed with 96 bits (of word hashes of 64) and judged: a window whose words start earlier
elsewhere is removed.

Shape of the job.  Texts that a smaller id has word for word are found by a minimum per
digest and left out; each of their windows starts earlier.  Map tasks drop repeats within a document and within a task's batch
before anything is shuffled, so a passage that every document holds costs a row per
task, not per document.  What is shuffled are blocks of packed hashes, dealt by hash; a
reducer answers each block with the positions that repeat, by document.  Texts are
shuffled once, by document; answers are joined to them there.  No pair of documents is
ever formed and no group is ever collected.

Defined cases: a null text has no words; texts shorter than a window lose nothing; rows
that repeat an id are the same document, so they do not remove each other's words, while
repeats within each are removed; a null id is a document that starts before all others;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, prefix_hash, span_hash, utf8, window_hashes, word_spans

WIDTH, ANCHOR, PERIOD, COVER = 20, 8, 13, (0, 1, 3, 9)
#: Bytes of text for each part that hashes are dealt to, about.
PART_BYTES = 16 << 20
#: Bytes of text that a map task looks at together.
CHUNK_BYTES = 16 << 20
#: Most parts that a task deals its blocks to at once.  Beyond, they are dealt twice, to the root of their number each
#: time: blocks grow as the power 1.5 of the input, not as its square.
FAN = 1024
_ON_COVER = np.isin(np.arange(PERIOD), COVER)
_LOWEST = -(1 << 63)
#: Columns of an anchor (lower 32 bits, next 16, place, whether it asks) and of a window (64 bits, 32 more, place).
_ANCHORS, _WINDOWS = ("<u4", "<u2", "<u4", "<u1"), ("<u8", "<u4", "<u4")
_BLOCKS = "part int, block binary"
_ANSWERS = "id long, print long, at binary"


def _hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a text, starts and ends of its words, and the words' hashes."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_spans(data)
    return data, start, end, span_hash(prefix_hash(data), start, end) if len(start) else np.zeros(0, np.uint64)


def _first_seen(*keys: np.ndarray) -> np.ndarray:
    """Which entries are the first of their key in an array."""
    n = len(keys[0])
    order = np.lexsort((np.arange(n), *keys[::-1]))
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], 0)
    first = np.zeros(n, bool)
    first[order[new]] = True
    return first


def anchor_positions(n_words: int) -> np.ndarray:
    """Where the anchors of a text of n words start: positions on the cover."""
    at = np.arange(max(0, n_words - ANCHOR + 1))
    return at[_ON_COVER[at % PERIOD]] if n_words >= WIDTH else at[:0]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as one block; decoded by ``_unpack`` with the same types."""
    return np.int64(len(arrays[0])).tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(block, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(block, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _ways(parts: int, fan: int) -> tuple[int, int]:
    """How many parts blocks are dealt to at first, and how many each of those is dealt to then."""
    if parts <= fan:
        return parts, 1
    root = int(parts**0.5) + 1
    return root, -(-parts // root)


def _home(ids: np.ndarray, first: int, then: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each id, at first and then."""
    h = mix64(ids.view(np.uint64))
    return ((h >> np.uint64(32)) % np.uint64(first)).astype(np.int64), ((h & np.uint64(0xFFFFFFFF)) % np.uint64(then)).astype(np.int64)


def _answer(ids: np.ndarray, prints: np.ndarray, at: np.ndarray, first: int):
    """Answers as blocks again, dealt by id: a row for each part, however many texts it is about."""
    import pyarrow as pa

    part = _home(ids, first, 1)[0]
    order = np.lexsort((at, prints, ids, part))
    ids, prints, at, part = ids[order], prints[order], at[order].astype(np.uint32), part[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])
    owner = np.cumsum(new) - 1
    rows, blocks = [], []
    for here in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(part)) + 1) if len(ids) else []:
        rows.append(int(part[here[0]]))
        blocks.append(_block(b"\x01", ids[new], prints[new], owner[here], [at[here]]))
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block"])


def _merge(batches):
    """A row (id, print, packed positions) for each text that the blocks of a part answer."""
    import pyarrow as pa

    found = [_read_block(block, "<u4") for batch in batches for block in batch.column(1).to_pylist()]
    if found:
        ids, prints, at = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((at, prints, ids))
        ids, prints, at = ids[order], prints[order], at[order]
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])) + 1
        heads = np.concatenate(([0], cut)).astype(int)
        packed = [x.tobytes() for x in np.split(at, cut)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[heads], pa.int64()), pa.array(prints[heads], pa.int64()), pa.array(packed, pa.binary())], names=["id", "print", "at"])


def _block(mark: bytes, ids: np.ndarray, prints: np.ndarray, owner: np.ndarray, columns: list[np.ndarray]) -> bytes:
    """The owners that occur, then for each entry its owner's number and its columns."""
    names, index = np.unique(owner, return_inverse=True)
    return mark + _pack(ids[names], prints[names]) + _pack(index.astype(np.uint32), *columns)


def _read_block(block: bytes, *kinds: str) -> list[np.ndarray]:
    """ids and prints of the entries of a block, then their columns."""
    ids, prints = _unpack(block[1:], "<i8", "<i8")
    index, *rest = _unpack(block[9 + 16 * len(ids) :], "<u4", *kinds)
    return [ids[index], prints[index], *rest]


def _emit(parts: int, ids: np.ndarray, prints: np.ndarray, keys: np.ndarray, owner: np.ndarray, columns: list[np.ndarray], echo: tuple[np.ndarray, np.ndarray], salt: int):
    """Blocks of one batch: entries dealt by the upper bits of their key; echoes, which are answers already, dealt by salt."""
    import pyarrow as pa

    rows, blocks = [], []
    part = ((keys >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((owner, part))  # owners in order pack better
    for rows_of in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
        rows.append(int(part[rows_of[0]]))
        blocks.append(_block(b"\x00", ids, prints, owner[rows_of], [c[rows_of] for c in columns]))
    if len(echo[0]):
        rows.append((salt + int(ids[echo[0][0]])) % parts)
        blocks.append(_block(b"\x01", ids, prints, echo[0], [echo[1]]))
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blocks, pa.binary())], names=["part", "block"])


def _dealt_again(first: int, then: int, kinds: tuple[str, ...], middle):
    """Blocks of a part dealt to the ``then`` parts it consists of: entries by the bits that ``middle`` gives of their columns, answers by id."""

    def entries(mark: bytes, blocks: list[bytes], parts: list[int]):
        columns = list(map(np.concatenate, zip(*(_read_block(b, *(kinds if mark == b"\x00" else ("<u4",))) for b in blocks), strict=True)))
        ids, prints, rest = columns[0], columns[1], columns[2:]
        part = np.repeat(parts, [len(_unpack(b[9 + 16 * int(np.frombuffer(b[1:9], np.int64)[0]) :], "<u4")[0]) for b in blocks])
        fine = (middle(*rest) % np.uint64(then)).astype(np.int64) if mark == b"\x00" else _home(ids, first, then)[1]
        part = part * then + fine
        # texts are named once a block
        order = np.lexsort((prints, ids, part))
        ids, prints, part, rest = ids[order], prints[order], part[order], [c[order] for c in rest]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])
        owner = np.cumsum(new) - 1
        for here in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(part)) + 1) if len(ids) else []:
            yield int(part[here[0]]), _block(mark, ids[new], prints[new], owner[here], [c[here] for c in rest])

    def run(batches):
        import pyarrow as pa

        held = {b"\x00": ([], []), b"\x01": ([], [])}

        def flush():
            made = [x for mark, (blocks, parts) in held.items() if blocks for x in entries(mark, blocks, parts)]
            for blocks, parts in held.values():
                blocks.clear()
                parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.binary())], names=["part", "block"])

        size = 0
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks, parts = held[block[:1]]
                blocks.append(block)
                parts.append(part)
                size += len(block)
                if size > CHUNK_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    return run


def _chunks(batches, columns: int):
    """Columns (id, print, text, ...) of batches, gathered until they hold a few megabytes."""
    held, size = [[] for _ in range(columns)], 0
    for batch in batches:
        ids = batch.column(0).fill_null(_LOWEST).to_pylist()
        more = [batch.column(i).to_pylist() for i in range(3, columns)]
        for row in zip(ids, batch.column(1).to_pylist(), utf8(batch.column(2)), *more, strict=True):
            for c, v in zip(held, row, strict=True):
                c.append(v)
            size += len(row[2] or b"")
            if size > CHUNK_BYTES:
                yield held
                held, size = [[] for _ in range(columns)], 0
    if held[0]:
        yield held


def _gather(lists: list[list[np.ndarray]], kinds: list[str]) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, k), *x]) for x, k in zip(lists, kinds, strict=True)]


def _anchors(parts: int):
    """Anchors of texts, each hash once a batch; those that a batch repeats are echoed."""

    def run(batches):
        for n, (ids, prints, texts) in enumerate(_chunks(batches, 3)):
            keys, owners, places = [], [], []
            for i, text in enumerate(texts):
                words = _hashes(text or b"")[3]
                at = anchor_positions(len(words))
                if len(at):
                    own, first = np.unique(window_hashes(words, ANCHOR)[at], return_index=True)
                    keys.append(own)
                    owners.append(np.full(len(own), i, np.int64))
                    places.append(at[first].astype(np.uint32))
            key, owner, place = _gather([keys, owners, places], ["u8", "i8", "u4"])
            _, first, count = np.unique(key, return_index=True, return_counts=True)
            alone = np.zeros(len(key), bool)
            alone[first[count == 1]] = True
            # a key that the batch repeats is sent once, for others to meet, and needs no answer
            asks = alone[first].astype(np.uint8)
            # 48 bits of a key will do beside the part it is dealt to: a chance match costs a window judged in vain
            low, high = key[first].astype(np.uint32), (key[first] >> np.uint64(32)).astype(np.uint16)
            yield _emit(parts, np.array(ids, np.int64), np.array(prints, np.int64), key[first], owner[first], [low, high, place[first], asks], (owner[~alone], place[~alone]), n)

    return run


def _repeated(parts: int):
    """Positions of anchors that occur again, by text."""

    def run(batches):
        sent, found = [], []
        for batch in batches:
            for block in batch.column(1).to_pylist():
                if block[0]:
                    found.append(_read_block(block, "<u4"))
                else:
                    sent.append(_read_block(block, *_ANCHORS))
        if sent:
            ids, prints, low, high, place, asks = map(np.concatenate, zip(*sent, strict=True))
            key = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
            _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
            again = (count[inverse] > 1) & (asks == 1)
            found.append([ids[again], prints[again], place[again]])
        if found:
            yield _answer(*(np.concatenate(x) for x in zip(*found, strict=True)), parts)

    return run


def candidate_windows(words: np.ndarray, answered: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text that hold an anchor which occurs again.

    Of an anchor that a text holds more than once only the first place was asked about;
    its answer counts for all of them.
    """
    n, at = len(words) - WIDTH + 1, anchor_positions(len(words))
    if n <= 0 or not len(answered):
        return np.zeros(0, np.int64)
    own = window_hashes(words, ANCHOR)
    at = at[np.isin(own[at], own[answered[answered < len(own)]])]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(0, at - (WIDTH - ANCHOR)), 1)
    np.add.at(edge, np.minimum(n, at + 1), -1)
    return np.flatnonzero(np.cumsum(edge)[:n] > 0)


def _flat(answer: bytes | None) -> np.ndarray:
    return np.frombuffer(answer or b"", "<u4")


def _two_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return window_hashes(words, WIDTH), (window_hashes(mix64(words), WIDTH, 0x5BD1E995) >> np.uint64(32)).astype(np.uint32)


def _earlier(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each window, the smallest id that has it."""
    order = np.lexsort((ids, b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    lowest = np.empty_like(ids)
    lowest[order] = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
    return lowest


def _windows(parts: int):
    """Candidate windows, each once a text; those that an earlier text of the batch has are echoed."""

    def run(batches):
        for n, (ids, prints, texts, answers) in enumerate(_chunks(batches, 4)):
            lists = [[], [], [], []]
            for i, (text, answer) in enumerate(zip(texts, answers, strict=True)):
                words = _hashes(text or b"")[3] if answer else np.zeros(0, np.uint64)
                at = candidate_windows(words, _flat(answer))
                if len(at):
                    a, b = (x[at] for x in _two_hashes(words))
                    first = _first_seen(a, b)
                    for c, v in zip(lists, (a[first], b[first], np.full(int(first.sum()), i, np.int64), at[first].astype(np.uint32)), strict=True):
                        c.append(v)
            a, b, owner, place = _gather(lists, ["u8", "u4", "i8", "u4"])
            known, names = np.array(ids, np.int64), np.array(prints, np.int64)
            later = known[owner] > _earlier(known[owner], a, b)
            yield _emit(parts, known, names, a[~later], owner[~later], [a[~later], b[~later], place[~later]], (owner[later], place[later]), n)

    return run


def _later(parts: int):
    """Positions of windows that start in a document with a smaller id too, by text."""

    def run(batches):
        sent, found = [], []
        for batch in batches:
            for block in batch.column(1).to_pylist():
                if block[0]:
                    found.append(_read_block(block, "<u4"))
                else:
                    sent.append(_read_block(block, *_WINDOWS))
        if sent:
            ids, prints, a, b, place = map(np.concatenate, zip(*sent, strict=True))
            later = ids > _earlier(ids, a, b)
            found.append([ids[later], prints[later], place[later]])
        if found:
            yield _answer(*(np.concatenate(x) for x in zip(*found, strict=True)), parts)

    return run


def covered(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which words lie in a window that starts at one of starts, or repeats an earlier one of this text."""
    n = len(words)
    edge = np.zeros(n + 1, np.int64)
    if n >= WIDTH:
        a, b = _two_hashes(words)
        first = _first_seen(a, b)
        # all places of a window go with its first place
        removed = ~first
        starts = starts.astype(np.int64)
        removed[starts[starts <= n - WIDTH]] = True
        at = np.flatnonzero(removed)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WIDTH, -1)
    return np.cumsum(edge)[:n] > 0


def _result(keep_text: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, answer, copy in zip(utf8(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                data, start, end, words = _hashes(text or b"")
                gone = np.full(len(words), len(words) >= WIDTH) if copy else covered(words, _flat(answer))
                kept = b" ".join(text[s:e] for s, e in zip(start[~gone].tolist(), end[~gone].tolist(), strict=True)) if len(words) else b""
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            arrays = [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, part_bytes: int = PART_BYTES, fan: int = FAN) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of each row; kept only if keep_text."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-total // part_bytes))

    first, then = _ways(parts, fan)

    def placed(blocks: DataFrame, kinds: tuple[str, ...], middle) -> DataFrame:
        """Blocks in the partition of their part."""
        blocks = blocks.repartitionById(first, F.col("part"))
        return blocks if then == 1 else blocks.mapInArrow(_dealt_again(first, then, kinds, middle), _BLOCKS).repartitionById(first * then, F.col("part"))

    def dealt(blocks: DataFrame, reduce, kinds: tuple[str, ...], middle) -> DataFrame:
        answers = placed(blocks, kinds, middle).mapInArrow(reduce(first), _BLOCKS)
        return placed(answers, kinds, middle).mapInArrow(_merge, _ANSWERS)

    def joined(left: DataFrame, known: DataFrame, name: str) -> DataFrame:
        """left with the column ``name`` of the texts that known has; texts stay where their exchange put them."""
        known = known.select(F.col("id").alias("_id"), F.col("print").alias("_print"), name)
        same = (F.coalesce("id", F.lit(_LOWEST)) == F.col("_id")) & (F.col("print") == F.col("_print"))
        return left.join(known, same, "left").drop("_id", "_print")

    # texts that a smaller id has word for word go whole: neither they nor, for their sake, the first are looked into
    keys = rows.select(F.coalesce("id", F.lit(_LOWEST)).alias("id"), "print", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    firsts = keys.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").withColumnRenamed("digest", "_digest")
    firsts = materialize(firsts, "firsts")  # a join of its own, so that AQE may split a digest that many rows share
    copies = keys.join(firsts, F.col("digest") == F.col("_digest")).where("id > first").select("id", "print").distinct().withColumn("copy", F.lit(True))
    marked = joined(rows, copies, "copy")
    fresh = marked.where("copy IS NULL")
    again = dealt(fresh.select("id", "print", "text").mapInArrow(_anchors(first), _BLOCKS), _repeated, _ANCHORS, lambda low, high, *_: high.astype(np.uint64))
    later = dealt(joined(fresh, again, "at").select("id", "print", "text", "at").mapInArrow(_windows(first), _BLOCKS), _later, _WINDOWS, lambda a, *_: (a >> np.uint64(32)) & np.uint64(0xFFFF))
    kinds = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    found = joined(marked, later, "at").select("id", "print", "text", "at", "copy")
    return found.mapInArrow(_result(keep_text), kinds)


def op8_substrings(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages that appear earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs, keep_text=False).drop("kept")
