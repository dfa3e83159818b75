"""Helpers that every training-data operator uses: shared storage, words, hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..storage import discard, free_name, fresh_path, materialize, shared_dir

__all__ = ["WORD", "discard", "free_name", "fresh_path", "materialize", "mix64", "n_words", "open_fs", "prefix_hash", "shared_dir", "span_hash", "utf8", "window_hashes", "word_hashes", "word_spans"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def open_fs(uri: str):
    """The pyarrow filesystem of a URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def n_words(text: Column) -> Column:
    """Words of a text, as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2 ** 64; kept, as texts ask for it again and again."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over bytes; ``span_hash`` takes the hash of any span from it."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span [start, end): equal bytes have equal hashes wherever they stand."""
    inverse = _powers(_INVERSE, len(prefix))
    return mix64((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a UTF-8 text (as bytes) start and end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate(([0], edge))
    if word[-1]:
        edge = np.concatenate((edge, [len(data)]))
    return edge[0::2], edge[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, in order."""
    data = np.frombuffer(text, np.uint8)
    start, end = word_spans(data)
    return span_hash(prefix_hash(data), start, end) if len(start) else np.zeros(0, np.uint64)


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``width`` words, from the words' hashes, by doubling."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    done, out, power, step = 0, None, words ^ np.uint64(seed), 1
    while step <= width:
        if width & step:
            part = power[done : done + n]
            out = mix64(part) if out is None else mix64(out * np.uint64(0x9FB21C651E98DF25) + part)
            done += step
        if step * 2 <= width:
            power = mix64(power[:-step] * np.uint64(0xD6E8FEB86659FD93) + power[step:])
        step *= 2
    return out


def utf8(column) -> list[bytes | None]:
    """A string column of a pyarrow batch as UTF-8 bytes."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()
