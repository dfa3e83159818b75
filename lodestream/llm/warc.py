"""A deterministic sharded WARC writer, and its reader.

Records are range-partitioned and sorted by key; the bounds come from a sample that the
keys' hashes choose, so equal tables give equal shards.  Each shard is written as
gzip-per-record files that roll at a compressed size.  A file is written under a
temporary name and renamed; the manifest, which Spark commits last, names the files that
count.  A retried task writes the same bytes to the same names.

Of records with equal payloads of at least ``revisit_from`` bytes, the one with the
smallest key is a response and the others are revisits that refer to it.

Defined cases: a null html is an empty payload; a null url leaves the target out; rows
that share key and payload with the smallest are all responses; a null key sorts first,
and is a revisit where a row with a key has its payload; rows that share a key, or have
none, are split over shards by their digests where they are more than one shard holds; an empty table writes no files
but a manifest, and reads back as no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, open_fs, utf8

REVISIT_FROM = 100
_LOWEST = -(1 << 63)
SHARD_BYTES = 32 << 20
ROLL_BYTES = 8 << 20
#: At most about this many keys are looked at to set the bounds of shards.
SAMPLE = 50_000
#: Fixed, as the tables hold no times: equal tables give equal archives.
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
_RECORDS = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def _record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{key}:{digest}')}>"


def _headers(fields: list[tuple[str, object]], version: str) -> bytes:
    return (version + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def _uri(url: str | None) -> str | None:
    """A url that can't end a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(key: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One record, compressed as a gzip member of its own; digests and lengths are computed anew."""
    http = _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))], "HTTP/1.1 200 OK")
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(key, digest)), ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", _record_id(first, digest) if revisit else None), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Key", key), ("X-Refers-To-Key", first if revisit else None), ("X-Target", None if url is None else json.dumps(url)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    return gzip_member(_headers(fields, "WARC/1.1") + block + b"\r\n\r\n")


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time or name, so equal bytes give equal bytes."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def _info(name: str) -> bytes:
    body = b"software: lodestream\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]
    return gzip_member(_headers(fields, "WARC/1.1") + body + b"\r\n\r\n")


class _Roller:
    """Writes the files of one shard; each gets its name when it is whole."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.fs, self.root = open_fs(root)
        self.shard, self.roll_bytes, self.number, self.done, self.parts, self.size, self.n = shard, roll_bytes, 0, [], [], 0, 0

    @property
    def name(self) -> str:
        return f"part-{self.shard:06d}-{self.number:05d}.warc.gz"

    def add(self, member: bytes) -> None:
        if self.n and self.size + len(member) > self.roll_bytes:
            self.close()
        if not self.parts:
            self.parts = [_info(self.name)]
            self.size = len(self.parts[0])
        self.parts.append(member)
        self.size += len(member)
        self.n += 1

    def close(self) -> None:
        if not self.n:
            return
        data, final = b"".join(self.parts), f"{self.root}/{self.name}"
        hidden = f"{self.root}/.{self.name}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(hidden) as out:
            out.write(data)
        self.fs.move(hidden, final)
        self.done.append((self.shard, self.name, self.n, len(data), hashlib.sha256(data).hexdigest()))
        self.number, self.parts, self.size, self.n = self.number + 1, [], 0, 0


def _writer(root: str, roll_bytes: int):
    def write(batches):
        import pyarrow as pa

        roller, key, firsts, done = None, (), {}, []
        for batch in batches:
            shards, keys, urls, digests, given = (batch.column(c).to_pylist() for c in ("shard", "key", "url", "digest", "first"))
            for shard, k, url, digest, first, payload in zip(shards, keys, urls, digests, given, utf8(batch.column("html")), strict=True):
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller = _Roller(root, shard, roll_bytes)
                if key != (k,):
                    key, firsts = (k,), {}
                if first is not None:  # a decision, which sorts before the records of its key
                    firsts[digest] = first
                    continue
                roller.add(record(k, url, payload or b"", digest, firsts.get(digest), digest in firsts))
        if roller:
            roller.close()
            done += roller.done
        columns = list(zip(*done, strict=True)) or [[], [], [], [], []]
        types = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["shard", "file", "records", "bytes", "sha256"])

    return write


def _tie(digest: Column) -> Column:
    """What splits rows of one key."""
    return F.xxhash64(digest)


def _bounds(keys: DataFrame, shard_bytes: int, sample: int) -> tuple[list[tuple[int, int]], int]:
    """Keys and ties at which shards begin, from a sample by hash whose size is bounded; and the number of shards."""
    step = max(1, -(-keys.count() // sample))
    at = keys.select(F.coalesce("key", F.lit(_LOWEST)).alias("key"), _tie(F.col("digest")).alias("tie"), "n")
    found = at.where(F.pmod(F.xxhash64("key", "tie"), F.lit(step)) == 0).groupBy("key", "tie").agg(F.sum("n").alias("n")).orderBy("key", "tie").collect()
    total = sum(r.n for r in found) * step
    shards, bounds, so_far = max(1, -(-total // shard_bytes)), [], 0
    for r in found:
        so_far += r.n * step
        if len(bounds) < shards - 1 and so_far * shards > total * (len(bounds) + 1):
            bounds.append((r.key, r.tie))
    return bounds, len(bounds) + 1


def _shard_of(bounds: list[tuple[int, int]]):
    """The shard of (key, tie): how many bounds are not above it."""
    import numpy as np

    keys, ties = (np.array([b[i] for b in bounds], "int64") for i in (0, 1))

    @F.pandas_udf("int")
    def shard_of(key, tie):
        import pandas as pd

        key, tie = key.to_numpy(), tie.to_numpy()
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        out = low.copy()
        for i in np.unique(low[low < high]).tolist():  # bounds of one key: the tie decides among them
            here = (low == i) & (high > i)
            out[here] += np.searchsorted(ties[i : high[here][0]], tie[here], "right")
        return pd.Series(out.astype("int32"))

    return shard_of


def write_archives(pages: DataFrame, root: str, key_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_from: int = REVISIT_FROM, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, sample: int = SAMPLE) -> DataFrame:
    """Write the pages below root; returns the manifest that was committed.

    The html is shuffled once.  Which rows are revisits is found on (key, digest) alone,
    by a minimum per digest with map-side partial minima, and sent to the writers as rows
    that sort before the records they are about.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(key_col).cast("long").alias("key"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("n", F.octet_length("html").cast("long"))
    keys = rows.select("key", "digest", "n")
    groups = keys.where(F.col("n") >= revisit_from).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("copies"))
    groups = groups.where((F.col("copies") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("g_digest"), "first")
    again = keys.join(groups, F.col("digest") == F.col("g_digest")).where(F.col("key").isNull() | (F.col("key") != F.col("first")))
    bounds, shards = _bounds(rows.select("key", "digest", "n"), shard_bytes, sample)
    shard = _shard_of(bounds)(F.coalesce(F.col("key"), F.lit(_LOWEST)), _tie(F.col("digest"))) if bounds else F.lit(0)
    decisions = again.select(shard.alias("shard"), "key", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "first")
    records = rows.select(shard.alias("shard"), "key", "url", "html", "digest", F.lit(None).cast("long").alias("first"))
    dealt = decisions.unionByName(records).repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "key", F.col("first").isNull(), "digest", "url")
    fs, path = open_fs(root)
    fs.create_dir(path, recursive=True)
    dealt.mapInArrow(_writer(root, roll_bytes), _MANIFEST).write.json(f"{root}/manifest")
    return dealt.sparkSession.read.schema(_MANIFEST).json(f"{root}/manifest")


def _members(stream, size: int = 1 << 16):
    """The members of a gzip stream, one after the other; it is read in pieces, so what follows a member's end is copied once and no more."""
    inflate, out, data = None, [], stream.read(size)
    while data:
        if inflate is None:
            inflate, out = zlib.decompressobj(31), []
        out.append(inflate.decompress(data))
        if inflate.eof:
            yield b"".join(out)
            data, inflate = inflate.unused_data, None
        else:
            data = b""
        data = data or stream.read(size)
    if inflate is not None:
        raise ValueError("the last member is cut off")


def _parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:]), rest


def _reader(root: str, digests_only: bool):
    def read(batches):
        import pyarrow as pa

        fs, path = open_fs(root)
        types = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())
        names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
        for batch in batches:
            for file in batch.column("file").to_pylist():
                out = []
                with fs.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for member in _members(stream):
                        fields, rest = _parse(member)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        block = rest[: int(fields["Content-Length"])]
                        if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
                            raise ValueError(f"{file}: the block of {fields['WARC-Record-ID']} is damaged")
                        http, payload = _parse(block)
                        digest, n = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
                        if fields["WARC-Type"] == "response":
                            digest, n = hashlib.sha256(payload).hexdigest(), len(payload)
                        key, first = fields.get("X-Key"), fields.get("X-Refers-To-Key")
                        url = json.loads(fields["X-Target"]) if "X-Target" in fields else None
                        kept = payload if fields["WARC-Type"] == "response" and not digests_only else None
                        out.append((key and int(key), url, fields["WARC-Type"], kept, n, digest, first and int(first)))
                columns = list(zip(*out, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return read


def read_archives(spark: SparkSession, root: str, digests_only: bool = False) -> DataFrame:
    """The records of every file that the manifest below root names, a task per few files.

    Digests are checked and computed anew from the payloads.  A revisit has no payload of
    its own; with digests_only no record brings its payload along.
    """
    files = spark.read.schema(_MANIFEST).json(f"{root}/manifest")
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # a lost task costs one shard's worth of reading, whatever the number of files
    tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))))
    return files.select("file").repartition(tasks).mapInArrow(_reader(root, digests_only), _RECORDS)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back from them."""
    root = fresh_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), root)
    return read_archives(spark, root, digests_only=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
