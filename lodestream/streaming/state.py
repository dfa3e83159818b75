"""Streaming forms of the stateful operators: running counts, breakers, memos with a lifetime, due postings.

Clocks are event times: every row carries its own, so replays agree with the first run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..storage import fresh_path


def status_counts(rows: DataFrame, status: str) -> DataFrame:
    """Counts per status, kept up to date: the complete-mode form of an audit that polls."""
    return rows.groupBy(status).agg(F.count("*").alias("n"))


def windowed_counts(rows: DataFrame, time: str, status: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per status and window of event time; rows later than the watermark are left out."""
    return rows.withWatermark(time, late).groupBy(F.window(time, width), status).agg(F.count("*").alias("n"))


def _ordered(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(batches)).sort_values(["ts", "event_id"], kind="stable")


def breaker(rows: DataFrame, failures: int = 5, bench_seconds: int = 300) -> DataFrame:
    """(key, ts, event_id, allowed) from (key, ts, event_id, failed): after ``failures`` in a row a key is benched.

    A row while the key is benched is not allowed and changes nothing; a success resets.
    """
    out, state = "key string, ts timestamp, event_id long, allowed boolean", "run int, until timestamp"

    def step(key, batches, memory: GroupState):
        run, until = memory.get if memory.exists else (0, None)
        until = None if until is None or pd.isna(until) else pd.Timestamp(until)
        rows, said = _ordered(batches), []
        for ts, failed in zip(rows["ts"], rows["failed"], strict=True):
            allowed = until is None or ts >= until
            said.append(allowed)
            if not allowed:
                continue
            run = run + 1 if failed else 0
            until = ts + pd.Timedelta(seconds=bench_seconds) if run >= failures else None
            run = 0 if run >= failures else run
        memory.update((int(run), None if until is None else until.to_pydatetime()))
        yield pd.DataFrame({"key": key[0], "ts": rows["ts"].to_numpy(), "event_id": rows["event_id"].to_numpy(), "allowed": said})

    return rows.groupBy("key").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def dead_hosts(rows: DataFrame, failures: int = 3, memo_seconds: int = 900) -> DataFrame:
    """(key, ts, event_id, skipped): a host that failed ``failures`` times, each within the memo of the last, is skipped until it runs out."""
    out, state = "key string, ts timestamp, event_id long, skipped boolean", "n int, last timestamp"

    def step(key, batches, memory: GroupState):
        n, last = memory.get if memory.exists else (0, None)
        last = None if last is None or pd.isna(last) else pd.Timestamp(last)
        rows, said = _ordered(batches), []
        for ts, failed in zip(rows["ts"], rows["failed"], strict=True):
            if last is not None and (ts - last).total_seconds() > memo_seconds:
                n, last = 0, None
            skip = n >= failures
            said.append(skip)
            if not skip:
                n, last = (n + 1, ts) if failed else (0, None)
        memory.update((int(n), None if last is None else last.to_pydatetime()))
        yield pd.DataFrame({"key": key[0], "ts": rows["ts"].to_numpy(), "event_id": rows["event_id"].to_numpy(), "skipped": said})

    return rows.groupBy("key").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def ttl_cache(rows: DataFrame, positive_seconds: int = 3600, negative_seconds: int = 300) -> DataFrame:
    """(key, ts, event_id, hit): whether a look-up finds a value that has not run out; found values live longer than failures."""
    out, state = "key string, ts timestamp, event_id long, hit boolean", "until timestamp"

    def step(key, batches, memory: GroupState):
        until = memory.get[0] if memory.exists else None
        until = None if until is None or pd.isna(until) else pd.Timestamp(until)
        rows, said = _ordered(batches), []
        for ts, failed in zip(rows["ts"], rows["failed"], strict=True):
            hit = until is not None and ts < until
            said.append(hit)
            if not hit:
                until = ts + pd.Timedelta(seconds=negative_seconds if failed else positive_seconds)
        memory.update((None if until is None else until.to_pydatetime(),))
        yield pd.DataFrame({"key": key[0], "ts": rows["ts"].to_numpy(), "event_id": rows["event_id"].to_numpy(), "hit": said})

    return rows.groupBy("key").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def resume(new: DataFrame, path: str, key: str, checkpoint: str):
    """A query that appends to path the rows of a stream whose key it does not hold yet; a batch that is replayed adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        try:
            done = spark.read.parquet(path)
        except Exception as fault:
            if "PATH_NOT_FOUND" not in str(fault) and "UNABLE_TO_INFER_SCHEMA" not in str(fault):
                raise
        else:
            rows = rows.join(done.select(key), key, "left_anti")
        rows.write.mode("append").parquet(path)

    return new.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def drain(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that a stream has to say about what is there now, written below the shared folder and read back."""
    spark = df.sparkSession
    place = fresh_path(spark, name)
    if mode == "append":
        query = df.writeStream.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).format("parquet").option("path", f"{place}/out").start()
    else:  # each trigger replaces the whole result
        query = df.writeStream.option("checkpointLocation", f"{place}/state").trigger(availableNow=True).outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{place}/out")).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{place}/out")
