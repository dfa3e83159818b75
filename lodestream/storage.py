"""What outlives a task: intermediate tables in the folder that driver and executors share, and folders that are replaced as a whole."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI.

    It is the session's ``spark.checkpoint.dir``.  Only where that is unset, and only
    in local mode, a folder under /tmp/checkpoints takes its place.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        found = "file://" + tempfile.mkdtemp(dir="/tmp/checkpoints")
        context.setCheckpointDir(found)
    return found if ":" in found.split("/")[0] else "file://" + os.path.abspath(found)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(df: DataFrame) -> None:
    """Delete the files that ``materialize`` wrote for df, once nothing reads them any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path, fs = file_system(df.sparkSession, folder)
        fs.delete(path, True)


def free_name(base: str, *taken: list[str]) -> str:
    """base, lengthened until it is none of the names taken, in any case."""
    used = {n.lower() for names in taken for n in names}
    while base.lower() in used:
        base += "_"
    return base


def swap(spark: SparkSession, path: str, new: str) -> None:
    """Put the whole folder ``new`` in the place of ``path``, so that a crash at any point leaves one of the two.

    A note beside the folder says what is to take its place; it appears by one rename,
    which is the commit.  Whoever finds the note finishes the swap (``settle``).
    """
    (note, fs), (hidden, _) = file_system(spark, f"{path}.swap"), file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(hidden)
    out.write(bytearray(new.encode()))
    out.close()
    fs.rename(hidden, note)
    settle(spark, path)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a swap that was committed but not carried out; without one, nothing."""
    note, fs = file_system(spark, f"{path}.swap")
    if not fs.exists(note):
        return
    stream = fs.open(note)
    new = bytes(stream.readAllBytes()).decode()
    stream.close()
    at, (fresh, _) = file_system(spark, path)[0], file_system(spark, new)
    if fs.exists(fresh):  # else it has been renamed already
        fs.delete(at, True)
        fs.rename(fresh, at)
    fs.delete(note, False)
