"""Order-safe relational operators: first and last per key, shards, resume, merges, coverage, audits.

Every operator whose result depends on order takes an ordinal column; none depends on the
order of files or partitions.  Tables of companies and postings are joined by plain
equi-joins: Spark broadcasts a side only where its size is known to be below the
session's threshold, and AQE splits keys that are skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import discard, free_name, materialize


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth")


def keep_last(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The last row of each key by its ordinal."""
    return keep_first(df, keys, [F.desc(ordinal)])


def keep_first_filled(df: DataFrame, key: Column, order: Sequence[Column | str]) -> DataFrame:
    """The first row of each derived key; rows whose key is blank go."""
    return keep_first(df.withColumn("__key", F.trim(key)).where(F.col("__key") != ""), ["__key"], order).drop("__key")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    """At most ``most`` rows per key, by an order of priority; tasks drop the rest before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where(F.col("__nth") <= most).drop("__nth")


def export_key(name: Column, website: Column) -> Column:
    norm = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.concat(norm(name), F.lit("|"), norm(website))


def resume_key(name: Column, website: Column) -> Column:
    return F.concat(name, F.lit("|"), website)


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_idx") -> DataFrame:
    """Rows numbered from 0 in a total order, without one task for all of them.

    Rows are range-partitioned by the order, sorted in their partition and written with
    their place in it, once: whatever else is asked of them (how many each partition
    holds, the rows themselves) comes from that table, so that two samplings or
    coalescings can't disagree.  What the partitions before a row's own hold, one row per
    partition, is added by a join that loses none.
    """
    key, place, part, before = (free_name(n, df.columns, [name]) for n in ("__order", "__place", "__part", "__before"))
    spread = df.withColumn(key, F.struct(*(c if isinstance(c, Column) else F.col(c) for c in order))).repartitionByRange(key)
    placed = materialize(spread.sortWithinPartitions(key).drop(key).withColumn(place, F.monotonically_increasing_id()), "numbered")
    at = F.shiftright(F.col(place), 33)  # the upper bits are the partition's number, the lower 33 the row's place in it
    sizes = placed.groupBy(at.alias(part)).agg(F.count("*").alias("__n"))
    sum_before = F.coalesce(F.sum("__n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col(part), sum_before.alias(before))
    numbered = placed.withColumn(part, at).join(offsets, part, "left")
    number = F.coalesce(F.col(before), F.raise_error(F.lit("a partition has no offset"))) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*(F.col(f"`{c}`") for c in df.columns if c != name), number.cast("long").alias(name))


def shard_interleave(df: DataFrame, index: int, count: int, ordinal: str = "row_idx") -> DataFrame:
    return df.where(F.pmod(F.col(ordinal), F.lit(count)) == index)


def shard_block(df: DataFrame, index: int, count: int, total: int, ordinal: str = "row_idx") -> DataFrame:
    """The index-th of ``count`` contiguous blocks of ceil(total / count) rows."""
    size = max(1, -(-total // count))
    return df.where((F.col(ordinal) >= index * size) & (F.col(ordinal) < (index + 1) * size))


def offset_limit(df: DataFrame, offset: int, limit: int | None, ordinal: str = "row_idx") -> DataFrame:
    """By ordinal, as a range: no sort and no single task."""
    kept = df.where(F.col(ordinal) >= offset)
    return kept if limit is None else kept.where(F.col(ordinal) < offset + limit)


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of todo whose key done doesn't hold."""
    return todo.join(done.select(F.col(key)).distinct(), key, "left_anti")


def merge_results(rows: DataFrame, results: DataFrame, key: str, ordinal: str, columns: Sequence[str]) -> DataFrame:
    """rows with columns overwritten by the last result of their key; a matched blank overwrites too."""
    last = keep_last(results, [key], ordinal).select(F.col(key).alias("__key"), F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = rows.join(last, F.col(key) == F.col("__key"), "left")
    new = lambda c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) if c in rows.columns else F.col(f"__{c}")
    return joined.select(*(new(c).alias(c) if c in columns else F.col(c) for c in rows.columns), *(new(c).alias(c) for c in columns if c not in rows.columns))


def purge(rows: DataFrame, status: str, gone: Sequence[str]) -> DataFrame:
    return rows.where(~F.coalesce(F.col(status), F.lit("")).isin(*gone))


def migrate(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns asked for, in order: new ones blank, others dropped."""
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def fan_out(df: DataFrame, key: str, counted: str) -> DataFrame:
    """(key, n): distinct values of counted per key that is neither null nor blank."""
    return df.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "").groupBy(key).agg(F.countDistinct(counted).alias("n"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """(column, n, percent) of each value; the total is a scalar subquery, so no task sees all values."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.withColumn("percent", 100.0 * F.col("n") / df.agg(F.count("*")).scalar())


def top_counts(df: DataFrame, column: str, most: int) -> DataFrame:
    """(column, n) of the most frequent values, ties by value; tasks drop all but ``most`` before the last one sorts."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(most)


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (n, and per column the number of values that are null or blank)."""
    return df.agg(F.count("*").alias("n"), *(F.count_if(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "").alias(c) for c in columns))


def group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """df with the number of rows that share its keys: counted before the shuffle and joined back, so a key that many rows share is no single task's."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return df.join(counts, list(keys), "left")


def union_rows(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, by name; a column that a part lacks is null there."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def union_first(parts: Sequence[DataFrame], key: str, name: str = "part") -> DataFrame:
    """Each key of the parts once, with the number (from 1) of the first part that has it."""
    return union_rows(*(p.select(key, F.lit(i).alias(name)) for i, p in enumerate(parts, 1))).groupBy(key).agg(F.min(name).alias(name))


def unpivot_metrics(totals: DataFrame) -> DataFrame:
    """One row of metrics as rows (metric, value)."""
    return totals.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in totals.columns))).alias("m")).select("m.*")


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """(median, n): the value at index n // 2 of the positive ones in ascending order; both null and 0 without any.

    Counts per value are range-partitioned by value and written; the partition that holds
    the middle is found from one sum per partition, and only its values are ordered.
    """
    counts = df.where(F.col(column) > 0).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    held = materialize(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "counts")
    sums = held.groupBy("part").agg(F.sum("c").alias("c")).orderBy("part").collect()
    total, before, middle = sum(r.c for r in sums), 0, None
    for r in sums:
        if before + r.c > total // 2:
            middle = r.part
            break
        before += r.c
    own = held.where(F.col("part") == F.lit(middle))
    upto = F.lit(before) + F.sum("c").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return own.select("v", upto.alias("upto")).where(F.col("upto") > total // 2).agg(F.min("v").alias("median"), F.lit(total).cast("long").alias("n"))


def positive_statistics(df: DataFrame, column: str) -> DataFrame:
    """One row (total, low, high, mean, n) of the positive values."""
    v = F.col(column)
    return df.where(v > 0).agg(F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.count("*").alias("n"))


def snapshot_delta(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, before, after, delta) of values whose counts differ."""
    a = before.groupBy(key).agg(F.count("*").alias("before"))
    b = after.groupBy(key).agg(F.count("*").alias("after"))
    both = a.join(b, key, "full_outer").fillna(0, ["before", "after"])
    return both.withColumn("delta", F.col("after") - F.col("before")).where("delta != 0")


def breaker_runs(events: DataFrame, key: str, order: Sequence[str], failed: Column, least: int) -> DataFrame:
    """Runs of at least ``least`` failures in a row per key: (key, run, n, first, last); by sums over resets."""
    w = Window.partitionBy(key).orderBy(*order)
    marked = events.withColumn("__failed", failed).withColumn("run", F.sum(F.when(F.col("__failed"), 0).otherwise(1)).over(w))
    runs = marked.where("__failed").groupBy(key, "run").agg(F.count("*").alias("n"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))
    return runs.where(F.col("n") >= least)


def within_cap(files: DataFrame, order: Sequence[Column | str], size: str, cap: int, key: str) -> DataFrame:
    """Newest files of each cache while their sizes stay within its cap."""
    total = F.sum(size).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return files.withColumn("__total", total).where(F.col("__total") <= cap).drop("__total")


def reachable(spark, edges: DataFrame, roots: DataFrame, levels: int) -> DataFrame:
    """(node, depth): breadth-first from roots along edges (src, dst), at most ``levels`` steps; each node at its least depth.

    Each front is written to the shared folder, so a level reads the fronts before it and
    computes none of them again; it ends with the first front that is empty.
    """
    fronts = [materialize(roots.select(F.col("node"), F.lit(0).alias("depth")).distinct(), "front")]
    for depth in range(1, levels + 1):
        seen = fronts[0]
        for f in fronts[1:]:
            seen = seen.unionByName(f)
        step = fronts[-1].join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        front = materialize(step.join(seen.select("node"), "node", "left_anti").select("node", F.lit(depth).alias("depth")), "front")
        if front.isEmpty():
            discard(front)
            break
        fronts.append(front)
    found = fronts[0]
    for f in fronts[1:]:
        found = found.unionByName(f)
    return found
