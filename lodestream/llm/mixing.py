"""Mixing sources to target weights, with DataFrame functions alone.

Words are counted once and summed per source (map-side partial sums, so a hot source
costs no more than another), targets are set on the table of sources, and each document
is then emitted floor(rate) times plus one Bernoulli copy whose probability is the
fraction.  The coin is an MD5 of seed and document id: reruns and retried tasks agree.

Coins drawn independently miss the target of a small source by chance.  So all coins of
a source are turned by the same angle, one of ``TURNS`` on the circle [0, 1): each coin
stays uniform, the words taken are the target on the average over all angles, and the
angle is used at which they come nearest to it.  The words for each angle are sums per
source, which tasks add up before the shuffle, like the sizes.

Defined cases: a null text has no words; a null source is a source of its own, after
all others; a source without words has target 0 and gives no copies; rows that repeat
an id share its coin; an empty table gives an empty result.  Other columns pass
``emit`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, materialize, n_words

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MAX_REPEAT = 3
SEED = "mix-1"
#: Angles at which the coins of a source are tried.
TURNS = 64


def coin(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed and key alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Shares by weight stop at max_repeat times a source's size and the excess is reshared
    until none is above.  Sorted by cap over weight, the capped sources are a prefix: with
    the caps before a source taken off and the rest shared by weight, the largest share
    per weight that its own source can hold is the one that all uncapped sources get.
    The windows here run over one row per source, never over documents.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    table = table.withColumn("_rank", rank).withColumn("_weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * max_repeat)
    table = table.withColumn("_ratio", F.col("_cap").cast("double") / F.col("_weight"))
    every = Window.partitionBy()
    upto = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = F.sum("source_size").over(every) - (F.sum("_cap").over(upto) - F.col("_cap"))
    weights_left = F.sum("_weight").over(every) - F.sum("_weight").over(upto) + F.col("_weight")
    table = table.withColumn("_share", rest.cast("double") / weights_left)
    level = F.max(F.when(F.col("_share") <= F.col("_ratio"), F.col("_share"))).over(every)
    table = table.withColumn("_level", level)
    target = F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight"))
    return table.select("source", "source_size", target.alias("target"))


def _turned(coin: Column, turn: Column | int) -> Column:
    """A coin turned by turn / TURNS of the circle; exact, as coins have 52 bits."""
    angle = coin + turn / F.lit(float(TURNS))
    return F.when(angle >= 1, angle - 1).otherwise(angle)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """(doc_id, source, size, coin) of each document, written once: texts are read for it a single time."""
    return materialize(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"), coin(F.col(f"`{id_col}`"), seed).alias("coin")), "sizes")


def source_rates(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, rate, turn) from rows (source, size, coin), a row per source."""
    table = source_targets(sized.select("source", "size"), weights, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    table = materialize(table.withColumn("rate", rate), "rates")
    part = table.select(F.col("source").alias("_source"), (F.col("rate") - F.floor("rate")).alias("_part"))
    each = sized.join(part, F.col("source").eqNullSafe(F.col("_source")))
    taken = [F.sum(F.when(_turned(F.col("coin"), k) < F.col("_part"), F.col("size")).otherwise(0)).alias(f"t{k}") for k in range(TURNS)]
    sums = each.groupBy("source").agg(*taken).select(F.col("source").alias("_source"), F.array(*(f"t{k}" for k in range(TURNS))).alias("_taken"))
    both = table.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
    wanted = F.col("target") - F.floor("rate") * F.col("source_size")
    misses = F.transform("_taken", lambda t, k: F.struct(F.abs(t - wanted).alias("miss"), k.alias("turn")))
    turned = both.select("source", "source_size", "target", "rate", F.coalesce(F.array_min(misses)["turn"], F.lit(0)).alias("turn"))
    return materialize(turned, "turns")  # written, so that Spark knows its size before it plans the join with all documents


def _copies(coin: Column, rate: Column, turn: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(_turned(coin, turn) < rate - whole, 1).otherwise(0)).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), a row per document.

    The join with the sources is an equi-join that Spark broadcasts only if the table of
    sources is below the session's threshold, and whose skew AQE splits otherwise.
    """
    sized = _sized(docs, id_col, text_col, source_col, seed)
    table = source_rates(sized, weights, max_repeat).withColumnRenamed("source", "_source")
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("_source")), "left")
    joined = joined.withColumn("copies", _copies(F.col("coin"), F.col("rate"), F.col("turn")))
    return joined.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the columns of docs, each row as often as the mix takes it."""
    own_source, own_rate, own_turn, own_copy = (free_name(n, docs.columns) for n in ("mix_source", "mix_rate", "mix_turn", "mix_copy"))
    table = source_rates(_sized(docs, id_col, text_col, source_col, seed), weights, max_repeat)
    table = table.select(F.col("source").alias(own_source), F.col("rate").alias(own_rate), F.col("turn").alias(own_turn))
    joined = docs.join(table, F.col(f"`{source_col}`").eqNullSafe(F.col(own_source)), "left")
    copies = _copies(coin(F.col(f"`{id_col}`"), seed), F.col(own_rate), F.col(own_turn))
    joined = joined.withColumn(own_copy, F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_mix(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with the words that the mix takes from it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM per_source),
ratios AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM weighed),
shares AS (
  SELECT *, CAST(sum(source_size) OVER () - (sum(cap) OVER upto - cap) AS DOUBLE)
            / CAST(sum(weight) OVER () - sum(weight) OVER upto + weight AS DOUBLE) AS share
  FROM ratios WINDOW upto AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
levels AS (SELECT *, max(CASE WHEN share <= ratio THEN share END) OVER () AS level FROM shares),
targets AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM levels),
rates AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5('mix-1:' || CAST(d.doc_id AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS coin
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
turned AS (
  SELECT source, source_size, target, rate, turn, size,
         CASE WHEN coin + turn / 64.0::DOUBLE >= 1 THEN coin + turn / 64.0::DOUBLE - 1 ELSE coin + turn / 64.0::DOUBLE END AS coin
  FROM rates, (SELECT CAST(range AS INTEGER) AS turn FROM range(64))),
tried AS (
  SELECT source, turn, any_value(target) - floor(any_value(rate)) * any_value(source_size) AS wanted,
         sum(CASE WHEN coin < rate - floor(rate) THEN size ELSE 0 END) AS taken
  FROM turned GROUP BY source, turn),
chosen AS (SELECT source, turn FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(taken - wanted), turn) AS rn FROM tried) WHERE rn = 1),
final AS (
  SELECT r.*, CASE WHEN coin + turn / 64.0::DOUBLE >= 1 THEN coin + turn / 64.0::DOUBLE - 1 ELSE coin + turn / 64.0::DOUBLE END AS turned
  FROM rates r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN turned < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM final
"""
