"""Ranks and score ranges of ``key, member, score`` tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.session import ensure_checkpoint_dir

# A key with more rows than this is ranked over several tasks.
HOT_ROWS = 20_000_000
# Up to this many rows per key Spark itself cuts a row-number filter before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
CUT_ROWS = 1000


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    descending: bool = False,
    name: str = "position",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """0-based position of each row in its key's order.

    Keys are counted first (one column, combined map-side). Ordinary keys use one window.
    Rows of hot keys are range-partitioned by (key, order), so a key spans as many tasks as
    it needs; positions inside a part are then shifted by the rows of the parts before it.
    """
    window = W.partitionBy(*keys).orderBy(*[F.desc(c) if descending else F.asc(c) for c in order])
    hot = df.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
    # At most total_rows / hot_rows keys.
    hot_keys = hot.collect()
    simple = (F.row_number().over(window) - 1).cast("bigint").alias(name)
    if not hot_keys:
        return df.select("*", simple)
    spark = df.sparkSession
    hot = F.broadcast(spark.createDataFrame(hot_keys, hot.schema))
    cold_part = df.join(hot, list(keys), "left_anti").select("*", simple)
    return cold_part.unionByName(_ranged_positions(df.join(hot, list(keys), "left_semi"), keys, order, descending, name))


def _ranged_positions(df, keys, order, descending, name):
    columns = df.columns
    sort = [F.desc(c) if descending else F.asc(c) for c in order]
    ensure_checkpoint_dir(df.sparkSession)
    # The parts are read twice below and must be the same both times, also after a lost
    # executor, so they are written to the shared folder.
    parts = (
        df.repartitionByRange(*keys, *sort).withColumn("_part", F.spark_partition_id()).checkpoint()
    )
    sizes = parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    local = F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*sort)) - 1
    numbered = parts.withColumn("_local", local)
    return numbered.join(offsets, [*keys, "_part"]).select(
        *columns, (F.col("_local") + F.col("_offset")).cast("bigint").alias(name)
    )


def slice_positions(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    start: int,
    end: int,
    name: str,
    descending: bool = False,
    **options,
) -> DataFrame:
    """Rows at positions ``start..end`` of each key's order (inclusive, negatives from the end).

    A range that lies at one end needs only that end of each key: the row-number filter cuts
    every partition before the shuffle. Only a range from one end to the other ranks all rows.
    """

    def ordering(reverse):
        return [F.desc(c) if reverse else F.asc(c) for c in order]

    if 0 <= start and 0 <= end < CUT_ROWS:
        window = W.partitionBy(key).orderBy(*ordering(descending))
        ranked = df.withColumn("_n", F.row_number().over(window))
        return ranked.filter((F.col("_n") <= end + 1) & (F.col("_n") > start)).withColumn(
            name, (F.col("_n") - 1).cast("bigint")
        ).drop("_n")
    if -CUT_ROWS <= start < 0 and end < 0:
        window = W.partitionBy(key).orderBy(*ordering(not descending))
        ranked = df.withColumn("_n", F.row_number().over(window))
        kept = ranked.filter((F.col("_n") <= -start) & (F.col("_n") >= -end))
        sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
        return (
            kept.join(sizes, key).withColumn(name, (F.col("_size") - F.col("_n")).cast("bigint")).drop("_n", "_size")
        )
    ranked = positions(df, [key], order, descending=descending, name="_n", **options)
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    lo = F.lit(start) if start >= 0 else F.col("_size") + start
    hi = F.lit(end) if end >= 0 else F.col("_size") + end
    return (
        ranked.join(sizes, key)
        .filter((F.col("_n") >= lo) & (F.col("_n") <= hi))
        .withColumnRenamed("_n", name)
        .drop("_size")
    )


# ---- writes


def upsert_scores(scores: DataFrame) -> DataFrame:
    """Last score per member of ``key, member, score, seq`` writes."""
    return scores.groupBy("key", "member").agg(F.max_by("score", "seq").alias("score"))


def remove_members(scores: DataFrame, removals: DataFrame) -> DataFrame:
    return scores.join(removals.select("key", "member").distinct(), ["key", "member"], "left_anti")


def increment_scores(scores: DataFrame, deltas: DataFrame) -> DataFrame:
    both = scores.select("key", "member", "score").unionByName(
        deltas.select("key", "member", F.col("delta").alias("score"))
    )
    return both.groupBy("key", "member").agg(F.sum("score").alias("score"))


# ---- reads


def rank(scores: DataFrame, descending: bool = False, **options) -> DataFrame:
    """0-based rank per key; equal scores order by member."""
    return positions(scores, ["key"], ["score", "member"], descending, "rank", **options)


def top_range(scores: DataFrame, start: int, end: int, **options) -> DataFrame:
    """Members at descending ranks ``start..end`` (inclusive, negatives from the end)."""
    order = ["score", "member"]
    return slice_positions(scores, "key", order, start, end, "rank", descending=True, **options)


def score_range(scores: DataFrame, high: float, low: float) -> DataFrame:
    """Rows with ``low <= score <= high`` (the filter reaches the scan)."""
    return scores.filter(F.col("score").between(low, high))


def descending_order(scores: DataFrame) -> DataFrame:
    return scores.orderBy("key", F.desc("score"), F.desc("member"))


def count_in_range(scores: DataFrame, low: float, high: float) -> DataFrame:
    """Per key: members in all, and members in the score range."""
    inside = F.col("score").between(low, high)
    return scores.groupBy("key").agg(
        F.count(F.lit(1)).alias("cardinality"), F.count(F.when(inside, 1)).alias("in_range")
    )


def scores_of(scores: DataFrame, asked: DataFrame) -> DataFrame:
    """Score of each asked ``key, member``, null when absent."""
    return asked.select("key", "member").join(scores, ["key", "member"], "left")


def remove_by_rank(scores: DataFrame, start: int, end: int, **options) -> DataFrame:
    """Drop ascending ranks ``start..end`` (inclusive, negatives from the end)."""
    order = ["score", "member"]
    doomed = slice_positions(scores, "key", order, start, end, "rank", **options)
    return remove_members(scores, doomed)


def remove_by_score(scores: DataFrame, low: float, high: float) -> DataFrame:
    return scores.filter(~F.coalesce(F.col("score").between(low, high), F.lit(False)))
