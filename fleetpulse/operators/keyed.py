"""Keyed tables: counters, upserts, conditional inserts, expiry, lists."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions.times import micros
from fleetpulse.operators.ranking import slice_positions


# ---- counters


def count_deltas(deltas: DataFrame, keys: Sequence[str], delta: str = "delta") -> DataFrame:
    """Net change per key of signed deltas."""
    return deltas.groupBy(*keys).agg(F.sum(delta).alias("value"))


def add_to_counters(counters: DataFrame, deltas: DataFrame, keys: Sequence[str], delta: str = "delta") -> DataFrame:
    """Counters after applying deltas; a missing counter starts at zero."""
    change = deltas.select(*keys, F.col(delta).alias("value"))
    return counters.select(*keys, "value").unionByName(change).groupBy(*keys).agg(F.sum("value").alias("value"))


# ---- upserts


def last_writes(updates: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "seq") -> DataFrame:
    """Last write per key for every column that was given (null = not given)."""
    at = F.struct(order) if isinstance(order, str) else F.struct(*order)
    skip = {*keys, *([order] if isinstance(order, str) else order)}
    fields = [c for c in updates.columns if c not in skip]
    return updates.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in fields])


def merge_fields(table: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "seq") -> DataFrame:
    """Field-level upsert of a wide table: only given fields change, new keys are added."""
    new = last_writes(updates, keys, order)
    fields = [c for c in table.columns if c not in keys]
    given = set(new.columns)
    joined = table.alias("t").join(new.alias("u"), list(keys), "full")
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"u.{c}"), F.col(f"t.{c}")).alias(c) if c in given else F.col(f"t.{c}") for c in fields],
        *[F.col(f"u.{c}") for c in new.columns if c not in keys and c not in fields],
    )


def merge_hash(table: DataFrame, updates: DataFrame) -> DataFrame:
    """Field-level upsert of a long hash ``key, field, value``; updates also carry ``seq``."""
    stored = table.select("key", "field", "value", F.lit(None).cast("bigint").alias("seq"))
    both = stored.unionByName(updates.select("key", "field", "value", "seq"))
    # stored rows sort in front of any update
    order = F.struct(F.col("seq").isNotNull(), "seq")
    return both.groupBy("key", "field").agg(F.max_by("value", order).alias("value"))


def delete_fields(table: DataFrame, removals: DataFrame) -> DataFrame:
    return table.join(removals.select("key", "field").distinct(), ["key", "field"], "left_anti")


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """Existing rows win; among new rows of one key the first wins."""
    fields = [c for c in table.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.col(order)).alias("_first"))
    new = first.select(*keys, *[F.col("_first")[c].alias(c) for c in fields])
    return table.unionByName(new.join(table.select(*keys), list(keys), "left_anti"))


def insert_all_if_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """Insert the batch only when none of its keys exists yet; of several rows of a key the last is inserted."""
    fields = [c for c in table.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), F.col(order)).alias("_last"))
    rows = last.select(*keys, *[F.col("_last")[c].alias(c) for c in fields])
    taken = rows.join(table.select(*keys), list(keys), "left_semi")
    # a single row, whatever the size of the tables
    verdict = taken.agg((F.count(F.lit(1)) == 0).alias("_free"))
    allowed = (
        rows.select(*table.columns, F.lit(True).alias("_free"))
        .join(F.broadcast(verdict), "_free", "left_semi")
        .drop("_free")
    )
    return table.unionByName(allowed)


def expire(table: DataFrame, written_at: str, as_of: Column, ttl: str) -> DataFrame:
    """Rows younger than the time to live."""
    age = F.unix_micros(as_of) - F.unix_micros(written_at)
    return table.filter(age < micros(ttl))


def delete_keys(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return table.join(keys.select(on).distinct(), on, "left_anti")


# ---- lists ``key, pos, value`` (head has the lowest pos)


def list_length(lists: DataFrame) -> DataFrame:
    return lists.groupBy("key").agg(F.count(F.lit(1)).alias("length"))


def push(lists: DataFrame, pushed: DataFrame, left: bool = False) -> DataFrame:
    """Append ``key, seq, value`` rows at the tail, or one by one at the head."""
    edge = lists.groupBy("key").agg((F.min("pos") if left else F.max("pos")).alias("_edge"))
    last = pushed.groupBy("key").agg((F.min("seq")).alias("_first"))
    offset = F.col("seq") - F.col("_first") + 1
    base = F.coalesce(F.col("_edge"), F.lit(0))
    placed = (
        pushed.join(last.join(edge, "key", "left"), "key")
        .select("key", (base - offset if left else base + offset).alias("pos"), "value")
    )
    return lists.select("key", "pos", "value").unionByName(placed)


def list_range(lists: DataFrame, start: int, end: int, **options) -> DataFrame:
    """Elements ``start..end`` (inclusive, negatives from the tail) with 0-based ``index``.

    Trimming a list is keeping such a range. Ranges at one end never rank the whole list:
    Spark cuts each partition to that end before the shuffle.
    """
    return slice_positions(lists, "key", ["pos"], start, end, "index", **options)


def list_index(lists: DataFrame, index: int) -> DataFrame:
    return list_range(lists, index, index)


def remove_values(lists: DataFrame, value: Column, count: int, **options) -> DataFrame:
    """Remove elements equal to ``value``: the first ``count`` from the head, the last
    ``-count`` from the tail, or all of them when ``count`` is zero."""
    if count == 0:
        return lists.filter(~F.coalesce(F.col("value") == value, F.lit(False)))
    window = W.partitionBy("key").orderBy(F.asc("pos") if count > 0 else F.desc("pos"))
    matches = lists.filter(F.col("value") == value).select("key", "pos")
    doomed = matches.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= abs(count))
    return lists.join(doomed.select("key", "pos"), ["key", "pos"], "left_anti")
