"""Per-key timelines that survive one key holding much of the data.

A plain ``Window.partitionBy(vehicle)`` puts a vehicle's whole history into one task. Here
every timeline is cut into fixed time slices: row-level windows run per (key, slice), and only
small per-slice results meet per key. Their number is bounded by the covered time, not by the
number of rows.

Two forms are used. *Fragments* (episodes): a slice is reduced to mergeable pieces that do not
need to know the past, and the pieces are joined up per key. *Header rows* (statistics whose
rows must know the past): the running value of earlier slices enters the row-level window as
one extra row in front of the slice, so no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions.times import micros

DEFAULT_SLICE = "10 minutes"


# Slice number of what happened before the data at hand.
PAST_SLICE = -(2**62)


def slice_number(ts: Column, width: str = DEFAULT_SLICE) -> Column:
    size = F.lit(micros(width))
    return F.call_function("div", F.unix_micros(ts) - F.pmod(F.unix_micros(ts), size), size)


SLICE_LADDER = ("1 day", "1 hour", "10 minutes", "1 minute", "10 seconds", "1 second")


def fit_slice_width(rows: DataFrame, keys: Sequence[str], target_rows: int = 5_000_000) -> str:
    """The widest slice that keeps every (key, slice) within ``target_rows`` rows.

    For data that may hold a very busy key. Rows are counted per key and second, combined
    map-side; wider slices add those counts up. One number per width reaches the driver.
    """
    finest = SLICE_LADDER[-1]
    counts = rows.groupBy(*keys, slice_number(F.col("ts"), finest).alias("_slice")).count()
    second = F.col("_slice") * micros(finest)
    wider = F.array(*[F.struct(F.lit(w).alias("width"), F.floor(second / micros(w)).alias("at")) for w in SLICE_LADDER[:-1]])
    fullest = (
        counts.select(*keys, "count", F.explode(wider).alias("w"))
        .groupBy(*keys, "w")
        .agg(F.sum("count").alias("rows"))
        .groupBy("w.width")
        .agg(F.max("rows").alias("rows"))
    )
    rows_of = {r.width: r.rows for r in fullest.collect()}
    return next((w for w in SLICE_LADDER[:-1] if rows_of.get(w, 0) <= target_rows), finest)


def with_headers(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows plus header rows; ``_head`` is 0 on headers and 1 on rows."""
    return rows.withColumn("_head", F.lit(1)).unionByName(
        headers.withColumn("_head", F.lit(0)), allowMissingColumns=True
    )


def slice_window(keys: Sequence[str], order: Sequence[str]):
    """Row-level window of one slice, header first."""
    return W.partitionBy(*keys, "_slice").orderBy("_head", *order)


def before(window):
    return window.rowsBetween(W.unboundedPreceding, -1)


def up_to(window):
    return window.rowsBetween(W.unboundedPreceding, W.currentRow)


@dataclass(frozen=True)
class GapRule:
    """An episode opens on a hot row and ends on a cold row more than ``gap`` after the last
    hot one. Silence alone never ends an episode."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    gap: str
    slice_width: str = DEFAULT_SLICE

    @property
    def gap_us(self) -> int:
        return micros(self.gap)

    def row_window(self):
        return W.partitionBy(*self.keys, "_slice").orderBy(*self.order)


def _ended(hot: Column, cold: Column, rule: GapRule) -> Column:
    """The latest cold row is the one furthest from the latest hot row, so it alone tells
    whether the episode has ended."""
    return F.coalesce(cold - hot > F.lit(rule.gap_us), F.lit(False))


def gap_segments(rows: DataFrame, rule: GapRule) -> DataFrame:
    """Cut each slice into segments; hot rows of one segment belong to one episode.

    ``rows`` needs the key columns, ``ts``, the order columns and booleans ``hot`` and
    ``cold`` (a row that is neither takes no part). Adds ``_slice``, ``_seg`` (0 before the
    slice's first hot row), ``_starts`` on a segment's first hot row, and the times
    ``_hot_us`` and ``_cold_us``.
    """
    us = F.unix_micros("ts")
    base = (
        rows.filter(F.col("hot") | F.col("cold"))
        .withColumn("_slice", slice_number(F.col("ts"), rule.slice_width))
        .withColumn("_hot_us", F.when(F.col("hot"), us))
        .withColumn("_cold_us", F.when(~F.col("hot"), us))
    )
    window = rule.row_window()
    seen = base.withColumns(
        {"_prev_hot": F.max("_hot_us").over(before(window)), "_prev_cold": F.max("_cold_us").over(before(window))}
    )
    fresh = F.col("_prev_hot").isNull() | _ended(F.col("_prev_hot"), F.col("_prev_cold"), rule)
    return (
        seen.withColumn("_starts", F.col("hot") & fresh)
        .withColumn("_seg", F.sum(F.col("_starts").cast("int")).over(up_to(window)))
        .drop("_prev_hot", "_prev_cold", "cold")
    )


def fragment_times() -> list[Column]:
    """Aggregates every fragment of a segment has."""
    return [F.min("_hot_us").alias("_first_us"), F.max("_hot_us").alias("_hot_us"), F.max("_cold_us").alias("_cold_us")]


def joined_fragments(fragments: DataFrame, rule: GapRule) -> DataFrame:
    """Number the episodes of a key over its fragments ``_slice, _seg``.

    Adds ``_episode`` and ``_begins``. A key has at most one fragment per slice plus one per
    episode, and episodes are more than a gap apart.
    """
    window = W.partitionBy(*rule.keys).orderBy("_slice", "_seg")
    seen = fragments.withColumns(
        {"_prev_hot": F.max("_hot_us").over(before(window)), "_prev_cold": F.max("_cold_us").over(before(window))}
    )
    fresh = F.col("_prev_hot").isNull() | _ended(F.col("_prev_hot"), F.col("_prev_cold"), rule)
    return (
        seen.withColumn("_begins", F.col("_first_us").isNotNull() & fresh)
        .withColumn("_episode", F.sum(F.col("_begins").cast("int")).over(up_to(window)))
        .filter(F.col("_episode") > 0)
        .drop("_prev_hot", "_prev_cold")
    )


def episode_times(rule: GapRule) -> list[Column]:
    """Aggregates every merged episode has."""
    return [
        F.min("_first_us").alias("_first_us"),
        F.max("_hot_us").alias("_hot_us"),
        F.max("_cold_us").alias("_cold_us"),
        _ended(F.max("_hot_us"), F.max("_cold_us"), rule).alias("closed"),
    ]


def preceding(episodes: DataFrame) -> DataFrame:
    """Merged open episodes as fragments in front of any other."""
    return episodes.drop("closed").withColumns({"_slice": F.lit(PAST_SLICE), "_seg": F.lit(0).cast("bigint")})
