"""Per-vehicle-per-day statistics.

A statistic is built from *fragments*: mergeable summaries of one time slice of one
vehicle-day. The same fragments serve the batch table, the running values at each flush and
the streaming state (a stored statistic is itself a fragment that precedes the new ones).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions import messages as M
from fleetpulse.functions.times import day, micros
from fleetpulse.operators import timeline as TL

KEYS = ("day", "vehicle_id")
# A pause of this length or more starts a new working stretch; a daily
# distance must stay below this many units to be believed.
WORK_GAP = "5 minutes"
MILE_CAP = 500.0


def readings(messages: DataFrame) -> DataFrame:
    """Messages with a sequence column ``seq`` -> ``vehicle_id, ts, seq`` and daily metrics."""
    rows = M.with_event_time(M.with_vehicle(messages))
    rows = M.with_metrics(rows, "mileage", "energy", "fuel", "charge_all", "charge_status")
    return rows.select(
        "vehicle_id", "ts", "seq", "timestamp", "mileage", "energy", "fuel", "charge_all", "charge_status"
    )


def _positive(name: str) -> Column:
    return F.when(F.col(name) > 0, F.col(name))


def fragments(
    rows: DataFrame,
    state: DataFrame | None = None,
    work_gap: str = WORK_GAP,
    mile_cap: float = MILE_CAP,
    slice_width: str = TL.DEFAULT_SLICE,
    every: str = "1 day",
) -> DataFrame:
    """Summaries per (day, vehicle, slice); ``state`` holds statistics of earlier data.

    The input is read once. A slice is summed up without knowing the past: its rows' running
    highest distance readings are kept as a list (no longer than the slice), and only when
    the slices of a vehicle-day meet does its first reading say which of them can be believed.
    A slice also ends where an interval ``every`` ends, whose number is ``flush``.
    """
    cut = [*KEYS, "flush", "_slice"]
    order = F.struct("ts", "seq")
    base = rows.select(
        day(F.col("ts")).alias("day"),
        "vehicle_id",
        TL.slice_number(F.col("ts"), every).alias("flush"),
        TL.slice_number(F.col("ts"), slice_width).alias("_slice"),
        "ts",
        "seq",
        F.unix_micros("ts").alias("_us"),
        _positive("mileage").alias("_mile"),
        _positive("energy").alias("_energy"),
        _positive("fuel").alias("_fuel"),
        _positive("charge_all").alias("_charge_all"),
        "charge_status",
        F.col("timestamp").alias("_stat_ts"),
    )
    window = W.partitionBy(*cut).orderBy("ts", "seq")
    walked = base.select(
        "*",
        F.max("_mile").over(TL.up_to(window)).alias("_high"),
        (F.col("_us") - F.lag("_us").over(window)).alias("_pause"),
    )

    def worked(pause):
        return F.when(pause < micros(work_gap), pause)

    slices = walked.groupBy(*cut).agg(
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.min("_us").alias("_from"),
        F.max("_us").alias("_until"),
        F.sum(worked(F.col("_pause"))).alias("_inside"),
        F.min_by("_mile", F.when(F.col("_mile").isNotNull(), order)).alias("_first"),
        F.max("_mile").alias("max_mile"),
        F.collect_set("_high").alias("_highs"),
        F.min_by("_energy", F.when(F.col("_energy").isNotNull(), order)).alias("first_energy"),
        F.max("_energy").alias("max_energy"),
        F.min_by("_fuel", F.when(F.col("_fuel").isNotNull(), order)).alias("first_fuel"),
        F.max("_fuel").alias("max_fuel"),
        F.max_by("_charge_all", F.when(F.col("_charge_all").isNotNull(), order)).alias("charge_all"),
        F.max_by("charge_status", order).alias("charge_status"),
        F.max_by("_stat_ts", order).alias("stat_ts"),
    )
    if state is not None:
        past = state.select(
            *KEYS,
            F.lit(TL.PAST_SLICE).alias("flush"),
            F.lit(TL.PAST_SLICE).alias("_slice"),
            F.col("first_mile").alias("_first"),
            "max_mile",
            F.unix_micros("last.ts").alias("_until"),
        )
        slices = slices.unionByName(past, allowMissingColumns=True)
    # Slices of a vehicle-day are bounded by the day.
    days = W.partitionBy(*KEYS).orderBy("flush", "_slice")
    linked = slices.select(
        "*",
        F.first("_first", ignorenulls=True).over(TL.up_to(days)).alias("first_mile"),
        F.max("max_mile").over(TL.before(days)).alias("_high"),
        (F.col("_from") - F.max("_until").over(TL.before(days))).alias("_pause"),
    ).filter(F.col("_slice") > F.lit(TL.PAST_SLICE))

    def believed(high):
        distance = high - F.col("first_mile")
        return (high >= F.coalesce("_high", high)) & (distance > 0) & (distance < mile_cap)

    highs = F.filter(F.array_append("_highs", F.col("_high")), believed)
    zero = F.lit(0).cast("bigint")
    return linked.select(
        *KEYS,
        "flush",
        "first",
        "last",
        (F.coalesce("_inside", zero) + F.coalesce(worked(F.col("_pause")), zero)).alias("work_us"),
        "first_mile",
        "max_mile",
        (F.array_max(highs) - F.col("first_mile")).alias("mile_count"),
        "first_energy",
        "max_energy",
        "first_fuel",
        "max_fuel",
        "charge_all",
        "charge_status",
        "stat_ts",
    )


def _merged(over=None) -> list[Column]:
    """Merge expressions of fragments, for a groupBy or over a window of fragments."""

    def first_of(name):
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.col("first")))

    def last_of(name):
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("first")))

    merged = {
        "first": F.min("first"),
        "last": F.max("last"),
        "work_us": F.sum("work_us"),
        "first_mile": first_of("first_mile"),
        "max_mile": F.max("max_mile"),
        "mile_count": F.max("mile_count"),
        "first_energy": first_of("first_energy"),
        "max_energy": F.max("max_energy"),
        "first_fuel": first_of("first_fuel"),
        "max_fuel": F.max("max_fuel"),
        "charge_all": last_of("charge_all"),
        "charge_status": last_of("charge_status"),
        "stat_ts": F.max_by("stat_ts", F.col("first")),
    }
    return [(c.over(over) if over is not None else c).alias(n) for n, c in merged.items()]


def merge(frags: DataFrame, *also: Column) -> DataFrame:
    """Fragments -> one mergeable statistic per (day, vehicle), and other aggregates."""
    return frags.groupBy(*KEYS).agg(*_merged(), *also)


def report(state: DataFrame, *extra: str) -> DataFrame:
    """The published columns of merged statistics."""

    def zero(c):
        return F.coalesce(c, F.lit(0.0))

    return state.select(
        *KEYS,
        *extra,
        zero(F.col("mile_count")).alias("mile_count"),
        zero(F.col("max_mile")).alias("mile_total"),
        F.col("first.ts").alias("work_start"),
        F.col("last.ts").alias("work_end"),
        F.floor(F.col("work_us") / 1000).cast("bigint").alias("work_time_ms"),
        zero(F.col("max_energy") - F.col("first_energy")).alias("energy_count"),
        zero(F.col("max_energy")).alias("energy_total"),
        zero(F.col("max_fuel") - F.col("first_fuel")).alias("fuel_count"),
        zero(F.col("max_fuel")).alias("fuel_total"),
        "charge_status",
        zero(F.col("charge_all")).alias("charge_all"),
        F.col("stat_ts").alias("statistic_ts"),
    )


def daily_stats(rows: DataFrame, **options) -> DataFrame:
    """One row per vehicle and day."""
    return report(merge(fragments(rows, **options)))


def daily_flushes(rows: DataFrame, every: str = "5 minutes", **options) -> DataFrame:
    """The running statistic of a vehicle-day at the end of each flush interval in which it
    reported, with the working time added since its previous flush (``work_delta_ms``)."""
    frags = fragments(rows, every=every, **options).groupBy(*KEYS, "flush").agg(*_merged())
    # A vehicle-day has at most as many of these as a day has flush intervals.
    window = TL.up_to(W.partitionBy(*KEYS).orderBy("flush"))
    running = frags.select(
        *KEYS,
        F.timestamp_micros((F.col("flush") + F.lit(1)) * F.lit(micros(every))).alias("flush_ts"),
        F.floor(F.col("work_us") / 1000).cast("bigint").alias("work_delta_ms"),
        *_merged(window),
    )
    return report(running, "flush_ts", "work_delta_ms")


def work_hours(deltas: DataFrame, hours: DataFrame | None = None) -> DataFrame:
    """Accumulated working time per vehicle: stored total plus all new deltas."""
    new = deltas.select("vehicle_id", F.col("work_delta_ms").alias("work_ms"))
    if hours is not None:
        new = new.unionByName(hours.select("vehicle_id", "work_ms"))
    return new.groupBy("vehicle_id").agg(F.sum("work_ms").alias("work_ms"))


def mile_aggregate(rows: DataFrame) -> DataFrame:
    """Distance combiner: start and end reading, and the sum of later readings' distances
    from the first one. A lone record has only its total."""
    order = F.struct("ts", "seq")
    mile = F.coalesce(F.col("mileage"), F.lit(0.0)).cast("decimal(28,6)")
    agg = rows.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(mile).alias("s"),
        F.min_by(mile, order).alias("f"),
        F.max_by(mile, order).alias("e"),
    )
    several = F.col("n") > 1
    return agg.select(
        "vehicle_id",
        F.when(several, F.col("f")).otherwise(0).cast("double").alias("mile_start"),
        F.when(several, F.col("e")).otherwise(0).cast("double").alias("mile_end"),
        F.when(several, F.col("s") - F.col("n") * F.col("f")).otherwise(0).cast("double").alias("mile_count"),
        F.col("f").cast("double").alias("mile_total"),
    )
