"""Vehicle status: live derivation, offline sweep, per-interval coalescing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions.messages import evaluate_once
from fleetpulse.functions.times import micros
from fleetpulse.operators import timeline as TL
from fleetpulse.operators.rules import (
    OFFLINE,
    ONLINE,
    STATUS_RULE,
    first_match,
    select_rules,
    with_model_rules,
    with_pair_index,
)


def latest_records(df: DataFrame, keys: list[str], order: Column, *columns: str) -> DataFrame:
    """Last record per key, reduced before the shuffle."""
    names = columns or tuple(c for c in df.columns if c not in keys)
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("_last"))
    return last.select(*keys, *[F.col("_last")[n].alias(n) for n in names])


def record_status(
    records: DataFrame, vehicles: DataFrame, rules: DataFrame, keep_current: bool = False
) -> DataFrame:
    """Add ``active_status`` to each record: the first matching status rule, else online.

    ``keep_current`` holds a vehicle's stored status while nothing matches, unless that
    status is missing or offline.
    """
    listed = with_model_rules(with_pair_index(records), vehicles, select_rules(rules, STATUS_RULE))
    default = F.lit(ONLINE)
    if keep_current:
        stored = vehicles.select("vehicle_id", F.col("active_status").try_cast("int").alias("_stored"))
        listed = listed.join(stored, "vehicle_id", "left")
        default = F.when(F.col("_stored") != OFFLINE, F.col("_stored")).otherwise(ONLINE)
    status = F.coalesce(first_match(F.col("_index"), F.col("rules"))["status"], default)
    return evaluate_once(listed, active_status=status).drop(
        "rules", "fiber_unid", "_stored", "_index"
    )


def vehicle_status(records: DataFrame, vehicles: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """Current status per vehicle.

    A status depends on its own record only, so records are first reduced to the last one per
    vehicle and rules are evaluated once per vehicle.
    """
    last = latest_records(records, ["vehicle_id"], F.struct("ts", "seq"), "ts", "pairs")
    status = record_status(last, vehicles, rules, **options)
    return status.select("vehicle_id", F.col("active_status").cast("string").alias("active_status"), "ts")


def offline_sweep(vehicles: DataFrame, as_of: Column, timeout: str = "5 minutes") -> DataFrame:
    """Vehicles unheard of for longer than ``timeout`` (or ever) become offline.

    ``vehicles`` holds ``vehicle_id, active_status, last_rx``; ``silent`` marks who this
    sweep found offline, as opposed to a status stored earlier.
    """
    late = F.unix_micros(as_of) - F.unix_micros("last_rx") > micros(timeout)
    offline = F.col("last_rx").isNull() | late
    swept = vehicles.withColumn("silent", offline)
    status = F.when(F.col("silent"), F.lit(str(OFFLINE))).otherwise(F.col("active_status"))
    return swept.withColumn("active_status", status)


def coalesce_last(df: DataFrame, every: str, *columns: str) -> DataFrame:
    """Last record per vehicle and interval (``flush_ts`` is the interval's end)."""
    timed = df.withColumn("_interval", F.window("ts", every))
    names = columns or tuple(df.columns)
    last = latest_records(timed, ["vehicle_id", "_interval"], F.struct("ts", "seq"), *[c for c in names if c != "vehicle_id"])
    return last.select("vehicle_id", F.col("_interval.end").alias("flush_ts"), *[c for c in names if c != "vehicle_id"])


HOLD = "60 seconds"


def matched_status(records: DataFrame, vehicles: DataFrame, rules: DataFrame) -> DataFrame:
    """``vehicle_id, ts, seq, matched``: the status of the first status rule that holds, else null."""
    listed = with_model_rules(with_pair_index(records.select("vehicle_id", "ts", "seq", "pairs")), vehicles, select_rules(rules, STATUS_RULE))
    found = evaluate_once(listed, matched=first_match(F.col("_index"), F.col("rules"))["status"])
    return found.select("vehicle_id", "ts", "seq", "matched")


def with_hysteresis(rows: DataFrame, stored: DataFrame, hold: str = HOLD, slice_width: str = TL.DEFAULT_SLICE) -> DataFrame:
    """Each record's status: what matched, or what was there before, but for a vehicle without a match.

    A record without a match keeps its vehicle's status; it becomes online when the vehicle's last match (or,
    before any, its first record) is more than ``hold`` ago, or when the status it would keep is offline or
    missing. ``rows``: ``vehicle_id, ts, seq, matched``; ``stored``: ``vehicle_id, status`` from before.

    The effect of a slice on the status is its last match, or none, and the time it begins: such effects are
    joined in order per vehicle and enter each slice as one header row, so a busy vehicle is many tasks.
    """
    us = F.unix_micros("ts")
    match = F.when(F.col("matched").isNotNull(), F.struct(F.col("matched").alias("status"), us.alias("us")))
    base = rows.select("vehicle_id", TL.slice_number(F.col("ts"), slice_width).alias("_slice"), "ts", "seq", us.alias("_us"), "matched", match.alias("_match"))
    order = F.struct("ts", "seq")
    effects = base.groupBy("vehicle_id", "_slice").agg(
        F.max_by("_match", F.when(F.col("_match").isNotNull(), order)).alias("_match"), F.min("_us").alias("_first")
    )
    slices = W.partitionBy("vehicle_id").orderBy("_slice")
    headers = effects.select(
        "vehicle_id",
        "_slice",
        F.last("_match", ignorenulls=True).over(TL.before(slices)).alias("_match"),
        F.min("_first").over(TL.up_to(slices)).alias("_first"),
    )
    known = stored.select("vehicle_id", F.col("status").alias("_stored"))
    headers = headers.join(known, "vehicle_id", "left")
    window = TL.up_to(TL.slice_window(["vehicle_id"], ["ts", "seq"]))
    walked = TL.with_headers(base, headers).select(
        "*",
        F.last("_match", ignorenulls=True).over(window).alias("_last"),
        F.max("_first").over(window).alias("_begin"),
        F.max("_stored").over(window).alias("_before"),
    )
    since = F.col("_us") - F.coalesce(F.col("_last.us"), F.col("_begin"))
    kept = F.when(F.col("_last").isNotNull(), F.col("_last.status")).otherwise(F.col("_before"))
    online = (since > micros(hold)) | kept.isNull() | (kept == OFFLINE)
    status = F.coalesce("matched", F.when(online, F.lit(ONLINE)).otherwise(kept))
    return walked.filter(F.col("_head") == 1).select("vehicle_id", "ts", "seq", status.alias("active_status"))


def status_with_hysteresis(records: DataFrame, vehicles: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """The status of each record under the rule of ``with_hysteresis``, from the vehicles' stored status on."""
    stored = vehicles.select("vehicle_id", F.col("active_status").try_cast("int").alias("status"))
    return with_hysteresis(matched_status(records, vehicles, rules), stored, **options)
