"""Alarm episodes per (vehicle, code, level)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.times import day, episode_unid, month_suffix
from fleetpulse.operators import timeline as TL
from fleetpulse.operators.rules import ALARM_RULE, rule_checks, select_rules

# An alarm ends when a cold record comes more than this after the last hot one;
# a rule of this status raises alarms.
ALARM_GAP = "5 minutes"
RAISE = 1
KEYS = ("vehicle_id", "code", "level")


def gap_rule(gap: str = ALARM_GAP, slice_width: str = TL.DEFAULT_SLICE) -> TL.GapRule:
    return TL.GapRule(KEYS, ("ts", "seq", "neg_inx"), gap, slice_width)


def alarm_signals(records: DataFrame, vehicles: DataFrame, rules: DataFrame) -> DataFrame:
    """Hot/cold rows: one per record and alarm rule of its model whose pair is present.

    A rule lacking code, name or level is skipped, as is a vehicle lacking position, domain
    or model. A usable value that does not raise is cold; a pair that is absent, or whose value is
    null or no number, says nothing.
    """
    usable = select_rules(rules, ALARM_RULE).dropna(subset=["code", "alarm_name", "alarm_level"])
    checks = rule_checks(records.select("vehicle_id", "ts", "seq", "pairs"), vehicles, usable, complete=True)
    checks = checks.filter(~F.isnan("pair_value"))
    hot = F.col("holds") & F.coalesce(F.col("status") == RAISE, F.lit(False))
    return checks.select(
        "vehicle_id",
        "code",
        F.col("alarm_level").alias("level"),
        "ts",
        "seq",
        (-F.col("inx")).alias("neg_inx"),
        "alarm_name",
        hot.alias("hot"),
        (~hot).alias("cold"),
    )


def fragments(signals: DataFrame, rule: TL.GapRule) -> DataFrame:
    """Episode pieces per slice, mergeable in time order."""
    named = F.max(F.when(F.col("_starts"), F.col("alarm_name"))).alias("error_name")
    return TL.gap_segments(signals, rule).groupBy(*KEYS, "_slice", "_seg").agg(*TL.fragment_times(), named)


def merge(frags: DataFrame, rule: TL.GapRule, *also: Column) -> DataFrame:
    """Fragments -> one row per episode, itself a fragment for later data."""
    named = F.max(F.when(F.col("_begins"), F.col("error_name"))).alias("error_name")
    grouped = TL.joined_fragments(frags, rule).groupBy(*KEYS, "_episode")
    return grouped.agg(*TL.episode_times(rule), named, *also).drop("_episode")


def _identity() -> Column:
    return episode_unid(F.col("vehicle_id"), F.col("code"), F.col("level"), F.col("_first_us"))


def publish(episodes: DataFrame, vehicles: DataFrame, *also: Column) -> DataFrame:
    """Episode rows with id, vehicle position and month partition, and further columns. ``end_ts`` is the
    last hot record of a closed episode and null while it is open."""
    dims = vehicles.select("vehicle_id", "domain_unid", "lat", "lon")
    begin_ts = F.timestamp_micros("_first_us")
    return episodes.join(dims, "vehicle_id", "left").select(
        _identity().alias("unid"),
        "vehicle_id",
        "domain_unid",
        "code",
        "level",
        "error_name",
        "lat",
        "lon",
        begin_ts.alias("begin_ts"),
        F.when(F.col("closed"), F.timestamp_micros("_hot_us")).alias("end_ts"),
        month_suffix(begin_ts).alias("table_suf"),
        *also,
    )


def alarm_episodes(
    records: DataFrame, vehicles: DataFrame, rules: DataFrame, gap: str = ALARM_GAP, **options
) -> DataFrame:
    """All episodes of the records, open ones included."""
    rule = gap_rule(gap, **options)
    return publish(merge(fragments(alarm_signals(records, vehicles, rules), rule), rule), vehicles)


def begin_events(episodes: DataFrame) -> DataFrame:
    """Rows that raise an alarm."""
    return episodes.drop("end_ts")


def end_events(episodes: DataFrame) -> DataFrame:
    """Rows that end one; the month partition is that of the begin."""
    return episodes.filter(F.col("end_ts").isNotNull()).select("unid", "end_ts", "table_suf")


def apply_ends(begins: DataFrame, ends: DataFrame) -> DataFrame:
    """Event table: begin rows with the end of the same id and month, when there is one."""
    last = ends.groupBy("unid", "table_suf").agg(F.max("end_ts").alias("end_ts"))
    return begins.join(last, ["unid", "table_suf"], "left").withColumn(
        "flag_did", F.when(F.col("end_ts").isNotNull(), 1).otherwise(0)
    )


def open_alarms(episodes: DataFrame) -> DataFrame:
    return episodes.filter(F.col("end_ts").isNull())


def close_offline(open_episodes: DataFrame, swept: DataFrame, as_of: Column) -> DataFrame:
    """End rows, timed ``as_of``, for open episodes of vehicles the sweep found offline."""
    offline = swept.filter("silent").select("vehicle_id")
    closed = open_episodes.join(offline, "vehicle_id", "left_semi")
    return closed.select("unid", as_of.alias("end_ts"), "table_suf")


def alarm_snapshot(episodes: DataFrame) -> DataFrame:
    """Latest alarm per vehicle: time, level, and the alert flag count of one."""
    order = F.struct("begin_ts", "level", "code")
    last = episodes.groupBy("vehicle_id").agg(F.max(order).alias("_last"))
    return last.select(
        "vehicle_id",
        F.col("_last.begin_ts").alias("datime_alert"),
        F.lit(1).alias("count_alert"),
        F.col("_last.level").alias("level_alert"),
    )


def daily_alarm_count(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy(day(F.col("begin_ts")).alias("day"), "vehicle_id").agg(
        F.count(F.lit(1)).alias("alarm_count")
    )
