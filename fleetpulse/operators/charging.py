"""Charging sessions and their daily roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.functions import messages as M
from fleetpulse.functions.times import day, millis_key
from fleetpulse.operators import timeline as TL
from fleetpulse.operators.rules import CHARGING, STATUS_RULE, any_match, select_rules, with_model_rules, with_pair_index

# Fixed value: a session ends when a non-charging record comes more than this after the last
# charging one.
CHARGE_GAP = "30 minutes"
KEYS = ("vehicle_id",)


def gap_rule(gap: str = CHARGE_GAP, slice_width: str = TL.DEFAULT_SLICE) -> TL.GapRule:
    return TL.GapRule(KEYS, ("ts", "seq"), gap, slice_width)


def with_charging(records: DataFrame, vehicles: DataFrame, rules: DataFrame) -> DataFrame:
    """Records with ``hot``: any charging rule of the vehicle's model holds.

    An absent pair, an unknown vehicle or model mean that it does not.
    """
    listed = with_model_rules(with_pair_index(records), vehicles, select_rules(rules, STATUS_RULE, CHARGING))
    return M.evaluate_once(listed, hot=any_match(F.col("_index"), F.col("rules"))).drop("rules", "fiber_unid", "_index")


def charge_signals(records: DataFrame, vehicles: DataFrame, rules: DataFrame) -> DataFrame:
    """Hot (charging) and cold rows with charge and state of charge.

    Records with unusable numbers are dropped.
    """
    charging = with_charging(records.select("vehicle_id", "ts", "seq", "pairs"), vehicles, rules)
    return M.with_metrics(charging, "in_charge", "soc").select(
        "vehicle_id", "ts", "seq", "in_charge", "soc", "hot", (~F.col("hot")).alias("cold")
    )


def fragments(signals: DataFrame, rule: TL.GapRule) -> DataFrame:
    """Session pieces per slice. Besides first and last readings a piece keeps its
    second-to-last charge, which decides the start charge of sessions that begin at zero."""
    order = F.struct("ts", "seq")
    hot = F.col("hot")
    positive = F.when(hot & (F.col("in_charge") > 0), order)
    earlier = F.last(F.when(hot, F.col("in_charge")), ignorenulls=True).over(TL.before(rule.row_window()))
    rows = TL.gap_segments(signals, rule).withColumn("_earlier", earlier)
    several = F.sum(hot.cast("int")) > 1
    return rows.groupBy(*KEYS, "_slice", "_seg").agg(
        *TL.fragment_times(),
        F.sum(hot.cast("bigint")).alias("n"),
        F.max(F.when(F.col("_starts"), F.col("in_charge"))).alias("first_charge"),
        F.max(F.when(F.col("_starts"), F.col("soc"))).alias("first_soc"),
        F.min_by("in_charge", positive).alias("positive_charge"),
        F.min(positive).alias("positive_at"),
        F.max(F.when(hot, order)).alias("last_at"),
        F.max_by("in_charge", F.when(hot, order)).alias("last_charge"),
        F.when(several, F.max_by("_earlier", F.when(hot, order))).alias("charge_before"),
        F.max_by("soc", F.when(hot & ~F.col("_starts") & (F.col("soc") > 0), order)).alias("rest_soc"),
    )


def merge(frags: DataFrame, rule: TL.GapRule, *also: Column) -> DataFrame:
    """Fragments -> one row per session, itself a fragment for later data."""
    # The charge reading before a piece's own first one is the last of the previous piece.
    pieces = TL.before(W.partitionBy(*KEYS, "_episode").orderBy("_slice", "_seg"))
    first_counts = F.when(~F.col("_begins") & (F.col("first_soc") > 0), F.col("first_soc"))
    linked = TL.joined_fragments(frags, rule).withColumns(
        {
            "charge_before": F.coalesce("charge_before", F.last("last_charge", ignorenulls=True).over(pieces)),
            "rest_soc": F.coalesce("rest_soc", first_counts),
        }
    )
    begins = F.col("_begins")
    return (
        linked.groupBy(*KEYS, "_episode")
        .agg(
            *TL.episode_times(rule),
            F.sum("n").alias("n"),
            F.max(F.when(begins, F.col("first_charge"))).alias("first_charge"),
            F.max(F.when(begins, F.col("first_soc"))).alias("first_soc"),
            F.min_by("positive_charge", "positive_at").alias("positive_charge"),
            F.min("positive_at").alias("positive_at"),
            F.max("last_at").alias("last_at"),
            F.max_by("last_charge", "last_at").alias("last_charge"),
            F.max_by("charge_before", "last_at").alias("charge_before"),
            F.max_by("rest_soc", F.when(F.col("rest_soc").isNotNull(), F.col("last_at"))).alias("rest_soc"),
            *also,
        )
        .drop("_episode")
    )


def publish(sessions: DataFrame) -> DataFrame:
    """Session rows. An open session has start values only."""
    closed = F.col("closed")
    begin_ts = F.timestamp_micros("_first_us")
    # A session starts with its first positive charge before the last record, else with the
    # reading before the last.
    repaired = (
        F.when(F.col("n") == 1, F.col("first_charge"))
        .when(F.col("positive_at") < F.col("last_at"), F.col("positive_charge"))
        .otherwise(F.col("charge_before"))
    )
    start = F.when(closed, repaired).otherwise(F.col("first_charge"))

    def on_close(c):
        return F.when(closed, c)

    return sessions.select(
        millis_key(begin_ts, F.col("vehicle_id")).alias("row_key"),
        "vehicle_id",
        begin_ts.alias("start_date"),
        on_close(F.timestamp_micros("_hot_us")).alias("end_date"),
        start.alias("start_charge"),
        on_close(F.col("last_charge")).alias("end_charge"),
        on_close(F.col("last_charge") - repaired).alias("charge"),
        F.col("first_soc").alias("start_soc"),
        on_close(F.coalesce("rest_soc", "first_soc")).alias("end_soc"),
        (~closed).alias("is_open"),
    )


def charge_sessions(
    records: DataFrame, vehicles: DataFrame, rules: DataFrame, gap: str = CHARGE_GAP, **options
) -> DataFrame:
    rule = gap_rule(gap, **options)
    return publish(merge(fragments(charge_signals(records, vehicles, rules), rule), rule))


def expire_sessions(sessions: DataFrame, as_of: Column, older_than_us: int) -> DataFrame:
    """Mergeable open sessions begun longer ago than ``older_than_us`` get closed at their
    last charging record."""
    old = F.unix_micros(as_of) - F.col("_first_us") > F.lit(older_than_us)
    return sessions.withColumn("closed", F.col("closed") | old)


def daily_charge(sessions: DataFrame) -> DataFrame:
    """Number and quantity of closed sessions by vehicle and day of session start."""
    return (
        sessions.filter(~F.col("is_open"))
        .groupBy(day(F.col("start_date")).alias("day"), "vehicle_id")
        .agg(F.count(F.lit(1)).alias("charge_count"), F.sum("charge").alias("charge_quantity"))
    )
