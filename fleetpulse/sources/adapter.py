"""Telemetry, vehicles and rules derived from general-purpose tables.

The benchmark tables hold no vehicles, so an event stream stands in for telemetry: each user is
a vehicle, each event one message. Every derived value is a function of its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.messages import METRICS, VEHICLE_CODE, evaluate_once

EPOCH_US = 1_704_067_200_000_000  # 2024-01-01
EVENT_CODES = ("click", "view", "error", "purchase", "signup")
OPTION_CYCLE = ("=", ">", ">=", "<", "<=", "[between]", "(between)", "(between]", "[between)", "?")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes]
    )


def readings(events: DataFrame) -> DataFrame:
    """``vehicle_id, ts, seq`` and typed metrics; absent metrics are null."""
    us = F.unix_micros("ts") - F.lit(EPOCH_US)
    cents = F.round(F.col("value") * 100).cast("bigint")
    k = F.get_json_object("props", "$.k").cast("int")

    def reading(divisor: int, plus: Column) -> Column:
        return (F.floor(us / F.lit(divisor)).cast("bigint") + plus) / 100.0

    return events.select(
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("code"),
        "value",
        reading(1_800_000, cents).alias("mileage"),
        F.when(F.col("event_type").isin("click", "view"), reading(18_000_000, k)).alias("energy"),
        F.when(F.col("event_type") == "error", reading(36_000_000, k)).alias("fuel"),
        F.when(k >= 50, F.col("value")).otherwise(0.0).alias("charge_all"),
        F.when(F.col("event_type") == "purchase", "false").otherwise("0.0").alias("charge_status"),
        F.when(k % 4 == 0, 0.0).otherwise(F.col("value")).alias("in_charge"),
        k.cast("double").alias("soc"),
    )


def _pair(code: Column, alias: str, value: Column) -> Column:
    fields = (code.alias("code"), F.lit(alias).alias("alias"), F.lit("").alias("title"))
    return F.struct(*fields, value.cast("string").alias("value"))


def records(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Messages with structured pairs: ``vehicle_id, ts, seq, timestamp, pairs``; ``value`` replaces
    the text of the event's own pair."""
    rows = readings(events)
    pairs = [
        _pair(F.lit(VEHICLE_CODE), "", F.col("vehicle_id")),
        _pair(F.col("code"), "", F.col("value") if value is None else value),
        *[
            F.when(F.col(m).isNotNull(), _pair(F.lit(""), METRICS[m][0], F.col(m)))
            for m in ("mileage", "energy", "fuel", "charge_all", "in_charge", "soc")
        ],
        F.when(F.col("charge_status") == "false", _pair(F.lit(""), METRICS["charge_status"][0], F.lit("true"))),
    ]
    built = rows.select("vehicle_id", "ts", "seq", "timestamp", F.array_compact(F.array(*pairs)).alias("_pairs"))
    return evaluate_once(built, pairs=F.col("_pairs")).drop("_pairs")


def wire_messages(events: DataFrame) -> DataFrame:
    """The same messages as JSON text ``str`` (receive time in whole seconds)."""
    body = F.struct(
        F.unix_millis("timestamp").alias("TIMESTAMP"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("DATIME_RX"),
        "pairs",
    )
    return evaluate_once(records(events), str=F.to_json(body)).select("seq", "str")


def vehicles(customer: DataFrame) -> DataFrame:
    """Vehicle dimension, a vehicle for each customer; some lack a model or a position."""
    key = F.col("c_custkey")
    return customer.select(
        F.concat(F.lit("V"), key.cast("string")).alias("vehicle_id"),
        F.when(key % 10 != 7, F.concat(F.lit("F"), (key % 3).cast("string"))).alias("fiber_unid"),
        F.concat(F.lit("D"), F.col("c_nationkey").cast("string")).alias("domain_unid"),
        F.when(key % 11 != 3, F.col("c_acctbal") / 100).alias("lat"),
        (F.col("c_acctbal") / 50).alias("lon"),
        F.when(key % 3 != 0, F.when(key % 3 == 1, "0").otherwise("4")).alias("active_status"),
    )


def rules(nation: DataFrame) -> DataFrame:
    """A status and an alarm rule per nation, over all options, models and codes."""
    n = F.col("n_nationkey")
    options = F.array(*[F.lit(o) for o in OPTION_CYCLE])
    codes = F.array(*[F.lit(c) for c in EVENT_CODES])
    fifth = F.floor(n / 5).cast("int")
    return nation.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("type")).select(
        F.concat(F.lit("F"), (n % 3).cast("string")).alias("fiber_unid"),
        F.get(codes, n % 5).alias("code"),
        F.get(options, (n + fifth) % 10).alias("option"),
        (5 + n * 7 % 40).alias("value"),
        (65 + n * 7 % 40).alias("value_last"),
        F.when(F.col("type") == 1, F.when(n % 4 == 1, 3).otherwise(4 + n % 3))
        .otherwise(F.when(n % 8 == 3, 0).otherwise(1))
        .alias("status"),
        F.lit("").alias("remarks"),
        F.when(n != 17, F.col("n_regionkey")).alias("alarm_level"),
        F.when(n != 11, F.col("n_name")).alias("alarm_name"),
        "type",
        F.when(n % 12 == 5, 1).otherwise(0).alias("flag_del"),
        n.alias("inx"),
    )
