"""Telemetry messages: JSON text -> pairs -> named metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import SECOND_FORMAT, parse_second_text

PAIR_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in ("code", "alias", "title", "value")])

# Pairs arrive as free-form objects. Reading them as maps keeps "field missing" (default
# applies) apart from "field is null" (the pair has no usable value).
_WIRE_TYPE = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("datime_RX", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField("_bad", T.StringType()),
    ]
)

# Defaults of a pair's fields, and the names telemetry units send.
PAIR_DEFAULTS = {"code": "", "alias": "", "title": "", "value": "0.0"}
VEHICLE_CODE = "ENTITY_UNID"
# metric -> (alias, value when the record has no such pair)
METRICS = {
    "device_id": ("DEVICE_ID", None),
    "speed": ("SPEED_GPS", None),
    "fuel": ("FUEL_CONSUM_TOTAL", None),
    "mileage": ("MILEAGE", "0.0"),
    "energy": ("POWER_CONSUM_TOTAL", "0.0"),
    "in_charge": ("POWER_CHARING_TOTAL", "0.0"),
    "soc": ("SOC", "0.0"),
    "charge_status": ("ChargeStatus", "0.0"),
    "charge_all": ("ChargeAll", "0.0"),
}
TEXT_METRICS = ("device_id", "charge_status")
# A present charge-status pair always reads as this text.
CHARGE_STATUS_PRESENT = "false"


def number(text: Column) -> Column:
    """Double, or null for text that is no number (plain casts would fail the job)."""
    return text.try_cast("double")


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed a single time per row.

    The optimizer pushes a filter on a derived column below the projection that derives it,
    which repeats the derivation; for JSON parsing and array lambdas that repetition costs
    more than the filter saves. A generator output is never inlined.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    spread = df.select("*", F.explode(F.array(packed)).alias("_once"))
    return spread.select(*df.columns, *[F.col("_once")[n].alias(n) for n in columns])


def _field(pair: Column, name: str) -> Column:
    return F.when(F.map_contains_key(pair, name), pair[name]).otherwise(F.lit(PAIR_DEFAULTS[name]))


def normalize_keys(raw: Column) -> Column:
    """Both spellings of the envelope keys become one, anywhere in the text."""
    text = F.replace(raw, F.lit("TIMESTAMP"), F.lit("timestamp"))
    return F.replace(text, F.lit("DATIME_RX"), F.lit("datime_RX"))


def wire_time(text: Column) -> Column:
    """Message timestamp: epoch milliseconds or date text."""
    return F.coalesce(
        F.timestamp_millis(text.try_cast("bigint")),
        F.try_to_timestamp(text, F.lit(SECOND_FORMAT)),
        text.try_cast("timestamp"),
    )


def parse_messages(df: DataFrame, raw: str = "str") -> DataFrame:
    """JSON text -> ``timestamp, datime_rx, pairs``; unparsable messages are dropped.

    Other columns of ``df`` (offset, partition, ...) are kept.
    """
    options = {"columnNameOfCorruptRecord": "_bad"}
    parsed = evaluate_once(df, _m=F.from_json(normalize_keys(F.col(raw)), _WIRE_TYPE, options))
    kept = parsed.filter(F.col("_m").isNotNull() & F.col("_m._bad").isNull())
    pairs = F.transform(
        F.col("_m.pairs"), lambda p: F.struct(*[_field(p, n).alias(n) for n in PAIR_TYPE.fieldNames()])
    )
    return evaluate_once(
        kept,
        timestamp=F.coalesce(wire_time(F.col("_m.timestamp")), F.current_timestamp()),
        datime_rx=F.coalesce(F.col("_m.datime_RX"), F.lit("")),
        pairs=F.coalesce(pairs, F.array().cast(T.ArrayType(PAIR_TYPE))),
    ).drop(raw, "_m")


def first_pair(pairs: Column, predicate) -> Column:
    """The first pair the predicate holds for, as a struct; null when there is none."""
    return F.get(F.filter(pairs, predicate), F.lit(0))


def pair_by_code(pairs: Column, code: Column | str) -> Column:
    """First pair whose alias or code equals ``code``, in array order."""
    wanted = F.lit(code) if isinstance(code, str) else code
    return first_pair(pairs, lambda p: (p["alias"] == wanted) | (p["code"] == wanted))


def pair_index(pairs: Column) -> Column:
    """Names (alias and code of every pair) and their values, side by side in pair order.

    Built once per record, it answers any number of lookups without an array lambda each.
    """

    nan = F.lit(float("nan"))
    names = F.flatten(F.transform(pairs, lambda p: F.array(p["alias"], p["code"])))
    values = F.flatten(F.transform(pairs, lambda p: F.array_repeat(F.coalesce(number(p["value"]), nan), 2)))
    return F.struct(names.alias("names"), values.alias("values"))


def indexed_number(index: Column, code: Column) -> Column:
    """Number of the first pair whose alias or code equals ``code``.

    Null when there is no such pair; junk and null values read as NaN, which keeps a present
    pair apart from an absent one.
    """
    return F.get(index["values"], (F.array_position(index["names"], code) - 1).cast("int"))


def vehicle_id(pairs: Column) -> Column:
    return first_pair(pairs, lambda p: p["code"] == F.lit(VEHICLE_CODE))["value"]


def metric(pairs: Column, name: str) -> Column:
    """Text value of a named metric with its missing-pair default."""
    return _metric_value(_metric_pair(pairs, name), name)


def _metric_pair(pairs: Column, name: str) -> Column:
    alias = METRICS[name][0]
    return first_pair(pairs, lambda p: p["alias"] == F.lit(alias))


def _metric_value(pair: Column, name: str) -> Column:
    value = F.lit(CHARGE_STATUS_PRESENT) if name == "charge_status" else pair["value"]
    return F.when(pair.isNull(), F.lit(METRICS[name][1])).otherwise(value)


def with_vehicle(df: DataFrame) -> DataFrame:
    """Add ``vehicle_id``; records that name no vehicle are dropped."""
    return evaluate_once(df, vehicle_id=vehicle_id(F.col("pairs"))).filter(F.col("vehicle_id").isNotNull())


def with_event_time(df: DataFrame, fall_back: bool = False) -> DataFrame:
    """Add ``ts`` from the receive time; optionally fall back to the message timestamp."""
    ts = parse_second_text(F.col("datime_rx"))
    if fall_back:
        ts = F.coalesce(ts, F.col("timestamp"))
    return evaluate_once(df, ts=ts).filter(F.col("ts").isNotNull())


def with_metrics(df: DataFrame, *names: str, mark: str | None = None) -> DataFrame:
    """Add metric columns; a record whose present number does not parse is dropped, or kept with a
    false ``mark`` if that names a column."""
    names = names or tuple(METRICS)
    found = evaluate_once(df, **{f"_p_{n}": _metric_pair(F.col("pairs"), n) for n in names})
    values = {}
    for n in names:
        text = _metric_value(F.col(f"_p_{n}"), n)
        values[n] = text if n in TEXT_METRICS else number(text)
    typed = evaluate_once(found, **values)
    good = F.lit(True)
    for n in names:
        if n not in TEXT_METRICS:
            # without a pair, an optional metric is null and that is fine
            absent = F.col(f"_p_{n}").isNull() if METRICS[n][1] is None else F.lit(False)
            good = good & (F.col(n).isNotNull() | absent)
    kept = typed.filter(good) if mark is None else typed.withColumn(mark, good)
    return kept.drop(*[f"_p_{n}" for n in names])
