"""Custom rules: selection, grouping per vehicle model, and matching against records.

Rules and vehicles join without a broadcast hint: Spark broadcasts a side only when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise,
and AQE splits a skewed model or vehicle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.messages import evaluate_once, indexed_number, pair_index
from fleetpulse.functions.predicates import INTERVAL_FIELDS, interval, within

# Rule types and status codes.
STATUS_RULE, ALARM_RULE = 1, 2
OFFLINE, ONLINE, CHARGING = 0, 2, 3
#: Copies of a model's rule list.
SALTS = 32

_FIELDS = ("code", "option", "value", "value_last", "status", "remarks", "alarm_level", "alarm_name")


def select_rules(rules: DataFrame, rule_type: int, status: int | None = None) -> DataFrame:
    """Rules of a type that are not deleted (filters reach the scan)."""
    kept = rules.filter((F.col("type") == rule_type) & (F.col("flag_del") == 0))
    return kept if status is None else kept.filter(F.col("status") == status)


def ordered_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("inx"), "code")


def with_intervals(rules: DataFrame) -> DataFrame:
    """Rules with their predicate as interval columns."""
    ends = rules.withColumn("_i", interval(F.col("option"), F.col("value"), F.col("value_last")))
    return ends.select(*rules.columns, *[F.col("_i")[f].alias(f) for f in INTERVAL_FIELDS])


def rules_by_model(rules: DataFrame) -> DataFrame:
    """``fiber_unid, rules``: each model's rule list, highest ``inx`` first."""
    entry = F.struct((-F.col("inx")).alias("neg_inx"), *_FIELDS, *INTERVAL_FIELDS)
    return (
        with_intervals(rules.filter(F.col("fiber_unid").isNotNull()))
        .groupBy("fiber_unid")
        .agg(F.sort_array(F.collect_list(entry)).alias("rules"))
    )


def with_pair_index(records: DataFrame) -> DataFrame:
    return evaluate_once(records, _index=pair_index(F.col("pairs")))


def _matches(index: Column, rule: Column) -> Column:
    # the one-element array binds the looked-up number, which the test names several times
    number = F.array(indexed_number(index, rule["code"]))
    return F.exists(number, lambda v: within(v, *[rule[f] for f in INTERVAL_FIELDS]))


def first_match(index: Column, rules: Column) -> Column:
    """First rule of the list that holds for the record; null when none does."""
    return F.get(F.filter(rules, lambda r: _matches(index, r)), F.lit(0))


def any_match(index: Column, rules: Column) -> Column:
    return F.coalesce(F.exists(rules, lambda r: _matches(index, r)), F.lit(False))


def with_model_rules(records: DataFrame, vehicles: DataFrame, rules: DataFrame) -> DataFrame:
    """Left-join model and rule list; both stay null for unknown vehicles and models.

    There are few models, so a list has ``SALTS`` copies and a model's records are dealt to them by vehicle.
    """
    modelled = records.join(vehicles.select("vehicle_id", "fiber_unid"), "vehicle_id", "left")
    dealt = modelled.withColumn("_salt", F.pmod(F.xxhash64("vehicle_id"), F.lit(SALTS)).cast("int"))
    copies = rules_by_model(rules).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # second, so that no vehicle row ever carries its own copy of the list
    return dealt.join(copies, ["fiber_unid", "_salt"], "left").drop("_salt")


def rule_checks(records: DataFrame, vehicles: DataFrame, rules: DataFrame, complete: bool = False) -> DataFrame:
    """One row per record and rule of its model whose pair is present: ``holds`` tells whether
    the predicate is true. With ``complete`` only vehicles with position and domain count.

    A record meets rules by model and code, a row for each of its pairs, so no row is made for a rule whose
    pair the record lacks.
    """
    dims = vehicles.filter(F.col("fiber_unid").isNotNull())
    if complete:
        dims = dims.dropna(subset=["lat", "lon", "domain_unid"])
    known = with_pair_index(records.join(dims.select("vehicle_id", "fiber_unid"), "vehicle_id"))
    names, values = F.col("_index.names"), F.col("_index.values")
    kept = [c for c in known.columns if c not in ("pairs", "_index")]
    # a name that comes again stands for its first pair
    firsts = F.filter(F.arrays_zip(names.alias("code"), values.alias("pair_value"), F.sequence(F.lit(1), F.size(names)).alias("at")), lambda p: F.array_position(names, p["code"]) == p["at"])
    present = known.filter(F.size(names) > 0).select(*kept, F.explode(firsts).alias("_pair"))
    present = present.select(*kept, F.col("_pair.code").alias("code"), F.col("_pair.pair_value").alias("pair_value"))
    joined = present.join(with_intervals(rules), ["fiber_unid", "code"])
    return joined.withColumn("holds", within(F.col("pair_value"), *[F.col(f) for f in INTERVAL_FIELDS])).drop(*INTERVAL_FIELDS)
