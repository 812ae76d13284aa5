"""Users' combiners and table functions, tables by key, the replayable source, and the status automaton."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import models
from fleetpulse.functions import fanout, words
from fleetpulse.operators import combine
from fleetpulse.operators import daily as D
from fleetpulse.operators import status as S
from fleetpulse.sources import cycles
from fleetpulse.sources import keyed_files as KF
from fleetpulse.sources.sinks import read_batches
from fleetpulse.streaming import flows
from test_fleet import frame


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- combiners


def test_a_users_combiner(spark):
    class Longest(combine.Combiner):
        state = "size bigint, text string"

        def init(self, row):
            return (len(row.t or ""), row.t or "")

        def combine(self, one, other):
            return max(one, other)

    df = spark.createDataFrame([("a", "xx"), ("a", "yyy"), (None, "z"), (None, None), ("b", None)], "k string, t string").repartition(3)
    assert rows(combine.aggregate(df, ["k"], Longest(), ["t"])) == [("a", 3, "yyy"), ("b", 0, ""), (None, 1, "z")]
    assert combine.aggregate(df.limit(0), ["k"], Longest(), ["t"]).count() == 0
    assert Longest().zero() == (None, None)


def test_a_combiners_key_costs_no_call_of_its_own(spark):
    """Keys are merged as runs of sorted partitions, also where an Arrow batch ends within a key."""
    class Number(combine.Combiner):
        state = "n bigint"

        def init(self, row):
            return (1,)

        def combine(self, one, other):
            return (one[0] + other[0],)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = combine.aggregate(spark.range(0, 400, 1, 8).selectExpr("id % 7 AS k", "id AS t"), ["k"], Number(), ["t"], width=2)
        assert rows(found) == [(k, 58 if k == 0 else 57) for k in range(7)]
        assert "GroupsInPandas" not in found._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_distances_equal_the_builtin_aggregate(spark):
    rng = random.Random(2)
    trace = [(rng.choice(["HOT"] * 5 + ["V1", "V2"]), models.at(rng.randrange(5000)), i, rng.choice([None, 1.25, rng.random() * 100]), None, None) for i in range(400)]
    trace.append(("LONE", models.at(1), 1000, 5.0, None, None))
    df = frame(spark, trace).repartition(6)
    assert rows(combine.distances(df, width=3)) == rows(D.mile_aggregate(df))


def test_a_hot_key_is_merged_in_several_tasks(spark, tmp_path):
    class Tasks(combine.Combiner):
        state = "n bigint, tasks string"

        def init(self, row):
            return (1, "")

        def combine(self, one, other):
            from pyspark import TaskContext

            own = {str(TaskContext.get().taskAttemptId()), *one[1].split(), *other[1].split()}
            return (one[0] + other[0], " ".join(sorted(own)))

    df = spark.range(0, 40_000, 1, 12).select(F.lit("hot").alias("k"), "id")
    with_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = combine.aggregate(df, ["k"], Tasks(), ["id"], width=4).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_conf)
    assert row.n == 40_000
    # more than the twelve tasks that read and the one that ends it
    assert len(row.tasks.split()) > 13


# ---- table functions


def test_split_by_a_table_function(spark):
    texts = ["a b  c", "a ", "  ", "", None, " x", "é ß"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert rows(fanout.split_words(df, "text")) == rows(words.explode_words(df, "text"))
    numbered = fanout.fan_out(df, fanout.split_text, F.col("text").outer(), F.lit(" "), F.lit("piece"), F.lit(True))
    assert numbered.columns == ["id", "text", "piece", "place"]
    assert rows(numbered.filter("id = 0").select("piece", "place")) == [("", 2), ("a", 0), ("b", 1), ("c", 3)]
    with pytest.raises(Exception, match="must be a string"):
        fanout.fan_out(df, fanout.split_text, F.col("id").outer(), F.lit(" "), F.lit("piece"), F.lit(True)).collect()


# ---- tables by key


def stamps(path):
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.join(folder, n)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return found


def test_upsert_changes_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).cast("bigint").alias("seq"), F.lit(False).alias("gone"))
    KF.upsert(whole, path, ["k"], "seq", buckets=8)
    before = stamps(path)
    kind = "k bigint, v string, seq bigint, gone boolean"
    change = spark.createDataFrame([(7, "new", 5, False), (7, "older", 3, False)], kind)
    KF.upsert(change, path, ["k"], "seq", buckets=8)
    after = stamps(path)
    kept = {f for f in before if f in after}
    assert len({os.path.dirname(f) for f in before} - {os.path.dirname(f) for f in kept}) == 1
    assert all(before[f] == after[f] for f in kept) and KF.read(spark, path).count() == 200
    want = rows(KF.read(spark, path))
    assert (7, "new", 5, False) in want
    # again, and an update that comes too late: nothing changes
    KF.upsert(change, path, ["k"], "seq", buckets=8)
    KF.upsert(spark.createDataFrame([(7, "late", 1, False)], kind), path, ["k"], "seq", buckets=8)
    KF.upsert(whole.limit(0), path, ["k"], "seq", buckets=8)
    assert rows(KF.read(spark, path)) == want
    KF.upsert(spark.createDataFrame([(8, None, 9, True), (900, "x", 9, None)], kind), path, ["k"], "seq", buckets=8)
    left = {r.k for r in KF.read(spark, path, "gone").collect()}
    assert left == ({*range(200)} - {8}) | {900}


def test_point_reads_open_few_files(spark, tmp_path):
    path = str(tmp_path / "r")
    table = spark.range(0, 20_000, 1, 7).select((F.col("id") * 3).alias("k"), F.col("id").cast("string").alias("v"))
    KF.write_ranged(table, path, "k", 16)
    asked = spark.createDataFrame([(30,), (33,), (33,), (34,), (None,), (-5,)], "k bigint")
    found = KF.read_keys(spark, path, "k", asked)
    assert rows(found) == [(30, "10"), (33, "11")]
    assert len(found.inputFiles()) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(k" in plan
    assert KF.read_keys(spark, path, "k", asked.filter("k = 34 OR k < 0")).count() == 0
    assert KF.read_keys(spark, path, "k", asked.limit(0)).count() == 0
    many = spark.range(0, 3000).select(F.col("id").alias("k"))
    found = KF.read_keys(spark, path, "k", many)
    assert found.count() == 1000 and 1 <= len(found.inputFiles()) <= 2
    texts = table.select(F.col("v").alias("k"), F.lit(1).alias("n"))
    KF.write_ranged(texts, str(tmp_path / "s"), "k", 4, distinct=5000)
    assert KF.read_keys(spark, str(tmp_path / "s"), "k", spark.createDataFrame([("77",), ("x",)], "k string")).count() == 1


# ---- the replayable source


def test_cycles_go_on_after_a_restart(spark, tmp_path):
    table = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (2, "d")], "at bigint, t string")
    for limit in (4, 4, 8):
        stream = cycles.cycling_table(spark, table, "at", 4, rows_per_batch=3, limit=limit)
        query = flows.append_changes(stream, str(tmp_path / "out"), str(tmp_path / "c"), mode="append")
        query.processAllAvailable()
        query.stop()
    found = read_batches(spark, str(tmp_path / "out")).drop("batch_id")
    assert rows(found) == sorted([(n, n % 4, t) for n in range(8) for at, t in rows(table) if at == n % 4], key=str)
    # a batch that is run again has the same numbers
    reader = cycles.PlaceReader({"size": "4", "rowsPerBatch": "3"})
    first, end = reader.read({"next": 3})
    assert list(first) == list(reader.readBetweenOffsets({"next": 3}, end)) == [(3, 3), (4, 0), (5, 1)]


# ---- status with hysteresis


def automaton(rows, stored, hold):
    status, timer, out = dict(stored), {}, []
    for v, ts, seq, matched in sorted(rows, key=lambda r: (r[1], r[2])):
        if matched is not None:
            status[v], timer[v] = matched, ts
        else:
            if v in timer:
                if (ts - timer[v]).total_seconds() > hold:
                    status[v] = 2
            else:
                timer[v] = ts
            if status.get(v) in (None, 0):
                status[v] = 2
        out.append((v, seq, status[v]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_hysteresis_equals_the_automaton(spark, seed):
    rng = random.Random(seed)
    step = rng.choice([10, 40, 90])
    times = sorted(rng.randrange(200 * step) for _ in range(300))
    trace = [(rng.choice(["HOT", "HOT", "V1", "V2", "NEW"]), models.at(t), i, rng.choice([None, None, None, 0, 3, 5])) for i, t in enumerate(times)]
    stored = {"HOT": 4, "V1": 0, "V2": None}
    df = spark.createDataFrame(trace, "vehicle_id string, ts timestamp, seq bigint, matched int").repartition(3)
    known = spark.createDataFrame(list(stored.items()), "vehicle_id string, status int")
    for width in ("1 second", "1 minute", "1 day"):
        found = S.with_hysteresis(df, known, slice_width=width).select("vehicle_id", "seq", "active_status")
        assert sorted(map(tuple, found.collect())) == automaton(trace, stored, 60)


def test_hysteresis_splits_a_busy_vehicle(spark):
    df = spark.range(1000).select(F.lit("HOT").alias("vehicle_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), F.lit(None).cast("int").alias("matched"))
    found = S.with_hysteresis(df, spark.createDataFrame([], "vehicle_id string, status int"), slice_width="10 seconds")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ---- rules meet records


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_no_record_is_shuffled_by_its_model_alone(spark, threshold):
    from fleetpulse.operators import alarms as A
    from fleetpulse.operators import charging as C
    from test_fleet import fixtures
    from test_streaming import RECORDS, random_records

    rules, vehicles = fixtures(spark)
    records = spark.createDataFrame(random_records(1, 50), RECORDS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for df in (A.alarm_signals(records, vehicles, rules), S.record_status(records, vehicles, rules), C.charge_signals(records, vehicles, rules)):
            lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
            alone = [k for k, line in enumerate(lines) if re.search(r"hashpartitioning\(fiber_unid#\d+, \d+\)", line)]
            # the rules themselves are grouped by model; what has records in it never is
            assert all("collect_list" in lines[k + 1] for k in alone)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
