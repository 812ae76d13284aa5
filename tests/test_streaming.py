import json
import random

import pytest
from pyspark.sql import functions as F

import models
from test_fleet import fixtures, frame, random_daily
from fleetpulse.operators import alarms as A
from fleetpulse.operators import charging as C
from fleetpulse.operators import daily as D
from fleetpulse.operators import status as S
from fleetpulse.operators import wordcount as WC
from fleetpulse.sources import streams
from fleetpulse.sources.sinks import latest_version, read_batches
from fleetpulse.streaming import flows, stateful

RECORDS = "vehicle_id string, ts timestamp, seq bigint, timestamp timestamp, pairs array<struct<code:string,alias:string,title:string,value:string>>"


def random_records(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for i, s in enumerate(sorted(rng.randrange(3 * 86400) for _ in range(n))):
        pairs = [("t", "", "", str(rng.choice([20, 60, 92, 99]))), ("c", "", "", str(rng.randrange(2)))]
        pairs = rng.sample(pairs, rng.randrange(3)) + [("", "SOC", "", str(i % 90)), ("", "POWER_CHARING_TOTAL", "", str(i % 7))]
        rows.append((f"V{rng.choice([1, 1, 1, 2, 3])}", models.at(s), i, models.at(s), pairs))
    return rows


def files(spark, df, path, parts):
    """The rows as files that arrive in event order, ``parts`` of them."""
    total = df.count()
    size = -(-total // parts)
    for p in range(parts):
        part = df.filter((F.col("seq") >= p * size) & (F.col("seq") < (p + 1) * size))
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(df, path, checkpoint, mode="update", prepare=None):
    query = flows.append_changes(df, path, str(checkpoint), mode=mode, prepare=prepare, once=True)
    query.awaitTermination()
    assert query.exception() is None
    return query


def closing(df, vehicle="END"):
    """The rows and one more, two days later, that moves the watermark past them."""
    last = df.agg(F.max("ts"), F.max("seq")).first()
    given = {"vehicle_id": F.lit(vehicle), "ts": F.lit(last[0]) + F.expr("INTERVAL 2 DAYS"), "seq": F.lit(last[1] + 10_000)}
    return df.unionByName(df.limit(1).select(*[given.get(c, F.lit(None).cast(t)).alias(c) for c, t in df.dtypes]))


def arrive(spark, df, path, parts, delay="1 minute", shuffle=None):
    """The rows, closed, as a stream with a watermark; ``shuffle`` seconds of disorder, from a seeded draw."""
    rows = df.collect()
    if shuffle:
        rng = random.Random(11)
        rows = sorted(rows, key=lambda r: r.ts.timestamp() + rng.random() * shuffle)
    size = -(-len(rows) // parts)
    for p in range(parts):
        spark.createDataFrame(rows[p * size : (p + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(path)
    closing(df).filter("vehicle_id = 'END'").coalesce(1).write.mode("append").parquet(path)
    return stateful.timed(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path), delay)


def final(spark, path, keys):
    return latest_version(read_batches(spark, path), keys).filter("vehicle_id <> 'END'")


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    left, right = (sorted((tuple(map(str, r)) for r in x.select(*columns).collect())) for x in (a, b))
    assert left == right


DELAY = 1800


@pytest.mark.parametrize("parts", [1, 4])
def test_daily_stream_equals_batch(spark, tmp_path, parts):
    """Rows in any order within the watermark's delay, however they are cut into batches."""
    df = frame(spark, random_daily(5, n=200))
    stream = arrive(spark, df, str(tmp_path / "in"), parts, "30 minutes", DELAY if parts > 1 else None)
    query = drain(stateful.daily_changes(stream, horizon_days=3), str(tmp_path / "out"), tmp_path / "c")
    same(final(spark, str(tmp_path / "out"), list(D.KEYS)), D.daily_stats(df))
    assert stateful.late_rows(query) == 0


def tables_of(spark):
    rules, vehicles = fixtures(spark)
    return vehicles, rules


@pytest.mark.parametrize("parts", [1, 4])
def test_alarm_stream_equals_batch(spark, tmp_path, parts):
    vehicles, rules = tables_of(spark)
    df = spark.createDataFrame(random_records(3), RECORDS)
    stream = arrive(spark, df, str(tmp_path / "in"), parts, "30 minutes", DELAY if parts > 1 else None)
    signals = A.alarm_signals(stream, vehicles, rules)
    drain(A.publish(stateful.alarm_changes(signals, "1 hour"), vehicles), str(tmp_path / "out"), tmp_path / "c")
    batch = A.alarm_episodes(df, vehicles, rules, gap="1 hour")
    assert batch.filter("end_ts IS NOT NULL").count() > 3
    same(final(spark, str(tmp_path / "out"), ["unid"]), batch)


def test_alarm_events_are_given_out_once_and_meet(spark, tmp_path):
    vehicles, rules = tables_of(spark)
    df = spark.createDataFrame(random_records(3), RECORDS)
    signals = A.alarm_signals(arrive(spark, df, str(tmp_path / "in"), 4), vehicles, rules)
    seen = F.timestamp_micros("_seen_us").alias("seen_ts")
    drain(A.publish(stateful.alarm_changes(signals, "1 hour", events=True), vehicles, seen), str(tmp_path / "events"), tmp_path / "c", "append")
    events = read_batches(spark, str(tmp_path / "events")).drop("batch_id")
    batch = A.alarm_episodes(df, vehicles, rules, gap="1 hour")
    same(events.filter("end_ts IS NULL").drop("seen_ts"), A.begin_events(batch).withColumn("end_ts", F.lit(None).cast("timestamp")))
    same(events.filter("end_ts IS NOT NULL").select("unid", "end_ts", "table_suf"), A.end_events(batch))

    # the two kinds as streams of their own: ends find their begins, begins without one come out in the end
    far = events.agg(F.max("seen_ts") + F.expr("INTERVAL 20 DAYS")).first()[0]
    for kind, rows in (("begins", events.filter("end_ts IS NULL")), ("ends", events.filter("end_ts IS NOT NULL"))):
        middle = rows.select(F.percentile_approx("seen_ts", 0.5)).first()[0]
        last = rows.limit(1).select(*[{"unid": F.lit("last"), "table_suf": F.lit("last"), "seen_ts": F.lit(far)}.get(c, F.lit(None).cast(t)).alias(c) for c, t in rows.dtypes])
        for part in (rows.filter(F.col("seen_ts") <= middle), rows.filter(F.col("seen_ts") > middle), last):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / kind))
    read = lambda kind: spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / kind))
    met = flows.ends_meet_begins(read("begins").drop("end_ts"), read("ends").select("unid", "end_ts", "table_suf", "seen_ts"), "10 days")
    drain(met, str(tmp_path / "table"), tmp_path / "d", "append")
    table = read_batches(spark, str(tmp_path / "table")).drop("batch_id").filter("unid <> 'last'")
    same(table, A.apply_ends(A.begin_events(batch), A.end_events(batch)))
    assert table.filter("end_ts IS NULL").count() > 0


def test_a_join_keeps_one_store_per_partition(spark, tmp_path):
    schema = "unid string, table_suf string, vehicle_id string, begin_ts timestamp, end_ts timestamp, seen_ts timestamp"
    spark.createDataFrame([("a", "1", "V1", models.at(1), models.at(2), models.at(3))], schema).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    met = flows.ends_meet_begins(read().drop("end_ts"), read().select("unid", "end_ts", "table_suf", "seen_ts"), "1 day")
    drain(met, str(tmp_path / "out"), tmp_path / "c", "append")
    stores = [x.name for x in (tmp_path / "c" / "state" / "0" / "0").iterdir() if x.is_dir()]
    assert not [x for x in stores if x.startswith(("left", "right"))]
    assert [r.vehicle_id for r in read_batches(spark, str(tmp_path / "out")).collect()] == ["V1"]


def test_machines_get_each_row_as_a_text(spark, tmp_path):
    schema = "vehicle_id string, ts timestamp, seq bigint, hot boolean, cold boolean, in_charge double, soc double"
    odd = 'V"1\n{é\U0001f600'
    nan, far = float("nan"), float("inf")
    rows = [(odd, models.at(1), 1, True, False, nan, None), (odd, models.at(2), 2, True, False, 0.1, -far), ("V2", models.at(1), 2**60, True, False, far, 1e-7)]
    rows.append(("V2", models.at(9 * 86400), 4, False, True, None, nan))
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    signals = stateful.timed(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 minute")
    found = stateful.charge_changes(signals, "1 hour")
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "Project [ts" in plan and "_bucket" in plan and "_row" in plan
    drain(found, str(tmp_path / "out"), tmp_path / "c")
    out = {r["vehicle_id"]: r for r in read_batches(spark, str(tmp_path / "out")).collect()}
    assert set(out) == {odd, "V2"}
    first, second = out[odd], out["V2"]
    assert first["n"] == 2 and first["first_charge"] != first["first_charge"] and first["last_charge"] == 0.1 and first["rest_soc"] is None
    assert (second["n"], second["first_charge"], second["positive_charge"], second["first_soc"], second["closed"]) == (1, far, far, 1e-7, False)


@pytest.mark.parametrize("parts", [1, 4])
def test_charge_stream_equals_batch(spark, tmp_path, parts):
    vehicles, rules = tables_of(spark)
    df = spark.createDataFrame(random_records(4), RECORDS)
    stream = arrive(spark, df, str(tmp_path / "in"), parts, "30 minutes", DELAY if parts > 1 else None)
    drain(C.publish(stateful.charge_changes(C.charge_signals(stream, vehicles, rules), "1 hour")), str(tmp_path / "out"), tmp_path / "c")
    batch = C.charge_sessions(df, vehicles, rules, gap="1 hour")
    assert batch.filter("NOT is_open").count() > 3
    same(final(spark, str(tmp_path / "out"), ["row_key"]), batch)


def test_status_stream_equals_batch(spark, tmp_path):
    vehicles, rules = tables_of(spark)
    df = spark.createDataFrame(random_records(6, 60), RECORDS)
    status = S.record_status(stateful.last_records(arrive(spark, df, str(tmp_path / "in"), 3), "pairs"), vehicles, rules)
    drain(status.select("vehicle_id", F.col("active_status").cast("string").alias("active_status"), "ts"), str(tmp_path / "out"), tmp_path / "c")
    same(final(spark, str(tmp_path / "out"), ["vehicle_id"]), S.vehicle_status(df, vehicles, rules))


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    """A query that is started anew, with rows that came meanwhile, has the days of one that never stopped."""
    df = frame(spark, random_daily(7, n=90))
    first, second = df.filter("seq < 45"), df.filter("seq >= 45")
    source = str(tmp_path / "in")
    df.limit(0).write.parquet(source)
    stream = stateful.timed(spark.readStream.schema(df.schema).parquet(source), "1 minute")
    for part in (first, closing(second)):
        part.coalesce(1).write.mode("append").parquet(source)
        drain(stateful.daily_changes(stream, horizon_days=3), str(tmp_path / "out"), tmp_path / "c")
    same(final(spark, str(tmp_path / "out"), list(D.KEYS)), D.daily_stats(df))


def test_late_rows_are_counted(spark, tmp_path):
    rows = [("V1", models.at(s), i, float(s), None, None) for i, s in enumerate([10, 4000, 20, 5000, 30])]
    stream = arrive(spark, frame(spark, rows), str(tmp_path / "in"), 5)
    query = drain(stateful.daily_changes(stream), str(tmp_path / "out"), tmp_path / "c")
    assert stateful.late_rows(query) == 1
    row = final(spark, str(tmp_path / "out"), list(D.KEYS)).first()
    assert (row.work_time_ms, row.mile_total, row.work_start.hour) == (0, 5000.0, models.at(10).hour)


def test_a_wrong_clock_makes_no_row_late(spark, tmp_path):
    far = 10 * 365 * 86_400
    rows = [("A", models.at(0), 0, 100.0, None, None), ("B", models.at(far), 1, 1.0, None, None), ("A", models.at(120), 2, 120.0, None, None)]
    source = str(tmp_path / "in")
    for r in rows:
        frame(spark, [r]).coalesce(1).write.mode("append").parquet(source)
    closing(frame(spark, [rows[0], rows[2]])).filter("vehicle_id = 'END'").write.mode("append").parquet(source)
    stream = stateful.timed(spark.readStream.schema(frame(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(source), "1 minute")
    query = drain(stateful.daily_changes(stream), str(tmp_path / "out"), tmp_path / "c")
    got = {(r.vehicle_id, r.day): (r.mile_count, r.work_time_ms) for r in final(spark, str(tmp_path / "out"), list(D.KEYS)).collect()}
    assert got == {("A", "20240301"): (20.0, 120_000)} and stateful.late_rows(query) == 0


def test_a_batch_touches_the_state_of_its_own_vehicles(spark, tmp_path):
    hour = 3600
    rows = [(v, models.at(s), i, float(s + 1), None, None) for i, (v, s) in enumerate([("V1", 0), ("V2", 0), ("V1", hour), ("V1", 2 * hour), ("V1", 3 * hour)])]
    df = frame(spark, rows)
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    for group in (rows[:2], rows[2:3], rows[3:4], rows[4:]):
        frame(spark, group).coalesce(1).write.mode("append").parquet(source)
    stream = stateful.timed(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source), "1 minute")
    drain(stateful.daily_changes(stream), str(tmp_path / "out"), checkpoint)
    changes = flows.state_of(spark, checkpoint, stateVarName="days", readChangeFeed="true", changeStartBatchId=0)
    touched = {}
    for r in changes.select("batch_id", "key.vehicle_id").distinct().collect():
        touched.setdefault(r.vehicle_id, set()).add(r.batch_id)
    assert len(touched["V2"]) == 1 and len(touched["V1"]) >= 3


def test_vehicles_share_the_calls_to_the_state(spark, tmp_path):
    """A variable of the state is read and written once per bucket, and each vehicle's days are its own."""
    n = 3 * stateful.BUCKETS
    df = frame(spark, [(f"V{i % n}", models.at(i // n * 60 + i % 50), i, float(i % 97 + i // n), None, None) for i in range(2 * n)])
    stream = arrive(spark, df, str(tmp_path / "in"), 2)
    drain(stateful.daily_changes(stream, horizon_days=3), str(tmp_path / "out"), tmp_path / "c")
    same(final(spark, str(tmp_path / "out"), list(D.KEYS)), D.daily_stats(df))
    stored = spark.read.format("statestore").option("stateVarName", "days").load(str(tmp_path / "c"))
    assert 0 < stored.count() <= stateful.BUCKETS
    assert flows.state_of(spark, str(tmp_path / "c"), stateVarName="days").select("key.vehicle_id").distinct().count() == n


def test_a_batch_is_staged_in_several_files(spark, tmp_path):
    """Each file is read by one task."""
    from fleetpulse.plans.streams import Replay

    rows = spark.range(0, 1000, 1, 1).selectExpr("id", "cast(id % 2 AS int) AS batch")
    Replay(rows, str(tmp_path / "r"), 2)
    for k in range(2):
        assert len(list((tmp_path / f"r/staged/batch={k}").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "r/staged")).count() == 1000


def test_old_days_and_sessions_expire(spark, tmp_path):
    rows = [("V1", models.at(0), 0, 1.0, None, None), ("V2", models.at(0), 1, 1.0, None, None), ("V2", models.at(5 * 86400), 2, 1.0, None, None)]
    stream = arrive(spark, frame(spark, rows), str(tmp_path / "in"), 3)
    drain(stateful.daily_changes(stream), str(tmp_path / "out"), tmp_path / "c")
    kept = flows.state_of(spark, str(tmp_path / "c"), stateVarName="days").select("key.vehicle_id", "user_map_key.day").collect()
    # a vehicle that is silent loses its day too, by its timer
    assert sorted(map(tuple, kept)) == [("V2", "20240306")]

    vehicles, rules = tables_of(spark)
    charging = spark.createDataFrame([("V1", models.at(s), s, models.at(s), [("c", "", "", "1")]) for s in (0, 90_000)], RECORDS)
    signals = C.charge_signals(arrive(spark, charging, str(tmp_path / "in2"), 2), vehicles, rules)
    drain(C.publish(stateful.charge_changes(signals, expire_after="24 hours")), str(tmp_path / "charge"), tmp_path / "d")
    got = final(spark, str(tmp_path / "charge"), ["row_key"]).orderBy("start_date").collect()
    assert [r.is_open for r in got] == [False, False]


def message(vehicle, second, **metrics):
    pairs = [{"code": "ENTITY_UNID", "value": vehicle}] + [{"code": "", "alias": k, "value": str(v)} for k, v in metrics.items()]
    return json.dumps({"TIMESTAMP": 0, "DATIME_RX": f"2024-03-01 06:00:{second:02d}", "pairs": pairs})


def test_messages_to_two_machines(spark, tmp_path):
    """One parsed stream feeds the charging and the daily machine; a record unfit for one still counts for the other."""
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [message("V1", 1, MILEAGE=10, c=1), "{bad", message("V1", 3, MILEAGE=14, c=1), message("V1", 5, MILEAGE=20, SOC="junk", c=1)]
    (folder / "a.txt").write_text("\n".join(lines))
    (folder / "b.txt").write_text(message("END", 59).replace("2024-03-01", "2024-03-09"))
    records = flows.record_stream(streams.message_stream(spark, "text", str(folder)))
    both = stateful.daily_and_charge(stateful.timed(records, "1 minute"), *tables_of(spark))
    out = str(tmp_path / "out")
    drain(both, out, tmp_path / "c", prepare=lambda batch: dict(zip(("daily", "charge"), stateful.split_both(batch))))
    row = final(spark, f"{out}/daily", list(D.KEYS)).first()
    assert (row.vehicle_id, row.mile_count, row.work_time_ms) == ("V1", 10.0, 4000)
    sessions = final(spark, f"{out}/charge", ["row_key"]).collect()
    assert [r.is_open for r in sessions] == [True]


def test_running_word_count(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(["the cow jumped", "the moon  x", "the end"]):
        (folder / f"{i}.txt").write_text(text)
    stream = streams.message_stream(spark, "text", str(folder), maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    counts = flows.running_word_count(stream, "str")
    drain(counts, out, tmp_path / "checkpoint")
    texts = spark.read.text(str(folder)).withColumnRenamed("value", "sentence")
    same(latest_version(read_batches(spark, out), ["word"]), WC.word_count(texts))
    # the state has what was given out, and an earlier batch's state what was known then
    same(flows.live_counts(spark, str(tmp_path / "checkpoint")), WC.word_count(texts))
    early = flows.live_counts(spark, str(tmp_path / "checkpoint"), batchId=0)
    assert early.agg(F.sum("count")).first()[0] < texts.select(F.explode(F.split("sentence", " "))).count()


def test_flushed_last_waits_for_the_watermark(spark, tmp_path):
    rows = [("V1", models.at(s), i, float(s), None, None) for i, s in enumerate([0, 50, 130, 86_400])]
    df = frame(spark, rows).select("vehicle_id", "ts", "seq", "mileage")
    stream = files(spark, df, str(tmp_path / "in"), 4)
    drain(flows.flushed_last(stream, "2 minutes", "1 minute", "mileage"), str(tmp_path / "out"), tmp_path / "c", "append")
    got = read_batches(spark, str(tmp_path / "out")).select("mileage").collect()
    assert sorted(r.mileage for r in got) == [50.0, 130.0]


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_presence(spark, tmp_path, parts):
    """The same transitions, however the rows are cut into batches."""
    seconds = [("V1", 0), ("V1", 100), ("V2", 1000), ("V1", 1100), ("V2", 86_400), ("V2", 86_460)]
    df = frame(spark, [(v, models.at(s), i, 0.0, None, None) for i, (v, s) in enumerate(seconds)])
    stream = files(spark, df, str(tmp_path / "in"), parts)
    drain(stateful.presence(stream, "5 minutes", "10 seconds"), str(tmp_path / "out"), tmp_path / "c", "append")
    got = read_batches(spark, str(tmp_path / "out"))
    v1 = [(r.active_status, r.t) for r in got.filter("vehicle_id = 'V1'").select(
        "active_status", F.col("ts").cast("timestamp_ntz").alias("t")).orderBy("ts").collect()]
    assert v1 == [("2", models.at(0)), ("0", models.at(400)), ("2", models.at(1100)), ("0", models.at(1400))]


def test_stream_is_enriched_from_wide_rows(spark, tmp_path):
    df = frame(spark, [(v, models.at(0), i, 0.0, None, None) for i, v in enumerate(["V1", "V2"])]).select("vehicle_id", "seq")
    wide = spark.createDataFrame([("V1", "7")], "row_key string, hours string")
    stream = files(spark, df, str(tmp_path / "in"), 1)
    drain(flows.enrich(stream, wide, "vehicle_id"), str(tmp_path / "out"), tmp_path / "c", "append")
    got = read_batches(spark, str(tmp_path / "out")).select("vehicle_id", "hours").collect()
    assert sorted(map(tuple, got)) == [("V1", "7"), ("V2", None)]


def test_sample_sources(spark):
    words = streams.random_sentences(spark, ["a b", "c"])
    assert words.isStreaming and words.columns == ["word"]
    cycle = streams.cycling_rows(spark, [("the", 1), ("cow", 1)], "word string, count int")
    assert cycle.isStreaming and cycle.columns == ["word", "count"]
    assert "KafkaV2" not in str(words)


@pytest.mark.parametrize("build", [lambda s: streams.message_stream(s, **{"kafka.bootstrap.servers": "h:1"})])
def test_kafka_needs_its_package(spark, build):
    with pytest.raises(Exception, match="kafka"):
        build(spark)
