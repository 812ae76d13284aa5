import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import models
from fleetpulse.functions import messages as M
from fleetpulse.functions.times import micros
from fleetpulse.operators import alarms as A
from fleetpulse.operators import charging as C
from fleetpulse.operators import daily as D
from fleetpulse.operators import rules as R
from fleetpulse.operators import status as S
from fleetpulse.operators import timeline as TL

ROWS = "vehicle_id string, ts timestamp, seq bigint, mileage double, energy double, fuel double"


def frame(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    return df.select(
        "*", F.lit(0.0).alias("charge_all"), F.lit("0.0").alias("charge_status"), F.col("ts").alias("timestamp")
    )


def trace(values, step=60, vehicle="V1", start=0):
    return [(vehicle, models.at(start + i * step), i, v, None, None) for i, v in enumerate(values)]


def naive(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def stats(spark, rows, **options):
    out = naive(D.daily_stats(frame(spark, rows), **options), "work_start", "work_end").collect()
    return {(r.day, r.vehicle_id): r for r in out}


DAY = "20240301"


@pytest.mark.parametrize(
    "values,start_end_count",
    [
        ([0.0, 100.0, 150.0, 120.0], (150.0, 50.0)),
        ([100.0, 350.0, 700.0, 400.0], (700.0, 250.0)),
        ([100.0, 599.9], (599.9, 499.9)),
        ([100.0, 600.0], (600.0, 0.0)),
        ([0.0, 0.0], (0.0, 0.0)),
        ([100.0, 100.0], (100.0, 0.0)),
        ([100.0, 700.0, 710.0], (710.0, 0.0)),
    ],
)
def test_mileage(spark, values, start_end_count):
    row = stats(spark, trace(values))[(DAY, "V1")]
    assert (row.mile_total, pytest.approx(row.mile_count)) == start_end_count


def test_work_time_gaps(spark):
    seconds = [0, 60, 359, 659, 960]  # gaps 60, 299, 300, 301
    rows = [("V1", models.at(s), i, 0.0, None, None) for i, s in enumerate(seconds)]
    row = stats(spark, rows)[(DAY, "V1")]
    assert row.work_time_ms == 359_000
    assert (row.work_start, row.work_end) == (models.at(0), models.at(960))


def test_energy_fuel_and_midnight(spark):
    energies = [10.0, 8.0, 15.0]
    rows = [("V1", models.at(i), i, 0.0, e, None) for i, e in enumerate(energies)]
    rows += [("V1", models.at(18 * 3600 + 5), 9, 0.0, 40.0, 2.0)]
    out = stats(spark, rows)
    assert (out[(DAY, "V1")].energy_count, out[(DAY, "V1")].fuel_count) == (5.0, 0.0)
    assert (out[("20240302", "V1")].energy_count, out[("20240302", "V1")].fuel_total) == (0.0, 2.0)


def random_daily(seed, n=400, vehicles=3, span=2 * 86400):
    rng = random.Random(seed)
    odometer, rows = [0.0] * vehicles, []
    for i, s in enumerate(sorted(rng.randrange(span) for _ in range(n))):
        v = 0 if rng.random() < 0.6 else rng.randrange(vehicles)
        odometer[v] += rng.choice([0, 1, 5, 40, 200])
        mile = rng.choice([0.0, odometer[v], odometer[v], odometer[v] - 30, odometer[v] + 600 * (rng.random() < 0.02)])
        rows.append((f"V{v}", models.at(s), i, float(mile), rng.choice([None, float(s % 700)]), rng.choice([None, 0.0, s / 100])))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_daily_against_model(spark, seed):
    rows = random_daily(seed)
    want = models.daily(rows)
    for width in ("10 minutes", "1 day", "7 hours"):
        got = stats(spark, rows, slice_width=width)
        assert got.keys() == want.keys()
        for key, w in want.items():
            g = got[key]
            assert (g.mile_total, g.work_start, g.work_end) == (w["mile"][1], w["start"], w["end"])
            assert g.work_time_ms == w["work"] * 1000
            assert g.mile_count == pytest.approx(w["count"])
            assert g.energy_count == pytest.approx(w["energy"][1] - w["energy"][0])
            assert g.fuel_count == pytest.approx(w["fuel"][1] - w["fuel"][0])


def test_flushes_end_in_the_daily_row(spark):
    rows = random_daily(9)
    df = frame(spark, rows)
    flushes = D.daily_flushes(df, every="5 minutes").collect()
    final = {(r.day, r.vehicle_id): r for r in D.daily_stats(df).collect()}
    last, deltas = {}, {}
    for r in sorted(flushes, key=lambda r: r.flush_ts):
        key = (r.day, r.vehicle_id)
        last[key] = r
        deltas[key] = deltas.get(key, 0) + r.work_delta_ms
    for key, row in final.items():
        assert (last[key].mile_count, last[key].work_time_ms, last[key].energy_count) == (
            row.mile_count, row.work_time_ms, row.energy_count)
        assert deltas[key] == row.work_time_ms


@pytest.mark.parametrize("every", ["1 hour", "1 day", "25 minutes"])
def test_flush_interval_and_slice_width_are_apart(spark, every):
    df = frame(spark, random_daily(11))
    want = sorted(D.daily_flushes(df, every=every, slice_width="1 day").collect())
    for width in ("10 minutes", "7 hours"):
        assert sorted(D.daily_flushes(df, every=every, slice_width=width).collect()) == want


@pytest.mark.parametrize("cut", [100, 250])
def test_statistics_go_on_from_stored_ones(spark, cut):
    rows = random_daily(12)
    state = D.merge(D.fragments(frame(spark, rows[:cut])))
    later = D.fragments(frame(spark, rows[cut:]), state=state)
    got = D.report(D.merge(state.unionByName(later.drop("flush")))).collect()
    assert sorted(got) == sorted(D.daily_stats(frame(spark, rows)).collect())


def test_mile_aggregate_and_hours(spark):
    rows = trace([10.0, 30.0, 15.0]) + trace([7.0], vehicle="V2")
    got = {r.vehicle_id: r for r in D.mile_aggregate(frame(spark, rows)).collect()}
    assert tuple(got["V1"])[1:] == (10.0, 15.0, 25.0, 10.0)
    assert tuple(got["V2"])[1:] == (0.0, 0.0, 0.0, 7.0)
    deltas = spark.createDataFrame([("V1", 5), ("V1", 6), ("V2", 1)], "vehicle_id string, work_delta_ms bigint")
    stored = spark.createDataFrame([("V1", 100)], "vehicle_id string, work_ms bigint")
    assert {r.vehicle_id: r.work_ms for r in D.work_hours(deltas, stored).collect()} == {"V1": 111, "V2": 1}


# ---- episodes

SIGNALS = "vehicle_id string, ts timestamp, seq bigint, hot boolean"


def mark(spark, rows, gap, width):
    df = spark.createDataFrame(rows, SIGNALS).select(
        "*",
        F.coalesce("hot", F.lit(False)).alias("h"),
        (F.col("hot") == F.lit(False)).alias("c"),
    )
    df = df.select(
        "vehicle_id", "ts", "seq", F.col("h").alias("hot"), F.coalesce("c", F.lit(False)).alias("cold"),
        F.lit("c").alias("code"), F.lit(1).alias("level"), F.lit(0).alias("neg_inx"), F.lit("n").alias("alarm_name"),
    )
    rule = A.gap_rule(gap, slice_width=width)
    out = A.merge(A.fragments(df, rule), rule).withColumn("begin_ts", F.timestamp_micros("_first_us"))
    out = naive(out, "begin_ts")
    out = out.withColumn("end", F.when(F.col("closed"), F.timestamp_micros("_hot_us").cast("timestamp_ntz")))
    return sorted((r.vehicle_id, r.begin_ts, r.end) for r in out.collect())


def signal(*events):
    return [("V1", models.at(s), i, hot) for i, (s, hot) in enumerate(events)]


@pytest.mark.parametrize("width", ["10 minutes", "1 minute", "1 day"])
def test_alarm_traces(spark, width):
    hot, cold = True, False
    closes = mark(spark, signal((0, hot), (300, cold), (301, cold), (400, cold)), "5 minutes", width)
    assert closes == [("V1", models.at(0), models.at(0))]
    assert mark(spark, signal((0, hot), (300, cold)), "5 minutes", width) == [("V1", models.at(0), None)]
    assert mark(spark, signal((0, hot), (3600, hot)), "5 minutes", width) == [("V1", models.at(0), None)]
    two = mark(spark, signal((0, hot), (360, cold), (361, hot)), "5 minutes", width)
    assert two == [("V1", models.at(0), models.at(0)), ("V1", models.at(361), None)]
    one = mark(spark, signal((0, hot), (240, cold), (250, hot), (520, cold)), "5 minutes", width)
    assert one == [("V1", models.at(0), None)]
    nothing = mark(spark, signal((0, None), (10, cold), (900, None)), "5 minutes", width)
    assert nothing == []


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 4000), st.sampled_from([True, False, False, None]), st.sampled_from("ab")), max_size=60),
    st.sampled_from(["1 minute", "7 minutes", "1 day"]),
)
def test_episodes_against_model(spark, events, width):
    rows = [(k, models.at(s), i, hot) for i, (s, hot, k) in enumerate(events)]
    want = sorted(models.episodes(rows, 300), key=lambda e: (e[0], e[1]))
    assert mark(spark, rows, "5 minutes", width) == want


CHARGES = "vehicle_id string, ts timestamp, seq bigint, hot boolean, in_charge double, soc double"


def charge(spark, rows, gap="30 minutes", width="10 minutes"):
    df = spark.createDataFrame(rows, CHARGES).withColumn("cold", ~F.col("hot"))
    rule = C.gap_rule(gap, slice_width=width)
    out = C.publish(C.merge(C.fragments(df, rule), rule))
    return sorted(
        (
            (r.vehicle_id, r.start_date, r.end_date, r.start_charge, r.end_charge, r.start_soc, r.end_soc, r.is_open)
            for r in naive(out, "start_date", "end_date").collect()
        ),
        key=lambda r: (r[0], r[1]),
    )


def test_charge_traces(spark):
    def run(charges, socs, tail):
        rows = [("V1", models.at(i * 60), i, True, float(c), float(s)) for i, (c, s) in enumerate(zip(charges, socs))]
        last = (len(charges) - 1) * 60
        rows += [("V1", models.at(last + t), 100 + t, False, 0.0, 0.0) for t in tail]
        return charge(spark, rows)

    assert run([1], [5], [1800])[0][-1] is True
    assert run([1], [5], [1800, 1801])[0][-1] is False
    (s,) = run([0, 0, 3, 5, 8], [20, 0, 30, 0, 0], [2000])
    assert s[3:7] == (3.0, 8.0, 20.0, 30.0)
    (s,) = run([0, 4], [1, 0], [2000])
    assert s[3:5] == (0.0, 4.0)


@pytest.mark.parametrize("seed", range(3))
def test_sessions_against_model(spark, seed):
    rng = random.Random(seed)
    rows = [
        (f"V{rng.randrange(3)}", models.at(s), i, rng.random() < 0.3, rng.choice([0.0, 0.0, 3.0, float(i)]), float(rng.choice([0, i])))
        for i, s in enumerate(sorted(rng.randrange(60_000) for _ in range(300)))
    ]
    want = sorted(models.sessions(rows, 1800), key=lambda r: (r[0], r[1]))
    for width in ("10 minutes", "1 minute", "1 day"):
        assert charge(spark, rows, width=width) == want


def test_daily_charge_accumulates(spark):
    sessions = spark.createDataFrame(
        [("V1", models.at(0), 2.0, False), ("V1", models.at(9), 3.0, False), ("V1", models.at(20), None, True)],
        "vehicle_id string, start_date timestamp, charge double, is_open boolean",
    )
    assert tuple(C.daily_charge(sessions).first()) == (DAY, "V1", 2, 5.0)


# ---- rules, status, alarms end to end

RULES = (
    "fiber_unid string, code string, option string, value int, value_last int, status int, remarks string, "
    "alarm_level int, alarm_name string, type int, flag_del int, inx int"
)


def fixtures(spark):
    rules = spark.createDataFrame(
        [
            ("F0", "t", ">", 50, 0, 5, "", 0, "", 1, 0, 1),
            ("F0", "t", ">", 80, 0, 6, "", 0, "", 1, 0, 2),
            ("F0", "t", ">", 10, 0, 9, "", 0, "", 1, 1, 3),
            ("F0", "c", "=", 1, 0, 3, "", 0, "", 1, 0, 0),
            ("F0", "t", ">", 90, 0, 1, "", 2, "hot", 2, 0, 1),
            ("F0", "t", ">", 95, 0, 1, "", 2, "very hot", 2, 0, 2),
            ("F0", "t", ">", 0, 0, 1, "", None, "no level", 2, 0, 3),
            ("F0", "t", ">", 0, 0, 1, "", 4, None, 2, 0, 4),
            ("F0", "t", ">", 0, 0, 0, "", 5, "never", 2, 0, 5),
        ],
        RULES,
    )
    vehicles = spark.createDataFrame(
        [("V1", "F0", "D", 1.0, 2.0, "0"), ("V2", "F0", "D", None, 2.0, "4"), ("V3", None, "D", 1.0, 2.0, None)],
        "vehicle_id string, fiber_unid string, domain_unid string, lat double, lon double, active_status string",
    )
    return rules, vehicles


def record(vehicle, s, seq, **pairs):
    return (vehicle, models.at(s), seq, [("", k, "", v) for k, v in pairs.items()])


RECORDS = "vehicle_id string, ts timestamp, seq bigint, pairs array<struct<code:string,alias:string,title:string,value:string>>"


def test_status(spark):
    rules, vehicles = fixtures(spark)
    records = spark.createDataFrame(
        [
            record("V1", 0, 1, t="85"), record("V1", 1, 2, t="60"), record("V1", 2, 3, t="junk"),
            record("V1", 3, 4, c="1"), record("V1", 4, 5), record("V2", 0, 6, t="20"), record("V3", 0, 7, t="85"),
            record("V9", 0, 8, t="85"),
        ],
        RECORDS,
    )
    got = {r.seq: r.active_status for r in S.record_status(records, vehicles, rules).collect()}
    assert got == {1: 6, 2: 5, 3: 2, 4: 3, 5: 2, 6: 2, 7: 2, 8: 2}
    held = {r.seq: r.active_status for r in S.record_status(records, vehicles, rules, keep_current=True).collect()}
    assert held == {1: 6, 2: 5, 3: 2, 4: 3, 5: 2, 6: 4, 7: 2, 8: 2}
    last = {r.vehicle_id: r.active_status for r in S.vehicle_status(records, vehicles, rules).collect()}
    assert last == {"V1": "2", "V2": "2", "V3": "2", "V9": "2"}


def test_rule_lists_and_order(spark):
    rules, _ = fixtures(spark)
    listed = R.rules_by_model(R.select_rules(rules, R.STATUS_RULE)).first()
    assert [r.status for r in listed.rules] == [6, 5, 3]
    assert [r.inx for r in R.ordered_rules(R.select_rules(rules, R.STATUS_RULE)).collect()] == [2, 1, 0]


def test_alarms(spark):
    rules, vehicles = fixtures(spark)
    end_of_month = 30 * 86400 + 64000  # 2024-03-31 23:46:40
    records = spark.createDataFrame(
        [
            record("V1", end_of_month, 1, t="92"),
            record("V1", end_of_month + 100, 2, t="junk"),
            record("V1", end_of_month + 900, 3, other="1"),
            record("V1", end_of_month + 1000, 4, t="10"),
            record("V1", end_of_month + 1001, 5, t="99"),
            record("V2", end_of_month, 6, t="99"),
            record("V3", end_of_month, 7, t="99"),
        ],
        RECORDS,
    )
    rows = naive(A.alarm_episodes(records, vehicles, rules), "begin_ts", "end_ts").orderBy("begin_ts").collect()
    assert [(r.vehicle_id, r.code, r.level, r.error_name, r.table_suf) for r in rows] == [
        ("V1", "t", 2, "hot", "202403"), ("V1", "t", 2, "very hot", "202404")]
    assert rows[0].end_ts == models.at(end_of_month) and rows[1].end_ts is None
    assert len({r.unid for r in rows}) == 2

    episodes = A.alarm_episodes(records, vehicles, rules)
    ended = A.end_events(episodes)
    assert [r.table_suf for r in ended.collect()] == ["202403"]
    events = {r.unid: r.flag_did for r in A.apply_ends(A.begin_events(episodes), ended.union(ended)).collect()}
    assert sorted(events.values()) == [0, 1]
    snap = A.alarm_snapshot(episodes).first()
    assert (snap.count_alert, snap.level_alert) == (1, 2)

    seen = spark.createDataFrame([("V1", "5", models.at(0))], "vehicle_id string, active_status string, last_rx timestamp")
    now = F.lit(models.at(0) + timedelta(minutes=6))
    assert A.close_offline(A.open_alarms(episodes), S.offline_sweep(seen, now), now).count() == 1
    soon = F.lit(models.at(0) + timedelta(minutes=5))
    assert A.close_offline(A.open_alarms(episodes), S.offline_sweep(seen, soon), soon).count() == 0


def test_charge_predicate(spark):
    rules, vehicles = fixtures(spark)
    records = spark.createDataFrame(
        [record("V1", 0, 1, c="1"), record("V1", 1, 2, t="1"), record("V1", 2, 3, c="1", SOC="junk"), record("V3", 0, 4, c="1")],
        RECORDS,
    )
    got = {r.seq: (r.hot, r.cold) for r in C.charge_signals(records, vehicles, rules).collect()}
    assert got == {1: (True, False), 2: (False, True), 4: (False, True)}


def test_expiry_closes_old_sessions(spark):
    df = spark.createDataFrame(
        [("V1", models.at(0), False), ("V2", models.at(90_000), False)], "vehicle_id string, begin_ts timestamp, closed boolean"
    ).withColumn("_first_us", F.unix_micros("begin_ts"))
    out = C.expire_sessions(df, F.lit(models.at(90_001)), micros("1 day"))
    assert {r.vehicle_id: r.closed for r in out.collect()} == {"V1": True, "V2": False}


def test_slice_width_fits_the_busiest_key(spark):
    rows = frame(spark, trace([1.0] * 120, step=1) + trace([1.0] * 5, step=3600, vehicle="V2"))
    fitted = {n: TL.fit_slice_width(rows, ["vehicle_id"], n) for n in (1000, 60, 59, 10, 1)}
    assert fitted == {1000: "1 day", 60: "1 minute", 59: "10 seconds", 10: "10 seconds", 1: "1 second"}


def test_hot_vehicle_is_split(spark):
    """No row-level exchange or window may group by the vehicle alone."""
    rows = frame(spark, trace([1.0]))
    plan = D.fragments(rows)._jdf.queryExecution().executedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "Window [" in line and "lag(" in line]
    assert row_windows and all("_slice" in line for line in row_windows)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(exchanges) == 2 and sum("_slice" in line for line in exchanges) == 1


def test_daily_reads_and_parses_once(spark):
    text = F.concat(F.lit('{"vehicle_id": "V1", "mileage": "'), F.col("id"), F.lit('"}'))
    raw = spark.range(9).select(text.alias("str"), F.col("id").alias("seq"))
    plan = D.daily_stats(D.readings(M.parse_messages(raw)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 2


def test_episode_rows_are_exchanged_once_per_slice(spark):
    rules, vehicles = fixtures(spark)
    records = spark.createDataFrame([record("V1", 0, 1, t="99")], RECORDS)
    signals = A.alarm_signals(records, vehicles, rules)
    plan = A.fragments(signals, A.gap_rule())._jdf.queryExecution().executedPlan().toString()
    row_exchanges = [line for line in plan.splitlines() if "hashpartitioning(vehicle_id" in line and "_slice" in line]
    assert len(row_exchanges) == 1
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_slice" in line for line in windows)
