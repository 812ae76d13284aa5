"""Vehicle queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetpulse.operators import alarms as A
from fleetpulse.operators import charging as C
from fleetpulse.operators import combine as CB
from fleetpulse.operators import daily as D
from fleetpulse.operators import rules as R
from fleetpulse.operators import status as S
from fleetpulse.functions import messages as M
from fleetpulse.functions import times as TM
from fleetpulse.plans import sqltext as Q
from fleetpulse.plans.registry import query
from fleetpulse.sources import adapter
from fleetpulse.session import scratch_path
from fleetpulse.sources.sinks import append_batch, read_batches
from fleetpulse.sources.tables import deal, with_rule_defaults

FLEET = (Q.READINGS, Q.VEHICLES, Q.RULES, Q.CHECKS)
SECOND_FLEET = (Q.SECOND_READINGS, Q.VEHICLES, Q.RULES, Q.CHECKS)
HALF_DAY, DAY = "12 hours", "24 hours"
DAILY_COLUMNS = (
    "day, vehicle_id, mile_count, mile_total, work_start, work_end, work_time_ms, energy_count, energy_total, "
    "fuel_count, fuel_total, charge_status, charge_all"
)


def _events(spark, sf):
    return adapter.load(spark, sf, "events")


def _vehicles(spark, sf):
    return adapter.vehicles(adapter.load(spark, sf, "customer"))


def _rules(spark, sf):
    return adapter.rules(adapter.load(spark, sf, "nation"))


def _records(spark, sf):
    return adapter.records(deal(_events(spark, sf), "event_id"))


def _fleet(spark, sf):
    return _records(spark, sf), _vehicles(spark, sf), _rules(spark, sf)


def _wire(spark, sf):
    return adapter.wire_messages(deal(_events(spark, sf), "event_id"))


def _wire_records(spark, sf):
    """Messages as JSON text, parsed again."""
    return M.with_vehicle(M.parse_messages(_wire(spark, sf)))


# ---- daily statistics


def _daily(spark, sf):
    return D.daily_stats(adapter.readings(_events(spark, sf)))


@query("daily_stats", Q.with_ctes(Q.READINGS, Q.DAILY, select="SELECT *, work_end AS statistic_ts FROM daily"))
def daily_stats(spark, sf):
    return _daily(spark, sf)


@query("daily_mileage", Q.with_ctes(Q.READINGS, Q.DAILY, select="SELECT day, vehicle_id, mile_count, mile_total FROM daily"))
def daily_mileage(spark, sf):
    return _daily(spark, sf).select("day", "vehicle_id", "mile_count", "mile_total")


@query("daily_energy", Q.with_ctes(Q.READINGS, Q.DAILY, select="SELECT day, vehicle_id, energy_count, energy_total FROM daily"))
def daily_energy(spark, sf):
    return _daily(spark, sf).select("day", "vehicle_id", "energy_count", "energy_total")


@query("daily_fuel", Q.with_ctes(Q.READINGS, Q.DAILY, select="SELECT day, vehicle_id, fuel_count, fuel_total FROM daily"))
def daily_fuel(spark, sf):
    return _daily(spark, sf).select("day", "vehicle_id", "fuel_count", "fuel_total")


@query(
    "daily_work_time",
    Q.with_ctes(
        Q.READINGS,
        Q.DAILY.replace("300000000", "10800000000"),
        select="SELECT day, vehicle_id, work_start, work_end, work_time_ms FROM daily",
    ),
)
def daily_work_time(spark, sf):
    stats = D.daily_stats(adapter.readings(_events(spark, sf)), work_gap="3 hours")
    return stats.select("day", "vehicle_id", "work_start", "work_end", "work_time_ms")


FLUSHES = """
flushes AS (
  SELECT day, vehicle_id, make_timestamp((us // 21600000000 + 1) * 21600000000) AS flush_ts,
    coalesce(sum(gap) FILTER (WHERE gap < 10800000000), 0) AS delta_us,
    max(high - low) FILTER (WHERE high - low > 0 AND high - low < 500) AS d, max(high) AS h,
    arg_max(charge_status, ord) AS charge_status
  FROM walked GROUP BY ALL
)"""


@query(
    "daily_flushes",
    Q.with_ctes(
        Q.READINGS,
        Q.DAILY,
        FLUSHES,
        select="""SELECT day, vehicle_id, flush_ts, cast(delta_us // 1000 AS BIGINT) AS work_delta_ms,
          cast(sum(delta_us) OVER w // 1000 AS BIGINT) AS work_time_ms,
          coalesce(max(d) OVER w, 0.0) AS mile_count, coalesce(max(h) OVER w, 0.0) AS mile_total, charge_status
        FROM flushes WINDOW w AS (PARTITION BY day, vehicle_id ORDER BY flush_ts)""",
    ),
)
def daily_flushes(spark, sf):
    flushes = D.daily_flushes(adapter.readings(_events(spark, sf)), every="6 hours", work_gap="3 hours")
    return flushes.select(
        "day", "vehicle_id", "flush_ts", "work_delta_ms", "work_time_ms", "mile_count", "mile_total", "charge_status"
    )


@query(
    "work_hours",
    Q.with_ctes(
        Q.READINGS,
        Q.DAILY.replace("300000000", "10800000000"),
        select="SELECT vehicle_id, cast(sum(work_time_ms) AS BIGINT) AS work_ms FROM daily GROUP BY vehicle_id",
    ),
)
def work_hours(spark, sf):
    stats = D.daily_stats(adapter.readings(_events(spark, sf)), work_gap="3 hours")
    return D.work_hours(stats.withColumnRenamed("work_time_ms", "work_delta_ms"))


MILES = Q.with_ctes(
    Q.READINGS,
    """agg AS (SELECT vehicle_id, count(*) AS n, sum(cast(mileage AS DECIMAL(28, 6))) AS s,
      arg_min(mileage, ord) AS f, arg_max(mileage, ord) AS e FROM readings GROUP BY vehicle_id)""",
    select="""SELECT vehicle_id, CASE WHEN n > 1 THEN f ELSE 0.0 END AS mile_start,
      CASE WHEN n > 1 THEN e ELSE 0.0 END AS mile_end,
      CASE WHEN n > 1 THEN cast(s - n * cast(f AS DECIMAL(28, 6)) AS DOUBLE) ELSE 0.0 END AS mile_count,
      f AS mile_total FROM agg""",
)


@query("mile_aggregator", MILES)
def mile_aggregator(spark, sf):
    return D.mile_aggregate(adapter.readings(_events(spark, sf)))


@query("mile_combiner", MILES)
def mile_combiner(spark, sf):
    """The same by a user's combiner."""
    return CB.distances(adapter.readings(deal(_events(spark, sf), "event_id")))


COALESCED = """SELECT vehicle_id, make_timestamp((us // 21600000000 + 1) * 21600000000) AS flush_ts,
  max(seq) AS seq, arg_max(mileage, ord) AS mileage, arg_max(soc, ord) AS soc
FROM readings GROUP BY 1, 2"""


@query("coalesced_last", Q.with_ctes(Q.READINGS, select=COALESCED))
def coalesced_last(spark, sf):
    return S.coalesce_last(adapter.readings(_events(spark, sf)), "6 hours", "seq", "mileage", "soc")


# ---- messages


@query(
    "parse_messages",
    Q.with_ctes(
        Q.SECOND_READINGS,
        select="""SELECT vehicle_id, ts, seq, make_timestamp(epoch_us(exact_ts) // 1000 * 1000) AS message_ts,
          mileage, coalesce(energy, 0.0) AS energy, fuel, charge_all, charge_status, in_charge, soc,
          cast(NULL AS DOUBLE) AS speed, cast(NULL AS VARCHAR) AS device_id FROM readings""",
    ),
)
def parse_messages(spark, sf):
    rows = M.with_metrics(M.with_event_time(_wire_records(spark, sf)))
    return rows.select(
        "vehicle_id", "ts", "seq", F.col("timestamp").alias("message_ts"), *[m for m in M.METRICS]
    )


@query(
    "parse_malformed",
    Q.with_ctes(Q.SECOND_READINGS, select="SELECT seq, vehicle_id, mileage FROM readings WHERE seq % 13 NOT IN (0, 5, 7)"),
)
def parse_malformed(spark, sf):
    """Messages of which some are cut off, some no JSON and some null: these are left out, the rest is read."""
    seq, text = F.col("seq"), F.col("str")
    broken = F.when(seq % 13 == 0, F.substring(text, F.lit(1), F.length(text) - 2)).when(seq % 13 == 5, F.lit("no message")).when(seq % 13 != 7, text)
    parsed = M.with_vehicle(M.parse_messages(_wire(spark, sf).select("seq", broken.alias("str"))))
    return M.with_metrics(parsed, "mileage").select("seq", "vehicle_id", "mileage")


@query(
    "pair_lookup",
    Q.with_ctes(
        Q.READINGS,
        select="""SELECT seq, CASE WHEN code = 'click' THEN value END AS click, soc,
          CASE WHEN code = 'error' THEN value END AS error FROM readings""",
    ),
)
def pair_lookup(spark, sf):
    def found(code):
        return M.number(M.pair_by_code(F.col("pairs"), code)["value"])

    return _records(spark, sf).select(
        "seq", found("click").alias("click"), found("SOC").alias("soc"), found("error").alias("error")
    )


@query(
    "row_keys",
    Q.with_ctes(
        Q.READINGS,
        select="""SELECT seq, day || '-' || vehicle_id AS day_key,
          strftime(ts - INTERVAL 24 HOUR, '%Y%m%d') || '-' || vehicle_id AS previous_day_key,
          (us // 1000) || '-' || vehicle_id AS millis_key, strftime(ts, '%Y%m') AS table_suf,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS text, date_trunc('second', ts) AS back,
          upper(md5(concat_ws('#', vehicle_id, us))) AS unid FROM readings""",
    ),
)
def row_keys(spark, sf):
    ts, v = F.col("ts"), F.col("vehicle_id")
    return adapter.readings(_events(spark, sf)).select(
        "seq",
        TM.day_key(ts, v).alias("day_key"),
        TM.previous_day_key(ts, v).alias("previous_day_key"),
        TM.millis_key(ts, v).alias("millis_key"),
        TM.month_suffix(ts).alias("table_suf"),
        TM.second_text(ts).alias("text"),
        TM.parse_second_text(TM.second_text(ts)).alias("back"),
        TM.episode_unid(v, F.unix_micros(ts)).alias("unid"),
    )


# ---- rules and status


@query(
    "rules_by_model",
    Q.with_ctes(
        Q.VEHICLES,
        Q.RULES,
        select="""SELECT v.vehicle_id, v.fiber_unid, r.rule_list FROM vehicles v LEFT JOIN (
          SELECT fiber_unid, string_agg(inx || ':' || code || ':' || option, ',' ORDER BY inx DESC) AS rule_list
          FROM rules WHERE type = 1 AND flag_del = 0 GROUP BY fiber_unid) r USING (fiber_unid)""",
    ),
)
def rules_by_model(spark, sf):
    vehicles = _vehicles(spark, sf).select("vehicle_id")
    listed = R.with_model_rules(vehicles, _vehicles(spark, sf), R.select_rules(_rules(spark, sf), R.STATUS_RULE))
    text = F.transform("rules", lambda r: F.concat_ws(":", (-r["neg_inx"]).cast("string"), r["code"], r["option"]))
    return listed.select("vehicle_id", "fiber_unid", F.array_join(text, ",").alias("rule_list"))


@query(
    "rule_matches",
    Q.with_ctes(*FLEET, select="SELECT seq, vehicle_id, code, type, inx, holds FROM checks"),
)
def rule_matches(spark, sf):
    records, vehicles, rules = _fleet(spark, sf)
    kept = rules.filter(F.col("flag_del") == 0)
    return R.rule_checks(records, vehicles, kept).select("seq", "vehicle_id", "code", "type", "inx", "holds")


@query(
    "rules_as_loaded",
    Q.with_ctes(
        Q.READINGS,
        Q.VEHICLES,
        Q.RULES.replace("rules AS", "full_rules AS"),
        """rules AS (SELECT * REPLACE (CASE WHEN inx = 24 THEN '' ELSE code END AS code, CASE WHEN inx % 5 = 0 THEN '=' ELSE option END AS option,
          CASE WHEN inx % 7 = 0 THEN 0 ELSE value_low END AS value_low, CASE WHEN inx % 3 = 0 THEN 0 ELSE value_last END AS value_last) FROM full_rules)""",
        Q.CHECKS,
        select="SELECT seq, vehicle_id, code, type, inx, holds FROM checks WHERE code <> ''",
    ),
)
def rules_as_loaded(spark, sf):
    """Rules as a table has them, with upper-case names and nulls, matched after their defaults are set."""
    records, vehicles, rules = _fleet(spark, sf)
    missing = {"code": F.col("inx") == 24, "option": F.col("inx") % 5 == 0, "value": F.col("inx") % 7 == 0, "value_last": F.col("inx") % 3 == 0}
    raw = rules.select(*[(F.when(~missing[c], F.col(c)) if c in missing else F.col(c)).alias(c.upper()) for c in rules.columns])
    kept = with_rule_defaults(raw).filter(F.col("flag_del") == 0)
    found = R.rule_checks(records, vehicles, kept).filter("code <> ''")
    return found.select("seq", "vehicle_id", "code", "type", "inx", "holds")


@query(
    "record_status",
    Q.with_ctes(*FLEET, Q.STATUS, select="SELECT seq, vehicle_id, coalesce(matched, 2) AS active_status FROM statuses"),
)
def record_status(spark, sf):
    return S.record_status(*_fleet(spark, sf)).select("seq", "vehicle_id", "active_status")


LATEST_STATUS = """SELECT vehicle_id, cast(arg_max(coalesce(matched, 2), ord) AS VARCHAR) AS active_status,
  max(ts) AS ts FROM statuses GROUP BY vehicle_id"""


@query("vehicle_status", Q.with_ctes(*FLEET, Q.STATUS, select=LATEST_STATUS))
def vehicle_status(spark, sf):
    return S.vehicle_status(*_fleet(spark, sf))


@query(
    "vehicle_status_keep_current",
    Q.with_ctes(
        *FLEET,
        Q.STATUS,
        select="""SELECT s.vehicle_id, cast(coalesce(arg_max(coalesce(matched, -1), ord),
            -1) AS VARCHAR) AS last_match, max(ts) AS ts, any_value(v.active_status) AS stored
          FROM statuses s LEFT JOIN vehicles v USING (vehicle_id) GROUP BY s.vehicle_id""",
    ).replace("SELECT s.vehicle_id, cast(", "SELECT vehicle_id, CASE WHEN last_match <> '-1' THEN last_match "
      "WHEN stored <> '0' THEN stored ELSE '2' END AS active_status, ts FROM (SELECT s.vehicle_id, cast(")
    + ")",
)
def vehicle_status_keep_current(spark, sf):
    return S.vehicle_status(*_fleet(spark, sf), keep_current=True)


def _hysteresis(hold_us: int) -> str:
    """The status automaton, record by record."""
    return f"""WITH RECURSIVE {", ".join((*FLEET, Q.STATUS))},
      steps AS (SELECT s.*, epoch_us(s.ts) AS us, row_number() OVER (PARTITION BY s.vehicle_id ORDER BY s.ord) AS i FROM statuses s),
      walk AS (
        SELECT vehicle_id, i, ts, seq, coalesce(matched, CASE WHEN cast(active_status AS INTEGER) <> 0 THEN cast(active_status AS INTEGER) END, 2) AS status, us AS timer
        FROM steps LEFT JOIN vehicles USING (vehicle_id) WHERE i = 1
        UNION ALL
        SELECT s.vehicle_id, s.i, s.ts, s.seq, CASE WHEN matched IS NOT NULL THEN matched WHEN us - timer > {hold_us} OR status = 0 THEN 2 ELSE status END,
          CASE WHEN matched IS NOT NULL THEN us ELSE timer END
        FROM walk w JOIN steps s ON s.vehicle_id = w.vehicle_id AND s.i = w.i + 1
      )
      SELECT vehicle_id, ts, seq, status AS active_status FROM walk"""


@query("status_hysteresis", _hysteresis(60_000_000))
def status_hysteresis(spark, sf):
    return S.status_with_hysteresis(*_fleet(spark, sf))


@query("status_hysteresis_half_day", _hysteresis(43_200_000_000))
def status_hysteresis_half_day(spark, sf):
    return S.status_with_hysteresis(*_fleet(spark, sf), hold=HALF_DAY)


@query(
    "offline_vehicles",
    Q.with_ctes(
        *FLEET,
        select="""SELECT vehicle_id, CASE WHEN last_rx IS NULL OR TIMESTAMP '2024-01-31' - last_rx > INTERVAL 12 HOUR
          THEN '0' ELSE active_status END AS active_status, last_rx,
          last_rx IS NULL OR TIMESTAMP '2024-01-31' - last_rx > INTERVAL 12 HOUR AS silent
        FROM vehicles LEFT JOIN (SELECT vehicle_id, max(ts) AS last_rx FROM readings GROUP BY 1) USING (vehicle_id)""",
    ),
)
def offline_vehicles(spark, sf):
    return _swept(spark, sf)


def _as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def _swept(spark, sf):
    heard = adapter.readings(_events(spark, sf)).groupBy("vehicle_id").agg(F.max("ts").alias("last_rx"))
    known = _vehicles(spark, sf).select("vehicle_id", "active_status").join(heard, "vehicle_id", "left")
    return S.offline_sweep(known, _as_of(), HALF_DAY)


# ---- alarms

EPISODES = (*FLEET, Q.alarms(43_200_000_000))


def _episodes(spark, sf):
    return A.alarm_episodes(*_fleet(spark, sf), gap=HALF_DAY)


@query("alarm_episodes", Q.with_ctes(*EPISODES, select="SELECT * FROM episodes"))
def alarm_episodes(spark, sf):
    return _episodes(spark, sf)


@query("alarm_episodes_short_gap", Q.with_ctes(*FLEET, Q.alarms(300_000_000), select="SELECT * FROM episodes"))
def alarm_episodes_short_gap(spark, sf):
    return A.alarm_episodes(*_fleet(spark, sf))


GAPPED = Q.READINGS.replace(
    "event_type AS code, value,", "event_type AS code, CASE WHEN event_id % 7 <> 3 AND event_id % 11 <> 5 THEN value END AS value,"
)


@query(
    "alarms_with_gaps",
    Q.with_ctes(GAPPED, Q.VEHICLES, Q.RULES, Q.CHECKS, Q.alarms(43_200_000_000), select="SELECT * FROM episodes"),
)
def alarms_with_gaps(spark, sf):
    """Some values are null and some are no numbers: they neither raise nor end an alarm."""
    seq = F.col("seq")
    value = F.when(seq % 7 == 3, F.lit(None)).when(seq % 11 == 5, "junk").otherwise(F.col("value").cast("string"))
    return A.alarm_episodes(adapter.records(_events(spark, sf), value), _vehicles(spark, sf), _rules(spark, sf), gap=HALF_DAY)


@query("alarm_begins", Q.with_ctes(*EPISODES, select="SELECT * EXCLUDE (end_ts) FROM episodes"))
def alarm_begins(spark, sf):
    return A.begin_events(_episodes(spark, sf))


@query(
    "alarm_ends",
    Q.with_ctes(*EPISODES, select="SELECT unid, end_ts, table_suf FROM episodes WHERE end_ts IS NOT NULL"),
)
def alarm_ends(spark, sf):
    return A.end_events(_episodes(spark, sf))


@query(
    "alarm_event_table",
    Q.with_ctes(
        *EPISODES, select="SELECT *, CASE WHEN end_ts IS NULL THEN 0 ELSE 1 END AS flag_did FROM episodes"
    ),
)
def alarm_event_table(spark, sf):
    episodes = _episodes(spark, sf)
    return A.apply_ends(A.begin_events(episodes), A.end_events(episodes))


@query("alarm_events_by_month", Q.with_ctes(*EPISODES, select="SELECT * EXCLUDE (end_ts) FROM episodes"))
def alarm_events_by_month(spark, sf):
    """Begin events as an event store keeps them: a folder for each month."""
    path = scratch_path(spark, "alarm-events")
    append_batch(A.begin_events(_episodes(spark, sf)), path, 0, ["table_suf"])
    return read_batches(spark, path).drop("batch_id").withColumn("table_suf", F.col("table_suf").cast("string"))


@query("open_alarms", Q.with_ctes(*EPISODES, select="SELECT * FROM episodes WHERE end_ts IS NULL"))
def open_alarms(spark, sf):
    return A.open_alarms(_episodes(spark, sf))


@query(
    "close_offline_alarms",
    Q.with_ctes(
        *EPISODES,
        select="""SELECT unid, TIMESTAMP '2024-01-31' AS end_ts, table_suf FROM episodes
          WHERE end_ts IS NULL AND vehicle_id IN (SELECT vehicle_id FROM readings GROUP BY vehicle_id
            HAVING TIMESTAMP '2024-01-31' - max(ts) > INTERVAL 12 HOUR)""",
    ),
)
def close_offline_alarms(spark, sf):
    return A.close_offline(A.open_alarms(_episodes(spark, sf)), _swept(spark, sf), _as_of())


@query(
    "daily_alarm_count",
    Q.with_ctes(
        *EPISODES,
        select="SELECT strftime(begin_ts, '%Y%m%d') AS day, vehicle_id, count(*) AS alarm_count FROM episodes GROUP BY 1, 2",
    ),
)
def daily_alarm_count(spark, sf):
    return A.daily_alarm_count(_episodes(spark, sf))


@query(
    "alarm_snapshot",
    Q.with_ctes(
        *EPISODES,
        select="""SELECT vehicle_id, begin_ts AS datime_alert, 1 AS count_alert, level AS level_alert FROM episodes
          QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY begin_ts DESC, level DESC, code DESC) = 1""",
    ),
)
def alarm_snapshot(spark, sf):
    return A.alarm_snapshot(_episodes(spark, sf))


# ---- charging

SESSIONS = (*FLEET, Q.charges(86_400_000_000))


@query("charge_sessions", Q.with_ctes(*SESSIONS, select="SELECT * FROM sessions"))
def charge_sessions(spark, sf):
    return C.charge_sessions(*_fleet(spark, sf), gap=DAY)


@query("charge_sessions_short_gap", Q.with_ctes(*FLEET, Q.charges(1_800_000_000), select="SELECT * FROM sessions"))
def charge_sessions_short_gap(spark, sf):
    return C.charge_sessions(*_fleet(spark, sf))


DAILY_CHARGE = """SELECT strftime(start_date, '%Y%m%d') AS day, vehicle_id, count(*) AS charge_count,
  round(sum(charge), 4) AS charge_quantity FROM sessions WHERE NOT is_open GROUP BY 1, 2"""


@query("daily_charge", Q.with_ctes(*SESSIONS, select=DAILY_CHARGE))
def daily_charge(spark, sf):
    rolled = C.daily_charge(C.charge_sessions(*_fleet(spark, sf), gap=DAY))
    return rolled.withColumn("charge_quantity", F.round("charge_quantity", 4))


# ---- whole flows, from message text


@query("status_from_messages", Q.with_ctes(*SECOND_FLEET, Q.STATUS, select=LATEST_STATUS))
def status_from_messages(spark, sf):
    records = M.with_event_time(_wire_records(spark, sf))
    return S.vehicle_status(records, _vehicles(spark, sf), _rules(spark, sf))


@query(
    "alarms_from_messages",
    Q.with_ctes(*SECOND_FLEET, Q.alarms(43_200_000_000), select="SELECT * FROM episodes"),
)
def alarms_from_messages(spark, sf):
    records = M.with_event_time(_wire_records(spark, sf))
    return A.alarm_episodes(records, _vehicles(spark, sf), _rules(spark, sf), gap=HALF_DAY)


@query("daily_from_messages", Q.with_ctes(Q.SECOND_READINGS, Q.DAILY, select=f"SELECT {DAILY_COLUMNS} FROM daily"))
def daily_from_messages(spark, sf):
    messages = M.parse_messages(_wire(spark, sf))
    return D.daily_stats(D.readings(messages)).drop("statistic_ts")


@query(
    "charges_from_messages",
    Q.with_ctes(*SECOND_FLEET, Q.charges(86_400_000_000), select="SELECT * FROM sessions"),
)
def charges_from_messages(spark, sf):
    records = M.with_event_time(_wire_records(spark, sf), fall_back=True)
    return C.charge_sessions(records, _vehicles(spark, sf), _rules(spark, sf), gap=DAY)
