"""Shared SQL text: the adapter tables and the state machines as window queries."""

from __future__ import annotations

READINGS = """
events_k AS (
  SELECT *, epoch_us(ts) AS us, cast(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
),
readings AS (
  SELECT 'V' || user_id AS vehicle_id, ts, event_id AS seq, us, event_type AS code, value,
    cast(us AS HUGEINT) * 1000000000 + event_id AS ord,
    strftime(ts, '%Y%m%d') AS day,
    cast((us - 1704067200000000) // 1800000 + cast(round(value * 100) AS BIGINT) AS DOUBLE) / 100 AS mileage,
    CASE WHEN event_type IN ('click', 'view')
      THEN cast((us - 1704067200000000) // 18000000 + k AS DOUBLE) / 100 END AS energy,
    CASE WHEN event_type = 'error'
      THEN cast((us - 1704067200000000) // 36000000 + k AS DOUBLE) / 100 END AS fuel,
    CASE WHEN k >= 50 THEN value ELSE 0.0 END AS charge_all,
    CASE WHEN event_type = 'purchase' THEN 'false' ELSE '0.0' END AS charge_status,
    CASE WHEN k % 4 = 0 THEN 0.0 ELSE value END AS in_charge,
    cast(k AS DOUBLE) AS soc
  FROM events_k
)"""

# The same with receive times cut to whole seconds, as messages carry them.
SECOND_READINGS = READINGS.replace(
    "SELECT *, epoch_us(ts) AS us,",
    "SELECT * REPLACE (date_trunc('second', ts) AS ts), ts AS exact_ts, epoch_us(date_trunc('second', ts)) AS us,",
).replace("(us - 1704067200000000)", "(epoch_us(exact_ts) - 1704067200000000)").replace(
    "event_type AS code,", "event_type AS code, exact_ts,"
)

VEHICLES = """
vehicles AS (
  SELECT 'V' || c_custkey AS vehicle_id,
    CASE WHEN c_custkey % 10 <> 7 THEN 'F' || (c_custkey % 3) END AS fiber_unid,
    'D' || c_nationkey AS domain_unid,
    CASE WHEN c_custkey % 11 <> 3 THEN c_acctbal / 100 END AS lat,
    c_acctbal / 50 AS lon,
    CASE WHEN c_custkey % 3 = 1 THEN '0' WHEN c_custkey % 3 = 2 THEN '4' END AS active_status
  FROM customer
)"""

RULES = """
rules AS (
  SELECT 'F' || (n % 3) AS fiber_unid,
    ['click', 'view', 'error', 'purchase', 'signup'][n % 5 + 1] AS code,
    ['=', '>', '>=', '<', '<=', '[between]', '(between)', '(between]', '[between)', '?'][(n + n // 5) % 10 + 1] AS option,
    5 + n * 7 % 40 AS value_low, 65 + n * 7 % 40 AS value_last,
    CASE WHEN type = 1 THEN CASE WHEN n % 4 = 1 THEN 3 ELSE 4 + n % 3 END
         WHEN n % 8 = 3 THEN 0 ELSE 1 END AS status,
    CASE WHEN n <> 17 THEN n_regionkey END AS alarm_level,
    CASE WHEN n <> 11 THEN n_name END AS alarm_name,
    type, CASE WHEN n % 12 = 5 THEN 1 ELSE 0 END AS flag_del, n AS inx
  FROM (SELECT n_nationkey AS n, n_name, n_regionkey, unnest([1, 2]) AS type FROM nation)
)"""

HOLDS = """CASE option WHEN '=' THEN value = value_low WHEN '>' THEN value > value_low
    WHEN '>=' THEN value >= value_low WHEN '<' THEN value < value_low WHEN '<=' THEN value <= value_low
    WHEN '[between]' THEN value >= value_low AND value <= value_last
    WHEN '(between)' THEN value > value_low AND value < value_last
    WHEN '(between]' THEN value > value_low AND value <= value_last
    WHEN '[between)' THEN value >= value_low AND value < value_last ELSE false END"""

# A record has one pair per event code, so a rule meets the record whose code it names.
CHECKS = f"""
checks AS (
  SELECT r.vehicle_id, r.ts, r.us, r.seq, r.code, r.value, u.inx, u.type, u.status, u.alarm_level, u.alarm_name,
    v.lat, v.lon, v.domain_unid, {HOLDS} AS holds
  FROM readings r JOIN vehicles v USING (vehicle_id) JOIN rules u ON u.fiber_unid = v.fiber_unid AND u.code = r.code
  WHERE u.flag_del = 0
)"""

STATUS = """
statuses AS (
  SELECT r.vehicle_id, r.ts, r.seq, r.ord, m.status AS matched
  FROM readings r LEFT JOIN (
    SELECT seq, arg_max(status, inx) AS status FROM checks WHERE type = 1 AND holds GROUP BY seq
  ) m USING (seq)
)"""


def alarms(gap_us: int) -> str:
    """Episodes of the alarm rules."""
    return f"""
signals AS (
  SELECT vehicle_id, code, alarm_level AS level, alarm_name, ts, us, seq, -inx AS neg_inx,
    holds AND coalesce(status = 1, false) AS hot
  FROM checks WHERE type = 2 AND value IS NOT NULL AND alarm_name IS NOT NULL AND alarm_level IS NOT NULL
    AND lat IS NOT NULL AND lon IS NOT NULL AND domain_unid IS NOT NULL
),
marked AS (
  SELECT *, max(CASE WHEN hot THEN us END) OVER w AS prev_hot, max(CASE WHEN NOT hot THEN us END) OVER w AS prev_cold
  FROM signals WINDOW w AS (PARTITION BY vehicle_id, code, level ORDER BY us, seq, neg_inx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
flagged AS (
  SELECT *, hot AND (prev_hot IS NULL OR coalesce(prev_cold - prev_hot > {gap_us}, false)) AS is_begin,
    NOT hot AND coalesce(us - prev_hot > {gap_us}, false) AND NOT coalesce(prev_cold - prev_hot > {gap_us}, false) AS is_close
  FROM marked
),
numbered AS (
  SELECT *, sum(CASE WHEN is_begin THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id, code, level
    ORDER BY us, seq, neg_inx ROWS UNBOUNDED PRECEDING) AS episode
  FROM flagged WHERE hot OR is_close
),
grouped AS (
  SELECT vehicle_id, code, level, min(us) AS begin_us, min(ts) AS begin_ts,
    max(CASE WHEN is_begin THEN alarm_name END) AS error_name,
    max(CASE WHEN hot THEN ts END) AS last_hot, bool_or(is_close) AS closed
  FROM numbered GROUP BY vehicle_id, code, level, episode
),
episodes AS (
  SELECT upper(md5(concat_ws('#', g.vehicle_id, g.code, g.level, g.begin_us))) AS unid, g.vehicle_id, v.domain_unid,
    g.code, g.level, g.error_name, v.lat, v.lon, g.begin_ts, CASE WHEN closed THEN last_hot END AS end_ts,
    strftime(g.begin_ts, '%Y%m') AS table_suf
  FROM grouped g JOIN vehicles v USING (vehicle_id)
)"""


def charges(gap_us: int) -> str:
    """Charging sessions."""
    return f"""
charging AS (
  SELECT r.*, EXISTS (SELECT 1 FROM checks c WHERE c.seq = r.seq AND c.type = 1 AND c.status = 3 AND c.holds) AS hot
  FROM readings r
),
marked AS (
  SELECT *, max(CASE WHEN hot THEN us END) OVER w AS prev_hot, max(CASE WHEN NOT hot THEN us END) OVER w AS prev_cold
  FROM charging WINDOW w AS (PARTITION BY vehicle_id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
flagged AS (
  SELECT *, hot AND (prev_hot IS NULL OR coalesce(prev_cold - prev_hot > {gap_us}, false)) AS is_begin,
    NOT hot AND coalesce(us - prev_hot > {gap_us}, false) AND NOT coalesce(prev_cold - prev_hot > {gap_us}, false) AS is_close
  FROM marked
),
numbered AS (
  SELECT *, sum(CASE WHEN is_begin THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id
    ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS episode
  FROM flagged WHERE hot OR is_close
),
hots AS (
  SELECT *, row_number() OVER w AS j, count(*) OVER (PARTITION BY vehicle_id, episode) AS n
  FROM numbered WHERE hot WINDOW w AS (PARTITION BY vehicle_id, episode ORDER BY us, seq)
),
closes AS (SELECT DISTINCT vehicle_id, episode FROM numbered WHERE is_close),
started AS (
  SELECT vehicle_id, episode, min(us) AS begin_us, min(ts) AS start_date, max(ts) AS last_hot, max(n) AS n,
    arg_min(in_charge, j) AS c0, arg_max(in_charge, j) AS c_last, arg_min(soc, j) AS soc0,
    arg_min(in_charge, j) FILTER (WHERE in_charge > 0 AND j < n) AS c_positive,
    max(in_charge) FILTER (WHERE j = n - 1) AS c_before,
    arg_max(soc, j) FILTER (WHERE soc > 0 AND j > 1) AS soc_last
  FROM hots GROUP BY vehicle_id, episode
),
repaired AS (
  SELECT s.*, c.episode IS NOT NULL AS closed, CASE WHEN n = 1 THEN c0 ELSE coalesce(c_positive, c_before) END AS c_start
  FROM started s LEFT JOIN closes c USING (vehicle_id, episode)
),
sessions AS (
  SELECT concat_ws('-', begin_us // 1000, vehicle_id) AS row_key, vehicle_id, start_date,
    CASE WHEN closed THEN last_hot END AS end_date, CASE WHEN closed THEN c_start ELSE c0 END AS start_charge,
    CASE WHEN closed THEN c_last END AS end_charge, CASE WHEN closed THEN c_last - c_start END AS charge,
    soc0 AS start_soc, CASE WHEN closed THEN coalesce(soc_last, soc0) END AS end_soc, NOT closed AS is_open
  FROM repaired
)"""


DAILY = """
walked AS (
  SELECT *, us - lag(us) OVER p AS gap,
    max(CASE WHEN mileage > 0 THEN mileage END) OVER (p ROWS UNBOUNDED PRECEDING) AS high,
    first_value(CASE WHEN mileage > 0 THEN mileage END IGNORE NULLS) OVER (p ROWS UNBOUNDED PRECEDING) AS low
  FROM readings WINDOW p AS (PARTITION BY vehicle_id, day ORDER BY us, seq)
),
daily AS (
  SELECT day, vehicle_id,
    coalesce(max(high - low) FILTER (WHERE high - low > 0 AND high - low < 500), 0.0) AS mile_count,
    coalesce(max(high), 0.0) AS mile_total, min(ts) AS work_start, max(ts) AS work_end,
    cast(coalesce(sum(gap) FILTER (WHERE gap < 300000000), 0) // 1000 AS BIGINT) AS work_time_ms,
    coalesce(max(energy) FILTER (WHERE energy > 0) - arg_min(energy, ord) FILTER (WHERE energy > 0), 0.0) AS energy_count,
    coalesce(max(energy) FILTER (WHERE energy > 0), 0.0) AS energy_total,
    coalesce(max(fuel) FILTER (WHERE fuel > 0) - arg_min(fuel, ord) FILTER (WHERE fuel > 0), 0.0) AS fuel_count,
    coalesce(max(fuel) FILTER (WHERE fuel > 0), 0.0) AS fuel_total,
    arg_max(charge_status, ord) AS charge_status,
    coalesce(arg_max(charge_all, ord) FILTER (WHERE charge_all > 0), 0.0) AS charge_all
  FROM walked GROUP BY day, vehicle_id
)"""


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select
