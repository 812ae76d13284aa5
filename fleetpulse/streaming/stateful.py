"""Per-vehicle machines on the state store.

``InOrder`` is a stateful processor that holds a key's rows until the watermark has passed them and then folds them
in time order, so results do not depend on how rows are cut into batches or on their order within the
watermark's delay. A call to the state store takes about half a millisecond from Python, so keys are dealt to ``BUCKETS``
buckets by hash, and a bucket reads and writes what it keeps in one call per variable. Rows go to Python as one text
each and results come back as a text for many: Spark turns rows of several columns into Python's one value at a time. Each bucket has one timer: the
moment at which something of its keys is due. A batch touches the state of the buckets of its own keys and of those
whose timer is due; nothing else is read or written. Rows that are behind the watermark when they come are dropped:
by the machine in the batch after the one that moved the watermark, later by Spark, which counts them in the query's
progress (``late_rows``).

A watermark belongs to the whole stream, so rows that are more than ``AHEAD`` in front of the clock are taken out
before it (``plausible``): a wrong clock of one vehicle cannot make the rows of others late.

State lives in RocksDB with changelog checkpoints (see ``session.SQL_SETTINGS``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import ArrayType, StructField, StructType, _parse_datatype_string

from fleetpulse.functions import messages as M
from fleetpulse.functions.times import day, micros
from fleetpulse.operators import alarms as A
from fleetpulse.operators import charging as C
from fleetpulse.operators import daily as D

AHEAD = "1 day"
#: Buckets of a machine's keys. A batch that has one of a bucket's keys rewrites what the bucket keeps.
BUCKETS = 1024
#: Results in a text.
RESULTS = 1000


def plausible(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows whose time is not further in the future than ``AHEAD``; null times go as well."""
    return rows.filter(F.col(ts) <= F.current_timestamp() + F.expr(f"INTERVAL {AHEAD}"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the reported batches of a query dropped because they came behind the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def _columns(schema: str) -> tuple[str, ...]:
    return tuple(field.split(" ")[0] for field in schema.split(", "))


class Kept(dict):
    """What a bucket's keys keep in a state variable: ``(*key, *more) -> values``, stored as JSON rows of both."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, width: int):
        super().__init__()
        self._state, self._width = handle.getValueState(name, "rows string"), width

    def load(self) -> None:
        stored = self._state.get()
        self.clear()
        for row in json.loads(stored[0]) if stored is not None else ():
            self[tuple(row[: self._width])] = tuple(row[self._width :])
        self._before = dict(self)

    def save(self) -> None:
        if self and self != self._before:
            self._state.update((json.dumps([(*k, *v) for k, v in self.items()]),))
        elif self._before and not self:
            self._state.clear()


class InOrder(StatefulProcessor):
    """Folds each key's rows in order of their first columns, once the watermark has passed them.

    ``keys`` is the number of key columns, which are numbers or texts; ``row`` is the schema of a held row and starts
    with ``us bigint``; ``out`` lists the columns of results. What keys keep is in the variables of ``kept``.
    """

    keys = 1
    row: str
    out: tuple[str, ...]
    kept: list[Kept]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState("held", "rows string")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare ``kept``."""

    def newest(self, row: tuple) -> int:
        """The time by which a row is late."""
        return row[0]

    def fold(self, key: tuple, rows: list[tuple], mark: int) -> list[tuple]:
        """Results of rows that are due, in order; ``mark`` is the watermark in microseconds."""
        raise NotImplementedError

    def dues(self) -> Iterator[tuple[tuple, int]]:
        """Keys and when, in microseconds, something they keep is due."""
        return iter(())

    def forget(self, mark: int) -> None:
        """Drop what is over without a result."""

    def _advance(self, fresh: list[tuple], mark_ms: int) -> Iterator[Row]:
        mark, n = mark_ms * 1000, self.keys
        stored = self._held.get()
        held = json.loads(stored[0]) if stored is not None else []
        ready: dict[tuple, list] = {}
        rest = []
        for r in chain(held, fresh):
            if r[n] <= mark:
                ready.setdefault(tuple(r[:n]), []).append(tuple(r[n:]))
            else:
                rest.append(r)
        if len(rest) != len(held) or fresh:
            if rest:
                self._held.update((json.dumps(rest),))
            elif held:
                self._held.clear()
        for variable in self.kept:
            variable.load()
        for key, due in self.dues():
            if due <= mark:
                ready.setdefault(key, [])
        results = []
        for key, rows in ready.items():
            if len(rows) > 1:
                rows.sort(key=lambda r: tuple((v is not None, v) for v in r))
            results += [(*key, *r) for r in self.fold(key, rows, mark)]
        self.forget(mark)
        for variable in self.kept:
            variable.save()
        due = min(chain((r[n] for r in rest), (due for _, due in self.dues())), default=None)
        wanted = [] if due is None else [max(-(-due // 1000), mark_ms + 1)]
        timers = list(self._handle.listTimers())
        for timer in timers:
            if timer not in wanted:
                self._handle.deleteTimer(timer)
        for timer in wanted:
            if timer not in timers:
                self._handle.registerTimer(timer)
        for k in range(0, len(results), RESULTS):
            yield Row(_found=json.dumps([dict(enumerate(r)) for r in results[k : k + RESULTS]]))

    def _unpacked(self, texts: list[str]) -> list[tuple]:
        """The keys and the row of each text."""
        joined = f"[{','.join(texts)}]"
        fresh = [tuple(r.values()) for r in json.loads(joined)]
        if '"NaN"' in joined or 'Infinity"' in joined:  # Spark writes such numbers as texts
            kinds = [field.split(" ")[1] for field in self.row.split(", ")]
            doubles = {self.keys + k for k, kind in enumerate(kinds) if kind == "double"}
            fresh = [tuple(float(v) if k in doubles and v is not None else v for k, v in enumerate(r)) for r in fresh]
        return fresh

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # the columns of ``_fold``: the time, the bucket, and the keys and the row
        fresh = self._unpacked([r[2] for r in rows])
        mark_ms = timerValues.getCurrentWatermarkInMs()
        # Spark drops late rows by the watermark of the batch before; those between the two are late as well
        yield from self._advance([r for r in fresh if self.newest(r[self.keys :]) > mark_ms * 1000], mark_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def timed(rows: DataFrame, delay: str) -> DataFrame:
    """Plausible rows of a stream with a watermark on ``ts``; the machines below take such rows.

    Rows may be filtered and joined with tables afterwards: what these drop still moves the watermark.
    """
    return plausible(rows).withWatermark("ts", delay)


def _fold(rows: DataFrame, keys: list[str], machine: InOrder, schema: str, mode: str = "update") -> DataFrame:
    # rows without a key belong to no vehicle
    known = rows.dropna(subset=keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("_bucket")
    texts = F.to_json(F.struct(*[F.col(c).alias(str(k)) for k, c in enumerate((*keys, *_columns(machine.row)))]), {"ignoreNullFields": "false"})
    found = known.select("ts", bucket, texts.alias("_row")).groupBy("_bucket").transformWithState(machine, "_found string", mode, "EventTime")
    fields = _parse_datatype_string(schema).fields
    kind = ArrayType(StructType([StructField(str(k), f.dataType) for k, f in enumerate(fields)]))
    return found.select(F.inline(F.from_json("_found", kind))).toDF(*[f.name for f in fields])


# ---- online and offline

PRESENCE = "vehicle_id string, active_status string, us bigint"


class Presence(InOrder):
    """Online when first heard, offline when silent for longer than ``limit`` microseconds.

    The state is when an online vehicle was last heard of.
    """

    row = "us bigint, last bigint"
    out = _columns(PRESENCE)

    def __init__(self, limit: int):
        self.limit = limit

    def open(self, handle):
        self._last = Kept(handle, "last", self.keys)
        self.kept = [self._last]

    def newest(self, row):
        return row[1]

    def fold(self, key, rows, mark):
        (last,) = self._last.pop(key, (None,))
        changes = []
        for start, end in rows:
            if last is not None and start - last > self.limit:
                changes.append(("0", last + self.limit))
                last = None
            if last is None:
                changes.append(("2", start))
            last = end if last is None else max(last, end)
        if last is not None and last + self.limit <= mark:
            changes.append(("0", last + self.limit))
            last = None
        if last is not None:
            self._last[key] = (last,)
        return changes

    def dues(self):
        return ((key, last + self.limit) for key, (last,) in self._last.items())


def _stretches(limit: pd.Timedelta):
    """First and last times of each vehicle's stretches without a pause, per Arrow batch."""

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = pdf.sort_values(["vehicle_id", "ts"])
            pause = (rows["vehicle_id"] != rows["vehicle_id"].shift()) | (rows["ts"].diff() > limit)
            times = rows.groupby([rows["vehicle_id"], pause.cumsum()])["ts"]
            yield pd.DataFrame({"start": times.min(), "ts": times.max()}).reset_index()[["vehicle_id", "start", "ts"]]

    return reduce


def presence(rows: DataFrame, timeout: str = "5 minutes", delay: str = "1 minute") -> DataFrame:
    """Online (2) and offline (0) transitions of each vehicle by event time: ``vehicle_id, active_status, ts``.

    A transition is given out once, when the watermark makes it certain. ``rows``: ``vehicle_id, ts``; repeated rows
    change nothing. Rows are reduced to stretches without a pause before they are shuffled to the state, so a
    busy vehicle sends a few rows per micro-batch.
    """
    reduced = plausible(rows).select("vehicle_id", "ts").mapInPandas(
        _stretches(pd.Timedelta(timeout)), "vehicle_id string, start timestamp, ts timestamp"
    )
    heard = reduced.withWatermark("ts", delay).select("vehicle_id", "ts", F.unix_micros("start").alias("us"), F.unix_micros("ts").alias("last"))
    changes = _fold(heard, ["vehicle_id"], Presence(micros(timeout)), PRESENCE, "append")
    return changes.select("vehicle_id", "active_status", F.timestamp_micros("us").alias("ts"))


# ---- daily statistics

_DAY = (
    "first_us bigint, first_seq bigint, last_us bigint, last_seq bigint, work_us bigint, first_mile double, max_mile double, "
    "mile_count double, first_energy double, max_energy double, first_fuel double, max_fuel double, charge_all double, "
    "charge_status string, stat_us bigint"
)
DAILY = f"vehicle_id string, day string, {_DAY}"
_NAMES = _columns(_DAY)


class Daily(InOrder):
    """One statistic per vehicle and day; days older than the horizon are lost."""

    row = "us bigint, seq bigint, day string, stat_us bigint, mileage double, energy double, fuel double, charge_all double, charge_status string"
    out = _columns(DAILY)

    def __init__(self, work_gap: int, mile_cap: float, horizon: int):
        self.work_gap, self.mile_cap, self.horizon = work_gap, mile_cap, horizon

    def open(self, handle):
        self._days = Kept(handle, "days", self.keys + 1)
        self.kept = [self._days]

    def fold(self, key, rows, mark):
        results = []
        for name in sorted({r[2] for r in rows}):
            old = self._days.get((*key, name))
            new = self._extended(dict(zip(_NAMES, old)) if old else dict.fromkeys(_NAMES), [r for r in rows if r[2] == name])
            self._days[(*key, name)] = new
            results.append((name, *new))
        return results

    def forget(self, mark):
        for name in [name for name, day in self._days.items() if day[2] + self.horizon <= mark]:
            del self._days[name]

    def dues(self):
        return ((name[:-1], day[2] + self.horizon) for name, day in self._days.items())

    def _extended(self, s: dict, rows: list[tuple]) -> tuple:
        us, seq, _, stat, mile, energy, fuel, charge, status = zip(*rows)
        number = lambda values: np.array([np.nan if v is None or not v > 0 else v for v in values], float)
        known = lambda values: values[~np.isnan(values)].tolist()
        heard = np.array(us if s["last_us"] is None else (s["last_us"], *us), np.int64)
        gaps = np.diff(heard)
        work = (s["work_us"] or 0) + int(gaps[gaps < self.work_gap].sum())
        miles = number(mile)
        start = s["first_mile"] if s["first_mile"] is not None else next(iter(known(miles)), None)
        high = np.fmax.accumulate(np.concatenate([[np.nan if s["max_mile"] is None else s["max_mile"]], miles]))
        far = high - (np.nan if start is None else start)
        counts = [*far[(far > 0) & (far < self.mile_cap)].tolist(), *([] if s["mile_count"] is None else [s["mile_count"]])]
        pick = lambda name, values, how: how([x for x in (s[name], *values) if x is not None], default=None)
        first = lambda xs, default: next(iter(xs), default)
        last = lambda xs, default: next(reversed(xs), default)
        out = {
            "first_us": us[0] if s["first_us"] is None else s["first_us"],
            "first_seq": seq[0] if s["first_us"] is None else s["first_seq"],
            "last_us": us[-1],
            "last_seq": seq[-1],
            "work_us": work,
            "first_mile": start,
            "max_mile": pick("max_mile", known(miles), max),
            "mile_count": max(counts, default=None),
            "first_energy": pick("first_energy", known(number(energy)), first),
            "max_energy": pick("max_energy", known(number(energy)), max),
            "first_fuel": pick("first_fuel", known(number(fuel)), first),
            "max_fuel": pick("max_fuel", known(number(fuel)), max),
            "charge_all": pick("charge_all", known(number(charge)), last),
            "charge_status": pick("charge_status", status, last),
            "stat_us": stat[-1] if stat[-1] is not None else s["stat_us"],
        }
        return tuple(out[n] for n in _NAMES)


_DAILY_ROW = ("mileage", "energy", "fuel", "charge_all", "charge_status")


def _daily_columns() -> list[Column]:
    return [F.unix_micros("ts").alias("us"), F.col("seq").cast("bigint").alias("seq"), day(F.col("ts")).alias("day"), F.unix_micros("timestamp").alias("stat_us")]


def _report(found: DataFrame) -> DataFrame:
    moment = lambda c: F.struct(F.timestamp_micros(f"{c}_us").alias("ts"), F.col(f"{c}_seq").alias("seq")).alias(c)
    return D.report(found.select("*", moment("first"), moment("last"), F.timestamp_micros("stat_us").alias("stat_ts")))


def daily_changes(rows: DataFrame, horizon_days: int = 2, work_gap: str = D.WORK_GAP, mile_cap: float = D.MILE_CAP) -> DataFrame:
    """The changed daily statistics of each batch, in the columns of ``daily.report``.

    The input has the columns of ``daily.readings``. Days whose last row is older than the horizon leave the state.
    """
    named = rows.select("vehicle_id", "ts", *_daily_columns(), *_DAILY_ROW)
    machine = Daily(micros(work_gap), mile_cap, micros(f"{horizon_days} days"))
    return _report(_fold(named, ["vehicle_id"], machine, DAILY))


# ---- alarm episodes and charging sessions


class Episodes(InOrder):
    """Begins with a hot row and ends with a cold one that comes more than ``gap`` after the last hot one.

    The state is the open episode; ``expire``: it also ends so long after its begin. A result is the episode,
    whether it is closed, and the time of what changed it; with ``events`` there is one at the begin and
    one at the end, else one for each batch that changes the episode.
    """

    def __init__(self, gap: int, expire: int | None = None, events: bool = False):
        self.gap, self.expire, self.events = gap, expire, events

    def open(self, handle):
        self._open = Kept(handle, "open", self.keys)
        self.kept = [self._open]

    def begin(self, row: tuple) -> dict:
        return {}

    def extend(self, episode: dict, row: tuple) -> None:
        """Take one more hot row."""

    def fold(self, key, rows, mark):
        names = _columns(self.episode)
        before = self._open.pop(key, None)
        now = dict(zip(names, before)) if before is not None else None
        results, touched = [], False

        def end(us: int) -> None:
            nonlocal now, touched
            results.append((*now.values(), True, us))
            now, touched = None, False

        for row in rows:
            hot = row[3]
            if now is not None and self._old(now, row[0]):
                end(now["_first_us"] + self.expire)
            if hot and now is None:
                now, touched = {"_first_us": row[0], "_hot_us": row[0], **self.begin(row)}, not self.events
                if self.events:
                    results.append((*now.values(), False, row[0]))
            elif hot:
                now["_hot_us"], touched = row[0], not self.events
                self.extend(now, row)
            elif now is not None and row[0] - now["_hot_us"] > self.gap:
                end(row[0])
        if now is not None and self._old(now, mark):
            end(now["_first_us"] + self.expire)
        if touched:
            results.append((*now.values(), False, now["_hot_us"]))
        if now is not None:
            self._open[key] = tuple(now.values())
        return results

    def dues(self):
        return iter(()) if self.expire is None else ((key, episode[0] + self.expire + 1) for key, episode in self._open.items())

    def _old(self, episode: dict, us: int) -> bool:
        return self.expire is not None and us - episode["_first_us"] > self.expire


class AlarmEpisodes(Episodes):
    keys = len(A.KEYS)
    row = "us bigint, seq bigint, neg_inx bigint, hot boolean, alarm_name string"
    episode = "_first_us bigint, _hot_us bigint, error_name string"
    out = (*A.KEYS, *_columns(episode), "closed", "_seen_us")

    def begin(self, row):
        return {"error_name": row[4]}


class ChargeSessions(Episodes):
    row = "us bigint, seq bigint, none bigint, hot boolean, in_charge double, soc double"
    episode = (
        "_first_us bigint, _hot_us bigint, n bigint, first_charge double, first_soc double, positive_charge double, positive_at bigint, "
        "last_at bigint, last_charge double, charge_before double, rest_soc double, _known double"
    )
    out = (*C.KEYS, *_columns(episode), "closed", "_seen_us")

    def begin(self, row):
        charge, soc = row[4:6]
        positive = charge is not None and charge > 0
        return {
            "n": 1, "first_charge": charge, "first_soc": soc, "positive_charge": charge if positive else None,
            "positive_at": 1 if positive else None, "last_at": 1, "last_charge": charge, "charge_before": None, "rest_soc": None, "_known": charge,
        }

    def extend(self, e, row):
        charge, soc = row[4:6]
        e["n"] += 1
        e["last_at"], e["last_charge"], e["charge_before"] = e["n"], charge, e["_known"]
        if e["positive_at"] is None and charge is not None and charge > 0:
            e["positive_charge"], e["positive_at"] = charge, e["n"]
        if soc is not None and soc > 0:
            e["rest_soc"] = soc
        if charge is not None:
            e["_known"] = charge


def _schema(keys: str, machine: Episodes) -> str:
    return f"{keys}, {machine.episode}, closed boolean, _seen_us bigint"


def alarm_changes(signals: DataFrame, gap: str = A.ALARM_GAP, events: bool = False) -> DataFrame:
    """Episodes that a batch opened, extended or closed; ``alarms.publish`` makes event rows of them.

    With ``events`` an episode is given out twice, as it begins and as it ends, and never again.
    """
    rows = signals.filter(F.col("hot") | F.col("cold")).select(
        *A.KEYS, "ts", F.unix_micros("ts").alias("us"), F.col("seq").cast("bigint").alias("seq"), F.col("neg_inx").cast("bigint").alias("neg_inx"), "hot", "alarm_name"
    )
    kinds = ", ".join(f"{k} {t}" for k, t in signals.select(*A.KEYS).dtypes)
    machine = AlarmEpisodes(micros(gap), events=events)
    return _fold(rows, list(A.KEYS), machine, _schema(kinds, machine), "append" if events else "update")


def charge_changes(signals: DataFrame, gap: str = C.CHARGE_GAP, expire_after: str | None = None) -> DataFrame:
    """Sessions that a batch opened, extended or closed; ``charging.publish`` makes session rows of them.

    ``expire_after`` closes sessions that began longer than that ago.
    """
    rows = signals.filter(F.col("hot") | F.col("cold")).select(
        *C.KEYS, "ts", F.unix_micros("ts").alias("us"), F.col("seq").cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("none"), "hot", "in_charge", "soc"
    )
    machine = ChargeSessions(micros(gap), None if expire_after is None else micros(expire_after))
    return _fold(rows, list(C.KEYS), machine, _schema("vehicle_id string", machine))


# ---- both from one stream


class DailyAndCharge(InOrder):
    """Two machines fed by the same held rows: a record is parsed, shuffled and held once."""

    row = f"{Daily.row}, daily_ok boolean, hot boolean, in_charge double, soc double, charge_ok boolean"
    out = ("vehicle_id", *_columns(DAILY)[1:], *_columns(ChargeSessions.episode), "closed", "_seen_us")

    def __init__(self, days: Daily, sessions: ChargeSessions):
        self.days, self.sessions = days, sessions

    def open(self, handle):
        self.days.open(handle)
        self.sessions.open(handle)
        self.kept = [*self.days.kept, *self.sessions.kept]

    def fold(self, key, rows, mark):
        days = self.days.fold(key, [r[:9] for r in rows if r[9]], mark)
        sessions = self.sessions.fold(key, [(r[0], r[1], 0, *r[10:13]) for r in rows if r[13]], mark)
        wide = len(_columns(DAILY)) - 1
        blank = (None,) * (len(self.out) - 1 - wide)
        return [(*d, *blank) for d in days] + [((None,) * wide + s) for s in sessions]

    def forget(self, mark):
        self.days.forget(mark)

    def dues(self):
        return chain(self.days.dues(), self.sessions.dues())


def daily_and_charge(records: DataFrame, vehicles: DataFrame, rules: DataFrame, gap: str = C.CHARGE_GAP, horizon_days: int = 2) -> DataFrame:
    """Changed daily statistics and changed sessions of one stream of records; ``split_both`` parts them."""
    marked = M.with_metrics(C.with_charging(records, vehicles, rules), *_DAILY_ROW, mark="daily_ok")
    marked = M.with_metrics(marked, "in_charge", "soc", mark="charge_ok")
    rows = marked.select("vehicle_id", "ts", *_daily_columns(), *_DAILY_ROW, "daily_ok", "hot", "in_charge", "soc", "charge_ok")
    machine = DailyAndCharge(Daily(micros(D.WORK_GAP), D.MILE_CAP, micros(f"{horizon_days} days")), ChargeSessions(micros(gap)))
    schema = f"{DAILY}, {ChargeSessions.episode}, closed boolean, _seen_us bigint"
    return _fold(rows, ["vehicle_id"], machine, schema)


def split_both(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(daily statistics, sessions) of a batch of ``daily_and_charge``."""
    return _report(found.filter("day IS NOT NULL")), C.publish(found.filter("_first_us IS NOT NULL"))


# ---- last status: a streaming aggregate is enough


def last_records(rows: DataFrame, *columns: str) -> DataFrame:
    """The last record of each vehicle that a batch changed (update mode)."""
    order: Column = F.struct("ts", "seq")
    last = rows.groupBy("vehicle_id").agg(F.max_by(F.struct("ts", "seq", *columns), order).alias("_last"))
    return last.select("vehicle_id", *[F.col("_last")[c].alias(c) for c in ("ts", "seq", *columns)])
