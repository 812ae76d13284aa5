"""Streaming twins of batch queries: the same tables read as a stream in several micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.operators import alarms as A
from fleetpulse.operators import charging as C
from fleetpulse.operators import daily as D
from fleetpulse.operators import status as S
from fleetpulse.operators import wordcount as WC
from fleetpulse.plans import collections as CO
from fleetpulse.plans import fleet as FL
from fleetpulse.plans import sqltext as Q
from fleetpulse.plans.registry import query
from fleetpulse.session import scratch_path
from fleetpulse.sources import adapter
from fleetpulse.sources.cycles import cycling_table
from fleetpulse.sources.sinks import latest_version, read_batches
from fleetpulse.sources.streams import table_stream
from fleetpulse.streaming import flows, stateful

#: Micro-batches of a replayed table, at least, and rows of one.
BATCHES, BATCH_ROWS = 4, 1_000_000
#: The user of the row that ends a stream.
LAST = -1


class Replay:
    """Rows of a table as a stream, in micro-batches that one job stages and that are released one by one.

    ``rows`` has the number of each row's batch in ``batch``.
    """

    def __init__(self, rows: DataFrame, path: str, batches: int):
        self._spark, self._path, self._batches = rows.sparkSession, path, batches
        # a file is read by one task, so each batch has one for every core, whatever the row groups of the source
        files = self._spark.sparkContext.defaultParallelism
        dealt = rows.withColumn("_file", F.pmod(F.xxhash64(*rows.columns), F.lit(files)))
        dealt.repartition(max(1, batches) * files, "batch", "_file").drop("_file").write.partitionBy("batch").parquet(f"{path}/staged")
        self._schema = rows.drop("batch").schema
        self._fs_call("mkdirs", "in")

    def _fs_call(self, name: str, *paths: str) -> bool:
        jvm = self._spark._jvm
        targets = [jvm.org.apache.hadoop.fs.Path(f"{self._path}/{p}") for p in paths]
        return getattr(targets[0].getFileSystem(self._spark._jsc.hadoopConfiguration()), name)(*targets)

    def stream(self) -> DataFrame:
        raw = self._spark.readStream.schema(self._schema).option("recursiveFileLookup", "true").parquet(f"{self._path}/in")
        return raw.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in raw.dtypes])

    def run(self, query: StreamingQuery, between: Callable[[int], None] = lambda k: None) -> None:
        """Release all batches to a running query, one after the other; ``between`` is called after each."""
        try:
            for k in range(self._batches):
                self._fs_call("rename", f"staged/batch={k}", f"in/{k:06d}")
                query.processAllAvailable()
                between(k)
        finally:
            query.stop()


def replay_events(spark: SparkSession, sf: str, path: str, batches: int = BATCHES, jitter: int = 30_000_000, closed: bool = True) -> Replay:
    """The events as micro-batches in time order, neighbours ``jitter`` microseconds into each other.

    A stream that is ``closed`` ends with two more batches, of a row of user ``LAST`` each: the first one, a day later,
    moves the watermark past all others, and what is due then comes out with the second.
    """
    events = spark.read.parquet(f"{sf}/events.parquet")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    if jitter:
        us = us + F.pmod(F.xxhash64("event_id"), F.lit(jitter))
    low, high, last, rows = events.select(us.alias("us"), "ts").agg(F.min("us"), F.max("us"), F.max("ts"), F.count("*")).first()
    count = max(batches, -(-rows // BATCH_ROWS)) if rows else 0
    span = (high - low + 1) if rows else 1
    part = F.least(F.floor((us - F.lit(low)) * F.lit(count) / F.lit(span)).cast("int"), F.lit(count - 1))
    numbered = events.withColumn("batch", part)
    if closed and rows:
        then = F.lit(last) + F.expr("INTERVAL 1 DAY") + F.make_dt_interval(mins=F.col("id").cast("int"))
        given = {"event_id": F.lit(-1), "ts": then, "user_id": F.lit(LAST), "event_type": F.lit("end"), "props": F.lit("{}")}
        end = spark.range(2).select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in events.dtypes], (count + F.col("id")).cast("int").alias("batch"))
        numbered, count = numbered.unionByName(end), count + 2
    return Replay(numbered, path, count)


def _out(spark, path, keys=None):
    """What a query has written, without the row that ended the stream."""
    rows = read_batches(spark, path)
    if keys is not None:
        rows = latest_version(rows, keys)
    return rows.filter(F.col("vehicle_id") != f"V{LAST}") if "vehicle_id" in rows.columns else rows


def _sides(spark, sf):
    return FL._vehicles(spark, sf), FL._rules(spark, sf)


@contextmanager
def without_empty_batches(spark: SparkSession):
    """Queries started inside give out what is due with their next rows, not with a batch of its own."""
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _run(spark, sf, name: str, build: Callable[[DataFrame], DataFrame], prepare=None, mode: str = "update") -> str:
    """Replay the events through a query; the folder it wrote to."""
    path = scratch_path(spark, name)
    replay = replay_events(spark, sf, path)
    with without_empty_batches(spark):
        query = flows.append_changes(build(replay.stream()), f"{path}/out", f"{path}/checkpoint", mode=mode, prepare=prepare)
    replay.run(query)
    return f"{path}/out"


def _timed(stream: DataFrame) -> DataFrame:
    return stateful.timed(stream, "1 minute")


@query("stream_daily", Q.with_ctes(Q.READINGS, Q.DAILY, select=f"SELECT {FL.DAILY_COLUMNS} FROM daily"))
def stream_daily(spark, sf):
    out = _run(spark, sf, "daily", lambda rows: stateful.daily_changes(adapter.readings(_timed(rows))))
    return _out(spark, out, list(D.KEYS)).drop("statistic_ts")


@query("stream_alarms", Q.with_ctes(*FL.EPISODES, select="SELECT * FROM episodes"))
def stream_alarms(spark, sf):
    vehicles, rules = _sides(spark, sf)

    def build(rows):
        signals = A.alarm_signals(adapter.records(_timed(rows)), vehicles, rules)
        return A.publish(stateful.alarm_changes(signals, FL.HALF_DAY), vehicles)

    return _out(spark, _run(spark, sf, "alarms", build), ["unid"])


@query("stream_charge", Q.with_ctes(*FL.SESSIONS, select="SELECT * FROM sessions"))
def stream_charge(spark, sf):
    vehicles, rules = _sides(spark, sf)

    def build(rows):
        return C.publish(stateful.charge_changes(C.charge_signals(adapter.records(_timed(rows)), vehicles, rules), FL.DAY))

    return _out(spark, _run(spark, sf, "charge", build), ["row_key"])


@query(
    "shared_stream",
    Q.with_ctes(
        *FL.SESSIONS,
        Q.DAILY.replace("walked AS", "driven AS").replace("FROM walked", "FROM driven"),
        select="""SELECT 'charge' AS job, row_key AS key, start_charge AS value FROM sessions
          UNION ALL SELECT 'daily', day || '-' || vehicle_id, mile_total FROM daily""",
    ),
)
def shared_stream(spark, sf):
    """One stream of records feeds the charging and the daily machine."""
    vehicles, rules = _sides(spark, sf)
    out = _run(
        spark,
        sf,
        "shared",
        lambda rows: stateful.daily_and_charge(adapter.records(_timed(rows)), vehicles, rules, FL.DAY),
        lambda batch: dict(zip(("daily", "charge"), stateful.split_both(batch))),
    )
    sessions, days = _out(spark, f"{out}/charge", ["row_key"]), _out(spark, f"{out}/daily", list(D.KEYS))
    return sessions.select(F.lit("charge").alias("job"), F.col("row_key").alias("key"), F.col("start_charge").alias("value")).unionByName(
        days.select(F.lit("daily").alias("job"), F.concat_ws("-", "day", "vehicle_id").alias("key"), F.col("mile_total").alias("value"))
    )


@query("stream_status", Q.with_ctes(*FL.FLEET, Q.STATUS, select=FL.LATEST_STATUS))
def stream_status(spark, sf):
    vehicles, rules = _sides(spark, sf)

    def build(rows):
        status = S.record_status(stateful.last_records(adapter.records(rows), "pairs"), vehicles, rules)
        return status.select("vehicle_id", F.col("active_status").cast("string").alias("active_status"), "ts")

    return _out(spark, _run(spark, sf, "status", build), ["vehicle_id"])


@query(
    "stream_presence",
    Q.with_ctes(
        Q.READINGS,
        """heard AS (SELECT vehicle_id, us, us - lag(us) OVER w AS since, lead(us) OVER w - us AS until
          FROM readings WINDOW w AS (PARTITION BY vehicle_id ORDER BY us))""",
        select="""SELECT vehicle_id, '2' AS active_status, make_timestamp(us) AS ts FROM heard WHERE since IS NULL OR since > 43200000000
          UNION ALL SELECT vehicle_id, '0', make_timestamp(us + 43200000000) FROM heard WHERE until IS NULL OR until > 43200000000""",
    ),
)
def stream_presence(spark, sf):
    """Online and offline transitions, each given out once."""
    out = _run(spark, sf, "presence", lambda rows: stateful.presence(adapter.readings(rows), FL.HALF_DAY), mode="append")
    return _out(spark, out).drop("batch_id")


@query("stream_flushes", Q.with_ctes(Q.READINGS, select=FL.COALESCED))
def stream_flushes(spark, sf):
    """The last record of each vehicle and interval, given out once the interval is over."""
    out = _run(
        spark,
        sf,
        "flushes",
        lambda rows: flows.flushed_last(adapter.readings(stateful.plausible(rows)), "6 hours", "1 minute", "seq", "mileage", "soc"),
        mode="append",
    )
    return _out(spark, out).drop("batch_id")


@query("stream_alarm_events", Q.with_ctes(*FL.EPISODES, select="SELECT *, CASE WHEN end_ts IS NULL THEN 0 ELSE 1 END AS flag_did FROM episodes"))
def stream_alarm_events(spark, sf):
    """Begin and end events of one stream meet in another, which keeps begins until their ends come."""
    vehicles, rules = _sides(spark, sf)
    longest = "60 days"

    def detect(rows):
        signals = A.alarm_signals(adapter.records(_timed(rows)), vehicles, rules)
        return A.publish(stateful.alarm_changes(signals, FL.HALF_DAY, events=True), vehicles, F.timestamp_micros("_seen_us").alias("seen_ts"))

    found = read_batches(spark, _run(spark, sf, "alarm-events", detect, mode="append"))
    # in the order in which they were noticed, and two rows of each kind that close the stream
    path = scratch_path(spark, "alarm-event-table")
    numbers = found.agg(F.max("batch_id"), F.max("seen_ts")).first()
    count = (numbers[0] or 0) + 1
    rows = found.withColumnRenamed("batch_id", "batch").withColumn("is_end", F.col("end_ts").isNotNull())
    last = F.lit(numbers[1]) + F.expr(f"INTERVAL {longest}") + F.expr("INTERVAL 1 DAY") + F.make_dt_interval(mins=F.col("id").cast("int"))
    # no null in what the join compares: such rows never reach the watermark
    given = {"unid": F.lit("last"), "table_suf": F.lit("last"), "vehicle_id": F.lit(f"V{LAST}"), "seen_ts": last, "batch": count + F.floor(F.col("id") / 2)}
    ends = spark.range(4).select(*[(F.col("id") % 2).eqNullSafe(1).alias(c) if c == "is_end" else given.get(c, F.lit(None)).cast(t).alias(c) for c, t in rows.dtypes])
    every = rows.unionByName(ends).withColumn("batch", F.col("batch").cast("int"))
    # empty batches have no folder
    known = [r.batch for r in every.select("batch").distinct().orderBy("batch").collect()]
    place = F.create_map(*[F.lit(x) for k, b in enumerate(known) for x in (b, k)])
    replay = Replay(every.withColumn("batch", place[F.col("batch")]), path, len(known))
    begins = replay.stream().filter("NOT is_end").drop("is_end", "end_ts")
    finishes = replay.stream().filter("is_end").select("unid", "end_ts", "table_suf", "seen_ts")
    with without_empty_batches(spark):
        query = flows.append_changes(flows.ends_meet_begins(begins, finishes, longest), f"{path}/out", f"{path}/checkpoint", mode="append")
    replay.run(query)
    return _out(spark, f"{path}/out").drop("batch_id")


VERSIONS = "CASE WHEN epoch_us(ts) * 2 < (SELECT min(epoch_us(ts)) + max(epoch_us(ts)) + 1 FROM events) THEN 1 ELSE 2 END"


@query(
    "stream_enriched",
    f"""SELECT e.event_id, 'V' || e.user_id AS vehicle_id, CASE WHEN v = 1 THEN c_name ELSE c_name || ' (2)' END AS owner, v AS version
      FROM (SELECT *, {VERSIONS} AS v FROM events) e LEFT JOIN customer ON c_custkey = user_id AND (v = 1 OR c_custkey % 5 <> 0)""",
)
def stream_enriched(spark, sf):
    """A stored table changes between two batches: rows get the values of the version that was there when they came."""
    path = scratch_path(spark, "enriched")
    customer = adapter.load(spark, sf, "customer").select(F.concat(F.lit("V"), F.col("c_custkey").cast("string")).alias("row_key"), "c_custkey", F.col("c_name").alias("owner"))
    customer.drop("c_custkey").write.parquet(f"{path}/table/version=1")
    second = customer.filter("c_custkey % 5 <> 0").select("row_key", F.concat("owner", F.lit(" (2)")).alias("owner"))
    replay = replay_events(spark, sf, path, batches=2, jitter=0, closed=False)
    current = [1]

    def table(session):
        return session.read.parquet(f"{path}/table/version={current[0]}")

    def publish(_):
        if current[0] == 1:
            second.write.parquet(f"{path}/table/version=2")
            current[0] = 2

    # a version lasts for half of the batches, whatever their number
    half = replay._batches // 2
    rows = replay.stream().select("event_id", F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"))
    started = flows.enriched_changes(rows, table, "vehicle_id", f"{path}/out", f"{path}/checkpoint")
    replay.run(started, lambda k: publish(k) if k + 1 == half else None)
    found = read_batches(spark, f"{path}/out/rows")
    return found.select("event_id", "vehicle_id", "owner", F.when(F.col("batch_id") < half, 1).otherwise(2).alias("version"))


def _counting(spark, sf, name: str):
    """A running word count of the documents, in batches by id."""
    path = scratch_path(spark, name)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    replay = Replay(docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)).cast("int")), path, BATCHES)
    return path, replay, flows.running_word_count(replay.stream(), "text")


@query("stream_word_count", CO.WORDS + "SELECT * FROM counts")
def stream_word_count(spark, sf):
    path, replay, counts = _counting(spark, sf, "words")
    replay.run(flows.append_changes(counts, f"{path}/out", f"{path}/checkpoint"))
    return latest_version(read_batches(spark, f"{path}/out"), ["word"])


@query("live_word_lookup", CO.WORDS + "SELECT word, count FROM asked JOIN counts USING (word)")
def live_word_lookup(spark, sf):
    """The words of the conversations asked of the state of a running word count, while the query is there."""
    path, replay, counts = _counting(spark, sf, "live-words")
    running = counts.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{path}/checkpoint").start()
    answers = []

    def ask(k):
        if k == BATCHES - 1:
            batch = running.lastProgress["batchId"]
            found = WC.count_lookup(CO.load(spark, sf, "conversations"), flows.live_counts(spark, f"{path}/checkpoint", batchId=batch), "text")
            found.write.parquet(f"{path}/answers")
            answers.append(spark.read.parquet(f"{path}/answers"))

    replay.run(running, ask)
    return answers[0]


@query(
    "cycling_conversations",
    """SELECT conv_id + cycle * (SELECT max(conv_id) + 1 FROM conversations) AS number, conv_id AS place, turn, role, text
      FROM conversations, range(3) t(cycle) WHERE conv_id + cycle * (SELECT max(conv_id) + 1 FROM conversations) < 2 * (SELECT max(conv_id) + 1 FROM conversations) + 7""",
)
def cycling_conversations(spark, sf):
    """The conversations as an endless source, read through two cycles and a bit by a query that is restarted on the way."""
    path = scratch_path(spark, "cycles")
    turns = CO.load(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    size = (turns.agg(F.max("conv_id")).first()[0] or 0) + 1
    end = 2 * size + 7
    for limit in (size + 3, end):
        stream = cycling_table(spark, turns, "conv_id", size, rows_per_batch=max(1, size // 2), limit=limit)
        query = flows.append_changes(stream, f"{path}/out", f"{path}/checkpoint", mode="append")
        query.processAllAvailable()
        query.stop()
    return read_batches(spark, f"{path}/out").drop("batch_id")
