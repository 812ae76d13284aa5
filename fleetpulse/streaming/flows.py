"""Streaming queries: from a message stream to running jobs and aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetpulse.functions import messages as M
from fleetpulse.functions.words import explode_words
from fleetpulse.operators import status as S
from fleetpulse.sources.sinks import append_batch
from fleetpulse.sources.streams import with_arrival_order

# How often the results are flushed.
STATUS_EVERY, ALARM_EVERY, CHARGE_EVERY, DAILY_EVERY = "10 seconds", "10 seconds", "2 minutes", "5 minutes"


def record_stream(messages: DataFrame, fall_back: bool = False) -> DataFrame:
    """Message text -> ``vehicle_id, ts, seq, timestamp, pairs``."""
    parsed = M.with_vehicle(M.parse_messages(with_arrival_order(messages)))
    timed = M.with_event_time(parsed, fall_back)
    return timed.select("vehicle_id", "ts", F.col("seq").cast("bigint").alias("seq"), "timestamp", "pairs")


def reading_stream(records: DataFrame) -> DataFrame:
    """Records -> rows of the daily statistics."""
    names = ("mileage", "energy", "fuel", "charge_all", "charge_status")
    return M.with_metrics(records, *names).select("vehicle_id", "ts", "seq", "timestamp", *names)


def append_changes(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "update",
    prepare: Callable[[DataFrame], dict[str, DataFrame]] | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Write each micro-batch's rows to a folder of its own; a replayed batch writes the same folder.

    ``prepare`` makes several tables of a batch, each with a folder below ``path``; the batch is kept for them.
    ``once`` drains what is there and stops; otherwise the query goes on, ``every`` so often.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if prepare is None:
            append_batch(batch, path, batch_id)
            return
        batch.persist()
        for name, rows in prepare(batch).items():
            append_batch(rows, f"{path}/{name}", batch_id)
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def running_word_count(sentences: DataFrame, text: str = "sentence") -> DataFrame:
    """Running count per word, kept in the state store."""
    return explode_words(sentences.select(text), text).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def flushed_last(rows: DataFrame, every: str, delay: str, *columns: str) -> DataFrame:
    """Last row per vehicle and interval; an interval is emitted when the watermark passes it."""
    return S.coalesce_last(rows.withWatermark("ts", delay), every, *columns)


def state_of(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """The rows a query's state holds, as of its last committed batch, also while the query runs.

    What a machine's keys keep is given out by key: ``kept`` has the texts of the key and the values, ``key`` the
    vehicle and, for ``days``, ``user_map_key`` the day.
    """
    found = spark.read.format("statestore").options(**options).load(checkpoint)
    if options.get("stateVarName") not in ("days", "last", "open"):
        return found
    rows = found.withColumn("kept", F.explode(F.from_json("value.rows", "array<array<string>>"))).drop("value")
    named = rows.withColumn("key", F.struct(F.col("kept")[0].alias("vehicle_id")))
    return named.withColumn("user_map_key", F.struct(F.col("kept")[1].alias("day"))) if options["stateVarName"] == "days" else named


def live_counts(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """``word, count`` as a running word count has them now."""
    return state_of(spark, checkpoint, **options).select("key.word", F.col("value.count").alias("count"))


def enrich(stream: DataFrame, wide: DataFrame, row_key: str) -> DataFrame:
    """Stream rows with the columns of their stored wide row (null when there is none)."""
    return stream.join(wide.withColumnRenamed("row_key", row_key), row_key, "left")


def enriched_changes(
    stream: DataFrame, table: Callable[[SparkSession], DataFrame], row_key: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Each micro-batch joined with the table as it is then: ``table`` is asked at every batch.

    A ``RefreshingTable`` asks its source again when what it has is too old.
    """
    return append_changes(
        stream, path, checkpoint, every, "append", prepare=lambda batch: {"rows": enrich(batch, table(batch.sparkSession), row_key)}
    )


def ends_meet_begins(begins: DataFrame, ends: DataFrame, longest: str, delay: str = "1 minute") -> DataFrame:
    """Event rows as begins and ends arrive: an end joins the begin of its id and month.

    begins: the columns of ``alarms.begin_events`` and ``seen_ts``, when the begin was noticed; ends:
    ``unid, end_ts, table_suf, seen_ts``. A begin waits for its end up to ``longest``; then it is given out without one.
    """
    left = begins.withWatermark("seen_ts", delay).withColumnRenamed("seen_ts", "begun")
    right = ends.withWatermark("seen_ts", delay).select(
        F.col("unid").alias("_unid"), F.col("table_suf").alias("_suf"), "end_ts", F.col("seen_ts").alias("ended")
    )
    meets = (
        (F.col("unid") == F.col("_unid"))
        & (F.col("table_suf") == F.col("_suf"))
        & (F.col("ended") >= F.col("begun"))
        & (F.col("ended") <= F.col("begun") + F.expr(f"INTERVAL {longest}"))
    )
    met = left.join(right, meets, "left_outer")
    return met.drop("_unid", "_suf", "begun", "ended").withColumn("flag_did", F.when(F.col("end_ts").isNotNull(), 1).otherwise(0))
