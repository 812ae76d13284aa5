"""Streaming and sample sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the telemetry topic.
TOPIC = "pairs_up"


def message_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Telemetry messages as a stream with a text column ``str``.

    ``kafka`` starts at the latest offset and takes ``kafka.bootstrap.servers`` and, when
    wanted, ``maxOffsetsPerTrigger``; its rows also carry ``partition`` and ``offset``.
    ``text`` reads files with one message per line. Needs the Kafka package on the cluster.
    """
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("subscribe", TOPIC)
            .option("startingOffsets", "latest")
            .options(**options)
            .load()
        )
        return raw.select(F.col("value").cast("string").alias("str"), "partition", "offset")
    return spark.readStream.format(fmt).options(**options).load(path).select(F.col("value").alias("str"))


def with_arrival_order(stream: DataFrame) -> DataFrame:
    """Sequence number ``seq`` breaking ties of equal event times: offsets are ordered within
    a partition, and a vehicle's messages share one."""
    if "offset" in stream.columns:
        return stream.withColumn("seq", F.col("offset"))
    return stream.withColumn("seq", F.xxhash64("str"))


def table_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000, name: str = "*") -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", name)
        .parquet(path)
    )


def cycling_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, rows_per_second: int = 10) -> DataFrame:
    """An endless stream that repeats the given rows in order."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    fixed = spark.createDataFrame(list(rows), schema)
    entries = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(row, fixed.columns)]) for row in rows])
    picked = F.get(entries, (F.col("value") % len(rows)).cast("int"))
    return ticks.select(picked.alias("r")).select("r.*")


def random_sentences(spark: SparkSession, sentences: Sequence[str], rows_per_second: int = 10) -> DataFrame:
    """An endless stream of sentences drawn at random, column ``word``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    choice = F.floor(F.rand() * len(sentences)).cast("int")
    return ticks.select(F.get(F.array(*[F.lit(s) for s in sentences]), choice).alias("word"))
