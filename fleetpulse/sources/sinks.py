"""Sinks: replay-safe writers for streams and batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write a micro-batch's rows to its own folder; a replay overwrites the same folder."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows written by ``append_batch`` with their ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path)


def latest_version(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written row per key of rows from ``read_batches``."""
    fields = [c for c in batches.columns if c not in keys and c != "batch_id"]
    last = batches.groupBy(*keys).agg(F.max_by(F.struct(*fields), "batch_id").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in fields])


def jdbc_append(df: DataFrame, url: str, table: str, **options) -> None:
    """Append rows to a relational table, partition by partition in batches."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize="5000", **options).mode("append").save()


def jdbc_batch_writer(url: str, table: str, **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function staging rows with their batch id, so the database side can
    merge a batch once however often it is replayed."""

    def write(df: DataFrame, batch_id: int) -> None:
        jdbc_append(df.withColumn("batch_id", F.lit(batch_id)), url, table, **options)

    return write


def kafka_writer(df: DataFrame, servers: str, topic: str, key: str, value: str, checkpoint: str) -> DataStreamWriter:
    """Key/value messages to Kafka (needs the Kafka package on the cluster)."""
    out = df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    return (
        out.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def console_writer(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows)


def log_sample(df: DataFrame, *keys: str, fraction: float = 0.004, seed: int = 0) -> DataFrame:
    """A small share of the rows, for logging: drawn by a seeded hash of the keys, so that it does
    not depend on how the rows are partitioned."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.filter(draw < int(fraction * 2**32))
