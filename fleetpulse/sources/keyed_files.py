"""Parquet tables laid out by key: changed in part, and read by key without a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Asked keys that are pushed into the scan as values; more of them are joined instead.
PUSHED_KEYS = 1000


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def upsert(updates: DataFrame, path: str, keys: Sequence[str], order: str, buckets: int = 64) -> None:
    """Bring a table of one row per key up to date: the row with the largest ``order`` of each key stays.

    The table is a folder for each bucket of the keys' hash. Only buckets that have updates are read and
    written, as one dynamic partition overwrite; the files of others stay as they are. The order is kept with the rows, so
    a batch that is applied again, or late, changes nothing. A key is deleted by a row with a boolean column set, which
    stays as a tombstone that ``read`` leaves out. Empty updates change nothing.
    """
    spark = updates.sparkSession
    fresh = updates.withColumn("bucket", bucket_of(keys, buckets))
    # at most ``buckets`` small numbers
    touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]
    if not touched:
        return
    both = fresh
    if _exists(spark, path):
        both = both.unionByName(spark.read.schema(fresh.schema).parquet(path).filter(F.col("bucket").isin(touched)))
    fields = [c for c in updates.columns if c not in keys]
    # equal orders: the larger row, so that the result does not depend on who comes first
    last = both.groupBy("bucket", *keys).agg(F.max_by(F.struct(*fields), F.struct(order, F.xxhash64(*fields))).alias("_last"))
    rows = last.select(*keys, *[F.col("_last")[c].alias(c) for c in fields], "bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read(spark: SparkSession, path: str, deletes: str | None = None) -> DataFrame:
    """The rows of an upserted table; ``deletes`` names the column that marks tombstones."""
    rows = spark.read.parquet(path).drop("bucket")
    return rows if deletes is None else rows.filter(~F.coalesce(F.col(deletes), F.lit(False)))


def write_ranged(df: DataFrame, path: str, key: str, files: int, distinct: int | None = None) -> None:
    """Lay a table out for point reads: a range of keys to a file, in order, with a bloom filter.

    Beside the data, ``path/ranges`` tells which keys each file can have: a row per file.
    """
    count = distinct or max(1, df.select(F.approx_count_distinct(key)).first()[0] // files)
    ordered = df.repartitionByRange(files, key).sortWithinPartitions(key)
    ordered.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(count)).parquet(f"{path}/data")
    written = df.sparkSession.read.parquet(f"{path}/data").groupBy(F.input_file_name().alias("file"))
    written.agg(F.min(key).alias("low"), F.max(key).alias("high")).write.parquet(f"{path}/ranges")


def read_keys(spark: SparkSession, path: str, key: str, asked: DataFrame) -> DataFrame:
    """The rows of a ranged table whose key is asked: ``asked`` has the keys in its column ``key``.

    Only files whose range holds an asked key are opened. Few keys are pushed into the scan, where the files'
    statistics and bloom filters skip row groups; more are joined, so that nothing unbounded reaches the driver.
    """
    schema = spark.read.parquet(f"{path}/data").schema
    keys = asked.select(key).distinct()
    few = [r[0] for r in keys.limit(PUSHED_KEYS + 1).collect()]
    few = [k for k in few if k is not None] if len(few) <= PUSHED_KEYS else None
    ranges = spark.read.parquet(f"{path}/ranges")
    if few is not None:
        hit = F.exists(F.array(*[F.lit(k) for k in few]), lambda k: k.between(F.col("low"), F.col("high"))) if few else F.lit(False)
        files = [r.file for r in ranges.filter(hit).select("file").collect()]
    else:
        # a row per file, so the driver gets the list of files at most
        files = [r.file for r in ranges.join(keys, F.col(key).between(F.col("low"), F.col("high")), "left_semi").select("file").collect()]
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    return rows.filter(F.col(key).isin(few)) if few is not None else rows.join(keys, key, "left_semi")
