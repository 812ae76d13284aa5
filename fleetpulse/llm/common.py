"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.session import scratch_path

# A word is a run of code points other than the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """The folders that ``stored`` writes while this scope is the innermost open one.

    ``clear`` deletes them, once the frames built inside have been written elsewhere; what other scopes or
    none have stored is left alone::

        with Scratch(spark) as scratch:
            backoff.score(docs).write.parquet(path)
        scratch.clear()
    """

    _open: ContextVar[Scratch | None] = ContextVar("scratch", default=None)

    def __init__(self, spark: SparkSession):
        self._spark, self._paths, self._outer = spark, [], []

    def __enter__(self) -> Scratch:
        self._outer.append(Scratch._open.set(self))
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.reset(self._outer.pop())

    @classmethod
    def note(cls, path: str) -> None:
        if (scope := cls._open.get()) is not None:
            scope._paths.append(path)

    def clear(self) -> None:
        while self._paths:
            path = self._spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop())
            path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame to a fresh folder below the shared scratch folder and read it back.

    Cuts the lineage like ``checkpoint()``, survives lost executors, keeps column statistics and
    compresses; its files count as disk until an open ``Scratch`` is cleared. ``by`` names a column of
    few values to make folders of. What the write shuffled is deleted as it ends.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    Scratch.note(path)
    with shuffles_deleted(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What a write in here shuffles is deleted when it ends; otherwise it stays until the driver happens to collect
    the garbage that names it, so that the files of all steps may lie on the disks together."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    parts = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)), SPACES)
    return F.filter(parts, lambda w: w != "")


def tasks(spark: SparkSession) -> int:
    """How many groups to deal work into: what the cluster's settings give a shuffle."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of rows that Python is given at once; Spark's own limits are 10,000 rows and 64 MB.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit the batches of ``mapInArrow`` by bytes, from now on in this session.

    Executor and worker hold a batch at the same time, the executor in buffers of twice its size that it does not
    give back. Rows and results are the same; grouped functions get whole groups as before.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: A side is broadcast only if it was measured and has at most so many bytes of values.
BROADCAST_BYTES = 8 << 20


def join_small(left: DataFrame, right: DataFrame, on: Column, how: str, name: str) -> DataFrame:
    """Join with a side that is usually small: it is stored and measured, broadcast if its size
    allows, and otherwise joined by shuffle, where Spark splits skewed keys. Same rows either way."""
    right = stored(right, name)
    size = F.lit(0)
    for column, kind in right.dtypes:
        size = size + (F.coalesce(F.octet_length(column), F.lit(0)) if kind in ("string", "binary") else F.lit(16))
    held = right.agg(F.sum(size)).first()[0] or 0
    return left.join(F.broadcast(right) if held <= BROADCAST_BYTES else right, on, how)
