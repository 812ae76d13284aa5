"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that a reader's zone does not shift them."""
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes]
    )


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that must give the same rows."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
