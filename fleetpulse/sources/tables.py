"""Static tables: rules, vehicles, and generic relational reads."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = (
    "fiber_unid string, code string, option string, value int, value_last int, status int, remarks string, "
    "alarm_level int, alarm_name string, type int, flag_del int, inx int"
)
VEHICLE_SCHEMA = (
    "vehicle_id string, fiber_unid string, domain_unid string, lat double, lon double, active_status string, "
    "datime_rx string"
)
# What a rule's absent fields read as. Level and name stay null when null.
RULE_DEFAULTS = {"code": "", "option": "=", "value": 0, "value_last": 0, "status": 0}


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **options) -> DataFrame:
    """Any batch source; ``jdbc`` takes ``url``, ``dbtable`` and partitioning options, and
    filters and columns chosen later are pushed into it."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a source that comes in fewer splits than there are cores.

    Parsing and rule matching cost far more than moving the raw rows. A source with enough
    splits, as any large one has, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


#: Rows of a task that parses and matches messages.
TASK_ROWS = 50_000


def deal(df: DataFrame, key: str, rows: int = TASK_ROWS) -> DataFrame:
    """Short rows that are costly to parse, in tasks of about ``rows`` rows, one for each core at least.

    The number of splits says nothing about their rows: a file has a split for so many bytes, and all rows of a row
    group are in one of them. Parquet counts rows without reading them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)), key)


def with_rule_defaults(rules: DataFrame) -> DataFrame:
    """Lower-case column names and rule defaults."""
    named = rules.toDF(*[c.lower() for c in rules.columns])
    return named.fillna({k: v for k, v in RULE_DEFAULTS.items() if k in named.columns})


def rows_as_maps(df: DataFrame) -> DataFrame:
    """Each row as one ``map<column, text>``, nulls as empty text."""
    pairs = [x for c in df.columns for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return df.select(F.create_map(*pairs).alias("row"))


def rows_as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def last_row(df: DataFrame, order: str) -> DataFrame:
    """The last row of a result as one row."""
    return df.agg(F.max_by(F.struct("*"), order).alias("_r")).filter(F.col("_r").isNotNull()).select("_r.*")


class RefreshingTable:
    """A static table re-read when older than ``max_age_s``; call it at each micro-batch."""

    def __init__(self, load, max_age_s: float = 300.0, clock=time.monotonic):
        self._load, self._max_age, self._clock = load, max_age_s, clock
        self._df, self._at = None, None

    def __call__(self, spark: SparkSession) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._at > self._max_age:
            self._df, self._at = self._load(spark), now
        return self._df
