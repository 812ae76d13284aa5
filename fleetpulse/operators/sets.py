"""Algebra over membership tables ``key, member``.

All set operations are one aggregate per member (combined map-side), whatever the number of
sets; a set's size never meets a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _in_sets(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    flags = [F.bool_or(F.col("key") == k).alias(f"_in{i}") for i, k in enumerate(keys)]
    return table.filter(F.col("key").isin(*keys)).groupBy("member").agg(*flags)


def union(table: DataFrame, *keys: str) -> DataFrame:
    return table.filter(F.col("key").isin(*keys)).select("member").distinct()


def intersection(table: DataFrame, *keys: str) -> DataFrame:
    everywhere = reduce(lambda a, b: a & b, [F.col(f"_in{i}") for i in range(len(keys))])
    return _in_sets(table, keys).filter(everywhere).select("member")


def difference(table: DataFrame, first: str, *others: str) -> DataFrame:
    """Members of the first set that are in none of the others."""
    alone = reduce(lambda a, b: a & ~b, [F.col(f"_in{i}") for i in range(1 + len(others))])
    return _in_sets(table, (first, *others)).filter(alone).select("member")


def store(table: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Replace the set ``key`` by ``members``."""
    kept = table.filter(~F.col("key").eqNullSafe(key))
    return kept.unionByName(members.select(F.lit(key).alias("key"), "member"))


def add(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.select("key", "member").unionByName(rows.select("key", "member")).distinct()


def remove(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.join(rows.select("key", "member").distinct(), ["key", "member"], "left_anti")


def cardinality(table: DataFrame) -> DataFrame:
    return table.groupBy("key").agg(F.countDistinct("member").alias("cardinality"))


def is_member(table: DataFrame, asked: DataFrame) -> DataFrame:
    """``is_member`` for each asked ``key, member``."""
    known = table.select("key", "member").distinct().withColumn("_known", F.lit(True))
    return asked.join(known, ["key", "member"], "left").select(
        *asked.columns, F.coalesce("_known", F.lit(False)).alias("is_member")
    )


def members(table: DataFrame, key: str) -> DataFrame:
    return table.filter(F.col("key") == key).select("member").distinct()


def random_member(table: DataFrame, seed: int = 0) -> DataFrame:
    """One member per key, drawn by a seeded hash: repeatable and combined map-side."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("key").cast("string"), F.col("member").cast("string")))
    return table.groupBy("key").agg(F.min_by("member", F.struct(draw, "member")).alias("member"))
