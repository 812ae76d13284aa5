"""Distinct reach over two adjacency tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(adjacency: DataFrame, key: str, members: str) -> DataFrame:
    """``key, member`` rows of an adjacency list; an absent list gives none."""
    return adjacency.select(F.col(key).alias("key"), F.explode(members).alias("member"))


def reach(urls: DataFrame, tweeters: DataFrame, followers: DataFrame) -> DataFrame:
    """Number of distinct followers of all tweeters of each asked url; unknown urls reach 0.

    ``urls`` has ``url``; the adjacency tables are edges ``key, member``. Edges are deduplicated
    and cut to what was asked before they meet, so copies of an edge do not multiply and the
    work is (asked urls of a person) x (their distinct followers). The exact distinct count
    runs in two map-side combined steps, first per (url, follower).
    """
    asked = urls.select("url").distinct()
    people = (
        tweeters.join(asked, F.col("key") == F.col("url"), "left_semi")
        .select(F.col("key").alias("url"), F.col("member").alias("person"))
        .distinct()
    )
    crowd = followers.select(F.col("key").alias("person"), F.col("member").alias("follower"))
    crowd = crowd.join(people.select("person").distinct(), "person", "left_semi").distinct()
    counted = people.join(crowd, "person").groupBy("url").agg(F.countDistinct("follower").alias("reach"))
    return asked.join(counted, "url", "left").select("url", F.coalesce("reach", F.lit(0)).alias("reach"))
