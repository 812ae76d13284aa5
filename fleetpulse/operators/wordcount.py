"""Word counts and their on-demand queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.words import explode_words


def word_count(sentences: DataFrame, text: str = "sentence") -> DataFrame:
    return explode_words(sentences.select(text), text).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def words_of(args: DataFrame, counts: DataFrame, text: str = "args") -> DataFrame:
    """Count of each asked word; words never seen are left out, repeated ones stay."""
    return explode_words(args, text).join(counts, "word", "inner")


def count_lookup(args: DataFrame, counts: DataFrame, text: str = "args") -> DataFrame:
    return words_of(args.select(text), counts, text).select("word", "count")


def count_total(args: DataFrame, counts: DataFrame, by: list[str] | None = None, text: str = "args") -> DataFrame:
    """Sum of the asked words' counts, per request when ``by`` names its columns."""
    asked = words_of(args.select(*(by or []), text), counts, text)
    return asked.groupBy(*(by or [])).agg(F.sum("count").alias("sum"))
