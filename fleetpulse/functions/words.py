"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Split on single spaces: inner empty words stay, trailing ones go.

    Text of spaces only has no words; empty text is one empty word.
    """
    trimmed = F.rtrim(text, F.lit(" "))
    none = F.array().cast("array<string>")
    return F.when((trimmed == "") & (text != ""), none).otherwise(F.split(trimmed, " "))


def explode_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per word, other columns kept."""
    return df.select(*[c for c in df.columns if c != text], F.explode(words(F.col(text))).alias(word))
