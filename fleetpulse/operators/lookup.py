"""Keyed lookups expressed as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_by_key(keys: DataFrame, table: DataFrame, on: str | Sequence[str], keep_missing: bool = True) -> DataFrame:
    """Rows of ``table`` for the asked keys; every asked key stays, found or not, unless
    ``keep_missing`` is false (the null filter after a lookup)."""
    return keys.join(table, on, "left" if keep_missing else "inner")


def found_values(keys: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Found key/value pairs of a bulk fetch, each asked key once, missing ones left out."""
    asked = keys.select(key).distinct()
    return table.select(key, value).filter(F.col(value).isNotNull()).join(asked, key, "left_semi")


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns) or None)


def keys_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose key matches a glob of ``*``, ``?`` and ``[...]``.

    A pattern that is a plain prefix becomes a ``startswith`` the scan can use.
    """
    prefix = pattern[:-1]
    if pattern.endswith("*") and not set(prefix) & set("*?[]\\"):
        return df.filter(F.col(column).startswith(prefix))
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 1)
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and close > i:
            body = pattern[i + 1 : close].replace("\\", "")
            out.append("[" + body + "]")
            i = close
        else:
            if c == "\\" and i + 1 < len(pattern):
                i += 1
                c = pattern[i]
            out.append("\\" + c if not c.isalnum() and c not in "_ " and c.isascii() else c)
        i += 1
    return df.filter(F.col(column).rlike("(?s)^" + "".join(out) + "$"))
