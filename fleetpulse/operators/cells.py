"""Wide-row tables as cells ``row_key, family, qualifier, value, seq``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["row_key", "family", "qualifier"]


def merge_cells(cells: DataFrame) -> DataFrame:
    """Last write per cell."""
    return cells.groupBy(*CELL).agg(F.max_by("value", "seq").alias("value"))


def cells_of(df: DataFrame, row_key: str, family: str, columns: Sequence[str], seq: str) -> DataFrame:
    """Cells of a wide frame's columns as text; null columns write nothing."""
    return (
        df.select(F.col(row_key).alias("row_key"), F.col(seq).alias("seq"), *[F.col(c).cast("string") for c in columns])
        .unpivot(["row_key", "seq"], list(columns), "qualifier", "value")
        .filter(F.col("value").isNotNull())
        .select("row_key", F.lit(family).alias("family"), "qualifier", "value", "seq")
    )


def wide_rows(cells: DataFrame, family: str, qualifiers: Sequence[str]) -> DataFrame:
    """One row per key with the last value of the named qualifiers."""
    named = cells.filter((F.col("family") == family) & F.col("qualifier").isin(*qualifiers))
    order = F.col("seq")
    picked = [
        F.max_by("value", F.when(F.col("qualifier") == q, order)).alias(q) for q in qualifiers
    ]
    return named.groupBy("row_key").agg(*picked)


def get_cells(cells: DataFrame, keys: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Last value of one cell for each asked row key, null when absent."""
    column = cells.filter((F.col("family") == family) & (F.col("qualifier") == qualifier))
    asked = column.join(keys.select("row_key").distinct(), "row_key", "left_semi")
    last = merge_cells(asked).select("row_key", "value")
    return keys.select("row_key").join(last, "row_key", "left")


def family_map(cells: DataFrame, family: str) -> DataFrame:
    """``row_key -> map(qualifier, value)``; cells are merged first, so a map holds one entry
    per qualifier of its row and not one per write."""
    merged = merge_cells(cells.filter(F.col("family") == family))
    entries = F.sort_array(F.collect_list(F.struct("qualifier", "value")))
    return merged.groupBy("row_key").agg(F.map_from_entries(entries).alias("columns"))


def row_map(cells: DataFrame) -> DataFrame:
    """``row_key -> map(family, map(qualifier, value))``."""
    merged = merge_cells(cells)
    entries = F.sort_array(F.collect_list(F.struct("qualifier", "value")))
    per_family = merged.groupBy("row_key", "family").agg(entries.alias("e"))
    families = F.sort_array(F.collect_list(F.struct("family", "e")))
    nested = F.map_from_entries(
        F.transform(families, lambda f: F.struct(f["family"], F.map_from_entries(f["e"])))
    )
    return per_family.groupBy("row_key").agg(nested.alias("families"))


def delete_cells(cells: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Remove whole rows, families or cells: the tombstone's columns tell which."""
    on = [c for c in CELL if c in tombstones.columns]
    return cells.join(tombstones.select(*on).distinct(), on, "left_anti")


def unpivot_values(wide: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Wide counters -> ``key, column_name, column_value`` rows, values as long."""
    longs = wide.select(key, *[F.col(c).try_cast("bigint").alias(c) for c in columns])
    return longs.unpivot([key], list(columns), "column_name", "column_value").filter(
        F.col("column_value").isNotNull()
    )
