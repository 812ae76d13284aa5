"""A replayable test source: the rows of a table, in order, again and again.

The stream itself is only places: a Python data source counts upwards, its offset being the next number, so after
a restart the query goes on where it stopped and a batch that is run again has the same numbers. Rows come from a
join with the numbered table, on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class PlaceReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self._size, self._step = int(options["size"]), int(options.get("rowsPerBatch", "1000"))
        self._limit = int(options["limit"]) if "limit" in options else None

    def initialOffset(self) -> dict:
        return {"next": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        end = {"next": start["next"] + self._step if self._limit is None else max(start["next"], min(start["next"] + self._step, self._limit))}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(n, n % self._size) for n in range(start["next"], end["next"])]) if self._size else iter([])

    def commit(self, end: dict) -> None:
        pass


class Places(DataSource):
    """``number, place``: 0, 1, 2, ... and the place in a table of ``size`` rows that each stands for.

    Options: ``size``, ``rowsPerBatch`` (what one batch reads; its numbers pass through the driver), ``limit``
    (where the stream ends; without it, it doesn't).
    """

    @classmethod
    def name(cls) -> str:
        return "places"

    def schema(self) -> str:
        return "number bigint, place bigint"

    def simpleStreamReader(self, schema) -> PlaceReader:
        return PlaceReader(self.options)


def cycling_table(spark: SparkSession, table: DataFrame, place: str, size: int, rows_per_batch: int = 1000, limit: int | None = None) -> DataFrame:
    """A stream of the rows of ``table`` in the order of its column ``place`` (0 to ``size`` - 1), in cycles.

    ``number`` counts the places given out. Several rows of a place come together; a place without a row is left out.
    """
    spark.dataSource.register(Places)
    stream = spark.readStream.format("places").option("size", size).option("rowsPerBatch", rows_per_batch)
    if limit is not None:
        stream = stream.option("limit", limit)
    return stream.load().join(table.withColumnRenamed(place, "_place"), F.col("place") == F.col("_place")).drop("_place")
