"""Users' own aggregates: a combiner is applied where the rows are and its partial states are merged by key."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Combiner(ABC):
    """What a user writes: a state, how a row becomes one, and how two become one.

    ``combine`` must be associative and must not depend on the order of its arguments, since rows of a key meet in
    any order; whatever order matters belongs into the state. ``zero`` is the state of no rows.
    """

    #: The state's columns as DDL.
    state: str

    @abstractmethod
    def init(self, row) -> tuple:
        """The state of one row, which has the input's columns as attributes."""

    @abstractmethod
    def combine(self, one: tuple, other: tuple) -> tuple: ...

    def zero(self) -> tuple:
        return (None,) * len(self.columns())

    def columns(self) -> list[str]:
        return [field.split(" ")[0] for field in self.state.split(", ")]


def _known(values: tuple) -> tuple:
    return tuple(None if v is pd.NaT or isinstance(v, float) and v != v else v for v in values)


def _partials(keys: list[str], combiner: Combiner) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames):
        for frame in frames:
            states: dict[tuple, tuple] = {}
            for key, row in zip(zip(*[frame[k].tolist() for k in keys]), frame.itertuples(index=False)):
                key = _known(key)
                own = combiner.init(row)
                states[key] = combiner.combine(states[key], own) if key in states else own
            yield pd.DataFrame([(*k, *s) for k, s in states.items()], columns=[*keys, *combiner.columns()], dtype=object)

    return run


def _merge(names: list[str], combiner: Combiner) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One state per key of rows sorted by key; a key may go on in the next Arrow batch."""
    columns = [*names, *combiner.columns()]

    def run(frames):
        key, state = None, None
        for frame in frames:
            done = []
            for row in zip(*[frame[c].tolist() for c in columns]):
                row = _known(row)
                own, new = row[: len(names)], row[len(names) :]
                if state is not None and own == key:
                    state = combiner.combine(state, new)
                    continue
                if state is not None:
                    done.append((*key, *state))
                key, state = own, new
            yield pd.DataFrame(done, columns=columns, dtype=object)
        if state is not None:
            yield pd.DataFrame([(*key, *state)], columns=columns, dtype=object)

    return run


def _merged(states: DataFrame, names: list[str], combiner: Combiner) -> DataFrame:
    """The states of each key in one; keys are runs of sorted partitions, so a key costs no call of its own."""
    kinds = dict(states.dtypes)
    schema = ", ".join([*(f"`{n}` {kinds[n]}" for n in names), combiner.state])
    return states.repartition(*names).sortWithinPartitions(*names).mapInPandas(_merge(names, combiner), schema)


def aggregate(df: DataFrame, keys: Sequence[str], combiner: Combiner, columns: Sequence[str], width: int = 16) -> DataFrame:
    """The keys and the combined state of each key's rows; ``columns`` are what ``init`` reads.

    Rows become a state per key and Arrow batch without a shuffle. A key's states are then dealt to ``width``
    groups by the task they come from and merged there, and the ``width`` states left in a last step: a key
    with a third of all rows is reduced by every task that has some of them and merged by several. Null keys are a
    key; an empty table gives no row.
    """
    keys = list(keys)
    kinds = dict(df.dtypes)
    key_schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    schema = f"{key_schema}, {combiner.state}"
    read = df.select(*keys, *[c for c in columns if c not in keys])
    first = read.mapInPandas(_partials(keys, combiner), schema)
    parted = first.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(width)))
    return _merged(_merged(parted, [*keys, "_part"], combiner), keys, combiner)


class Distance(Combiner):
    """Number and sum of readings, the first and the last one; readings in millionths, order by (us, seq)."""

    state = "n bigint, total bigint, first_us bigint, first_seq bigint, first_mile bigint, last_us bigint, last_seq bigint, last_mile bigint"

    def init(self, row):
        mile = 0 if row.mileage is None or row.mileage != row.mileage else round(row.mileage * 1_000_000)
        return (1, mile, row.us, row.seq, mile, row.us, row.seq, mile)

    def combine(self, one, other):
        return (one[0] + other[0], one[1] + other[1], *min(one[2:5], other[2:5]), *max(one[5:8], other[5:8]))


def distances(rows: DataFrame, width: int = 16) -> DataFrame:
    """``daily.mile_aggregate`` by a combiner."""
    timed = rows.select("vehicle_id", F.unix_micros("ts").alias("us"), F.col("seq").cast("bigint").alias("seq"), "mileage")
    found = aggregate(timed, ["vehicle_id"], Distance(), ["us", "seq", "mileage"], width)
    several = F.col("n") > 1
    units = lambda c: (c / F.lit(1_000_000)).cast("double")
    return found.select(
        "vehicle_id",
        units(F.when(several, F.col("first_mile")).otherwise(0)).alias("mile_start"),
        units(F.when(several, F.col("last_mile")).otherwise(0)).alias("mile_end"),
        units(F.when(several, F.col("total") - F.col("n") * F.col("first_mile")).otherwise(0)).alias("mile_count"),
        units(F.col("first_mile")).alias("mile_total"),
    )
