"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source enters the mix equally often in the mean: ``target / source_size`` times.
The whole part of that is taken as it is; the fractional part is an inclusion probability. The cube
method moves the vector of probabilities through the null space of the balancing constraints
(tokens and documents) until almost all are 0 or 1, keeping both totals exactly; only the last dozen
documents of a source, the landing problem, are rounded together.

A source is dealt by hash into blocks of about ``block_rows`` documents that fly independently, each leaving at
most two undecided; those form the next round's blocks, until a source fits one block. So a
source of any size is spread over many tasks. All random numbers come from the rows themselves:
reruns and retried tasks agree, whatever the partitioning.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import WORD, stored

ROWS = "doc_id bigint, source string, size bigint, mark bigint, source_size bigint, target double, whole bigint, chance double"
EPSILON = 1e-9
#: Undecided documents of a source that the landing rounds together; it looks at 2 ** LANDING ways.
LANDING = 12


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Adds each source's target to a table of (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share ``share`` times all
    sizes; no target exceeds ``cap`` times the source's size, the excess is shared by weight among
    the others. Sorted by the level at which a source reaches its cap, the capped ones come first,
    so running sums give the level of the rest. The table has one row per source.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = sources.select("*", weight.alias("_w")).select("*", (F.col("source_size") * cap).alias("_cap"))
    level = Window.orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("source"))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    lifted = caps.select(
        "source",
        "source_size",
        "_w",
        "_cap",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).alias("_left"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).alias("_weights"),
    ).withColumn("_level", F.col("_left") / F.col("_weights"))
    capped = F.col("_level") * F.col("_w") > F.col("_cap")
    # the first source below its cap has the most weight behind it: its level is the final one
    first = F.min(F.when(~capped, F.struct(-F.col("_weights"), "_level"))).over(everything)
    return lifted.select("*", first.alias("_first")).select(
        "source", "source_size", F.when(capped, F.col("_cap")).otherwise(F.col("_first._level") * F.col("_w")).alias("target")
    )


def fly(sizes: list[float], chances: list[float], draw: random.Random, leave: int = 0) -> list[float]:
    """The flight: move probabilities along the null space of (sizes, ones) until at most ``leave``
    units, or no three and no two of equal size, are undecided. Both weighted totals keep their values."""
    chances = [c if EPSILON < c < 1 - EPSILON else float(round(c)) for c in chances]
    units = [k for k, c in enumerate(chances) if 0 < c < 1]
    undecided = len(units)
    waiting = iter(units)
    held: list[int] = []
    while undecided > leave:
        while len(held) < 3 and (k := next(waiting, None)) is not None:
            held.append(k)
        if len(held) == 3:
            a, b, c = (sizes[k] for k in held)
            step = [b - c, c - a, a - b]
            if not any(step):
                step = [1.0, -1.0, 0.0]
        elif len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            step = [1.0, -1.0]
        else:
            break
        up = min((1 - chances[k]) / s if s > 0 else chances[k] / -s for k, s in zip(held, step) if s)
        down = min(chances[k] / s if s > 0 else (1 - chances[k]) / -s for k, s in zip(held, step) if s)
        move = up if draw.random() * (up + down) < down else -down
        for k, s in zip(held, step):
            chances[k] += move * s
            if chances[k] < EPSILON or chances[k] > 1 - EPSILON:
                chances[k] = float(round(chances[k]))
        undecided -= len(held)
        held = [k for k in held if 0 < chances[k] < 1]
        undecided += len(held)
    return chances


def land(sizes: list[float], chances: list[float]) -> list[float]:
    """The landing: of all ways to round the few undecided units, the one that keeps the token
    total, and then the number of documents, nearest; ties go to the first in counting order."""
    left = [k for k, c in enumerate(chances) if 0 < c < 1]
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    moved = ways - np.array([chances[k] for k in left]).reshape(1, -1)
    tokens = moved @ np.array([sizes[k] for k in left])
    best = ways[int(np.argmin(np.round(np.abs(tokens) + np.abs(moved.sum(axis=1)), 6)))]
    chances = list(chances)
    for k, bit in zip(left, best.tolist()):
        chances[k] = float(bit)
    return chances


def _flight(level: int, seed: int, final: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "mark"], na_position="last", kind="stable")
        draw = random.Random(f"{seed}/{level}/{key}")
        sizes = rows["size"].astype(float).tolist()
        chances = fly(sizes, rows["chance"].tolist(), draw, LANDING if final else 0)
        return rows.assign(chance=land(sizes, chances) if final else chances)

    return run


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    block_rows: int = 2000,
    seed: int = 0,
) -> DataFrame:
    """How often each document enters the mix: (doc_id, source, size, mark, source_size, target, copies).

    ``size`` is the text's number of words (null or empty: 0), ``mark`` a hash of the text that tells
    repeated ids apart. A null source is a source of its own, after all others. Each row is a
    document: repeated rows are drawn separately. A source without words takes no words; its
    documents enter once. An empty table gives no row. Further columns are ignored.
    """
    text = F.col(text_col).cast("string")
    sizes = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(text).alias("mark"),
        ),
        "mix-sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    shares = stored(
        targets(totals.select("source", "source_size"), weights, share, cap)
        .withColumnRenamed("source", "_source")
        .join(totals.select(F.col("source"), "_n"), F.col("_source").eqNullSafe(F.col("source")))
        .drop("source"),
        "mix-sources",
    )
    most = shares.agg(F.max("_n")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    whole = F.floor(rate + EPSILON)
    rows = sizes.join(shares, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "source",
        "size",
        "mark",
        "source_size",
        "target",
        whole.alias("whole"),
        F.greatest(rate - whole, F.lit(0.0)).alias("chance"),
        "_n",
    )
    decided, level, count = [], 0, F.col("_n")
    while True:
        final = most <= block_rows
        blocks = F.greatest(F.ceil(count / block_rows), F.lit(1)).cast("bigint")
        dealt = rows.withColumn("_block", F.pmod(F.xxhash64("doc_id", "mark", F.lit(seed + level)), blocks))
        names = [c.split(" ")[0] for c in ROWS.split(", ")]
        flown = (
            dealt.select(*names, "_block", blocks.alias("_blocks"))
            .groupBy("source", "_block", "_blocks")
            .applyInPandas(_flight(level, seed, final), ROWS + ", _block bigint, _blocks bigint")
        )
        if final:
            decided.append(flown.drop("_block", "_blocks"))
            break
        flown = stored(flown, f"mix-flight-{level}")
        settled = F.col("chance").isin(0.0, 1.0)
        decided.append(flown.filter(settled).drop("_block", "_blocks"))
        rows, level = flown.filter(~settled).select(*names, (F.col("_blocks") * 2).alias("_n")), level + 1
        most, count = 2 * -(-most // block_rows), F.col("_n")
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select(
        "doc_id", "source", "size", "mark", "source_size", "target", (F.col("whole") + F.col("chance").cast("bigint")).alias("copies")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix, each as often as it was taken, with all columns they came with.

    Rows of one id are told apart by source, size and text, in that order; equal rows are
    interchangeable.
    """
    text = F.col(text_col).cast("string")
    drawn = mix(docs, id_col, text_col, source_col, **options)
    mine = Window.partitionBy("_id").orderBy("_source", "_mark")
    left = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"),
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        F.xxhash64(text).alias("_mark"),
    ).select("_doc", "_id", F.row_number().over(mine).alias("_k"))
    right = drawn.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("mark").alias("_mark"), "copies").select(
        F.col("_id").alias("_rid"), F.row_number().over(mine).alias("_rk"), "copies"
    )
    kept = left.join(right, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_k") == F.col("_rk")))
    return kept.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("_doc.*")
