"""Approximate nearest neighbours by collision-counting hashing.

Every shard of the vectors keeps one sorted array for each of ``projections`` random lines. A query
opens a window around its own place on every line and widens all windows step by step (virtual
rehashing: no bucket is ever built). A vector found in enough windows is verified with its exact
cosine. The search of a shard ends when its k-th best is within the radius that the windows stand
for; the k-th best of a small sample of the shard bounds that radius. So clustered data end early, and
vectors without structure cost up to a full scan but keep their recall.

Queries meet the shards in blocks: a task holds one shard and one block of queries, whatever the
size of either table; each returns k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id bigint, vec_id bigint, score double"
#: Steps of the radius, as shares of its bound; rows of a shard that give the bound.
SHARES, SAMPLE = (0.25, 0.5, 0.75, 1.0), 1000


def least_collisions(projections: int, miss: float = 1.96) -> int:
    """Windows in which a vector at the radius is found, less ``miss`` standard deviations."""
    p = math.erf(1 / math.sqrt(2))
    return max(1, math.floor(projections * p - miss * math.sqrt(projections * p * (1 - p))))


class Shard:
    """Sorted projections of unit vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, seed: int):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.lines = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        placed = (vectors / self.norms[:, None]) @ self.lines
        self.order = np.argsort(placed, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(placed, axis=0).T.copy()
        self.least = least_collisions(projections)
        self.sample = np.random.default_rng(seed).permutation(len(ids))[:SAMPLE]

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        n, lines = len(self.ids), len(self.sorted)
        norm = math.sqrt(float((query * query).sum()))
        centre = (query / norm) @ self.lines
        verified = self.ids == own
        best = self._nearest(self.sample[~verified[self.sample]], query, norm, k)
        verified[self.sample] = True
        # the k-th of any vectors bounds the radius in which the k nearest lie
        bound = math.sqrt(max(0.0, 2 + 2 * best[k - 1][0])) if len(best) >= k else 2.0
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)])
        high, counts = low.copy(), np.zeros(n, np.int64)
        for share in SHARES:
            radius = share * bound
            fresh = []
            for j in range(lines):
                a, b = np.searchsorted(self.sorted[j], (centre[j] - radius, centre[j] + radius))
                a, b = min(a, low[j]), max(b, high[j])
                fresh += [self.order[j, a : low[j]], self.order[j, high[j] : b]]
                low[j], high[j] = a, b
            counts += np.bincount(np.concatenate(fresh), minlength=n)
            new = np.flatnonzero(~verified & (counts >= self.least)) if radius < 2 else np.flatnonzero(~verified)
            verified[new] = True
            best = sorted(set(best).union(self._nearest(new, query, norm, k)))[:k]
            if len(best) >= k and math.sqrt(max(0.0, 2 + 2 * best[k - 1][0])) <= radius:
                break
        return best

    def _nearest(self, places: np.ndarray, query: np.ndarray, norm: float, k: int) -> list[tuple[float, int]]:
        """(minus cosine, id) of the k best of these rows, ties to the smaller id."""
        if not len(places):
            return []
        dots = self.vectors[places] @ query if 4 * len(places) < len(self.ids) else (self.vectors @ query)[places]
        scores = dots / (self.norms[places] * norm)
        if len(places) > 4 * k:  # ties at the border stay in
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[near], scores[near]
        return sorted({(-float(s), int(i)) for s, i in zip(scores, self.ids[places])})[:k]


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def search(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = 24,
    shard_rows: int = 20000,
    query_rows: int = 20000,
    seed: int = 7,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by cosine of every row whose id ``every`` divides.

    The query's own id is no candidate. Vectors that are null, empty, zero, or hold null or non-finite
    parts take no part, nor do rows without id; only vectors of equal length are compared. Repeated
    rows count once. With fewer than k candidates all are returned; ties go to the smaller id. An empty
    table gives no row; further columns are ignored.
    """
    x = lambda v: v.cast("double")
    good = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < float("inf"))) & F.exists("vector", lambda v: x(v) != 0)
    usable = (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))
        .select("vec_id", "vector", F.size("vector").alias("dim"))
    )
    asked = usable.filter(F.col("vec_id") % every == 0)
    rows, queries = usable.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-queries // query_rows))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    held = usable.select("*", place(shards).alias("shard"), number(blocks).alias("block"))
    sent = asked.select("*", place(blocks).alias("block"), number(shards).alias("shard"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            shard = Shard(left["vec_id"].to_numpy(), _vectors(left["vector"]), projections, seed)
            for own, query in zip(right["vec_id"].to_pylist(), _vectors(right["vector"])):
                for minus, vec_id in shard.search(own, query, k):
                    found["query_id"].append(own)
                    found["vec_id"].append(vec_id)
                    found["score"].append(-minus)
        return pa.table(found, pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    keys = ("dim", "shard", "block")
    near = held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(meet, FOUND)
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
