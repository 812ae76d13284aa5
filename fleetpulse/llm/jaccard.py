"""N-gram Jaccard join by partitions of the universe.

Linked sets differ in few tokens: 100 * common >= ``percent`` * all bounds their symmetric difference by
``most``. The universe of tokens is dealt by hash into more segments than that, their number depending
on the size bands of the two sets, so by the pigeonhole linked sets agree on whole segments. A set
gives each segment a value: 0 leaves it out, 1 looks for equal segments, 2 also for segments that differ by
one token (one-deletion neighbourhoods, kept for every eighth segment). The values must sum to more
than ``most``; the cheapest choice leaves out the empty segments, which all sets share, then takes equal
segments at one lookup each, then neighbourhoods at a lookup per token, and empty segments last.

A set mostly has more filled segments than it needs. Linked sets then agree on one more segment than a set can
spare, so each set leaves the spare buckets with the most members out (a prefix of all buckets in one order, the
rarest first): a passage that many otherwise different texts have fills few segments, and these are the first to go.

Beforehand tokens that only one set has are put aside (they count as differences), with every set
that has too many of them to be similar to any other. Equal sets are one class throughout.

Candidates are verified exactly on their tokens. First every set is compared with one member of its
buckets (a hub), the one it shares most buckets with. Buckets whose members links do not yet connect
are then compared in full, in blocks: a task has some members of the largest bucket that holds them, all
sets they meet in any bucket, and counts common tokens by an inverted list. Pairs are never rows of a
table; no two different sets that agree on a bucket stay uncompared unless links connect them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored
from fleetpulse.llm.components import components
from fleetpulse.llm.packed import mix
from fleetpulse.llm.shingles import shingle_sets

#: ``how`` is 1 for a bucket that lists the set, plus 2 if the set asks there, plus 4 times the pair of bands, plus 16 times what it can spare.
SIGNATURES = "bucket bigint, node bigint, how int"
EVERY = 8
ROUNDS = 1
#: Sets on either side of a block of comparisons.
ASKING, ANSWERING = 500, 2000


def bands(percent: int, largest: int = 1 << 40) -> list[int]:
    """Lower ends of the size bands; linked sets lie in one band or in neighbouring ones."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, -(-ends[-1] * 100 // percent)))
    return ends


def most_apart(one: int, other: int, percent: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (one + other) * (100 - percent) // (100 + percent)


def _segments(tokens: np.ndarray, count: int, salt: int) -> list[tuple[int, np.ndarray]]:
    where = (mix(tokens + np.uint64(salt)) % np.uint64(count)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[order], np.arange(count + 1))
    return where, order, cuts


def signatures(size: int, tokens: np.ndarray, percent: int, ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, listed, asks) of one set: buckets in which others find it, and in which it looks for others."""
    bucket, how = _signatures(size, tokens, percent, ends)
    return bucket, how & 1 > 0, how & 2 > 0


def _signatures(size: int, tokens: np.ndarray, percent: int, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, how) of one set."""
    band = int(np.searchsorted(ends, size, side="right")) - 1
    alone = size - len(tokens)
    buckets, ways = [], []

    def put(values: np.ndarray, is_listed: bool, is_asking: bool, side: int, spare: int = 0) -> None:
        buckets.append(values)
        ways.append(np.full(len(values), is_listed + 2 * is_asking + 4 * side + 16 * spare, np.int32))

    own = mix(tokens)
    for low in (band - 1, band):
        for high in (low, low + 1):
            if low < 0 or band not in (low, high):
                continue
            side = 2 * (band - low) + high - low  # 0, 1 and 3
            low_top, high_top = ends[low + 1] - 1, ends[high + 1] - 1
            other_top = min(high_top if band == low else low_top, size * 100 // percent)
            other_least = ends[low] if band == high and low != high else ends[high]
            if other_top < ends[low] or other_top < other_least and band == low or 100 * other_top < percent * size:
                continue
            widest = most_apart(low_top, min(high_top, low_top * 100 // percent), percent)
            count = widest + 1 + -(-low_top * 7 // 100) + 5
            salt = (low * 2 + (high > low)) * 0x9E3779B1 + 1
            where, order, cuts = _segments(tokens, count, salt)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own[order], dtype=np.uint64)])
            content = sums[cuts[1:]] - sums[cuts[:-1]]
            name = lambda which, values, kind: mix(mix(values + np.uint64(kind)) ^ mix(which.astype(np.uint64) + np.uint64(salt << 8)))
            segment = np.arange(count)
            filled = cuts[1:] > cuts[:-1]
            need = most_apart(size, other_top, percent) - alone + 1
            if need <= 0:
                continue  # alone in too many tokens
            exact = name(segment, content, 0)
            # values: filled segments 1; neighbourhoods then make up for what is missing, smallest segments first
            missing = need - int(filled.sum())
            put(exact[filled], True, True, side, max(0, -missing))
            special = segment[(segment % EVERY == 0) & filled]
            taken = special[np.argsort((cuts[1:] - cuts[:-1])[special], kind="stable")][: max(0, missing)]
            put(exact[~filled], True, missing > len(taken), side)
            inner = np.flatnonzero(where % EVERY == 0)
            put(name(where[inner], content[where[inner]] - own[inner], 1), True, False, side)
            if missing > 0 and len(taken):
                inner = np.flatnonzero(np.isin(where, taken))
                put(name(where[inner], content[where[inner]] - own[inner], 0), False, True, side)
                put(name(taken, content[taken], 1), False, True, side)
    if not buckets:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(ways)


def _sign(percent: int):
    def run(batches):
        ends = bands(percent)
        for batch in batches:
            parts = ([], [], [])
            for node, size, raw in zip(*[batch.column(k).to_pylist() for k in ("node", "size", "tokens")]):
                bucket, how = _signatures(size, np.frombuffer(raw, np.uint64), percent, ends)
                for column, values in zip(parts, (bucket.view(np.int64), np.full(len(bucket), node, np.int64), how)):
                    column.append(values)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in parts], ["bucket", "node", "how"])

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for n, x, m, y in zip(*[batch.column(k).to_pylist() for k in ("size_a", "tokens_a", "size_b", "tokens_b")]):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * common >= percent * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], ["a", "b", "linked"])

    return run


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("size").alias(f"size_{s}"), F.col("tokens").alias(f"tokens_{s}"), F.col("held").alias(f"held_{s}"))
    # sizes first: tokens travel only with pairs that can be linked
    sizes = nodes.select("node", "size", "held")
    left = sizes.select(F.col("node").alias("a"), F.col("size").alias("_n"), F.col("held").alias("_h"))
    right = sizes.select(F.col("node").alias("b"), F.col("size").alias("_m"), F.col("held").alias("_k"))
    common = F.least("_h", "_k")
    able = pairs.join(left, "a").join(right, "b").filter(100 * common >= percent * (F.col("_n") + F.col("_m") - common)).select("a", "b")
    full = able.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "tokens_a", "size_b", "tokens_b")
    return full.mapInArrow(_verify(percent), "a bigint, b bigint, linked boolean").filter("linked").select("a", "b")


def links_between(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every set that is linked with a different one; nodes: (node, size, tokens, held)."""
    signed = nodes.select("node", "size", "tokens").mapInArrow(_sign(percent), SIGNATURES)
    members = stored(_members(signed), "buckets")
    links: DataFrame | None = None
    for turn in range(ROUNDS):
        chosen = F.min_by("node", F.xxhash64("node", F.lit(turn)))
        hubs = members.filter("listed AND asks").groupBy("group").agg(chosen.alias("hub"))
        counted = members.join(hubs, "group").filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("_n"))
        pairs = counted.groupBy("node").agg(F.max_by("hub", F.struct("_n", "hub")).alias("hub"))
        pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        fresh = stored(_verified(pairs, nodes, percent), "links")
        links = fresh if links is None else links.unionByName(fresh)
    known = nodes.select("node", F.col("node").alias("component"))
    if links is not None:
        found = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        known = nodes.select("node").join(found, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("_component", "node").alias("component"))
    rest = stored(_compared(members, known, nodes, percent), "links")
    return components(rest if links is None else links.unionByName(rest))


def _members(signed: DataFrame) -> DataFrame:
    """(group, node, listed, asks): the buckets in which sets can meet, without those that a set can spare."""
    bucket = Window.partitionBy("bucket")
    met = lambda rows, *also: rows.select(
        "*", F.count("*").over(bucket).alias("_n"), F.bit_or("how").over(bucket).alias("_any"), *also
    ).filter("_n > 1 AND _any & 3 = 3")
    # all members of a bucket give it the same place in the order; what a set cannot spare is not counted
    spare = F.shiftright("how", 4)
    counted = F.when(spare > 0, F.col("how"))
    order = Window.partitionBy("node", counted).orderBy(F.desc("_n"), "bucket")
    ranked = met(signed).withColumn("_at", F.row_number().over(order)).filter(F.col("_at") > spare).select("bucket", "node", "how")
    kept = met(ranked, F.bit_xor(F.xxhash64("node", F.col("how").bitwiseAND(3))).over(bucket).alias("_members"))
    # buckets with the same members are one group
    flag = lambda bit: F.col("how").bitwiseAND(bit) > 0
    return kept.select(F.xxhash64("_members", "_n").alias("group"), "node", flag(1).alias("listed"), flag(2).alias("asks")).distinct()


def _compared(members: DataFrame, known: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between sets that share a bucket and are in different components, as many as connect them."""
    placed = members.join(known, "node")
    spans = placed.groupBy("group").agg(F.min("component").alias("_c"), F.max("component").alias("_d"), F.count("*").alias("_n"))
    placed = stored(placed.join(spans.filter("_c <> _d").select("group", "_n"), "group"), "open")
    # a set's home is its largest bucket; sets that share a bucket have homes that meet in it
    homes = placed.groupBy("node").agg(F.max(F.struct("_n", "group")).alias("_h"), F.first("component").alias("component"))
    homes = stored(homes.select("node", "component", F.col("_h.group").alias("home")), "homes")
    kept = F.xxhash64("_m", "_k")
    met = placed.select("group", "node").join(homes.select("node", "home"), "node").select("group", "home").distinct()
    alike = met.groupBy("group").agg(F.bit_xor(F.xxhash64("home")).alias("_m"), F.count("*").alias("_k")).groupBy(kept).agg(F.min("group").alias("group"))
    met = stored(met.join(alike.select("group"), "group"), "meetings")
    sizes = homes.groupBy("home").agg(F.count("*").alias("_n"))
    sized = met.join(sizes, "home")
    one = sized.select("group", F.struct("_n", "home").alias("_x"))
    two = sized.select("group", F.struct("_n", "home").alias("_y"))
    # the larger home asks; whatever links two sets is symmetric, so each pair of homes meets once
    pairs = one.join(two, "group").filter("_x >= _y").select(F.col("_x").alias("x"), F.col("_y").alias("y")).distinct()
    deal = lambda size, n: F.pmod(F.xxhash64("node"), F.ceil(size / F.lit(n))).cast("bigint")
    full = homes.join(nodes.select("node", "size", "tokens"), "node")
    asks = full.join(sizes, "home").select(F.col("home").alias("_ha"), "node", "component", "size", "tokens", deal(F.col("_n"), ASKING).alias("block"))
    met_sizes = pairs.groupBy(F.col("x.home").alias("_hx")).agg(F.sum("y._n").alias("_all"), F.first("x._n").alias("_own"))
    met_pairs = pairs.select(F.col("x.home").alias("_hx"), F.col("y.home").alias("_hy")).join(met_sizes.withColumnRenamed("_hx", "_hz"), F.col("_hx") == F.col("_hz"))
    number = lambda rows, n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(rows) / F.lit(n)) - 1))
    answers = full.join(met_pairs, F.col("home") == F.col("_hy")).select(
        F.col("_hx").alias("home_b"), deal(F.col("_all"), ANSWERING).alias("part_b"), number("_own", ASKING).alias("block_b"), "node", "component", "size", "tokens"
    )
    asks = asks.join(met_sizes, F.col("_ha") == F.col("_hx")).select(
        F.col("_ha").alias("home_a"), number("_all", ANSWERING).alias("part_a"), F.col("block").alias("block_a"), "node", "component", "size", "tokens"
    )
    left = asks.groupBy("home_a", "block_a", "part_a")
    right = answers.withColumnsRenamed({c: f"{c}_b" for c in ("node", "component", "size", "tokens")}).groupBy("home_b", "block_b", "part_b")
    return left.cogroup(right).applyInArrow(_block(percent), "a bigint, b bigint")


def _block(percent: int):
    def run(asks: pa.Table, answers: pa.Table) -> pa.Table:
        found: tuple[list, list] = ([], [])
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        if asks.num_rows and answers.num_rows:
            held = [np.frombuffer(x, np.uint64) for x in answers["tokens_b"].to_pylist()]
            owner = np.repeat(np.arange(len(held)), [len(x) for x in held])
            every = np.concatenate(held)
            order = np.argsort(every, kind="stable")
            every, owner = every[order], owner[order]
            names, sizes, groups = (answers[k].to_numpy() for k in ("node_b", "size_b", "component_b"))
            for node, size, group, raw in zip(*[asks[k].to_pylist() for k in ("node", "size", "component", "tokens")]):
                own = np.frombuffer(raw, np.uint64)
                low, high = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
                counts = high - low
                places = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
                common = np.bincount(owner[places], minlength=len(held))
                linked = np.flatnonzero((100 * common >= percent * (size + sizes - common)) & (groups != group))
                _, first = np.unique(groups[linked], return_index=True)
                for at in linked[first].tolist():  # only links that connect more than the block's earlier ones
                    one, two = top(group), top(int(groups[at]))
                    if one != two:
                        parent[two] = one
                        found[0].append(node)
                        found[1].append(int(names[at]))
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_key): the component of every document under links of similar sets.

    ``component_id`` is the smallest id that links reach; documents with equal sets are linked. Null and
    empty texts have empty sets and are alone, as are texts without a partner. Each row is a
    document: repeated rows are linked. Rows without id count, but only ids are named; a component
    without any id has a null one. An empty table gives no row; further columns are ignored.
    """
    sets = stored(shingle_sets(docs, id_col, text_col, width, percent), "sets")
    nodes = (
        sets.filter("tokens IS NOT NULL")
        .groupBy(F.col("set_key").alias("node"))
        .agg(F.first("n_shingles").alias("size"), F.first("tokens").alias("tokens"))
        .withColumn("held", (F.octet_length("tokens") / 8).cast("bigint"))
    )
    nodes = stored(nodes, "nodes")
    found = links_between(nodes, percent).select(F.col("node").alias("_node"), "component")
    own = sets.select("doc_id", "n_shingles", "set_key")
    some = own.filter("n_shingles > 0").join(found, F.col("set_key") == F.col("_node"), "left")
    some = some.select("doc_id", "n_shingles", "set_key", F.coalesce("component", "set_key").alias("_class"))
    least = some.groupBy(F.col("_class").alias("_c")).agg(F.min("doc_id").alias("component_id"))
    linked = some.join(least, F.col("_class") == F.col("_c")).select("doc_id", "n_shingles", "component_id", "set_key")
    empty = own.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "set_key")
    return linked.unionByName(empty)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one of every component, the one with the smallest id; texts without words all stay.

    ``docs`` is a table read from files: its rows are numbered as they are read. Its columns travel as one
    struct, so none of their names can clash. Null ids come last, repeated rows are one component, and an
    empty table gives no row.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), packed)
    found = joined(rows.select("row", "text"), "row", "text", **options).select(F.col("doc_id").alias("n"), F.col("component_id").alias("c"))
    best = F.min_by("row", F.struct(F.col("id").isNull(), F.col("id"), F.col("row")))
    first = found.join(rows.select("row", "id"), F.col("n") == F.col("row")).groupBy("c").agg(best.alias("first")).select("first")
    return rows.join(first, F.col("row") == F.col("first"), "left_semi").select("doc.*")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, i, n, concat_ws(' ', w, lead(w, 1) OVER k, lead(w, 2) OVER k, lead(w, 3) OVER k, lead(w, 4) OVER k) AS g
  FROM u WINDOW k AS (PARTITION BY doc_id ORDER BY i)) WHERE i < greatest(n - 3, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
m AS (SELECT x, min(y) AS least FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least, doc_id)::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = doc_id
"""
