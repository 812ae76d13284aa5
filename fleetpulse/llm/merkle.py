"""A dataset's manifest as a hash tree, folded again from midstates.

Leaves are hashed where the texts are and leave without them. Within a group leaves stand in order; every
eight nodes become one. ``FAN ** DEPTH`` consecutive nodes are a block: one task builds the levels
inside of it and passes on its top, so a tree of any size is a few rounds of blocks, and no task holds
more than a block. The tops of all groups make one more tree in the same way.

On the way down each block gets the runs above it. For every run a copy of the hash state before each
child's slot is retained: to fold a replaced leaf, the state of its slot is resumed with the replacement and
the siblings to its right; what stands to its left is never hashed again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored

FAN, DEPTH = 8, 3
BLOCK = FAN**DEPTH
# Fixed value: the columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run above a block: all its children, and which of them leads down to the block.
RUNS = "array<struct<slot: int, run: array<string>>>"
ABOVE = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))]))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text", tamper_every: int = 3) -> DataFrame:
    """(doc_id, grp, leaf, offered): each row's digest, and the one it is folded with.

    Where ``tamper_every`` divides the CRC-32 of the id, ``offered`` is the digest of the row with the A-Z of its
    text lower-cased. A row without id is not tampered with.
    """
    digest = lambda swap: F.sha2(F.concat(*[_field(swap(c)) for c in fields]).cast("binary"), 256)
    lowered = lambda c: F.translate(F.col(c).cast("string"), UPPER, LOWER) if c == text_col else F.col(c)
    tampered = F.crc32(F.col(id_col).cast("string")) % tamper_every == 0
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(group_col).cast("string").alias("grp"), digest(F.col).alias("leaf"), F.when(tampered, digest(lowered)).alias("_other"))
    return own.select("doc_id", "grp", "leaf", F.coalesce("_other", "leaf").alias("offered"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with ``place`` (from 0) and ``size`` of their group ``grp``, in the order of the columns.

    Rows are sorted over all tasks; a group may span many of them. Only counts per task and group meet.
    """
    dealt = rows.withColumn("_spread", F.monotonically_increasing_id())
    ordered = dealt.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("grp", *order, "_spread")])
    ordered = ordered.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("grp", *order, "_spread")]).drop("_spread")
    kept = stored(ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ordered")
    group = Window.partitionBy("_g")
    counts = kept.groupBy(F.col("grp").alias("_g"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_g", "_p", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("size"))
    found = kept.join(starts, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return found.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "size")


def _sha(text: str):
    return hashlib.sha256(text.encode())


def _inner(digests: list[str], size: int) -> list[list[list[str]]]:
    """The levels of one block, each a list of runs; ``size``: nodes of the whole group at its lowest level."""
    levels = []
    for _ in range(DEPTH):
        if size <= 1:
            break
        runs = [digests[k : k + FAN] for k in range(0, len(digests), FAN)]
        levels.append(runs)
        digests, size = [_sha("".join(run)).hexdigest() for run in runs], -(-size // FAN)
    return levels


def _in_order(table: pa.Table) -> dict[str, list]:
    return table.sort_by("place").to_pydict()


def _tops(table: pa.Table) -> pa.Table:
    rows = _in_order(table)
    levels = _inner(rows["digest"], rows["size"][0])
    top = _sha("".join(levels[-1][0])).hexdigest() if levels else rows["digest"][0]
    left = -(-rows["size"][0] // BLOCK)
    return pa.table({"grp": pa.array([rows["grp"][0]], pa.string()), "place": [rows["place"][0] // BLOCK], "digest": [top], "size": [left]})


def _path(levels: list, at: int) -> list[dict]:
    path = []
    for runs in levels:
        path.append({"slot": at % FAN, "run": runs[at // FAN]})
        at //= FAN
    return path


def _down(table: pa.Table, above: pa.Table) -> pa.Table:
    """Of each node of a block the runs that lead to the root."""
    rows = _in_order(table)
    levels = _inner(rows["digest"], rows["size"][0])
    higher = above["above"][0].as_py() if above.num_rows else []
    paths = [_path(levels, k) + higher for k in range(table.num_rows)]
    return pa.table({"grp": pa.array(rows["grp"], pa.string()), "place": rows["place"], "above": pa.array(paths, ABOVE)})


def _midstates(run: list[str]) -> list:
    """A copy of the hash state before each child, and the text of the children to its right."""
    states, state = [], hashlib.sha256()
    for k, child in enumerate(run):
        states.append((state.copy(), "".join(run[k + 1 :]).encode()))
        state.update(child.encode())
    return states


def _fold(table: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and folded root of each leaf of a block."""
    rows = _in_order(table)
    levels = _inner(rows["digest"], rows["size"][0])
    kept = [[_midstates(run) for run in runs] for runs in levels]
    higher = above["above"][0].as_py() if above.num_rows else []
    resumed = [_midstates(x["run"])[x["slot"]] for x in higher]
    beside = "".join(c for x in higher for k, c in enumerate(x["run"]) if k != x["slot"]).encode()
    proofs, folded = [], []
    for k, offered in enumerate(rows["offered"]):
        proof, states, at = hashlib.sha256(), [], k
        for runs, mids in zip(levels, kept):
            run, slot = runs[at // FAN], at % FAN
            proof.update("".join(run[:slot] + run[slot + 1 :]).encode())
            states.append(mids[at // FAN][slot])
            at //= FAN
        proof.update(beside)
        digest = offered
        for state, right in states + resumed:
            state = state.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        proofs.append(proof.hexdigest())
        folded.append(digest)
    return pa.table({"doc_id": pa.array(rows["doc_id"], pa.int64()), "grp": pa.array(rows["grp"], pa.string()), "leaf": rows["digest"], "proof_sha256": proofs, "folded_root": folded})


def _block() -> Column:
    return F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")


def _meet(nodes: DataFrame, above: DataFrame, how, schema: str) -> DataFrame:
    own, top = nodes.groupBy("grp", _block()), above.withColumn("block", F.col("place")).groupBy("grp", "block")
    return own.cogroup(top).applyInArrow(how, schema)


class Tree:
    """The tables of a tree, lowest first: (grp, place, digest, size), each a block's top of the one before."""

    def __init__(self, lowest: DataFrame):
        self.tables = [lowest]
        while not self.tables[-1].filter("size > 1").isEmpty():
            nodes = self.tables[-1].select("grp", "place", "digest", "size").groupBy("grp", _block())
            self.tables.append(stored(nodes.applyInArrow(_tops, "grp string, place bigint, digest string, size bigint"), "tops"))

    def tops(self) -> DataFrame:
        """(grp, digest): one node for each group."""
        return self.tables[-1].select("grp", "digest")

    def above(self, paths: DataFrame, until: int) -> DataFrame:
        """The runs above each node of table ``until``; ``paths``: those above the tops."""
        for nodes in reversed(self.tables[until:-1]):
            paths = stored(_meet(nodes.select("grp", "place", "digest", "size"), paths, _down, f"grp string, place bigint, above {RUNS}"), "above")
        return paths


def manifest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Options are those of ``leaves``. In a group rows stand by id, those without id first; equal ids, so repeated
    rows too, stand by their digests and are a leaf each. A null group is a group, and the first. A group of
    one leaf has that leaf for its subroot, and a lone subroot is the root. ``verified``: the root folded
    from the offered digest is the root. An empty table gives no row; further columns are ignored.
    """
    rows = stored(leaves(docs, **options), "leaves")
    ordered = stored(numbered(rows, "doc_id", "leaf", "offered").withColumnRenamed("leaf", "digest"), "numbered")
    tree = Tree(ordered)
    # the subroots in the order of their groups are one more tree
    subroots = stored(tree.tops().withColumnRenamed("grp", "name").withColumn("grp", F.lit("")), "subroots")
    crown = Tree(stored(numbered(subroots, "name"), "crown"))
    none = F.array().cast(RUNS).alias("above")
    over = crown.above(crown.tables[-1].select("grp", "place", none), 0)
    named = crown.tables[0].select("name", F.col("place").alias("_p"), F.col("digest").alias("subroot")).join(over.withColumnRenamed("place", "_q"), F.col("_p") == F.col("_q"))
    named = stored(named.select(F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("place"), "above", "subroot"), "crowned")
    paths = tree.above(named.select("grp", "place", "above"), 1)
    # a tree of one table has no block below its tops: the leaf is the top
    folded = _meet(ordered, paths, _fold, "doc_id bigint, grp string, leaf string, proof_sha256 string, folded_root string")
    root = crown.tops().select(F.col("digest").alias("root"))
    tops = named.select(F.col("grp").alias("_g"), "subroot").join(F.broadcast(root))  # one row
    out = folded.join(tops, F.col("grp").eqNullSafe(F.col("_g")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


SQL = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc),
f AS (SELECT *, doc_id::VARCHAR AS i, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
a AS (SELECT doc_id, lang,
    coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS lower_body,
    coalesce(xor(list_reduce([4294967295] || list_transform(range(length(i)), lambda k: ascii(i[k + 1])), lambda c, v: xor(c // 256, crc[xor(c % 256, v) + 1])), 4294967295) % 3 = 0, false) AS tampered
  FROM f, t),
l AS (SELECT doc_id, lang, sha256(head || body) AS leaf, sha256(head || CASE WHEN tampered THEN lower_body ELSE body END) AS offered FROM a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, offered) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (ORDER BY lang, doc_id, leaf, offered) AS k FROM l),
n(lvl, lang, r, h, n) AS (SELECT 0, lang, r, leaf, n FROM o
  UNION ALL SELECT lvl + 1, lang, r // 8, sha256(string_agg(h, '' ORDER BY r)), any_value((n + 7) // 8) FROM n WHERE n > 1 GROUP BY lvl, lang, r // 8),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM n WHERE n = 1),
u(lvl, r, h, n) AS (SELECT 0, r, subroot, n FROM s UNION ALL SELECT lvl + 1, r // 8, sha256(string_agg(h, '' ORDER BY r)), any_value((n + 7) // 8) FROM u WHERE n > 1 GROUP BY lvl, r // 8),
x AS (SELECT lvl, lang, r // 8 AS p, list(h ORDER BY r) AS hs FROM n WHERE n > 1 GROUP BY ALL),
y AS (SELECT lvl, r // 8 AS p, list(h ORDER BY r) AS hs FROM u WHERE n > 1 GROUP BY ALL),
w(k, lang, lvl, r, h, proof) AS (SELECT k, lang, 0, r, offered, '' FROM o
  UNION ALL SELECT k, w.lang, w.lvl + 1, r // 8, sha256(array_to_string(hs[:r % 8] || [h] || hs[r % 8 + 2:], '')), proof || array_to_string(hs[:r % 8] || hs[r % 8 + 2:], '')
  FROM w JOIN x ON x.lvl = w.lvl AND x.lang IS NOT DISTINCT FROM w.lang AND x.p = w.r // 8),
z AS (SELECT k, lang, h, proof FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY lvl DESC) = 1),
v(k, lvl, r, h, proof) AS (SELECT k, 0, s.r, h, proof FROM z JOIN s ON s.lang IS NOT DISTINCT FROM z.lang
  UNION ALL SELECT k, v.lvl + 1, r // 8, sha256(array_to_string(hs[:r % 8] || [h] || hs[r % 8 + 2:], '')), proof || array_to_string(hs[:r % 8] || hs[r % 8 + 2:], '')
  FROM v JOIN y ON y.lvl = v.lvl AND y.p = v.r // 8),
e AS (SELECT k, h, proof FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, q.h AS root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = q.h AS verified
FROM o JOIN e USING (k) JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN (SELECT h FROM u WHERE n = 1) q ON true
"""
