"""Near duplicates by fast similarity sketches.

A sketch has ``BINS`` coordinates. Rounds of hashing place every shingle into one bin; a bin takes the
smallest value of the first round that reaches it and is full from then on. Rounds go on until all bins are
full. After as many rounds as there are bins, round BINS + i puts every shingle into bin i, so no
bin stays empty. A sketch takes BINS * log(BINS) placements and one for each shingle, instead of their
product, and the share of equal coordinates is concentrated around the similarity as with independent ones.

Coordinates are cut into bands of ``ROWS``; sets that agree on a band are candidates. A link of 0.8 escapes all
bands with probability (1 - 0.8 ** ROWS) ** (BINS / ROWS), which is 1e-6 here, and a set escapes its group only
if all its links do. Equal sets are one class before bands are compared. Candidates are verified on their full sets:
each with a hub of its bands first; what these links do not connect is compared in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import join_small, stored
from fleetpulse.llm.components import components
from fleetpulse.llm.jaccard import _compared, _verified
from fleetpulse.llm.packed import give_back, mix, steps, unsteps
from fleetpulse.llm.shingles import shingle_hashes

#: Coordinates of a sketch, and how many of them make a band.
BINS, ROWS = 600, 8
#: Bytes of text, and texts, that a task sketches at once.
CHUNK_BYTES, CHUNK_TEXTS = 2 << 20, 2000
SETS = "doc_id bigint, at bigint, n_shingles bigint, key_high bigint, key_low bigint, bands array<bigint>, tokens binary"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(hashes: np.ndarray, owners: np.ndarray, count: int, bins: int = BINS) -> np.ndarray:
    """The sketches, a row each, of ``count`` sets: ``hashes`` grouped by ``owners``, none of them without any."""
    table = np.full(count * bins, _EMPTY, np.uint64)
    missing = np.full(count, bins)
    for turn in range(2 * bins):
        x = mix(hashes ^ mix(np.full(1, turn + 1, np.uint64))[0])
        if turn < bins:
            place = (x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
            cell = owners * bins + place.astype(np.int64)
        else:
            cell = owners * bins + (turn - bins)
        open_cells = table[cell] == _EMPTY
        cell, value = cell[open_cells], (np.uint64(turn) << np.uint64(48)) | (mix(x[open_cells]) >> np.uint64(16))
        np.minimum.at(table, cell, value)
        missing -= np.bincount(np.unique(cell) // bins, minlength=count)
        # sets whose bins are full leave
        going = missing[owners] > 0
        if not going.all():
            hashes, owners = hashes[going], owners[going]
        if not len(hashes):
            break
    return table.reshape(count, bins)


def bands(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash of each band of every sketch."""
    count, bins = table.shape
    cut = mix(table + np.arange(bins, dtype=np.uint64)).reshape(count, bins // rows, rows)
    out = np.zeros(cut.shape[:2], np.uint64)
    for k in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
    return mix(out + np.arange(bins // rows, dtype=np.uint64))


def _chunk(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    count = batch.num_rows
    hashes, owners = shingle_hashes(batch.column(2), width)
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        new = np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(owners) != 0)])
        hashes, owners = hashes[new], owners[new]
    sizes = np.bincount(owners, minlength=count).astype(np.int64)
    ends = np.cumsum(sizes)
    some = np.flatnonzero(sizes)
    keys = np.zeros((2, count), np.uint64)
    signs: list = [None] * count
    if len(some):
        rank = np.full(count, -1)
        rank[some] = np.arange(len(some))
        for k in range(2):
            keys[k, some] = np.add.reduceat(mix(hashes + np.uint64(k)), (ends - sizes)[some])
        for at, row in zip(some.tolist(), bands(sketches(hashes, rank[owners], len(some))).view(np.int64)):
            signs[at] = row
    tokens = [steps(hashes[e - n : e]) if n else None for e, n in zip(ends.tolist(), sizes.tolist())]
    arrays = [batch.column(0), batch.column(1), pa.array(sizes), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64))]
    arrays += [pa.array(signs, pa.list_(pa.int64())), pa.array(tokens, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, [x.split(" ")[0] for x in SETS.split(", ")])


def _sketch(width: int):
    def run(batches):
        for batch in batches:
            length = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = length[start - 1] if start else 0
                stop = min(start + CHUNK_TEXTS, max(start + 1, int(np.searchsorted(length, done + CHUNK_BYTES))))
                yield _chunk(batch.slice(start, stop - start), width)
                start = stop
        give_back()

    return run


def _tokens(batches):
    for batch in batches:
        raw = [unsteps(x).tobytes() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], ["node", "size", "tokens"])


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """A row for each document: its set's size, key (128 bits), bands and tokens; empty sets have no bands."""
    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("at"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    return own.mapInArrow(_sketch(width), SETS)


def candidates(signed: DataFrame) -> DataFrame:
    """(group, node): the members of every band's bucket that has several; buckets of the same members are one group."""
    sized = signed.groupBy("bucket").agg(F.count("*").alias("_n"), F.bit_xor(F.xxhash64("node")).alias("_members")).filter("_n > 1")
    sized = stored(sized.select(F.col("bucket").alias("_bucket"), F.xxhash64("_members", "_n").alias("group")), "buckets")
    met = signed.join(sized, F.col("bucket") == F.col("_bucket"))
    return met.select("group", "node").distinct()


def linked(sets: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """(node, component) of every class of sets that is linked with a different one.

    sets: (at, n_shingles, bands, tokens), firsts: the ``at`` of one set of each class. Bands travel without
    tokens, and tokens of candidates only.
    """
    own = sets.select(F.col("at").alias("node"), "bands").join(firsts, F.col("node") == F.col("_first"), "left_semi")
    members = stored(candidates(own.select("node", F.explode("bands").alias("bucket"))), "members")
    asked = members.select(F.col("node").alias("_node")).distinct()
    full = sets.select(F.col("at").alias("node"), F.col("n_shingles").alias("size"), "tokens")
    packed = join_small(full, asked, F.col("node") == F.col("_node"), "left_semi", "asked")
    nodes = stored(packed.mapInArrow(_tokens, "node bigint, size bigint, tokens binary").withColumn("held", F.col("size")), "nodes")
    hubs = members.groupBy("group").agg(F.min_by("node", F.xxhash64("node")).alias("hub"))
    counted = members.join(hubs, "group").filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("_n"))
    best = counted.groupBy("node").agg(F.max_by("hub", F.struct("_n", "hub")).alias("hub"))
    pairs = best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = stored(_verified(pairs, nodes, percent), "links")
    found = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    known = nodes.select("node").join(found, F.col("node") == F.col("_node"), "left").select("node", F.coalesce("_component", "node").alias("component"))
    rest = stored(_compared(members, known, nodes, percent), "links")
    return components(links.unionByName(rest))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents link when their sets of ``width``-word shingles have ``percent`` of their union in common;
    ``component_id`` is the smallest id that links reach, and ``kept`` marks its bearer. Texts with fewer
    words have their whole sequence as one shingle; null and blank texts have none and are alone, each
    kept. Each row is a document, so repeated rows are linked, and rows that share the smallest id are all kept. Rows without
    id count but are not named: alone they, and components of nothing else, have a null component and are not
    kept. An empty table gives no row; further columns are ignored.
    """
    sets = stored(sketched(docs, id_col, text_col, width), "sketches")
    key = ("key_high", "key_low", "n_shingles")
    classes = sets.filter("n_shingles > 0").groupBy(*key).agg(F.min("at").alias("node"))
    classes = stored(classes.select(*[F.col(k).alias(f"_{k}") for k in key], "node"), "classes")
    found = linked(sets, classes.select(F.col("node").alias("_first")), percent).select(F.col("node").alias("_at"), "component")
    grouped = classes.join(found, F.col("node") == F.col("_at"), "left").select(*[f"_{k}" for k in key], F.coalesce("component", "node").alias("class"))
    some = sets.filter("n_shingles > 0").select("doc_id", *key)
    same = (F.col("key_high") == F.col("_key_high")) & (F.col("key_low") == F.col("_key_low")) & (F.col("n_shingles") == F.col("__n_shingles"))
    grouped = grouped.withColumnRenamed("_n_shingles", "__n_shingles")
    placed = stored(some.join(stored(grouped, "classes"), same).select("doc_id", "n_shingles", "class"), "placed")
    least = placed.groupBy(F.col("class").alias("_class")).agg(F.min("doc_id").alias("component_id"))
    together = join_small(placed, least, F.col("class") == F.col("_class"), "inner", "least").select("doc_id", "n_shingles", "component_id")
    alone = sets.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return together.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


SQL = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w),
s AS (SELECT DISTINCT k, g FROM (SELECT k, i, n, w || coalesce(' ' || lead(w) OVER (PARTITION BY k ORDER BY i), '') AS g FROM u) WHERE i < greatest(n, 2)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
c AS (SELECT k, md5(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY k),
e AS (SELECT h, min(k) AS k FROM c GROUP BY h),
t AS (SELECT s.k, g, n FROM s JOIN n USING (k) WHERE s.k IN (SELECT k FROM e)),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY f, g) AS p FROM (SELECT *, count(*) OVER (PARTITION BY g) AS f FROM t)),
-- linked sets have one of their rarest shingles in common
x AS (SELECT k, g, n FROM o WHERE 100 * (p - 1) <= 20 * n),
p AS (SELECT DISTINCT a.k AS x, b.k AS y FROM x a JOIN x b ON a.g = b.g AND a.k < b.k AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
v AS (SELECT p.x, p.y, count(*) AS c FROM p JOIN t a ON a.k = p.x JOIN t b ON b.k = p.y AND a.g = b.g GROUP BY ALL),
l AS (SELECT v.x, v.y FROM v JOIN n a ON a.k = v.x JOIN n b ON b.k = v.y WHERE 100 * c >= 80 * (a.n + b.n - c)),
b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT k, k FROM e UNION SELECT r.x, b.y FROM r JOIN b ON b.x = r.y),
m AS (SELECT x, min(y) AS m FROM r GROUP BY x),
d AS (SELECT w.doc_id, c.k, m.m AS g FROM c JOIN e USING (h) JOIN m ON m.x = e.k JOIN w ON w.k = c.k),
i AS (SELECT g, min(doc_id) AS component_id FROM d GROUP BY g)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n > 0 THEN component_id ELSE w.doc_id END AS component_id,
  coalesce(w.doc_id = CASE WHEN n.n > 0 THEN component_id ELSE w.doc_id END, false) AS kept
FROM w LEFT JOIN n USING (k) LEFT JOIN d ON d.k = w.k LEFT JOIN i ON i.g = d.g
"""
