"""Language-model scoring by stupid backoff, as a relational job.

Each document is scored by the n-grams of all *other* documents (its own occurrences are subtracted, so a
document does not vouch for itself). A word is scored by the longest n-gram ending in it that others have,

    S(w | context) = count(context w) / count(context), else ``alpha`` * S(w | shorter context),

down to count(w) / words. The steps are those of a join with counts, on whole columns:

* explode: a task turns its texts into n-grams and reduces them to distinct hashes with counts;
* count: parts, by range of hash, add up the counts of all tasks: the n-gram tables;
* join and sum: each task's n-grams get their totals back, in the order in which they were sent, and its
  documents add up their logarithms.

A frequent n-gram is one row per task, and a text of any length or a source of any size is only more
rows. N-grams are told apart by 60-bit hashes. Logarithms are rounded to millionths and added up as whole
numbers, so the sums do not depend on any order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored, tasks
from fleetpulse.llm.packed import deal, mix, planes, slices, steps, unplanes, unsteps

ROWS = "part bigint, kind int, task bigint, size int, slice int, hash binary, count binary, doc binary, none binary, length binary"
NAMES = [c.split(" ")[0] for c in ROWS.split(", ")]
SCORES = "doc_id bigint, n_words bigint, n_full bigint, n_single bigint, micro bigint"
GRAMS, TEXTS, TOTALS = 0, 1, 2
HELD, CHUNK_BYTES = 1_250_000, 2 << 20
UNIT = 1_000_000
_STEP, _DROP = np.uint64(0x9E3779B97F4A7C15), np.uint64(4)
#: Parts for each task that a shuffle has: a part is held in memory at once.
PARTS = 2


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * (len(NAMES) - 5)]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(NAMES, kinds)], NAMES)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and each text's number of words."""
    lists = pc.ascii_split_whitespace(texts)
    first = lists.offsets[0].as_py()
    flat = lists.values.slice(first, lists.offsets[-1].as_py() - first)
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[full]
    coded = flat.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)) >> _DROP
    hashes = distinct[coded.indices.to_numpy(zero_copy_only=False)[full]] if len(flat) else np.zeros(0, np.uint64)
    return hashes, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def gram_hashes(words: np.ndarray, lengths: np.ndarray, order: int):
    """For each size: hashes of the n-grams that start at each word, and which of them end inside their text."""
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(words))
    held = words
    yield held, np.ones(len(words), bool)
    for size in range(2, order + 1):
        ahead = np.concatenate([words[size - 1 :], np.zeros(min(size - 1, len(words)), np.uint64)])
        held = mix(held * _STEP + ahead + np.uint64(size)) >> _DROP
        yield held, room >= size


def _explode(order: int, parts: int, kind: int):
    """Rows of one kind: the n-grams of each batch of texts, or what is needed to list them again."""

    def flush(held, docs, task):
        words = np.concatenate([w for w, _ in held])
        lengths = np.concatenate([n for _, n in held])
        rows = []
        for size, (hashes, inside) in enumerate(gram_hashes(words, lengths, order) if kind == GRAMS else (), 1):
            distinct, counts = np.unique(hashes[inside], return_counts=True)
            for part, at in slices(deal(distinct << _DROP, parts)):
                rows.append(
                    {"part": -1 - part, "kind": GRAMS, "task": task, "size": size, "slice": part, "hash": steps(distinct[at]), "count": planes(counts[at].astype(np.uint64))}
                )
        if kind == GRAMS:
            for k in range(0, len(rows), 64):
                yield _rows(rows[k : k + 64])
            return
        distinct, number = np.unique(words, return_inverse=True)
        ids = np.array([0 if d is None else d for d in docs], np.int64)
        none = np.array([d is None for d in docs], np.uint8)
        rows.append(
            {
                "part": task,
                "kind": TEXTS,
                "task": task,
                "hash": steps(distinct),
                "count": planes(number.astype(np.uint32)),
                "doc": planes(ids),
                "none": planes(none),
                "length": planes(lengths),
            }
        )
        yield _rows(rows)

    def run(batches):
        held, docs, count = [], [], 0
        task = TaskContext.get().partitionId() << 20
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES)))
                held.append(word_hashes(batch.column(1).slice(start, stop - start)))
                docs += batch.column(0).slice(start, stop - start).to_pylist()
                count, start = count + len(held[-1][0]), stop
                if count >= HELD:
                    yield from flush(held, docs, task)
                    held, docs, count, task = [], [], 0, task + 1
        if docs:
            yield from flush(held, docs, task)

    return run


def _count(table: pa.Table) -> pa.Table:
    """One part of the n-gram tables: totals for each task's n-grams, in the order they came."""
    rows: list[dict] = []
    for size in sorted(set(table["size"].to_pylist()) - {None}):
        own = table.filter((pc.field("kind") == GRAMS) & (pc.field("size") == size))
        hashes = [unsteps(x) for x in own["hash"].to_pylist()]
        counts = np.concatenate([unplanes(x, np.uint64) for x in own["count"].to_pylist()])
        distinct, number = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(number, counts.astype(np.float64), len(distinct)).astype(np.uint64)[number]
        ends = np.cumsum([len(h) for h in hashes])
        for task, part, a, n in zip(own["task"].to_pylist(), own["slice"].to_pylist(), ends, [len(h) for h in hashes]):
            rows.append({"part": task, "kind": TOTALS, "task": task, "size": size, "slice": part, "count": planes(totals[a - n : a])})
    return pa.Table.from_batches([_rows(rows)])


def _others(number: np.ndarray, totals: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each n-gram of each text: how often all other texts have it."""
    found = totals[number].astype(np.int64)
    left = np.zeros(len(number), np.int64)
    several = np.flatnonzero(found > 1)
    if len(several):
        pair = owner[several] * len(totals) + number[several]
        _, which, own = np.unique(pair, return_inverse=True, return_counts=True)
        left[several] = found[several] - own[which]
    return left


def _logs(counts: np.ndarray) -> np.ndarray:
    return np.rint(UNIT * np.log(counts.astype(np.float64))).astype(np.int64)


def _sum(order: int, alpha: float):
    penalty = round(UNIT * math.log(alpha))

    def run(table: pa.Table, batch: pa.Table) -> pa.Table:
        """One batch of texts: n-grams joined to their totals, logarithms added up per text."""
        texts = batch.to_pylist()[0]
        words = unsteps(texts["hash"])[unplanes(texts["count"], np.uint32)]
        lengths, n = unplanes(texts["length"], np.int64), len(words)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        replies = sorted(table.select(["size", "slice", "count"]).to_pylist(), key=lambda r: (r["size"], r["slice"]))
        others = []
        for size, (hashes, inside) in enumerate(gram_hashes(words, lengths, order), 1):
            totals = np.concatenate([unplanes(r["count"], np.uint64) for r in replies if r["size"] == size] or [np.zeros(0, np.uint64)])
            left = np.zeros(n, np.int64)
            _, number = np.unique(hashes[inside], return_inverse=True)
            left[inside] = _others(number, totals, owner[inside])
            others.append(left)
        place = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        longest = np.minimum(place + 1, order)
        micro, open_places = np.zeros(n, np.int64), np.ones(n, bool)
        full = np.zeros(n, bool)
        for size in range(order, 1, -1):
            at = np.flatnonzero(open_places & (place >= size - 1))
            at = at[others[size - 1][at - size + 1] > 0]
            begin = at - size + 1
            micro[at] = _logs(others[size - 1][begin]) - _logs(others[size - 2][begin]) + penalty * (longest[at] - size)
            open_places[at] = False
            full[at] = size == order
        at = np.flatnonzero(open_places)
        micro[at] = _logs(np.maximum(others[0][at], 0.5)) + penalty * (longest[at] - 1)
        per = lambda values: np.bincount(owner, values, len(lengths)).astype(np.int64)
        sums = np.zeros(len(lengths), np.int64)
        some = lengths > 0
        if n:
            sums[some] = np.add.reduceat(micro, (np.cumsum(lengths) - lengths)[some])
        return pa.table(
            {
                "doc_id": pa.array(unplanes(texts["doc"], np.int64), mask=unplanes(texts["none"], np.uint8) > 0),
                "n_words": lengths,
                "n_full": per(full),
                "n_single": per(open_places),
                "micro": sums,
            }
        )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3, alpha: float = 0.4) -> DataFrame:
    """(doc_id, n_words, n_full, n_single, log_score, mean_log) for every row.

    ``n_full`` words are scored by n-grams of full order, ``n_single`` by their own count. A word that no
    other row has counts as half an occurrence. Words are what ASCII white space separates. Null and
    empty texts, and texts alone in the table, have null scores. Rows are documents: a repeated row vouches
    for its copy. ``docs`` has the same partitions whenever it is read, as files have. An empty table gives no row; further columns are ignored.
    """
    parts = PARTS * tasks(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # texts are read again rather than sent along with their n-grams; both reads cut them into the same batches
    totals = own.mapInArrow(_explode(order, parts, GRAMS), ROWS).groupBy("part").applyInArrow(_count, ROWS)
    texts = own.mapInArrow(_explode(order, parts, TEXTS), ROWS)
    sums = stored(totals.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(_sum(order, alpha), SCORES), "backoff")
    corpus = sums.agg(F.sum("n_words").alias("_all"))  # one row
    rest = F.col("_all") - F.col("n_words")
    micro = F.col("micro") - F.col("n_single") * F.rint(F.log(rest.cast("double")) * UNIT).cast("bigint")
    log_score = F.when((F.col("n_words") > 0) & (rest > 0), micro / F.lit(float(UNIT)))
    joined = sums.join(F.broadcast(corpus))
    return joined.select("doc_id", "n_words", "n_full", "n_single", log_score.alias("log_score"), (log_score / F.col("n_words")).alias("mean_log"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT rid, unnest(ws) AS g1, generate_subscripts(ws, 1) AS i FROM d),
p AS (SELECT rid, i, g1, lag(g1) OVER k || ' ' || g1 AS g2, lag(g1, 2) OVER k || ' ' || lag(g1) OVER k || ' ' || g1 AS g3
  FROM u WINDOW k AS (PARTITION BY rid ORDER BY i)),
c AS (SELECT rid, i,
  count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY rid, g1) AS c1,
  CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY rid, g2) ELSE 0 END AS c2,
  CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY rid, g3) ELSE 0 END AS c3 FROM p),
l AS (SELECT *, lag(c1) OVER w AS b1, lag(c2) OVER w AS b2, least(i, 3) AS longest FROM c WINDOW w AS (PARTITION BY rid ORDER BY i)),
s AS (SELECT rid, count(*) AS n, count(*) FILTER (c3 > 0) AS n_full, count(*) FILTER (c3 = 0 AND c2 = 0) AS n_single,
  sum(CASE WHEN c3 > 0 THEN round(1e6::DOUBLE * ln(c3::DOUBLE))::BIGINT - round(1e6::DOUBLE * ln(b2::DOUBLE))::BIGINT
    WHEN c2 > 0 THEN round(1e6::DOUBLE * ln(c2::DOUBLE))::BIGINT - round(1e6::DOUBLE * ln(b1::DOUBLE))::BIGINT - 916291 * (longest - 2)
    ELSE round(1e6::DOUBLE * ln(greatest(c1, 0.5::DOUBLE)))::BIGINT - 916291 * (longest - 1) END) AS micro FROM l GROUP BY rid),
a AS (SELECT sum(len(ws)) AS total FROM d),
r AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_full, 0)::BIGINT AS n_full, coalesce(n_single, 0)::BIGINT AS n_single,
  CASE WHEN len(ws) > 0 AND total > len(ws) THEN (micro - n_single * round(1e6::DOUBLE * ln((total - len(ws))::DOUBLE))::BIGINT)::DOUBLE / 1e6::DOUBLE END AS log_score
  FROM d CROSS JOIN a LEFT JOIN s USING (rid))
SELECT *, log_score / n_words AS mean_log FROM r
"""
