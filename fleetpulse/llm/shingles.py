"""Word-shingle sets of documents, and which of their shingles other documents have too.

Tasks exchange whole columns: a task turns its texts into (shingle hash, text number) pairs, marks what
it saw twice itself and sends each hash once to its part; parts send back which hashes several
texts have. A shingle that half of all texts share is one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import small_batches, tasks
from fleetpulse.llm.packed import columns, deal, give_back, mix, planes, slices, steps

ROWS = "part bigint, kind int, task bigint, hash binary, text binary, doc binary, none binary, size binary, sum binary"
NAMES = [c.split(" ")[0] for c in ROWS.split(", ")]
SETS = "doc_id bigint, n_shingles bigint, set_key bigint, tokens binary"
SINGLE, SEEN, TEXTS, SHARED = 0, 1, 2, 3
#: Pairs a task holds, bytes of text it splits at once.
HELD, CHUNK_BYTES = 1_500_000, 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * (len(NAMES) - 3)]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(NAMES, kinds)], NAMES)


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of its text) of every shingle, repeats included; hashes have 56 bits.

    Words are lower-cased for A-Z and split at ASCII white space. A text with fewer words than
    ``width`` has its whole sequence as its one shingle; a text without words has none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    first = lists.offsets[0].as_py()
    flat = lists.values.slice(first, lists.offsets[-1].as_py() - first)
    offsets = lists.offsets.to_numpy() - first
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    number = np.repeat(np.arange(len(texts)), np.diff(offsets))[full]
    coded = flat.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    word = distinct[coded.indices.to_numpy(zero_copy_only=False)[full]] if len(flat) else np.zeros(0, np.uint64)
    counts = np.bincount(number, minlength=len(texts)) if len(number) else np.zeros(len(texts), np.int64)
    begins = np.cumsum(counts) - counts
    hashes, owners = [], []
    for size in range(1, width + 1):  # short texts by their own size, all others by the full width
        whole = counts == size if size < width else counts >= width
        if not whole.any():
            continue
        per = np.where(whole, counts - size + 1, 0)
        owner = np.repeat(np.arange(len(texts)), per)
        at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + begins[owner]
        h = np.full(len(at), np.uint64(size))
        for k in range(size):
            h = mix(h * _STEP + word[at + k])
        hashes.append(h >> np.uint64(8))
        owners.append(owner)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


def _flush(held: list, docs: list, task: int, parts: int):
    """Rows of one batch of texts: sizes and keys of the sets, pairs dealt to parts, pairs known to be shared."""
    hashes = np.concatenate([h for h, _ in held]) if held else np.zeros(0, np.uint64)
    texts = np.concatenate([t for _, t in held]) if held else np.zeros(0, np.uint32)
    held.clear()
    order = np.argsort(hashes, kind="stable")  # a text's pairs lie together, so its equal hashes do then
    hashes, texts = hashes[order], texts[order]
    del order
    if len(hashes):
        new = np.concatenate([[True], (np.diff(hashes) != 0) | (np.diff(texts) != 0)])
        hashes, texts = hashes[new], texts[new]
    sizes = np.bincount(texts, minlength=len(docs)).astype(np.int64)
    sums = np.zeros(len(docs), np.uint64)
    if len(hashes):
        by_text = np.argsort(texts, kind="stable")
        starts = np.cumsum(sizes) - sizes
        some = sizes > 0
        sums[some] = np.add.reduceat(mix(hashes[by_text]), starts[some])
        del by_text
    none = np.array([d is None for d in docs], np.uint8)
    ids = np.array([0 if d is None else d for d in docs], np.int64)
    rows = [{"part": task, "kind": TEXTS, "task": task, "doc": planes(ids), "none": planes(none), "size": planes(sizes), "sum": planes(sums)}]
    if len(hashes):
        again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        several = again | np.concatenate([again[1:], [False]])
        rows.append({"part": task, "kind": SHARED, "task": task, "hash": steps(hashes[several]), "text": planes(texts[several])})
        for kind, which in ((SINGLE, ~several), (SEEN, several & ~again)):
            h, t = hashes[which], texts[which]
            for part, at in slices(deal(h << np.uint64(8), parts)):
                rows.append(
                    {"part": -1 - part, "kind": kind, "task": task, "hash": steps(h[at]), "text": planes(t[at]) if kind == SINGLE else None}
                )
    for k in range(0, len(rows), 128):
        yield _rows(rows[k : k + 128])


def _split(width: int, parts: int):
    def run(batches):
        held, docs, count = [], [], 0
        task, step = TaskContext.get().partitionId() << 20, 0
        for batch in batches:
            bytes_so_far = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = bytes_so_far[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(bytes_so_far, done + CHUNK_BYTES)))
                hashes, owners = shingle_hashes(batch.column(1).slice(start, stop - start), width)
                held.append((hashes, (owners + len(docs)).astype(np.uint32)))
                docs += batch.column(0).slice(start, stop - start).to_pylist()
                count, start = count + len(hashes), stop
                if count >= HELD:
                    yield from _flush(held, docs, task + step, parts)
                    held, docs, count, step = [], [], 0, step + 1
                    give_back()
        if docs:
            yield from _flush(held, docs, task + step, parts)
        held, docs = [], []
        give_back()

    return run


def _compare(table: pa.Table) -> pa.Table:
    """One part: which of the hashes that tasks saw once are in several tasks; other rows pass through."""
    kinds = np.asarray(table["kind"])
    rows = table.filter(pa.array(kinds >= TEXTS)).to_pylist()
    own = table.filter(pa.array(kinds < TEXTS))
    if own.num_rows:
        hashes, texts, senders = [], [], []
        names = np.array([*own["task"].to_pylist(), -1], np.int64)  # by row; the last one stands for none
        for kind, row in zip(own["kind"].to_pylist(), range(own.num_rows)):
            got = columns(own.slice(row, 1), hash="steps", text=np.uint32)
            hashes.append(got["hash"])
            texts.append(got["text"] if kind == SINGLE else np.zeros(len(got["hash"]), np.uint32))
            senders.append(np.full(len(got["hash"]), row if kind == SINGLE else -1, np.int32))
        del own
        hashes, texts, senders = np.concatenate(hashes), np.concatenate(texts), np.concatenate(senders)
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        several = again | np.concatenate([again[1:], [False]])
        hashes, order = hashes[several], order[several]
        named = senders[order] >= 0
        hashes, order = hashes[named], order[named]
        texts, senders = texts[order], names[senders[order]]
        order = np.argsort(senders, kind="stable")
        hashes, texts, senders = hashes[order], texts[order], senders[order]
        for task, at in slices(senders):
            rows.append({"part": task, "kind": SHARED, "task": task, "hash": steps(hashes[at]), "text": planes(texts[at])})
    give_back()
    return pa.Table.from_batches([_rows(rows)])


def _collect(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """One task's texts: the sets that can have a partner keep their shared hashes, in order."""
        kinds = np.asarray(table["kind"])
        own = columns(table.filter(pa.array(kinds == TEXTS)), doc=np.int64, none=np.uint8, size=np.int64, sum=np.uint64)
        got = columns(table.filter(pa.array(kinds == SHARED)), hash="steps", text=np.uint32)
        order = np.lexsort((got["hash"], got["text"]))
        hashes, texts = got["hash"][order], got["text"][order]
        counts = np.bincount(texts, minlength=len(own["doc"])).astype(np.int64)
        ends = np.cumsum(counts)
        partner = (100 * counts >= percent * own["size"]) & (own["size"] > 0)
        give_back()
        keys = mix(own["sum"] ^ mix(own["size"].astype(np.uint64))).view(np.int64)
        tokens = [hashes[b - c : b].tobytes() if p else None for b, c, p in zip(ends.tolist(), counts.tolist(), partner.tolist())]
        return pa.table(
            {
                "doc_id": pa.array(own["doc"], mask=own["none"] > 0),
                "n_shingles": own["size"],
                "set_key": keys,
                "tokens": pa.array(tokens, pa.binary()),
            }
        )

    return run


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, tokens) for every row.

    Equal sets have equal keys. ``tokens`` holds the hashes that at least one other text has, in
    ascending order, if they make up ``percent`` of the set: other sets cannot be that similar to any.
    """
    parts = tasks(docs.sparkSession)
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    pairs = own.mapInArrow(_split(width, parts), ROWS)
    shared = pairs.groupBy("part").applyInArrow(_compare, ROWS)
    return shared.groupBy(F.col("part").alias("_task")).applyInArrow(_collect(percent), SETS)
