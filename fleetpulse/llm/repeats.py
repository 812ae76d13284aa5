"""Exact substring deduplication with suffix arrays over shards of text.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a smaller document,
or earlier in the same one. Equal strings must meet in one shard, so texts are cut by content: every
window of ``length`` bytes has an anchor, the short gram in it with the smallest hash (the first of equal
ones). Windows with one anchor form a context of less than two lengths. Equal windows have equal
anchors, so a shard takes the contexts of its anchors and nothing else:

1. per task, contexts are reduced to (anchor hash, content hash, place); within a task only the first
   place of equal contexts travels, the later ones are already known to repeat it;
2. per shard of anchors, equal contexts become one text with its first place; all later places repeat it.
   Anchors with several different contexts ask for their bytes;
3. per block of documents, the bytes of those contexts are looked up;
4. per shard, a suffix array (induced sorting) and permuted common prefixes over the different contexts
   find the windows they share; the first place of each stays;
5. per block of documents, the ranges found are cut out.

Contexts are compared by two 64-bit hashes in step 2 and byte by byte in step 4. An anchor with more than
``crowded`` different contexts is dealt again by single windows, so that no shard depends on how common a
passage is. A source or passage that holds a third of all rows sends one row per task and context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored, tasks
from fleetpulse.llm.packed import columns, deal, give_back, mix, planes, slices, steps, text_bytes
from fleetpulse.llm.suffixes import common_prefixes, suffix_array

ROWS = "part int, kind int, gram binary, content binary, doc binary, tie binary, block binary, low binary, span binary, bytes binary, number bigint"
NAMES = [c.split(" ")[0] for c in ROWS.split(", ")]
CONTEXTS, RANGES, WANTED, CROWDED = 0, 1, 2, 3
KINDS = {"content": np.uint64, "doc": np.int64, "tie": np.uint32, "block": np.int32, "low": np.int64, "span": np.int64}
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"

GRAM = 24
PIECE = 1 << 20
#: Contexts a task holds before it passes them on.
HELD = 1_000_000
#: Shards for each task that a shuffle has: a shard is held in memory at once.
SHARDS = 3
#: Text that one suffix array covers.
SHARD_BYTES = 1 << 19
#: Ids of documents without one: after all others, apart by the hash of their text.
NO_ID = 1 << 62

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        size = max(n, PIECE + 4096)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, np.uint64(base))
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS


def contexts(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, gram hash, content hash) of every context of texts laid end to end.

    ``ends`` has for each byte the end of its text.
    """
    n, gram = len(data), min(GRAM, length)
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    power, inverse = _powers(n + 1)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[:n], dtype=np.uint64)])
    grams = mix((running[gram:] - running[:-gram]) * inverse[: n - gram + 1])
    low28 = np.uint64((1 << 28) - 1)
    least = (grams & ~low28) | np.arange(len(grams), dtype=np.uint64)
    width, span = length - gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    windows = np.flatnonzero(np.arange(len(least)) + length <= ends[: len(least)])
    anchors = (least[windows] & low28).astype(np.int64)
    if not len(windows):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    cut = np.flatnonzero((np.diff(anchors) != 0) | (np.diff(windows) != 1)) + 1
    first, last = windows[np.concatenate([[0], cut])], windows[np.concatenate([cut - 1, [len(windows) - 1]])]
    anchor = anchors[np.concatenate([[0], cut])]
    content = (running[last + length] - running[first]) * inverse[first]
    shape = (anchor - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
    # smallest hashes are small numbers: spread them again before they are dealt to shards
    return first, last, mix(grams[anchor]), mix(content ^ mix(shape))


def _row(part: int, kind: int, **values) -> dict:
    return {"part": part, "kind": kind, **values}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * (len(NAMES) - 3), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(NAMES, kinds)], NAMES)


def _ranges(doc, tie, block, low, high) -> list[dict]:
    """Rows for ranges of bytes that go, by block of documents; overlapping ranges of a document are joined."""
    order = np.lexsort((low, tie, doc, block))
    doc, tie, block, low, high = (x[order] for x in (doc, tie, block, low, high))
    rows = []
    for part, at in slices(block):
        d, t, a, b = doc[at], tie[at], low[at], high[at]
        new = np.concatenate([[True], (np.diff(d) != 0) | (np.diff(t) != 0)])
        # ends of a document's ranges ascend with their starts, but for contexts inside others
        group = np.cumsum(new)
        shift = group * (int(b.max()) + 1)
        b = np.maximum.accumulate(b + shift) - shift
        start = new | np.concatenate([[True], a[1:] > b[:-1]])
        firsts = np.flatnonzero(start)
        lasts = np.concatenate([firsts[1:], [len(a)]]) - 1
        rows.append(
            _row(part, RANGES, doc=planes(d[firsts]), tie=planes(t[firsts]), low=planes(a[firsts]), span=planes(b[lasts] - a[firsts]))
        )
    return rows


def _take(held: dict[str, np.ndarray], keep: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[keep] for k, v in held.items()}


def _firsts(held: dict[str, np.ndarray], length: int) -> tuple[dict[str, np.ndarray], list[dict]]:
    """The first place of every distinct context, by gram hash; ranges of all later places."""
    held = _take(held, np.lexsort((held["low"], held["tie"], held["doc"], held["content"], held["gram"])))
    n = len(held["gram"])
    if not n:
        return held, []
    same = lambda *names: np.logical_and.reduce([held[k][1:] == held[k][:-1] for k in names])
    again = np.concatenate([[False], same("gram", "content")])
    place = np.concatenate([[False], same("gram", "content", "doc", "tie", "low")])  # a repeated row of the table
    later = _take(held, again & ~place)
    rows = _ranges(later["doc"], later["tie"], later["block"], later["low"], later["low"] + later["span"] + length)
    return _take(held, ~again), rows


def _pieces(batches: Iterator[pa.RecordBatch], length: int):
    """Texts in pieces of about PIECE bytes; longer texts overlap so that no window is lost.

    Gives the bytes, and for each text in it: start in the piece, start in the text, and id, tie and block.
    """
    data, heads, size = [], [], 0
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        keys = zip(*[batch.column(k).to_pylist() for k in ("doc", "tie", "block")])
        for a, b, key in zip(offsets[:-1].tolist(), offsets[1:].tolist(), keys):
            if b - a < length:
                continue
            for begin in range(a, b - length + 1, PIECE):
                piece = raw[begin : min(b, begin + PIECE + length - 1)]
                heads.append((size, begin - a, *key))
                data.append(piece)
                size += len(piece)
                if size >= PIECE:
                    yield np.concatenate(data), heads
                    data, heads, size = [], [], 0
    if data:
        yield np.concatenate(data), heads


def _reduce_texts(length: int, parts: int):
    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        count = 0

        def flush():
            if not held:
                return
            merged, rows = _firsts({k: np.concatenate([h[k] for h in held]) for k in held[0]}, length)
            held.clear()
            for part, at in slices(deal(merged["gram"], parts)):
                own = {k: planes(merged[k][at].astype(t)) for k, t in KINDS.items()}
                rows.append(_row(part, CONTEXTS, gram=steps(merged["gram"][at]), **own))
            del merged
            give_back()
            for k in range(0, len(rows), 256):
                yield _batch(rows[k : k + 256])

        for data, heads in _pieces(batches, length):
            begins = np.array([h[0] for h in heads])
            sizes = np.diff(np.append(begins, len(data)))
            first, last, gram, content = contexts(data, np.repeat(begins + sizes, sizes), length)
            text = np.searchsorted(begins, first, side="right") - 1
            of = lambda k, t: np.array([h[k] for h in heads], dtype=t)[text]
            held.append(
                {
                    "gram": gram,
                    "content": content,
                    "doc": of(2, np.int64),
                    "tie": of(3, np.uint32),
                    "block": of(4, np.int32),
                    "low": first - begins[text] + of(1, np.int64),
                    "span": last - first,
                }
            )
            count += len(first)
            if count >= HELD:
                yield from flush()
                count = 0
        yield from flush()

    return run


def _meet(length: int, crowded: int):
    """Step 2, for one shard: ranges by block, and the contexts whose bytes are wanted."""

    def run(table: pa.Table) -> pa.Table:
        kinds = np.asarray(table["kind"])
        rows = table.filter(pa.array(kinds == RANGES)).to_pylist()
        held = columns(table.filter(pa.array(kinds == CONTEXTS)), gram="steps", **KINDS)
        held, found = _firsts(held, length)
        rows += found
        if len(held["gram"]):
            _, number, counts = np.unique(held["gram"], return_inverse=True, return_counts=True)
            for kind, least, most in ((WANTED, 2, crowded), (CROWDED, crowded + 1, len(number))):
                own = _take(held, (counts[number] >= least) & (counts[number] <= most))
                own = _take(own, np.argsort(own["block"], kind="stable"))
                for block, at in slices(own["block"]):
                    values = {k: planes(own[k][at]) for k in ("gram", "doc", "tie", "low", "span")}
                    rows.append(_row(block, kind, number=at.stop - at.start, **values))
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _fetch(length: int, parts: int):
    """Step 3, for one block of documents: the wanted bytes, dealt to shards."""

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: list[dict] = []
        if wanted.num_rows and docs.num_rows:
            raw, offsets = text_bytes(docs["text"].combine_chunks() if docs.num_rows else docs["text"])
            at = {k: i for i, k in enumerate(zip(docs["doc"].to_pylist(), docs["tie"].to_pylist()))}
            block = docs["block"][0].as_py()
            out: list[tuple] = []
            for kind in (WANTED, CROWDED):
                own = columns(
                    wanted.filter(pa.array(np.asarray(wanted["kind"]) == kind)), gram=np.uint64, doc=np.int64, tie=np.uint32, low=np.int64, span=np.int64
                )
                for gram, doc, tie, low, span in zip(*[own[k].tolist() for k in ("gram", "doc", "tie", "low", "span")]):
                    begin = int(offsets[at[doc, tie]]) + low
                    if kind == WANTED:
                        out.append((gram, doc, tie, low, span, raw[begin : begin + span + length].tobytes()))
                        continue
                    for k in range(span + 1):  # a context of a crowded anchor: each window on its own
                        window = raw[begin + k : begin + k + length].tobytes()
                        out.append((int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little"), doc, tie, low + k, 0, window))
            out.sort(key=lambda x: x[0])
            shard = deal(np.array([x[0] for x in out], dtype=np.uint64), parts)
            for part, s in slices(shard):
                own = out[s]
                column = lambda k, t: planes(np.array([x[k] for x in own], dtype=t))
                rows.append(
                    _row(
                        part,
                        WANTED,
                        doc=column(1, np.int64),
                        tie=column(2, np.uint32),
                        block=planes(np.full(len(own), block, np.int32)),
                        low=column(3, np.int64),
                        span=column(4, np.int64),
                        bytes=b"".join(x[5] for x in own),
                    )
                )
        return pa.Table.from_batches([_batch(rows)])

    return run


def shared_windows(texts: list[np.ndarray] | np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur more than once in texts laid end to end: their starts, and the class of equal ones."""
    data = np.asarray(texts)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    whole = np.zeros(len(data) + len(lengths), np.uint16)  # a 0 ends each text
    moved = np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)
    whole[moved] = data.astype(np.uint16) + 1
    back = np.full(len(whole), -1, np.int64)
    back[moved] = np.arange(len(data))
    order = suffix_array(whole, length)
    prefix = common_prefixes(whole, order, 2 * length)[order]
    kind = np.cumsum(prefix < length)
    room = np.repeat(starts + lengths, lengths) - np.arange(len(data))
    place = back[order]
    valid = (place >= 0) & (room[np.maximum(place, 0)] >= length)
    place, kind = place[valid], kind[valid]
    many = np.bincount(kind)[kind] > 1 if len(kind) else np.zeros(0, bool)
    return place[many], kind[many]


def _sort_shard(length: int):
    """Step 4, for one shard of contexts."""

    def run(table: pa.Table) -> pa.Table:
        own = columns(table, doc=np.int64, tie=np.uint32, block=np.int32, low=np.int64, span=np.int64)
        rows: list[dict] = []
        if len(own["doc"]):
            sizes = own["span"] + length
            data = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
            place, kind = shared_windows(data, sizes, length)
            if len(place):
                starts = np.cumsum(sizes) - sizes
                context = np.searchsorted(starts, place, side="right") - 1
                doc, tie, block = (own[k][context] for k in ("doc", "tie", "block"))
                low = own["low"][context] + place - starts[context]
                order = np.lexsort((low, tie, doc, kind))
                later = order[np.concatenate([[False], np.diff(kind[order]) == 0])]
                rows = _ranges(doc[later], tie[later], block[later], low[later], low[later] + length)
        give_back()
        return pa.Table.from_batches([_batch(rows)])

    return run


def _cut(length: int, with_kept: bool, keep: tuple[str, ...]):
    """Step 5, for one block of documents."""

    def run(docs: pa.Table, ranges: pa.Table) -> pa.Table:
        own = columns(ranges, doc=np.int64, tie=np.uint32, low=np.int64, span=np.int64)
        order = np.lexsort((own["low"], own["tie"], own["doc"]))
        own = _take(own, order)
        found: dict[tuple[int, int], slice] = {}
        if len(order):
            cut = np.flatnonzero((np.diff(own["doc"]) != 0) | (np.diff(own["tie"]) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(order)]):
                found[int(own["doc"][a]), int(own["tie"][a])] = slice(a, b)
        raw, offsets = text_bytes(docs["text"].combine_chunks()) if docs.num_rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        seen: set[tuple[int, int]] = set()
        out: dict[str, list] = {k.split(" ")[0]: [] for k in RESULT.split(", ")}
        for key, doc_id, a, b in zip(
            zip(docs["doc"].to_pylist(), docs["tie"].to_pylist()), docs["doc_id"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()
        ):
            text, spans, kept = raw[a:b], 0, []
            if key in seen and b - a >= length:  # the same row once more
                spans = 1
            elif key in found:
                at, end = 0, -1
                for low, span in zip(own["low"][found[key]].tolist(), own["span"][found[key]].tolist()):
                    if low > end:
                        if low > at:
                            kept.append(text[at:low])
                        spans += 1
                    end = max(end, low + span)
                    at = end
                kept.append(text[at:])
            else:
                kept.append(text)
            seen.add(key)
            rest = b"".join(x.tobytes() for x in kept)
            for name, value in zip(out, (doc_id, b - a, b - a - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if with_kept else None)):
                out[name].append(value)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string()]
        result = pa.table(out, pa.schema(list(zip(out, kinds))))
        for k, _ in enumerate(keep):
            result = result.append_column(f"_keep{k}", docs[f"_keep{k}"])
        return result

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 100,
    with_kept: bool = False,
    crowded: int = 20000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, _keep0, ...): what is left of every text's UTF-8 bytes.

    ``kept`` has the text of those bytes if ``with_kept``, without characters that were cut in two;
    ``_keep0`` and so on have the columns named by ``keep``. Null and empty texts keep nothing and lose nothing. Rows of
    one id are documents in the order of a hash of their texts; of equal rows the first stays. Rows
    without id come after all others. An empty table gives no row; further columns are ignored.
    """
    spark = docs.sparkSession
    blocks, parts = tasks(spark), SHARDS * tasks(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text), 2))
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), key.alias("doc"), F.crc32(text.cast("binary")).alias("tie"), text.alias("text"),
                      *[F.col(c).alias(f"_keep{k}") for k, c in enumerate(keep)])
    own = own.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int"))
    reduced = own.select("doc", "tie", "block", "text").mapInArrow(_reduce_texts(length, parts), ROWS)
    met = stored(reduced.groupBy("part").applyInArrow(_meet(length, crowded), ROWS), "repeats")
    texts = own.groupBy("block")
    kinds = dict(docs.dtypes)
    schema = ", ".join([RESULT, *[f"_keep{k} {kinds[c]}" for k, c in enumerate(keep)]])
    wanted = met.filter(F.col("kind").isin(WANTED, CROWDED)).groupBy(F.col("part").alias("block"))
    asked = met.filter(F.col("kind").isin(WANTED, CROWDED)).agg(F.sum(F.col("number") * F.when(F.col("kind") == CROWDED, length).otherwise(1))).first()[0]
    shards = max(1, -(-(asked or 0) * 2 * length // SHARD_BYTES))
    shared = texts.cogroup(wanted).applyInArrow(_fetch(length, shards), ROWS)
    ranges = met.filter(F.col("kind") == RANGES).unionByName(shared.groupBy("part").applyInArrow(_sort_shard(length), ROWS))
    return texts.cogroup(ranges.groupBy(F.col("part").alias("block"))).applyInArrow(_cut(length, with_kept, keep), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated passages cut out of their texts; all other columns as they came."""
    others = tuple(c for c in docs.columns if c != text_col)
    cut = remove_repeats(docs, id_col, text_col, with_kept=True, keep=others, **options)
    columns_by_name = {c: F.col(f"_keep{k}") for k, c in enumerate(others)} | {text_col: F.col("kept")}
    return cut.select(*[columns_by_name[c].alias(c) for c in docs.columns])


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r)),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, run),
q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS e FROM s),
k AS (SELECT doc_id, string_agg(substr(h, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kh,
  sum(b - a) AS removed, count(*) AS spans FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kh, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
