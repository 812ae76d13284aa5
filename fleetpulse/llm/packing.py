"""Packing: power-of-two decomposition of every document.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then one piece for each set bit of the rest. Every piece is a sequence of its own, so
no sequence crosses documents and none is padded; sequences of equal length share a bucket from
which training draws whole batches.

Tokens never leave the task that reads the document: there is no shuffle, so a source or document
of any size only adds pieces. Within a task, ids are looked up per distinct word, as the
tokenizer drops white space before anything else and works on the words between it alone.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import small_batches
from fleetpulse.llm.packed import give_back

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"
#: Bytes of text tokenized at once; distinct words and bytes of them whose ids a task keeps.
CHUNK_BYTES = 4 << 20
KEPT_WORDS = 1_000_000
KEPT_BYTES = 64 << 20
#: Letters of Latin-1, whose lower case is a letter of its own, then marks without an apostrophe or angle bracket.
CAPITALS, SMALL = r"A-Z\x{c0}-\x{d6}\x{d8}-\x{de}", r"a-z\x{df}-\x{f6}\x{f8}-\x{ff}"
MARKS = r'.,:;!?#*$%&|()"-'
SIMPLE = f"^(?P<letters>[{CAPITALS}{SMALL}]+)(?P<marks>[{MARKS}]*)$"
#: Parts that a tokenizer may hand to its model whole: small letters or marks.
WHOLE = f"^(?:[{SMALL}]+|[{MARKS}]+)$"


class WordIds:
    """Ids of texts by way of their distinct words; equals ``encode`` on the whole text.

    A word of Latin letters with marks after it, the usual case, is looked up as its letters in
    lower case and its marks, which the tokenizer sets apart too; other words are looked up whole.
    New letters and marks go to the tokenizer's model as they would reach it, other new words are
    encoded as texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # tasks already use all cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._spelled = self._spelling()
        self._forget()

    def _spelling(self) -> dict[int, str] | None:
        """How the model sees each small letter and mark; none if it does not get runs of them whole and unchanged."""
        normalizer, splitter = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer

        def pieces(text: str) -> list[str]:
            text = text if normalizer is None else normalizer.normalize_str(text)
            return [text] if splitter is None else [piece for piece, _ in splitter.pre_tokenize_str(text)]

        small = [chr(c) for c in (*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100))]
        spelled = {c: "".join(pieces(c)) for c in (*small, *MARKS)}
        if any(pieces("".join(run)) != ["".join(spelled[c] for c in run)] for run in (small, MARKS)):
            return None
        if any(set(token.content) <= spelled.keys() for token in self._tokenizer.get_added_tokens_decoder().values()):
            return None
        return {ord(c): piece for c, piece in spelled.items() if c != piece}

    def _forget(self) -> None:
        self._known = pa.array([""])
        self._ids = np.zeros(0, np.uint32)
        self._starts, self._sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _ids_of(self, words: list[str], whole: bool) -> Iterator[list[int]]:
        if whole:
            tokenize, spelled = self._model.tokenize, self._spelled
            for word in words:
                yield [token.id for token in tokenize(word.translate(spelled) if not word.isascii() else word)]
        else:
            for k in range(0, len(words), 4096):
                for encoded in self._tokenizer.encode_batch_fast(words[k : k + 4096], add_special_tokens=False):
                    yield encoded.ids

    def _numbers(self, distinct: pa.Array) -> np.ndarray:
        """Each part's number among the known ones, after encoding those not seen before."""
        found = pc.index_in(distinct, value_set=self._known)
        numbers = pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        unseen = np.flatnonzero(pc.is_null(found).to_numpy(zero_copy_only=False))
        fresh = distinct.take(pa.array(unseen))
        whole = pc.match_substring_regex(fresh, WHOLE) if self._spelled is not None else pa.repeat(False, len(fresh))
        for kind in (True, False):
            chosen = pc.equal(whole, kind)
            words = fresh.filter(chosen)
            ids, sizes = array("I"), array("q")
            for own in self._ids_of(words.to_pylist(), kind):
                ids.extend(own)
                sizes.append(len(own))
            numbers[unseen[chosen.to_numpy(zero_copy_only=False)]] = len(self._known) + np.arange(len(words))
            lengths = np.array(sizes, np.int64)
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(lengths) - lengths])
            self._sizes = np.concatenate([self._sizes, lengths])
            self._ids = np.concatenate([self._ids, np.array(ids, np.uint32)])
            self._known = pa.concat_arrays([self._known, words])
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, one text after the other, and each text's number of ids."""
        if len(self._known) > KEPT_WORDS or self._known.nbytes > KEPT_BYTES:
            self._forget()
        lists = pc.ascii_split_whitespace(texts)
        first = lists.offsets[0].as_py()
        coded = lists.values.slice(first, lists.offsets[-1].as_py() - first).dictionary_encode()
        split = pc.extract_regex(coded.dictionary, SIMPLE)
        letters, marks = (pc.struct_field(split, k) for k in ("letters", "marks"))
        other = pc.is_null(split)
        parts = [pc.if_else(other, coded.dictionary, pc.utf8_lower(letters)), pc.if_else(other, "", marks)]
        parts = pa.concat_arrays(parts).dictionary_encode()
        numbers = self._numbers(parts.dictionary)[parts.indices.to_numpy(zero_copy_only=False)]
        # letters and marks of every distinct word in turn, then the ranges of their ids one after the other
        at = numbers.reshape(2, -1).T.ravel()
        starts, lengths = self._starts[at], self._sizes[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
        words = pa.ListArray.from_arrays(pa.array(ends[::2], pa.int32()), pa.array(self._ids[places])).take(coded.indices)
        offsets = lists.offsets.to_numpy() - first
        return words.values.to_numpy(), np.diff(words.offsets.to_numpy()[offsets])


def power_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, longest first; they sum to ``n``."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + CHUNK_BYTES)))
            yield batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start)
            start = stop


def _rows(keys: pa.Array, ids: np.ndarray, sizes: np.ndarray, longest: int, end_id: int) -> pa.RecordBatch:
    """The pieces of some documents, whose ids lie end to end without the end id."""
    raw, at = memoryview(ids.astype("<u4", copy=False).view(np.uint8)), 0
    last = np.array([end_id], "<u4").tobytes()
    rows: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens")}
    for key, n in zip(keys.to_pylist(), sizes.tolist()):
        own, at, begin = b"".join((raw[4 * at : 4 * (at + n)], last)), at + n, 0
        for length in power_lengths(n + 1, longest):
            rows["doc_id"].append(key)
            rows["start"].append(begin)
            rows["length"].append(length)
            rows["ids"].append(own[4 * begin : 4 * (begin + length)])
            rows["doc_tokens"].append(n + 1)
            begin += length
    return pa.RecordBatch.from_pydict(rows, pa.schema([(k, pa.binary() if k == "ids" else pa.int64()) for k in rows]))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 4096,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: its ids (little-endian unsigned 32-bit), place and sequence.

    ``longest`` is a power of two. Each document is its text's ids and ``end_id``; a null or empty
    text is that id alone. Each row of the input is a document, repeated rows are packed each time,
    a null id stays null; an empty table gives no row. Columns other than id and text are ignored.
    ``bucket`` is the base-2 logarithm of the length; ``sequence_id`` is unique, and its remainder
    by 64 is the bucket.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(batches):
        coder = WordIds(tokenizer_path)
        for keys, texts in _chunks(batches):
            yield _rows(keys, *coder.encode(pc.fill_null(texts, "")), longest, end_id)
            # allocators keep what a chunk has freed, in places that the next one does not fit
            give_back()
        del coder
        give_back()

    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bucket = F.log2("length").cast("int")
    return own.mapInArrow(cut, PIECES).select(
        "*",
        bucket.alias("bucket"),
        (F.monotonically_increasing_id() * 64 + bucket).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as files, a folder for each length."""
    pieces.write.partitionBy("bucket").parquet(path)
