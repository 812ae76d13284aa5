"""From raw documents to packed training sequences: filter, deduplicate, mix and pack.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``documents``, whatever they are called. A stage's result is written and read again as the next one's ``docs``, so
a stage begins by clearing what the operators of the stage before it kept for this ``sf_dir``.

Null and empty texts fail the quality rules; on their own, later stages keep them: they are no duplicates, have
nothing to cut, are taken by the mix as texts of size 0 and pack into their end id. Null ids, languages and
sources are values like others. Repeated rows are one component, of which one row stays. An empty table
gives an empty table.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import jaccard, mixing, packing, repeats, rules
from fleetpulse.llm.common import Scratch, stored, table

TOKENIZER = "word_bpe_49k.json"

#: What the stages keep until their successors run, by stage and input.
_KEPT: dict[tuple[str, str], Scratch] = {}


def _stage(before: str | None):
    """A stage whose stored tables go once its successor for the same input begins."""

    def wrap(build):
        @functools.wraps(build)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if (done := _KEPT.pop((before, sf_dir), None)) is not None:
                done.clear()
            with Scratch(spark) as scratch:
                result = build(spark, docs, sf_dir)
            _KEPT[build.__name__, sf_dir] = scratch
            return result

        return run_stage

    return wrap


@_stage(None)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules reject go."""
    return rules.accepted(docs, guarded=True)


@_stage("quality_rules")
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word shingles the first stays."""
    return jaccard.one_of_each(docs)


@_stage("near_duplicates")
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that an earlier document has too are cut out."""
    cut = repeats.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else cut


@_stage("repeated_passages")
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


@_stage("source_mix")
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences, each a piece of one document of a power-of-two length, with their ids (unsigned, 32 bits, little-endian)."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: Sampling and tokenization have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            with Scratch(spark) as written:
                docs = stored(docs, name)
            before.clear()  # what the stage has read
            before = written
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
