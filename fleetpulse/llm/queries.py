"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import backoff, extraction, jaccard, licenses, merkle, mixing, neighbours, packing, quality, repeats, rules, sketching, spelling
from fleetpulse.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_stupid_backoff", backoff.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score(table(spark, sf_dir, "documents"))


@query("op2_pu_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op3_adaptive_rules", rules.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join", jaccard.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents")).drop("set_key")


@query("op5_cube_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@query("op6_power_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@query("op7_host_paths")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


@query("op8_license_join", licenses.sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup", repeats.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op10_collision_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query("op11_fast_sketches", sketching.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketching.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", merkle.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants", spelling.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))
