"""The registered queries of the operators, and the SQL they must equal where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanecost.llm import chat, forest, huffman, merkle, minhash, packing, phrases, pieces, pii, polytope, quality, rules, sharding
from lanecost.llm.common import table
from lanecost.llm.sql import CHAT, COLLOCATIONS, DUPLICATES, MERKLE, VECTORS

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary(PIECES)
    rows = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, drop=("text",))
    return pieces.decode(rows, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return rules.judged(docs, drop=("text",))


def op4_forest_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_trusted_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judged(docs, table(spark, sf_dir, "labels"), drop=("text",))


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), lambda key: key % 20 == 0, k=20)


def op7_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op8_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"), vocabulary(BYTES), end=2)


def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verified(merkle.manifest(docs, presented=merkle.lowered_where(5)))


QUERIES: dict[str, Query] = {
    "op1_weak_supervision_pii": op1_weak_supervision_pii,
    "op2_distinct_chunks": op2_distinct_chunks,
    "op3_perplexity_bands": op3_perplexity_bands,
    "op4_forest_duplicates": op4_forest_duplicates,
    "op5_trusted_perplexity": op5_trusted_perplexity,
    "op6_projection_forest": op6_projection_forest,
    "op7_chat_perspectives": op7_chat_perspectives,
    "op8_length_buckets": op8_length_buckets,
    "op9_jump_shards": op9_jump_shards,
    "op10_huffman_ids": op10_huffman_ids,
    "op11_cross_polytope": op11_cross_polytope,
    "op12_collocations": op12_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL: dict[str, str] = {
    "op4_forest_duplicates": DUPLICATES,
    "op7_chat_perspectives": CHAT,
    "op11_cross_polytope": VECTORS,
    "op12_collocations": COLLOCATIONS,
    "op13_merkle_manifest": MERKLE,
}
