"""Queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import alignment, bpe, chat, contamination, neardup, pages, personal, quality, shards, substring, suffix, toxicity, vectors


#: Rows of a batch that goes to a Python worker. Texts are long, and a batch is held
#: several times over, on both sides.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_minhash_inverted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op5_suffix_radix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(table(spark, sf_dir, "documents"))


def op7_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op8_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op10_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents")).drop("kept_text")


def op11_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(table(spark, sf_dir, "documents"))


def op12_space_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


def op13_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_kneser_ney_toxicity,
        op2_seeded_alignment,
        op3_compression_bands,
        op4_minhash_inverted_join,
        op5_suffix_radix_sort,
        op6_line_blocks,
        op7_segment_tree_bpe,
        op8_snapshot_collapse,
        op9_kd_tree_shards,
        op10_count_min_substrings,
        op11_boosted_candidates,
        op12_space_anchors,
        op13_laesa_codes,
    )
}

ORACLE_SQL = {"op8_snapshot_collapse": chat.SQL, "op13_laesa_codes": vectors.SQL}
