"""Queries of the operators, each over its whole table, and their SQL where SQL can express them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    bpe, conversation_repair, language_id, language_model, ngram_join, oracle, packing, prefix_trie, quality_rules, simhash_join,
    suffix_dedup, token_counts, topk_blocks, varbyte)
from evenkeel.plans.staging import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), public_tokenizers.path(BYTE_BPE))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, folder), public_tokenizers.path(BYTE_BPE))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_documents(spark, folder))


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, folder))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return topk_blocks.top_k(vectors, F.col("vec_id") % 50 == 0)


def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_documents(spark, folder), public_tokenizers.path(WORD_BPE))


def op8_token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    varbyte.write_ids(_documents(spark, folder), public_tokenizers.path(WORD_BPE), path)
    return varbyte.read_ids(spark, path)


def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_groups(_documents(spark, folder))


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(_documents(spark, folder))


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.rebuilt_nodes(_conversations(spark, folder))


def op12_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_join.near_groups(_documents(spark, folder))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair(_conversations(spark, folder))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_token_counts, op3_language_id, op4_suffix_array_dedup, op5_quality_rules, op6_exact_top_k,
    op7_bpe_round_trip, op8_token_id_files, op9_ngram_jaccard, op10_language_model, op11_conversation_trie,
    op12_simhash_near_dedup, op13_conversation_repair)}

SQL = {
    "op4_suffix_array_dedup": oracle.REPEATS,
    "op9_ngram_jaccard": oracle.JACCARD,
    "op11_conversation_trie": oracle.TRIE,
    "op13_conversation_repair": oracle.REPAIR,
    "op6_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
