"""The registered queries of this subpackage: name -> (query, SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from threadloom.llm import (
    exact_search, gram_join, language, mixing, near_dup, packing, prefix_trie, repeats, role_repair,
    suffix_tree, tree_search, url_filter, warc,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf, "documents"), TOKENIZER)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_id(_table(spark, sf, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf, "documents"))


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf, "pages"))


def op5_warc_audit(spark: SparkSession, sf: str) -> DataFrame:
    return warc.audit_pages(_table(spark, sf, "pages"))


def op6_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


def op7_suffix_tree_score(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_tree.score_texts(_table(spark, sf, "documents"))


def op8_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return exact_search.exact_top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_vantage_tree(spark: SparkSession, sf: str) -> DataFrame:
    return tree_search.nearest(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf, "documents")).drop("kept_text")


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_nodes(_table(spark, sf, "conversations"))


def op12_role_repair(spark: SparkSession, sf: str) -> DataFrame:
    return role_repair.repair_conversations(_table(spark, sf, "conversations"))


def op13_gram_join(spark: SparkSession, sf: str) -> DataFrame:
    return gram_join.gram_groups(_table(spark, sf, "documents"))


QUERIES = {
    "op1_best_fit_packing": (op1_best_fit_packing, None),
    "op2_language_id": (op2_language_id, None),
    "op3_minhash_dedup": (op3_minhash_dedup, near_dup.SQL),
    "op4_url_filter": (op4_url_filter, None),
    "op5_warc_audit": (op5_warc_audit, warc.SQL),
    "op6_mix_sources": (op6_mix_sources, mixing.SQL),
    "op7_suffix_tree_score": (op7_suffix_tree_score, None),
    "op8_exact_top_k": (op8_exact_top_k, exact_search.SQL),
    "op9_vantage_tree": (op9_vantage_tree, None),
    "op10_substring_dedup": (op10_substring_dedup, repeats.SQL),
    "op11_prefix_trie": (op11_prefix_trie, prefix_trie.SQL),
    "op12_role_repair": (op12_role_repair, role_repair.SQL),
    "op13_gram_join": (op13_gram_join, gram_join.SQL),
}
