"""Each operator as a query over the driver's tables, with production parameters and over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import language, suffix_tree, toxicity
from wattline.llm.common import remainder
from wattline.llm.conversations import conversation_table, damaged
from wattline.llm.edit_counts import edited_counts, redactions
from wattline.llm.hash_index import exact_duplicates
from wattline.llm.line_dedup import deduplicated_lines
from wattline.llm.mixing import mix
from wattline.llm.ngram_join import link_components
from wattline.llm.oracles import ORACLES
from wattline.llm.packing import pack
from wattline.llm.quality import compression_bands
from wattline.llm.spelling import spelling_variants
from wattline.llm.token_files import token_table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_tree.suffix_tree_scores(documents(spark, sf), remainder(F.col("doc_id"), 5) == 1)


def op2_grouped_prefix_join(spark: SparkSession, sf: str) -> DataFrame:
    return link_components(documents(spark, sf), k=3, percent=90)


def op3_entropy_balancing(spark: SparkSession, sf: str) -> DataFrame:
    return mix(documents(spark, sf))


def op4_compression_bands(spark: SparkSession, sf: str) -> DataFrame:
    return compression_bands(documents(spark, sf))


def op5_extendible_hash(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf))


def op6_edited_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document before and after personal data are replaced by placeholders."""
    return edited_counts(documents(spark, sf), redactions)


def op7_winnowed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicated_lines(documents(spark, sf))


def op8_kneser_ney(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    held = remainder(F.col("doc_id"), 4) == 2
    model = language.fit(docs.where(~held), "doc_id", "text", "lang")
    return language.predict(docs, model, held_out=held)


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_table(documents(spark, sf))


def op10_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(documents(spark, sf))


def op11_trie_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(documents(spark, sf))


def op12_compression_distance(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = documents(spark, sf), remainder(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~held)
    return toxicity.scores(docs, model, held)


def op13_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation after the damage that its checksums ask for, and its repair."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    return conversation_table(damaged(turns), every=turns)


QUERIES = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_grouped_prefix_join": op2_grouped_prefix_join,
    "op3_entropy_balancing": op3_entropy_balancing,
    "op4_compression_bands": op4_compression_bands,
    "op5_extendible_hash": op5_extendible_hash,
    "op6_edited_counts": op6_edited_counts,
    "op7_winnowed_lines": op7_winnowed_lines,
    "op8_kneser_ney": op8_kneser_ney,
    "op9_token_files": op9_token_files,
    "op10_mixture_packing": op10_mixture_packing,
    "op11_trie_pairs": op11_trie_pairs,
    "op12_compression_distance": op12_compression_distance,
    "op13_structure_repair": op13_structure_repair,
    "pipeline": corpus_pipeline.run,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
