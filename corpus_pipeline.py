"""A pipeline from raw documents to packed token sequences. Each stage reads what the one before it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import stored
from wattline.llm.line_dedup import line_stage
from wattline.llm.mixing import mixed_copies
from wattline.llm.ngram_join import one_of_each
from wattline.llm.packing import pack
from wattline.llm.quality import quality_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the compression bands; the others go."""
    return quality_stage(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; documents of which nothing is left go."""
    left = line_stage(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similar sets of five-word shingles link."""
    return one_of_each(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram jaccard join", near_duplicates), ("mixing to target weights", mixture), ("packing", packing)]

#: Compression, fitted rates and tokens are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
