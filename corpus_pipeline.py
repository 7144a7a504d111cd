"""From raw documents to packed sequences: the stages of a training-data pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns and reads it again for the next one. All stages but the last keep the columns.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import line_dedup, ngram_join, packing, quality, secret_scan
from clickflow.llm.common import read_table, ship, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    ship(spark)
    return quality.quality_filter(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines, their length counted anew.

    Exact copies count as one page: the stage for near duplicates, which comes later, keeps one of them.
    """
    cleaned = line_dedup.line_dedup(docs, copies_once=True)
    chars = F.when(F.col("__removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    ship(spark)
    return ngram_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret masked, their length counted anew."""
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_join", near_duplicates),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

# Tokenizing and packing are beyond SQL; a test holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
