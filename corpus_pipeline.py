"""The corpus pipeline: each stage writes its rows, and the next one reads them.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir). All stages but
the last return the columns of ``documents``; the last returns token pieces with their
sequences. Each stage works on all rows its predecessor kept.
"""

from pyspark.sql import DataFrame, SparkSession

from upcharts.llm import decontamination, exact_dedup, language_id, near_dedup, packing
from upcharts.session import fresh_path, table_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.drop_unidentified(docs, language_id.train(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, fresh_path(spark, "digest_index"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontaminate_stage),
    ("packing", packing_stage),
]

#: Similarity components and packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored and read again."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
