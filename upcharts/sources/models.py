"""Derived models: literal rows, materialised tables, views, references."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def with_literal_ids(ids: DataFrame, literals: list[int | None]) -> DataFrame:
    """``ids`` (one column ``id``) followed by literal rows, duplicates kept."""
    rows = ids.sparkSession.createDataFrame(pa.table({"id": pa.array(literals, pa.int64())}))
    return ids.unionByName(rows)


def materialise_table(df: DataFrame, name: str, path: str) -> None:
    """Store a model as a table at ``path`` under a catalog name."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def materialise_view(df: DataFrame, name: str) -> None:
    """Register a model as a view: it is evaluated when it is read."""
    df.createOrReplaceTempView(name)


def ref(spark: SparkSession, name: str) -> DataFrame:
    """Another model, by name."""
    return spark.table(name)
