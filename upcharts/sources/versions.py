"""Small bookkeeping tables that are replaced as a whole, by a new version beside the old one.

A version is a folder with a number; it counts once Spark has marked it complete. A reader
takes the latest complete one, so a write that breaks off changes nothing. One writer at
a time.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from upcharts.session import list_folder, path_exists


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name) for name in list_folder(spark, folder) if name.isdigit())


def latest_version(spark: SparkSession, folder: str) -> str | None:
    """Path of the latest complete version, if there is any."""
    for number in reversed(_numbers(spark, folder)):
        path = f"{folder}/{number:08d}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            return path
    return None


def read_version(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The latest version; without one, no rows."""
    path = latest_version(spark, folder)
    return spark.createDataFrame([], schema) if path is None else spark.read.schema(schema).parquet(path)


def write_version(df: DataFrame, folder: str) -> None:
    """Store ``df``, which may come from an earlier version, as the next one."""
    numbers = _numbers(df.sparkSession, folder)
    df.coalesce(1).write.parquet(f"{folder}/{numbers[-1] + 1 if numbers else 0:08d}")
