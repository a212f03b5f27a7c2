"""Data-quality tests: a test returns its violations and passes when there are none."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, *columns: str) -> DataFrame:
    """Non-null values that occur more than once, with their count."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(present)
        .groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.where(F.col(column).isNull())


def not_null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Violations per column in one scan: column_name, n_records."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_records")


def with_reasons(df: DataFrame, unique: list[tuple[str, ...]] = (), required: list[str] = ()) -> DataFrame:
    """``df`` with ``reasons``: which rules each row breaks; empty for a good row.

    All rows of a repeated key break the rule, since nothing tells which of them is right.
    Keys with a null are left to ``required``.
    """
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in required]
    for number, key in enumerate(unique):
        flag = f"_repeated_{number}"
        repeated = unique_violations(df, *key).select(*key, F.lit(True).alias(flag))
        df = df.join(repeated, list(key), "left")
        broken.append(F.when(F.col(flag), F.lit(f"{', '.join(key)} is not unique")))
    rows = [c for c in df.columns if not c.startswith("_repeated_")]
    return df.select(*rows, F.array_compact(F.array(*broken)).alias("reasons"))
