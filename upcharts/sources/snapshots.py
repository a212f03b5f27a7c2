"""Raw inputs: weekly snapshot documents and artist metadata."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from upcharts.schemas import ARTIST_METADATA, SNAPSHOT


def read_snapshots(spark: SparkSession, glob: str, multi_line: bool = True) -> DataFrame:
    """One row per snapshot document, with ``ingested_at`` and ``row_no`` (see ``_read``).

    ``multi_line=False`` reads one document per line, which Spark can split.
    """
    return _read(spark, SNAPSHOT, glob, multi_line)


def read_artist_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per element of the metadata array, with ``ingested_at`` and ``row_no``."""
    return _read(spark, ARTIST_METADATA, path, multi_line)


def _read(spark: SparkSession, schema: StructType, path: str, multi_line: bool) -> DataFrame:
    """JSON files, with the file's time as ``ingested_at`` and a number that grows within a file.

    A record that does not fit the schema fails the query; nothing is skipped.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    return reader.json(path).select(
        "*",
        F.col("_metadata.file_modification_time").alias("ingested_at"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def latest_metadata(metadata: DataFrame, *order: str) -> DataFrame:
    """One row per credit; the row with the highest ``order`` wins."""
    return _latest(metadata, ["artist"], order)


def latest_snapshots(snapshots: DataFrame, keys: tuple[str, ...] = ("chart_date",), order: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """One document per key; a re-fetch replaces the earlier document."""
    return _latest(snapshots, list(keys), order)


def _latest(df: DataFrame, keys: list[str], order: Sequence[str]) -> DataFrame:
    # max_by combines on the map side, so a key with many versions is never
    # gathered and sorted in one task as row_number would. The order is a struct:
    # rows without an order value come first but keep their payload, and equal
    # order values are decided by content.
    payload = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, F.xxhash64(*payload).alias("content"))
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*payload), rank).alias("latest"))
        .select(*keys, *[F.col(f"latest.{c}").alias(c) for c in payload])
        .select(*df.columns)
    )


def explode_entries(snapshots: DataFrame, fallback_date: date | None = None) -> DataFrame:
    """One row per chart entry, the snapshot's date repeated.

    A missing date falls back to ``fallback_date``, or today's date.
    """
    today = F.current_date() if fallback_date is None else F.lit(fallback_date)
    return snapshots.select(
        F.coalesce("chart_date", today).alias("chart_date"), F.inline("entries")
    )


def empty_snapshots(snapshots: DataFrame) -> DataFrame:
    """Documents without entries: failed fetches, never loaded."""
    return snapshots.where((F.size("entries") == 0) | F.col("entries").isNull())
