"""The chart warehouse: raw entries, artist metadata, chart_history and its debuts."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.operators.cohort import debut_rows, full_window_limit
from upcharts.operators.matching import lookup_artists
from upcharts.operators.staging import stage_history
from upcharts.session import materialise, sized_for
from upcharts.sources.sales import artist_candidates, chart_entries, line_count

ROWS_PER_BLOCK = 100_000


@dataclass(frozen=True)
class Warehouse:
    entries: DataFrame
    metadata: DataFrame
    history: DataFrame
    debuts: DataFrame
    # last debut date with a full observation window, as a literal: plans that use
    # a cohort twice can then share its shuffles, and the scan can skip later weeks
    cutoff: date


_built: dict[tuple[str, str], Warehouse] = {}


def cluster_by_week(history: DataFrame) -> DataFrame:
    """Rows of a week together and sorted, so row-group statistics prune weeks.

    Within a week a credit's rows follow each other: what they share is stored once, and
    shuffles of the rows in this order compress it as well.
    A heavy week is split by rank into blocks of bounded size. Unlike a range
    partitioning this needs no sampling pass over the rows before it, and unlike
    a folder per week no small files when weeks are small.
    """
    blocked = history.withColumn("block", F.floor(F.col("rank") / ROWS_PER_BLOCK))
    return blocked.hint("rebalance", "chart_date", "block").sortWithinPartitions("chart_date", "artist", "title").drop("block")


def build_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Derive the chart from the sales tables and load it, stage by stage.

    Each stage is a table in the shared folder, so reports start from files
    with column and week pruning instead of repeating the derivation.
    Tasks grow in number with the lines, not in rows.
    """
    with sized_for(spark, line_count(spark, sf_dir)):
        entries = materialise(chart_entries(spark, sf_dir), "entries")
        metadata = materialise(lookup_artists(entries, artist_candidates(spark, sf_dir)), "metadata")
        staged = stage_history(entries, metadata)
        history = materialise(cluster_by_week(staged), "chart_history")
        debuts = materialise(debut_rows(history), "debuts")
        (cutoff,) = history.agg(full_window_limit()).first()
    return Warehouse(entries, metadata, history, debuts, cutoff)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this application for ``sf_dir``, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build_warehouse(spark, sf_dir)
    return _built[key]
