"""Calendar of expected weeks and completeness of the history."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def week_calendar(history: DataFrame, start: date) -> DataFrame:
    """Weekly dates stepping back from the latest chart date while >= ``start``.

    ``start`` need not fall on the weekly grid.
    """
    first = F.lit(start)
    return (
        history.agg(F.max("chart_date").alias("latest"))
        .where(F.col("latest") >= first)
        .select(F.explode(F.sequence("latest", first, F.expr("INTERVAL -7 DAYS"))).alias("chart_date"))
    )


def missing_weeks(calendar: DataFrame, history: DataFrame) -> DataFrame:
    """Expected weeks the history has no row for."""
    return calendar.join(history.select("chart_date").distinct(), "chart_date", "left_anti")


def backfill_summary(calendar: DataFrame, history: DataFrame) -> DataFrame:
    """One row: weeks saved, oldest, newest, weeks missing and their dates."""
    saved = history.select("chart_date").distinct().withColumn("saved", F.lit(True))
    # one value per calendar week, so the list is bounded by the calendar
    missed = F.when(F.col("saved").isNull(), F.date_format("chart_date", "yyyy-MM-dd"))
    return calendar.join(saved, "chart_date", "left").agg(
        F.count("saved").alias("weeks_saved"),
        F.min(F.when(F.col("saved"), F.col("chart_date"))).alias("oldest"),
        F.max(F.when(F.col("saved"), F.col("chart_date"))).alias("newest"),
        F.count(missed).alias("weeks_failed"),
        F.array_join(F.array_sort(F.collect_list(missed)), ", ").alias("failed"),
    )
