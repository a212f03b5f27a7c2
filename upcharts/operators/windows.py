"""Results of observation windows, stored per debut and maintained load by load.

A debut's window is closed once the history reaches its last week. A load of weeks
changes only closed debuts whose window covers one of them, so those debut weeks are measured
again from the weeks their windows span (nine for a load of the newest week) and replace
their stored rows. Reports then aggregate one row per debut and never read the history.
"""

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.operators.cohort import FAMILY_KEYS, WINDOW_WEEKS, debut_cohort, observation_window
from upcharts.sources import table

#: the weeks of a climb that count as early, and those a song must still be seen in
EARLY_UNTIL, LATE_FROM = 2, 5


def window_results(history: DataFrame, debut_weeks: list[date], weeks: int = WINDOW_WEEKS) -> DataFrame:
    """One row per debut of the given weeks: its keys, best rank, best early and best late rank."""
    last = max(debut_weeks)
    span = F.col("chart_date").between(F.lit(min(debut_weeks)), F.lit(last + timedelta(weeks=weeks)))
    rows = history.where(span)
    debuts = debut_cohort(rows, cutoff=last, require_tags=False).where(F.col("debut_date").isin(debut_weeks))
    week, rank = F.col("week_number"), F.col("rank")
    return (
        observation_window(debuts.select(*FAMILY_KEYS), rows, weeks, last)
        .groupBy(*FAMILY_KEYS)
        .agg(
            F.min(rank).alias("best"),
            F.min(F.when(week <= EARLY_UNTIL, rank)).alias("best_early"),
            F.min(F.when(week >= LATE_FROM, rank)).alias("best_late"),
        )
    )


def touched_debuts(loaded: Iterable[date], stored: Iterable[date], weeks: int = WINDOW_WEEKS) -> list[date]:
    """Of the ``stored`` weeks, those with closed windows that cover a ``loaded`` week."""
    stored, loaded, span = sorted(stored), sorted(loaded), timedelta(weeks=weeks)
    closed = [d for d in stored if d + span <= stored[-1]]
    return [d for d in closed if any(d <= w <= d + span for w in loaded)]


def maintain_windows(history: DataFrame, path: str, loaded: Iterable[date], stored: Iterable[date], weeks: int = WINDOW_WEEKS) -> list[date]:
    """Bring the results at ``path`` up to date after a load; the debut weeks measured again.

    ``stored`` are all weeks the history holds, ``loaded`` those that came or changed.
    """
    debut_weeks = touched_debuts(loaded, stored, weeks)
    if debut_weeks:
        results = window_results(history, debut_weeks, weeks).withColumn("chart_date", F.col("debut_date"))
        # weeks whose debuts are all gone are hidden as well
        table.write_load(results, path, replace=True, hide=debut_weeks)
    return debut_weeks


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    return table.read_live(spark, path).drop("chart_date")
