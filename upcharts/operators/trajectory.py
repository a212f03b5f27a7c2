"""Song trajectories after the debut."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.functions.tags import genre_family
from upcharts.operators.cohort import SONG, WINDOW_WEEKS, by_tag, debut_cohort, observation_window

DEBUT = [*SONG, "debut_date"]


def song_trajectory(history: DataFrame, weeks: int = WINDOW_WEEKS, **cohort) -> DataFrame:
    """Best rank per (song, debut, week since debut)."""
    debuts = debut_cohort(history, weeks=weeks, **cohort).select(*DEBUT).distinct()
    return (
        observation_window(debuts, history, weeks, cohort.get("cutoff"))
        .groupBy(*DEBUT, "week_number")
        .agg(F.min("rank").alias("rank"))
    )


def weeks_to_peak(trajectory: DataFrame) -> DataFrame:
    """Best rank and the first week it is reached, per debut."""
    return (
        trajectory.groupBy(*DEBUT)
        .agg(F.min(F.struct("rank", "week_number")).alias("peak"))
        .select(
            *DEBUT,
            F.col("peak.rank").alias("best_rank"),
            F.col("peak.week_number").alias("weeks_to_peak"),
        )
    )


def climb_slope(trajectory: DataFrame) -> DataFrame:
    """Least-squares ranks gained per week, per debut; needs two distinct weeks.

    Computed from exact integer sums, so it does not depend on merge order.
    """
    x, y = F.col("week_number").cast("long"), F.col("rank").cast("long")
    n, sx, sy, sxy, sxx = (F.col(c) for c in ("n_weeks", "sx", "sy", "sxy", "sxx"))
    return (
        trajectory.groupBy(*DEBUT)
        .agg(
            F.count("*").alias("n_weeks"),
            F.sum(x).alias("sx"),
            F.sum(y).alias("sy"),
            F.sum(x * y).alias("sxy"),
            F.sum(x * x).alias("sxx"),
        )
        .where(n * sxx != sx * sx)
        .select(*DEBUT, "n_weeks", ((sx * sy - n * sxy) / (n * sxx - sx * sx)).alias("climb_per_week"))
    )


def family_weekly_curve(history: DataFrame, weeks: int = WINDOW_WEEKS, **cohort) -> DataFrame:
    """Mean rank and tag rows per (genre family, week since debut)."""
    keys = [*DEBUT, "genre_tags"]
    debuts = debut_cohort(history, weeks=weeks, **cohort).select(*keys).distinct()
    weekly = (
        observation_window(debuts, history, weeks, cohort.get("cutoff"))
        .groupBy(*keys, "week_number")
        .agg(F.min("rank").alias("rank"))
    )
    return (
        by_tag(weekly)
        .withColumn("genre_family", genre_family("genre"))
        .where(F.col("genre_family").isNotNull())
        .groupBy("genre_family", "week_number")
        .agg(F.count("*").alias("n_rows"), F.round(F.avg("rank"), 2).alias("mean_rank"))
    )
