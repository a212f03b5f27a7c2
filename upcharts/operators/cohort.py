"""Debut cohorts, their observation window and how far each debut climbs.

Hot keys: a cohort has fewer than the bulk threshold of debuts per (credit,
week), because bulk weeks are excluded, so a chart row matches a bounded number
of debuts. The join key carries a time slice, which spreads a song with very
many rows over its slices; the aggregation after it re-shuffles anyway, so AQE
is free to split a slice that is still too large.
"""

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.functions.dates import month_start, weeks_between

WINDOW_WEEKS = 8

SONG = ["title", "artist"]
# songs whose debuts have equal rank and tags count once per song
GENRE_KEYS = [*SONG, "debut_rank", "genre_tags"]
# debuts are kept apart by date
FAMILY_KEYS = [*SONG, "primary_artist_used", "debut_date", "debut_rank", "genre_tags"]
ARTIST_KEYS = [*SONG, "primary_artist_used", "debut_date", "debut_rank"]


def full_window_limit(weeks: int = WINDOW_WEEKS) -> Column:
    """Aggregate: latest debut date that still has the whole window in the data."""
    return F.date_sub(F.max("chart_date"), 7 * weeks)


def cutoff_date(history: DataFrame, cutoff: date | None = None, weeks: int = WINDOW_WEEKS) -> Column:
    """``cutoff``, or the full-window limit of ``history`` as a scalar subquery."""
    return history.select(full_window_limit(weeks)).scalar() if cutoff is None else F.lit(cutoff)


def in_cohort(
    history: DataFrame,
    cutoff: date | None = None,
    weeks: int = WINDOW_WEEKS,
    require_tags: bool = True,
    require_primary: bool = False,
) -> Column:
    """Condition for a chart row to be a cohort debut.

    ``cutoff`` defaults to the last debut date with a full window.
    """
    condition = (
        (F.col("weeks_on_chart") == 1)
        & ~F.col("is_release_week_bulk_entry")
        & (F.col("chart_date") <= cutoff_date(history, cutoff, weeks))
    )
    if require_tags:
        condition &= F.size("genre_tags") > 0
    if require_primary:
        condition &= F.col("primary_artist_used").isNotNull()
    return condition


def debut_rows(history: DataFrame) -> DataFrame:
    """Chart rows any cohort may draw from: debuts outside bulk releases.

    Worth storing next to the history: reports then read one row per song for
    the cohort, and Catalyst knows its size when it picks the join.
    """
    return history.where((F.col("weeks_on_chart") == 1) & ~F.col("is_release_week_bulk_entry"))


def debut_cohort(history: DataFrame, debuts: DataFrame | None = None, **cohort) -> DataFrame:
    """Cohort debuts: song, primary artist, debut date and rank, tags.

    ``debuts`` is the stored result of ``debut_rows(history)``, if there is one.
    """
    rows = history if debuts is None else debuts
    return rows.where(in_cohort(history, **cohort)).select(
        *SONG,
        "primary_artist_used",
        F.col("chart_date").alias("debut_date"),
        F.col("rank").alias("debut_rank"),
        "genre_tags",
    )


def observation_window(
    debuts: DataFrame, history: DataFrame, weeks: int = WINDOW_WEEKS, cutoff: date | None = None, sliced: bool = True
) -> DataFrame:
    """Debuts with every position from the debut week to ``weeks`` later, inclusive.

    Time is cut into slices one window long, so a window touches at most two of
    them: each debut is looked up in two slices, each chart row stays in one. If no
    debut is later than ``cutoff``, chart rows after its window are never read.
    Without slices the join is on the song alone, which a history bucketed by song
    meets without a shuffle.
    """
    days = 7 * weeks
    if cutoff is not None:
        history = history.where(F.col("chart_date") <= F.lit(cutoff + timedelta(days=days)))

    def time_slice(d: Column) -> Column:
        return F.floor(F.unix_date(d) / (days + 1))

    debut, last = F.col("debut_date"), F.date_add("debut_date", days)
    if not sliced:
        inside = F.col("chart_date").between(debut, last)
        joined = debuts.join(history.select(*SONG, "chart_date", "rank"), SONG).where(inside)
        return joined.withColumn("week_number", weeks_between("chart_date", "debut_date"))
    slices = F.array_distinct(F.array(time_slice(debut), time_slice(last)))
    positions = history.select(
        *SONG, "chart_date", "rank", time_slice(F.col("chart_date")).alias("time_slice")
    )
    return (
        debuts.withColumn("time_slice", F.explode(slices))
        .join(positions, [*SONG, "time_slice"])
        .where(F.col("chart_date").between(debut, last))
        .drop("time_slice")
        .withColumn("week_number", weeks_between("chart_date", "debut_date"))
    )


def stored_cohort(
    windows: DataFrame, cutoff: date | None = None, require_tags: bool = True, require_primary: bool = False
) -> DataFrame:
    """The cohort's rows of stored window results, which hold debuts outside bulk releases only."""
    if cutoff is not None:
        windows = windows.where(F.col("debut_date") <= F.lit(cutoff))
    if require_tags:
        windows = windows.where(F.size("genre_tags") > 0)
    return windows.where(F.col("primary_artist_used").isNotNull()) if require_primary else windows


def best_rank(
    history: DataFrame,
    keys: Sequence[str] = tuple(GENRE_KEYS),
    weeks: int = WINDOW_WEEKS,
    strategy: str = "join",
    debuts: DataFrame | None = None,
    windows: DataFrame | None = None,
    sliced: bool = True,
    **cohort,
) -> DataFrame:
    """``*keys, best_rank_8wk``: best rank of each cohort debut inside its window.

    ``strategy="join"`` joins debuts to positions: one shuffle of the history,
    none when the debuts turn out small enough to broadcast. ``"window"`` takes
    a running minimum per song without a join; rows are first reduced to one per
    (song, week, debut), in the same one shuffle by song. ``windows`` are stored results
    of ``windows.py``; the history is not read then. Results are equal.
    """
    if windows is not None:
        return stored_cohort(windows, **cohort).groupBy(*keys).agg(F.min("best").alias("best_rank_8wk"))
    if strategy == "join":
        chosen = debut_cohort(history, debuts, weeks=weeks, **cohort).select(
            *dict.fromkeys([*keys, "debut_date"])
        )
        observed = observation_window(chosen, history, weeks, cohort.get("cutoff"), sliced)
        return observed.groupBy(*keys).agg(F.min("rank").alias("best_rank_8wk"))
    if strategy != "window":
        raise ValueError(f"unknown strategy: {strategy}")

    debut_fields = {
        "primary_artist_used": F.col("primary_artist_used"),
        "debut_date": F.col("chart_date"),
        "debut_rank": F.col("rank"),
        "genre_tags": F.col("genre_tags"),
    }
    wanted = [k for k in keys if k in debut_fields]
    debut = F.struct(*[debut_fields[k].alias(k) for k in wanted])
    rows = (
        history.select(
            *SONG,
            "chart_date",
            "rank",
            F.when(in_cohort(history, weeks=weeks, **cohort), debut).alias("debut"),
        )
        .repartition(*SONG)
        .groupBy(*SONG, "chart_date", "debut")
        .agg(F.min("rank").alias("rank"))
    )
    ahead = Window.partitionBy(*SONG).orderBy(F.unix_date("chart_date")).rangeBetween(0, 7 * weeks)
    return (
        rows.withColumn("best", F.min("rank").over(ahead))
        .where(F.col("debut").isNotNull())
        .select(*SONG, *[F.col(f"debut.{k}").alias(k) for k in wanted], "best")
        .groupBy(*keys)
        .agg(F.min("best").alias("best_rank_8wk"))
    )


def climbs(history: DataFrame, keys: Sequence[str] = tuple(GENRE_KEYS), **options) -> DataFrame:
    """``best_rank`` plus ``climb`` = debut rank - best rank (>= 0)."""
    return best_rank(history, keys, **options).withColumn(
        "climb", F.col("debut_rank") - F.col("best_rank_8wk")
    )


def by_tag(songs: DataFrame) -> DataFrame:
    """One row per song and tag (``genre``); songs without tags drop out."""
    return songs.withColumn("genre", F.explode("genre_tags")).drop("genre_tags")


def climb_by_tag(history: DataFrame, **options) -> DataFrame:
    return by_tag(climbs(history, GENRE_KEYS, **options))


def with_debut_month(songs: DataFrame) -> DataFrame:
    return songs.withColumn("debut_month", month_start("debut_date"))
