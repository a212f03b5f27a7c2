"""Week-to-week movement and how far its statistics can be trusted."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upcharts.functions.histogram import histogram_median, histogram_summary, value_histogram
from upcharts.operators.cohort import GENRE_KEYS, by_tag, climbs

MIN_SONGS = 8


def weekly_delta(history: DataFrame) -> DataFrame:
    """Places gained since last week (positive = up), where a last position exists."""
    return history.where(F.col("last_pos").isNotNull()).withColumn(
        "delta", F.col("last_pos") - F.col("rank")
    )


def snapshot_profile(history: DataFrame) -> DataFrame:
    """Rows, rows with a last position, debuts, anomalies and bulk rows per week."""
    return history.groupBy("chart_date").agg(
        F.count("*").alias("rows"),
        F.count("last_pos").alias("with_last_pos"),
        F.count_if("is_debut").alias("debuts"),
        F.count_if("is_reentry_anomaly").alias("reentry_anomalies"),
        F.count_if("is_release_week_bulk_entry").alias("bulk_rows"),
    )


def movement_baseline(history: DataFrame) -> DataFrame:
    """One row: eligible rows, mean and median delta, how many went up, flat, down."""
    return baseline_of(value_histogram(weekly_delta(history), [], "delta"))


def baseline_of(hist: DataFrame) -> DataFrame:
    """The baseline of a histogram of deltas (value, freq)."""
    median = histogram_median(hist, []).scalar()
    weighted = F.col("value").cast("decimal(19,0)") * F.col("freq").cast("decimal(19,0)")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("freq"))), F.lit(0))

    return hist.agg(
        F.coalesce(F.sum("freq"), F.lit(0)).alias("eligible"),
        F.round(F.sum(weighted).cast("double") / F.sum("freq"), 2).alias("mean_delta"),
        rows_where(F.col("value") > 0).alias("up"),
        rows_where(F.col("value") == 0).alias("flat"),
        rows_where(F.col("value") < 0).alias("down"),
    ).select("eligible", "mean_delta", median.alias("median_delta"), "up", "flat", "down")


def exclusion_overlap(history: DataFrame) -> DataFrame:
    """Bulk flag against last-position availability: is the bulk exclusion redundant?"""
    return history.groupBy(
        "is_release_week_bulk_entry", F.col("last_pos").isNotNull().alias("has_last_pos")
    ).agg(F.count("*").alias("rows"), F.count_if("is_debut").alias("debuts"))


def delta_by_tag(history: DataFrame) -> DataFrame:
    """Weekly deltas per tag, release-week floods excluded."""
    eligible = weekly_delta(history.where(~F.col("is_release_week_bulk_entry")))
    return by_tag(eligible.select("genre_tags", "delta"))


def genre_delta_naive(history: DataFrame) -> DataFrame:
    """Mean delta per genre, whatever its sample size."""
    return (
        delta_by_tag(history)
        .groupBy("genre")
        .agg(F.count("*").alias("n"), F.round(F.avg("delta"), 2).alias("mean_delta"))
    )


def robust_summary(df: DataFrame, keys: Sequence[str], value: str, min_n: int = MIN_SONGS) -> DataFrame:
    """Per key with >= ``min_n`` rows: n, mean, median, standard error, mean without the top row."""
    return robust_of(value_histogram(df, keys, value), keys, min_n)


def robust_of(hist: DataFrame, keys: Sequence[str], min_n: int = MIN_SONGS) -> DataFrame:
    """``robust_summary`` of a histogram (*keys, value, freq)."""
    return (
        histogram_summary(hist, keys)
        .where(F.col("n") >= min_n)
        .join(histogram_median(hist, keys), [*keys])
        .select(*keys, "n", "mean", "median", "se", "mean_without_top")
    )


def _rounded(summary: DataFrame, key: str) -> DataFrame:
    return summary.select(
        key,
        "n",
        F.round("mean", 2).alias("mean"),
        "median",
        F.round("se", 2).alias("se"),
        F.round("mean_without_top", 2).alias("mean_without_top"),
    )


def genre_delta_robust(history: DataFrame, min_songs: int = MIN_SONGS) -> DataFrame:
    return _rounded(robust_summary(delta_by_tag(history), ["genre"], "delta", min_songs), "genre")


def delta_histogram(history: DataFrame) -> DataFrame:
    """Weekly deltas as a histogram that merges over weeks: chart_date, genre, value, freq.

    Rows without a genre count every eligible chart row, the others the tags of rows outside
    release-week floods. One pass over the history; stored, it answers the movement
    statistics of any set of weeks.
    """
    tags = F.when(~F.col("is_release_week_bulk_entry"), F.col("genre_tags")).otherwise(F.array().cast("array<string>"))
    genres = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(tags, F.array().cast("array<string>")))
    rows = weekly_delta(history).select("chart_date", "delta", F.explode(genres).alias("genre"))
    return value_histogram(rows, ["chart_date", "genre"], "delta")


def merged_histogram(stored: DataFrame, keys: Sequence[str] = ("genre",)) -> DataFrame:
    """Histogram per genre, or of all rows where ``keys`` is empty, from those of single weeks."""
    chosen = stored.where(F.col("genre").isNotNull() if keys else F.col("genre").isNull())
    return chosen.groupBy(*keys, "value").agg(F.sum("freq").alias("freq"))


def stored_baseline(stored: DataFrame) -> DataFrame:
    return baseline_of(merged_histogram(stored, []))


def stored_delta_robust(stored: DataFrame, min_songs: int = MIN_SONGS) -> DataFrame:
    return _rounded(robust_of(merged_histogram(stored), ["genre"], min_songs), "genre")


def stored_delta_ci(stored: DataFrame, min_songs: int = MIN_SONGS) -> DataFrame:
    return confidence_interval(robust_of(merged_histogram(stored), ["genre"], min_songs))


def genre_climb_robust(history: DataFrame, min_songs: int = MIN_SONGS, **options) -> DataFrame:
    """The robust leaderboard of the observation-window climb."""
    tagged = by_tag(climbs(history, GENRE_KEYS, **options)).select("genre", "climb")
    return _rounded(robust_summary(tagged, ["genre"], "climb", min_songs), "genre")


def confidence_interval(summary: DataFrame) -> DataFrame:
    """95 % interval of the mean and whether it contains zero."""
    low = F.col("mean") - 1.96 * F.col("se")
    high = F.col("mean") + 1.96 * F.col("se")
    return summary.select(
        "genre",
        "n",
        F.round(low, 2).alias("ci_low"),
        F.round(high, 2).alias("ci_high"),
        ((low <= 0) & (high >= 0)).alias("crosses_zero"),
    )


def genre_delta_ci(history: DataFrame, min_songs: int = MIN_SONGS) -> DataFrame:
    return confidence_interval(robust_summary(delta_by_tag(history), ["genre"], "delta", min_songs))


def genre_sign_flip(history: DataFrame, min_songs: int = MIN_SONGS) -> DataFrame:
    """Does removing the single best row change the sign of the mean?"""
    flips = F.signum("mean") != F.signum("mean_without_top")
    return robust_summary(delta_by_tag(history), ["genre"], "delta", min_songs).select(
        "genre",
        "n",
        F.round("mean", 2).alias("mean"),
        F.round("mean_without_top", 2).alias("mean_without_top"),
        flips.alias("sign_flips"),
    )


def method_agreement(history: DataFrame, min_songs: int = MIN_SONGS, **options) -> DataFrame:
    """Genres ranked by three climb metrics, with the rank correlation of each pair.

    The rankings run over genres, at most one row per allowlisted genre.
    """
    tagged = by_tag(climbs(history, GENRE_KEYS, **options)).select("genre", "climb")
    hist = value_histogram(tagged, ["genre"], "climb")
    climbed = hist.groupBy("genre").agg(
        F.coalesce(F.sum(F.when(F.col("value") > 0, F.col("freq"))), F.lit(0)).alias("climbed")
    )
    metrics = (
        histogram_summary(hist, ["genre"])
        .where(F.col("n") >= min_songs)
        .join(climbed, "genre")
        .withColumn("pct_climbed", F.col("climbed") / F.col("n") * 100)
    )
    every = Window.partitionBy(F.lit(0))
    ranks = {
        "rank_by_mean": "mean",
        "rank_by_pct": "pct_climbed",
        "rank_without_top": "mean_without_top",
    }
    ranked = metrics.select(
        "genre",
        "n",
        *[F.rank().over(every.orderBy(F.desc(metric))).alias(name) for name, metric in ranks.items()],
    )

    def agreement(a: str, b: str):
        return F.round(F.corr(a, b).over(every), 4)

    return ranked.withColumns(
        {
            "corr_mean_pct": agreement("rank_by_mean", "rank_by_pct"),
            "corr_mean_without_top": agreement("rank_by_mean", "rank_without_top"),
        }
    )
