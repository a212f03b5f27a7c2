"""The five trend reports. Each takes chart_history and returns one result table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upcharts.functions.tags import genre_family
from upcharts.operators.cohort import (
    ARTIST_KEYS,
    FAMILY_KEYS,
    GENRE_KEYS,
    WINDOW_WEEKS,
    by_tag,
    climbs,
    debut_cohort,
    observation_window,
    stored_cohort,
    with_debut_month,
)


def _mapped(tagged: DataFrame) -> DataFrame:
    """Tag rows with their family; genres without a family drop out."""
    return tagged.withColumn("genre_family", genre_family("genre")).where(
        F.col("genre_family").isNotNull()
    )


def _climb_measures() -> list[Column]:
    climbed = F.count_if(F.col("climb") > 0)
    return [
        F.round(F.avg("climb"), 2).alias("mean_climb"),
        climbed.alias("songs_climbed"),
        F.round(climbed / F.count("*") * 100, 1).alias("pct_climbed"),
    ]


def genre_climb(history: DataFrame, min_songs: int = 8, **options) -> DataFrame:
    """How far and how often debuts climb, per genre."""
    return (
        by_tag(climbs(history, GENRE_KEYS, **options))
        .groupBy("genre")
        .agg(F.count("*").alias("n_songs"), *_climb_measures())
        .where(F.col("n_songs") >= min_songs)
        .orderBy(F.desc("pct_climbed"), "genre")
    )


def genre_family_climb(history: DataFrame, count_mode: str = "tag_rows", **options) -> DataFrame:
    """How far and how often debuts climb, per genre family.

    ``count_mode="tag_rows"`` counts a song once per matching tag;
    ``"songs"`` counts it once per family.
    """
    mapped = _mapped(by_tag(climbs(history, GENRE_KEYS, **options)))
    if count_mode == "songs":
        mapped = mapped.select("genre_family", "title", "artist", "debut_rank", "climb").distinct()
    elif count_mode != "tag_rows":
        raise ValueError(f"unknown count_mode: {count_mode}")
    return (
        mapped.groupBy("genre_family")
        .agg(
            F.count("*").alias("n_songs"),
            F.count_distinct("artist").alias("n_artists"),
            *_climb_measures(),
        )
        .orderBy(F.desc("pct_climbed"), "genre_family")
    )


def climbs_by_artist(history: DataFrame, **options) -> DataFrame:
    """Climbing tag rows per (family, primary artist, debut month)."""
    songs = with_debut_month(climbs(history, FAMILY_KEYS, **options).where(F.col("climb") > 0))
    return (
        _mapped(by_tag(songs))
        .groupBy("genre_family", "primary_artist_used", "debut_month")
        .agg(F.count("*").alias("climbs"))
    )


def top_artist_share(grouped: DataFrame) -> DataFrame:
    """Climbs of the leading artist per family; unmatched songs form one artist."""
    return (
        grouped.groupBy("genre_family", "primary_artist_used")
        .agg(F.sum("climbs").alias("artist_climbs"))
        .groupBy("genre_family")
        .agg(F.max("artist_climbs").alias("top_artist_climbs"))
    )


def recurrence_summary(history: DataFrame, **options) -> DataFrame:
    """Is a family's success broad, or carried by one act?

    All measures come from one grouping by (family, artist, month).
    """
    grouped = climbs_by_artist(history, **options)
    stats = grouped.groupBy("genre_family").agg(
        F.sum("climbs").alias("climbing_songs"),
        F.count_distinct("primary_artist_used").alias("distinct_climbing_artists"),
        F.count_distinct("debut_month").alias("distinct_months_active"),
    )
    share = F.col("top_artist_climbs") / F.col("climbing_songs")
    label = (
        F.when((F.col("distinct_climbing_artists") >= 5) & (share < 0.35), "Broad-based / recurring")
        .when(share >= 0.5, "Concentrated / one breakout act")
        .otherwise("Mixed")
    )
    return (
        stats.join(top_artist_share(grouped), "genre_family")
        .select(
            "genre_family",
            "climbing_songs",
            "distinct_climbing_artists",
            "distinct_months_active",
            F.round(share * 100, 1).alias("pct_from_top_artist"),
            label.alias("pattern_type"),
        )
        .orderBy(F.desc("climbing_songs"), "genre_family")
    )


def song_shapes(
    history: DataFrame, weeks: int = WINDOW_WEEKS, windows: DataFrame | None = None, sliced: bool = True, **cohort
) -> DataFrame:
    """Climbing songs still seen in week 5 or later: total climb and climb by week 2.

    ``windows`` are stored results of ``operators/windows.py``.
    """
    if windows is not None:
        best = {c: F.min(c).alias(c) for c in ("best", "best_early", "best_late")}
        measured = stored_cohort(windows, **cohort).groupBy(*GENRE_KEYS).agg(*best.values())
    else:
        debuts = debut_cohort(history, weeks=weeks, **cohort).select(*GENRE_KEYS, "debut_date")
        week, rank = F.col("week_number"), F.col("rank")
        observed = observation_window(debuts, history, weeks, cohort.get("cutoff"), sliced)
        measured = observed.groupBy(*GENRE_KEYS).agg(
            F.min(rank).alias("best"),
            F.min(F.when(week <= 2, rank)).alias("best_early"),
            F.min(F.when(week >= 5, rank)).alias("best_late"),
        )
    return (
        measured.where(F.col("best_early").isNotNull() & F.col("best_late").isNotNull())
        .withColumn("total_climb", F.col("debut_rank") - F.col("best"))
        .withColumn("early_climb", F.col("debut_rank") - F.col("best_early"))
        .where(F.col("total_climb") > 0)
        .select("title", "artist", "genre_tags", "total_climb", "early_climb")
    )


def trajectory_shape(history: DataFrame, min_songs: int = 5, **options) -> DataFrame:
    """Does a family climb early or steadily? Ratio of average early to average total climb."""
    early = F.avg("early_climb") / F.nullif(F.avg("total_climb"), F.lit(0.0))
    label = (
        F.when(early >= 0.7, "Flash - climbs fast, early peak")
        .when(early <= 0.4, "Slow-build - climbs steadily over time")
        .otherwise("Mixed pattern")
    )
    return (
        _mapped(by_tag(song_shapes(history, **options)))
        .groupBy("genre_family")
        .agg(
            F.count("*").alias("n_songs"),
            F.round(F.avg("total_climb"), 1).alias("avg_total_climb"),
            F.round(F.avg("early_climb"), 1).alias("avg_early_climb_wk1_2"),
            F.round(early * 100, 1).alias("pct_climb_happens_early"),
            label.alias("shape_type"),
        )
        .where(F.col("n_songs") >= min_songs)
        .orderBy(F.desc("pct_climb_happens_early"), "genre_family")
    )


def artist_recurrence(history: DataFrame, min_songs: int = 2, **options) -> DataFrame:
    """Artists whose debuts climb repeatedly, and over how many months."""
    songs = climbs(history, ARTIST_KEYS, require_tags=False, require_primary=True, **options)
    climbing = with_debut_month(songs.where(F.col("climb") > 0))
    # per month first, so that months can be counted without a distinct pass
    # over all songs of an artist
    monthly = climbing.groupBy("primary_artist_used", "debut_month").agg(
        F.count("*").alias("n"), F.sum("climb").alias("total"), F.max("climb").alias("best")
    )
    n, months = F.col("climbing_songs"), F.col("distinct_months_active")
    label = (
        F.when(n == 1, "One-time")
        .when(months >= 3, "Recurring across the year")
        .otherwise("Multiple songs, clustered timing")
    )
    return (
        monthly.groupBy("primary_artist_used")
        .agg(
            F.sum("n").alias("climbing_songs"),
            F.count("*").alias("distinct_months_active"),
            F.round(F.sum("total") / F.sum("n"), 1).alias("avg_climb"),
            F.max("best").alias("best_single_climb"),
        )
        .where(n >= min_songs)
        .withColumn("pattern_type", label)
        .orderBy(F.desc("climbing_songs"), F.desc("avg_climb"), "primary_artist_used")
    )


def artist_sketches(history: DataFrame, **options) -> DataFrame:
    """Climbing artists per family: counted, and estimated from sketches that roll up.

    A sketch of 2^16 registers is kept per (family, month); a family's estimate merges its months'
    without going back to the artists. Columns: genre_family, distinct_climbing_artists,
    estimate, relative_error.
    """
    grouped = climbs_by_artist(history, **options)
    monthly = grouped.groupBy("genre_family", "debut_month").agg(F.hll_sketch_agg("primary_artist_used", F.lit(16)).alias("sketch"))
    rolled = monthly.groupBy("genre_family").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    counted = grouped.groupBy("genre_family").agg(F.count_distinct("primary_artist_used").alias("distinct_climbing_artists"))
    exact = F.col("distinct_climbing_artists")
    error = F.when(exact > 0, F.abs(F.col("estimate") - exact) / exact).otherwise(F.col("estimate").cast("double"))
    return counted.join(rolled, "genre_family").withColumn("relative_error", error)
