"""Profiles of the tag vocabulary, the cohort and the corpus."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.operators.cohort import SONG, WINDOW_WEEKS, cutoff_date


def tagged_songs(entries: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct songs with the unfiltered tags of their credit: title, artist, tags."""
    return entries.select(*SONG).distinct().join(metadata.select("artist", "tags"), "artist")


def tag_profile(songs: DataFrame, rare: int = 2) -> DataFrame:
    """One row: songs, mean tags per song, distinct tags, tags on <= ``rare`` songs."""
    per_tag = (
        songs.select(*SONG, F.explode(F.array_distinct("tags")).alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("n"))
    )
    vocabulary = per_tag.agg(
        F.count("*").alias("distinct_tags"), F.count_if(F.col("n") <= rare).alias("rare_tags")
    )
    return songs.agg(
        F.count("*").alias("songs"), F.round(F.avg(F.size("tags")), 2).alias("mean_tags")
    ).select(
        "songs",
        "mean_tags",
        vocabulary.select("distinct_tags").scalar().alias("distinct_tags"),
        vocabulary.select("rare_tags").scalar().alias("rare_tags"),
    )


def tag_clusters(songs: DataFrame) -> DataFrame:
    """Tags attached to exactly the same songs: cluster (its first tag), tag, n_songs.

    Song sets are compared by fingerprints that combine on the map side, so the
    songs of a tag are never gathered. Each candidate is then checked song by
    song against its cluster's first tag, which must be among the same song's tags,
    and listed only if the sets are equal.
    """
    pairs = songs.select(*SONG, F.explode(F.array_distinct("tags")).alias("tag")).distinct()
    song = F.xxhash64(*SONG)
    prints = pairs.groupBy("tag").agg(
        F.count("*").alias("n_songs"),
        F.bit_xor(song).alias("mixed"),
        F.sum(song.cast("decimal(20,0)")).alias("summed"),
    )
    # tags of equal song sets all sit on one song, so a group is as small as a song's tags
    candidates = (
        prints.groupBy("n_songs", "mixed", "summed")
        .agg(F.min("tag").alias("cluster"), F.collect_list("tag").alias("tags"))
        .where(F.size("tags") > 1)
        .select("cluster", "n_songs", F.explode("tags").alias("tag"))
    )
    per_song = pairs.join(candidates, "tag").groupBy(*SONG).agg(
        F.collect_list(F.struct("cluster", "tag", "n_songs")).alias("found")
    )
    beside_first = F.filter("found", lambda c: F.array_contains(F.col("found.tag"), c["cluster"]))
    return (
        per_song.select(F.inline(beside_first))
        .groupBy("cluster", "tag", "n_songs")
        .agg(F.count("*").alias("shared"))
        .where(F.col("shared") == F.col("n_songs"))
        .select("cluster", "tag", "n_songs")
    )


def cohort_funnel(history: DataFrame, cutoff: date | None = None, weeks: int = WINDOW_WEEKS) -> DataFrame:
    """Distinct songs left after each cohort criterion, in order."""
    debut = F.col("weeks_on_chart").eqNullSafe(1)
    single = debut & ~F.col("is_release_week_bulk_entry")
    observed = single & (F.col("chart_date") <= cutoff_date(history, cutoff, weeks))
    tagged = observed & (F.size("genre_tags") > 0)
    steps = {"debuts": debut, "not_bulk": single, "full_window": observed, "tagged": tagged}
    per_song = history.groupBy(*SONG).agg(
        *[F.max(condition).alias(name) for name, condition in steps.items()]
    )
    return per_song.agg(
        F.count("*").alias("songs"), *[F.count_if(name).alias(name) for name in steps]
    )


def corpus_summary(history: DataFrame) -> DataFrame:
    """One row: weeks, rows, distinct songs, distinct primary artists, date range; from one scan."""
    return history.agg(
        F.count_distinct("chart_date").alias("weeks"),
        F.count("*").alias("rows"),
        F.count_distinct(F.struct(*SONG)).alias("songs"),
        F.count_distinct("primary_artist_used").alias("primary_artists"),
        F.min("chart_date").alias("first_week"),
        F.max("chart_date").alias("last_week"),
    )
