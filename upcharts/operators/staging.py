"""Cleaning: debut flags, bulk releases, genre filtering, the staging join."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upcharts.dims import GENRE_ALLOWLIST, override_frame
from upcharts.functions.credits import primary_artist
from upcharts.functions.tags import allowed_tags, no_tags
from upcharts.session import materialise
from upcharts.sources.history import conform

BULK_THRESHOLD = 5
# a credit is heavy above one row in HEAVY_SHARE; its rows are dealt over SALTS keys
HEAVY_SHARE, SALTS = 200, 64


def flag_debuts(entries: DataFrame) -> DataFrame:
    """Add is_debut and is_reentry_anomaly; blank last_pos where it means nothing.

    A missing weeks_on_chart is not a debut, a missing last_pos no anomaly.
    """
    debut = F.col("weeks_on_chart").eqNullSafe(1)
    reentry = F.col("last_pos").eqNullSafe(0) & ~debut
    return entries.withColumns(
        {
            "is_debut": debut,
            "is_reentry_anomaly": reentry,
            "last_pos": F.when(~debut & ~reentry, F.col("last_pos")),
        }
    )


def flag_bulk_entries(entries: DataFrame, threshold: int = BULK_THRESHOLD) -> DataFrame:
    """Flag all rows of a credit in a week where it has >= ``threshold`` debuts.

    Counting first and joining back keeps a credit that fills much of a week out
    of a single window task: the count combines on the map side, and AQE splits
    the probe side of the join. The bulk weeks are stored, so that Spark knows how few they
    are before it plans the join and need not shuffle the entries for it.
    """
    bulk = materialise(_bulk_weeks(entries, threshold), "bulk_weeks")
    return (
        entries.join(bulk, ["chart_date", "artist"], "left")
        .withColumn("is_release_week_bulk_entry", F.coalesce("bulk", F.lit(False)))
        .drop("bulk")
    )


def _bulk_weeks(entries: DataFrame, threshold: int) -> DataFrame:
    return (
        entries.where("is_debut")
        .groupBy("chart_date", "artist")
        .agg(F.count("*").alias("debuts"))
        .where(F.col("debuts") >= threshold)
        .select("chart_date", "artist", F.lit(True).alias("bulk"))
    )


def with_primary_artist(credits: DataFrame) -> DataFrame:
    return credits.withColumn("primary_artist", primary_artist("artist"))


def filter_genres(metadata: DataFrame, allowlist: Sequence[str] = GENRE_ALLOWLIST) -> DataFrame:
    """Add genre_tags (allowlisted) and dropped_tags (how many were not)."""
    return metadata.withColumn("genre_tags", allowed_tags("tags", allowlist)).withColumn(
        "dropped_tags", F.size("tags") - F.size("genre_tags")
    )


def resolve_metadata(
    metadata: DataFrame,
    allowlist: Sequence[str] = GENRE_ALLOWLIST,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Per credit: the values staging attaches to a chart row.

    Only a found credit has a primary artist, an id and tags. An overridden
    primary artist takes the override's tags and skips the allowlist.
    Columns: artist, primary_artist_used, mbid, genre_tags, dropped_tags, overridden.
    """
    if overrides is None:
        overrides = override_frame(metadata.sparkSession)
    found = F.coalesce("found", F.lit(False))
    matched = metadata.select(
        "artist",
        F.when(found, F.coalesce("primary_artist_used", "artist")).alias("primary_artist_used"),
        F.when(found, F.col("mbid")).alias("mbid"),
        F.when(found, F.coalesce("tags", no_tags())).otherwise(no_tags()).alias("tags"),
    )
    overridden = F.col("override_tags").isNotNull()
    return (
        filter_genres(matched, allowlist)
        .join(overrides, "primary_artist_used", "left")
        .select(
            "artist",
            "primary_artist_used",
            "mbid",
            F.coalesce("override_tags", "genre_tags").alias("genre_tags"),
            F.when(overridden, 0).otherwise(F.col("dropped_tags")).alias("dropped_tags"),
            overridden.alias("overridden"),
        )
    )


def heavy_credits(entries: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """Credits with more than one row in ``share`` of all; so there are fewer than ``share`` of them."""
    counts = materialise(entries.groupBy("artist").agg(F.count("*").alias("n")), "credit_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where((F.col("n") > total // share) & F.col("artist").isNotNull()).select("artist")


def join_per_credit(entries: DataFrame, resolved: DataFrame, share: int = HEAVY_SHARE, salts: int = SALTS) -> DataFrame:
    """``entries`` with the columns of their credit in ``resolved`` (left join).

    Rows of a heavy credit are dealt over ``salts`` keys, and its one row of ``resolved``
    is repeated for these only; all others keep one key.
    """
    heavy = F.broadcast(heavy_credits(entries, share).withColumn("heavy", F.lit(True)))
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("chart_date", "rank", "title"), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    rows = entries.join(heavy, "artist", "left").withColumn("salt", salt).drop("heavy")
    sides = resolved.join(heavy, "artist", "left").withColumn("salt", F.explode(copies)).drop("heavy")
    return rows.join(sides, ["artist", "salt"], "left").drop("salt")


def stage_history(
    entries: DataFrame,
    metadata: DataFrame,
    allowlist: Sequence[str] = GENRE_ALLOWLIST,
    overrides: DataFrame | None = None,
    bulk_threshold: int = BULK_THRESHOLD,
) -> DataFrame:
    """Chart entries cleaned and joined to artist metadata (one row per credit).

    Tags are resolved once per credit, before the join to the chart rows.
    """
    resolved = resolve_metadata(metadata, allowlist, overrides).drop("dropped_tags", "overridden")
    flagged = flag_bulk_entries(flag_debuts(entries), bulk_threshold)
    staged = join_per_credit(flagged, resolved).withColumn(
        "genre_tags", F.coalesce("genre_tags", no_tags())
    )
    return conform(staged)


def staging_summary(
    entries: DataFrame,
    metadata: DataFrame,
    allowlist: Sequence[str] = GENRE_ALLOWLIST,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Weeks staged, first and last, tags dropped and rows overridden (per chart row).

    The entries are scanned once, down to one row per credit and week.
    """
    resolved = resolve_metadata(metadata, allowlist, overrides).select("artist", "dropped_tags", "overridden")
    grain = entries.groupBy("artist", "chart_date").agg(F.count("*").alias("chart_rows"))
    return grain.join(resolved, "artist", "left").agg(
        F.count_distinct("chart_date").alias("weeks_staged"),
        F.min("chart_date").alias("first_week"),
        F.max("chart_date").alias("last_week"),
        F.coalesce(F.sum(F.col("chart_rows") * F.col("dropped_tags")), F.lit(0)).alias("dropped_tags"),
        F.coalesce(F.sum(F.when(F.col("overridden"), F.col("chart_rows"))), F.lit(0)).alias("overridden_rows"),
    )
