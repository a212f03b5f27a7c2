"""Named queries over the sales tables: name -> (spark, sf_dir) -> DataFrame."""

import uuid
from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.functions.dates import month_start, plus_weeks, weeks_between
from upcharts.functions.tags import genre_family
from upcharts.operators import cohort, matching, movement, profile, quality, staging, trajectory
from upcharts.plans import adhoc, reports
from upcharts.plans.maintained import maintained
from upcharts.plans.warehouse import warehouse
from upcharts.schemas import ARTIST_METADATA
from upcharts.session import fresh_path, materialise, table_path
from upcharts.sources import history as loads
from upcharts.sources import models, sales, snapshots, table, weeks
from upcharts.streaming.loads import load_stream, staged_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# weeks before this date count as loaded already
LOADED_BEFORE = date(1998, 1, 1)
# before the first chart, so that the calendar has weeks the history lacks
CALENDAR_START = date(1990, 1, 1)
# rows of a history bucketed by song that a task sorts
ROWS_PER_BUCKET = 500_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def on_history(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    """Register an operator that takes chart_history alone."""
    QUERIES[name] = lambda spark, sf_dir: operator(warehouse(spark, sf_dir).history)


def on_debuts(name: str, operator: Callable[..., DataFrame]) -> None:
    """Register an operator that takes chart_history, its stored debuts and the cutoff."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = warehouse(spark, sf_dir)
        return operator(base.history, debuts=base.debuts, cutoff=base.cutoff)

    QUERIES[name] = run


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in arrays})


def _manifest(history: DataFrame) -> DataFrame:
    return history.select("chart_date").where(F.col("chart_date") < LOADED_BEFORE).distinct()


# --- sources, sinks, loading ---------------------------------------------------


@query
def explode_entries(spark, sf_dir):
    pages = sales.snapshot_pages(warehouse(spark, sf_dir).entries)
    return snapshots.explode_entries(pages, fallback_date=LOADED_BEFORE)


@query
def metadata_dedup(spark, sf_dir):
    latest = snapshots.latest_metadata(sales.metadata_versions(spark, sf_dir), "version")
    return _joined(latest.drop("error"), "tags")


@query
def snapshot_dedup(spark, sf_dir):
    pages = sales.refetched_pages(warehouse(spark, sf_dir).entries)
    latest = snapshots.latest_snapshots(pages, keys=("chart_date", "page"))
    ranks = F.aggregate("entries", F.lit(0).cast("long"), lambda total, e: total + e["rank"])
    return latest.select(
        "chart_date",
        "page",
        "ingested_at",
        F.size("entries").alias("n_entries"),
        ranks.alias("rank_total"),
    )


@query
def date_fallback(spark, sf_dir):
    """Documents without a date, here every other page, get the fallback date."""
    pages = sales.snapshot_pages(warehouse(spark, sf_dir).entries)
    undated = pages.withColumn("chart_date", F.when(F.col("page") % 2 == 0, F.col("chart_date")))
    return snapshots.explode_entries(undated, fallback_date=LOADED_BEFORE)


@query
def read_snapshots(spark, sf_dir):
    """Pages fetched twice and stored as JSON files; the later files win."""
    # two writes read the pages
    pages = materialise(sales.snapshot_pages(warehouse(spark, sf_dir).entries), "pages")
    stale = F.transform("entries", lambda e: e.withField("title", F.lit("to be announced")))
    path = fresh_path(spark, "snapshot_files")
    for fetched in (pages.withColumn("entries", stale), pages):
        fetched.drop("page").write.mode("append").option("compression", "gzip").json(path)
    stored = snapshots.read_snapshots(spark, path, multi_line=False).withColumn("page", F.col("entries")[0]["rank"])
    return snapshots.explode_entries(snapshots.latest_snapshots(stored, keys=("chart_date", "page")))


@query
def read_metadata(spark, sf_dir):
    """Metadata stored twice, first as lookups that all failed; the later file's rows win."""
    metadata = warehouse(spark, sf_dir).metadata
    failed = metadata.withColumns({"found": F.lit(False), "error": F.lit("lookup timed out"), "tags": F.lit(None)})
    path = fresh_path(spark, "metadata_files")
    for stored in (failed, metadata):
        stored.select(ARTIST_METADATA.fieldNames()).write.mode("append").json(path)
    latest = snapshots.latest_metadata(snapshots.read_artist_metadata(spark, path, multi_line=False), "ingested_at")
    return _joined(latest.drop("ingested_at", "row_no"), "tags")


@query
def metadata_row_order(spark, sf_dir):
    """Versions of a credit in one file, written in order: the later row wins."""
    versions = sales.metadata_versions(spark, sf_dir)
    path = fresh_path(spark, "metadata_in_order")
    ordered = versions.repartition("artist").sortWithinPartitions("artist", "version")
    ordered.select(ARTIST_METADATA.fieldNames()).write.json(path)
    stored = snapshots.read_artist_metadata(spark, path, multi_line=False)
    # files of one write may differ in time, but a credit has one file
    latest = snapshots.latest_metadata(stored, "row_no")
    return _joined(latest.drop("ingested_at", "row_no", "error"), "tags")


@query
def staged_files(spark, sf_dir):
    """Weeks told from the paths of staged files."""
    path = fresh_path(spark, "staged_paths")
    loads.write_weeks(warehouse(spark, sf_dir).history, path)
    return loads.staged_files(spark, f"{path}/load=*/*/*.parquet").select("chart_date").distinct()


@query
def write_staged_roundtrip(spark, sf_dir):
    history = warehouse(spark, sf_dir).history
    path = fresh_path(spark, "staged")
    loads.write_weeks(history, path)
    # writing some weeks again replaces them and leaves the others alone
    loads.write_weeks(history.where(F.col("chart_date") < LOADED_BEFORE), path)
    return _joined(loads.read_history(spark, path), "genre_tags")


@query
def ndjson_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "ndjson")
    loads.export_ndjson(warehouse(spark, sf_dir).history, path)
    return _joined(loads.read_ndjson(spark, path), "genre_tags")


@query
def append_history(spark, sf_dir):
    history = warehouse(spark, sf_dir).history
    path = fresh_path(spark, "appended")
    loads.append_history(history.where(F.col("chart_date") < LOADED_BEFORE), path)
    loads.load_pending(history, _manifest(history), path, approved=True)
    return _joined(loads.read_history(spark, path), "genre_tags")


@query
def schema_evolution(spark, sf_dir):
    rows = warehouse(spark, sf_dir).history.select("chart_date", "rank", "title", "last_pos")
    new = rows.where(F.col("chart_date") >= LOADED_BEFORE).withColumn(
        "delta", F.col("last_pos") - F.col("rank")
    )
    return loads.evolve_schema(rows.where(F.col("chart_date") < LOADED_BEFORE), new)


@query
def stored_evolution(spark, sf_dir):
    """A later load brings a column to the stored table; rows loaded before read NULL there."""
    history = warehouse(spark, sf_dir).history
    path = fresh_path(spark, "evolved")
    early = F.col("chart_date") < LOADED_BEFORE
    loads.append_history(history.where(early), path)
    loads.append_history(
        history.where(~early).withColumn("delta", F.col("last_pos") - F.col("rank")), path, allow_new=True
    )
    return _joined(loads.read_history(spark, path, merge_schema=True), "genre_tags")


on_history("latest_snapshot", lambda h: _joined(loads.latest_week(h), "genre_tags"))
on_history("pending_weeks", lambda h: loads.pending_weeks(h, _manifest(h)))
on_history(
    "load_plan",
    lambda h: loads.load_plan(loads.pending_rows(h, _manifest(h)), "staged", "chart_history"),
)
on_history("load_audit", lambda h: loads.load_audit(loads.pending_rows(h, _manifest(h))))
on_history(
    "manifest_update",
    lambda h: loads.update_manifest(_manifest(h), loads.pending_weeks(h, _manifest(h))),
)


@query
def manifest_roundtrip(spark, sf_dir):
    history = warehouse(spark, sf_dir).history
    path, manifest = fresh_path(spark, "recorded"), fresh_path(spark, "manifest")
    # an early load, then all that is left, then nothing
    loads.load_recorded(history.where(F.col("chart_date") < LOADED_BEFORE), manifest, path, approved=True)
    for _ in range(2):
        loads.load_recorded(history, manifest, path, approved=True)
    return loads.read_manifest(spark, manifest)


@query
def stream_then_append(spark, sf_dir):
    """Early weeks stream in, later ones are appended, and one is replaced; no row is lost."""
    history = warehouse(spark, sf_dir).history
    staged, target, checkpoint = (fresh_path(spark, n) for n in ("mixed_staged", "mixed_history", "mixed_state"))
    early = F.col("chart_date") < LOADED_BEFORE
    # the stored history holds a week's rows together, and the load gathers them once more
    loads.export_ndjson(history.where(early), staged)
    load_stream(staged_stream(spark, staged), target, checkpoint).awaitTermination()
    loads.append_history(history.where(~early), target)
    loads.write_weeks(loads.latest_week(history), target)
    return _joined(loads.read_history(spark, target), "genre_tags")


@query
def stream_load(spark, sf_dir):
    staged = fresh_path(spark, "stream_staged")
    target, checkpoint = fresh_path(spark, "stream_history"), fresh_path(spark, "stream_state")
    loads.export_ndjson(warehouse(spark, sf_dir).history, staged)
    # the second run finds nothing new
    for _ in range(2):
        load_stream(staged_stream(spark, staged), target, checkpoint).awaitTermination()
    return _joined(loads.read_history(spark, target), "genre_tags")


@query
def load_audit_written(spark, sf_dir):
    """The audit of a load, from the counts taken while it was written."""
    history = warehouse(spark, sf_dir).history
    path = fresh_path(spark, "audited")
    loads.append_history(loads.pending_rows(history, _manifest(history)), path, load="audited")
    return loads.written_audit(spark, path, "audited")


@query
def week_replacement(spark, sf_dir):
    """A reader that began before weeks were replaced and one after it: both see whole weeks."""
    history = warehouse(spark, sf_dir).history
    path = fresh_path(spark, "replaced")
    loads.write_weeks(history, path)
    before = loads.read_history(spark, path)
    early = history.where(F.col("chart_date") < LOADED_BEFORE)
    loads.write_weeks(early.withColumn("rank", F.col("rank") + 1000), path)
    counts = [F.count("*").alias("rows"), F.sum("rank").alias("ranks")]
    seen = [df.groupBy("chart_date").agg(*counts).withColumn("reader", F.lit(name)) for name, df in (("before", before), ("after", loads.read_history(spark, path)))]
    return seen[0].union(seen[1])


def _with_faults(history: DataFrame) -> DataFrame:
    """History rows of which some stand twice at a rank and some lack a title."""
    again = history.where(F.col("rank") % 50 == 7).withColumn("title", F.concat("title", F.lit(" (again)")))
    title = F.when(F.col("rank") % 73 != 5, F.col("title"))
    return history.withColumn("title", title).union(again)


def _gated(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    path, kept_out = fresh_path(spark, "gated_history"), fresh_path(spark, "quarantine")
    # the second try of the load changes nothing
    for _ in range(2):
        loads.load_gated(_with_faults(warehouse(spark, sf_dir).history), path, kept_out, "gated")
    return path, kept_out


@query
def gated_load(spark, sf_dir):
    return _joined(loads.read_history(spark, _gated(spark, sf_dir)[0]), "genre_tags")


@query
def quarantine(spark, sf_dir):
    rows = table.read_quarantine(spark, _gated(spark, sf_dir)[1])
    return rows.select("load", "chart_date", "rank", "title", "artist", F.array_join("reasons", "; ").alias("reasons"))


on_history("dq_unique_faulty_history", lambda h: quality.unique_violations(_with_faults(h), "chart_date", "rank"))


# --- models --------------------------------------------------------------------


def _model_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(table_path(sf_dir, "supplier"))
    return models.with_literal_ids(suppliers.select(F.col("s_suppkey").alias("id")), [1, None])


@query
def literal_union(spark, sf_dir):
    return _model_ids(spark, sf_dir)


@query
def model_table(spark, sf_dir):
    # a name of its own, so that runs side by side do not replace each other's table
    name = f"upcharts_model_ids_{uuid.uuid4().hex[:12]}"
    models.materialise_table(_model_ids(spark, sf_dir), name, fresh_path(spark, "model_ids"))
    return models.ref(spark, name)


@query
def model_view(spark, sf_dir):
    models.materialise_view(_model_ids(spark, sf_dir), "all_ids")
    return models.ref(spark, "all_ids").where("id = 1")


# --- calendar and completeness -------------------------------------------------


on_history("week_calendar", lambda h: weeks.week_calendar(h, CALENDAR_START))
on_history("missing_weeks", lambda h: weeks.missing_weeks(weeks.week_calendar(h, CALENDAR_START), h))
on_history("backfill_summary", lambda h: weeks.backfill_summary(weeks.week_calendar(h, CALENDAR_START), h))


@query
def empty_snapshots(spark, sf_dir):
    pages = sales.fetched_pages(warehouse(spark, sf_dir).entries)
    return snapshots.empty_snapshots(pages).select("chart_date", "page")


# --- cleaning and staging --------------------------------------------------------


@query
def debut_flags(spark, sf_dir):
    return staging.flag_debuts(warehouse(spark, sf_dir).entries).select(
        "chart_date", "rank", "weeks_on_chart", "last_pos", "is_debut", "is_reentry_anomaly"
    )


@query
def bulk_entry_flag(spark, sf_dir):
    flagged = staging.flag_bulk_entries(staging.flag_debuts(warehouse(spark, sf_dir).entries))
    return flagged.select("chart_date", "rank", "artist", "is_release_week_bulk_entry")


@query
def primary_artist(spark, sf_dir):
    credits = matching.unique_credits(warehouse(spark, sf_dir).entries)
    return staging.with_primary_artist(credits)


@query
def genre_allowlist(spark, sf_dir):
    versions = sales.metadata_versions(spark, sf_dir)
    return _joined(
        staging.filter_genres(versions).select("version", "artist", "genre_tags", "dropped_tags"),
        "genre_tags",
    )


@query
def genre_override(spark, sf_dir):
    resolved = staging.resolve_metadata(warehouse(spark, sf_dir).metadata)
    return _joined(resolved, "genre_tags")


@query
def stage_history(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    return _joined(staging.stage_history(base.entries, base.metadata), "genre_tags")


@query
def staging_summary(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    return staging.staging_summary(base.entries, base.metadata)


# --- entity resolution -------------------------------------------------------------


def _credit_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).metadata.select("artist", "primary_artist_used")


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    primaries = _credit_map(spark, sf_dir).select("primary_artist_used").distinct()
    return matching.match_artists(primaries, sales.artist_candidates(spark, sf_dir))


@query
def unique_credits(spark, sf_dir):
    return matching.unique_credits(warehouse(spark, sf_dir).entries)


@query
def credit_map(spark, sf_dir):
    return matching.credit_map(matching.unique_credits(warehouse(spark, sf_dir).entries))


@query
def artist_match(spark, sf_dir):
    return _joined(_matched(spark, sf_dir), "tags")


@query
def name_scores(spark, sf_dir):
    """Credits against the acts of the whole catalogue, scored by their names."""
    names = matching.unique_credits(warehouse(spark, sf_dir).entries).select(F.col("artist").alias("name"))
    acts = sales.act_catalogue(spark, sf_dir).select(F.col("artist").alias("candidate")).distinct()
    return matching.name_scores(names, acts, threshold=60)


@query
def artist_match_scored(spark, sf_dir):
    """Credits resolved by computed scores instead of given ones."""
    credits = matching.unique_credits(warehouse(spark, sf_dir).entries).select(F.col("artist").alias("primary_artist_used"))
    acts = sales.act_catalogue(spark, sf_dir).withColumnRenamed("artist", "candidate")
    answers = matching.scored_candidates(credits.select(F.col("primary_artist_used").alias("name")), acts, best_only=True)
    return matching.match_artists(credits, answers).select("primary_artist_used", "status", "score", "mbid", "found")


@query
def match_status(spark, sf_dir):
    return matching.match_status(_matched(spark, sf_dir))


@query
def match_fanout(spark, sf_dir):
    results = _matched(spark, sf_dir)
    return _joined(matching.fan_out(_credit_map(spark, sf_dir), results), "tags")


@query
def match_summary(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    return matching.match_summary(base.entries, base.metadata)


# --- cohorts and climbs --------------------------------------------------------------


def _observed(history: DataFrame, **chosen) -> DataFrame:
    return cohort.observation_window(cohort.debut_cohort(history, **chosen), history, cutoff=chosen.get("cutoff"))


on_debuts("debut_cohort", lambda h, **c: _joined(cohort.debut_cohort(h, **c), "genre_tags"))
on_debuts(
    "artist_debut_cohort",
    lambda h, **c: cohort.debut_cohort(
        h, **c, require_tags=False, require_primary=True
    ).drop("genre_tags"),
)
on_debuts("observation_window", lambda h, **c: _observed(h, **c).drop("genre_tags"))
on_debuts("best_rank_8wk", lambda h, **c: _joined(cohort.best_rank(h, **c), "genre_tags"))
on_history("best_rank_window", lambda h: _joined(cohort.best_rank(h, strategy="window"), "genre_tags"))
on_debuts("climb_by_tag", cohort.climb_by_tag)
on_debuts(
    "genre_family_map",
    lambda h, **c: cohort.climb_by_tag(h, **c).select(
        "title", "artist", "genre", genre_family("genre").alias("genre_family")
    ),
)
on_debuts(
    "top_artist_share",
    lambda h, **c: reports.top_artist_share(reports.climbs_by_artist(h, **c)),
)
on_debuts(
    "week_number",
    lambda h, **c: _observed(h, **c).select(
        "title",
        "artist",
        "debut_date",
        "chart_date",
        weeks_between("chart_date", "debut_date").alias("week_number"),
        # the day after a chart Saturday already belongs to the next week
        weeks_between(F.date_add("chart_date", 1), "debut_date").alias("week_number_next_day"),
    ),
)
on_debuts(
    "debut_month",
    lambda h, **c: cohort.debut_cohort(h, **c).select(
        "title",
        "artist",
        "debut_date",
        month_start("debut_date").alias("debut_month"),
        plus_weeks("debut_date", cohort.WINDOW_WEEKS).alias("window_end"),
    ),
)

# --- reports ---------------------------------------------------------------------


on_debuts("genre_climb", reports.genre_climb)
on_debuts("genre_family_climb", reports.genre_family_climb)
on_debuts("genre_family_climb_songs", partial(reports.genre_family_climb, count_mode="songs"))
on_debuts("recurrence_summary", reports.recurrence_summary)
on_debuts("trajectory_shape", reports.trajectory_shape)
on_debuts("artist_recurrence", reports.artist_recurrence)
on_debuts("artist_recurrence_all", partial(reports.artist_recurrence, min_songs=1))

# --- movement, robustness, profiles ------------------------------------------------


on_history(
    "weekly_delta",
    lambda h: movement.weekly_delta(h).select("chart_date", "rank", "last_pos", "delta"),
)
on_history("snapshot_profile", movement.snapshot_profile)
on_history("movement_baseline", movement.movement_baseline)
on_history("exclusion_overlap", movement.exclusion_overlap)
on_history("genre_delta_naive", movement.genre_delta_naive)
on_history("genre_delta_robust", movement.genre_delta_robust)
on_history("genre_delta_ci", movement.genre_delta_ci)
on_history("genre_sign_flip", movement.genre_sign_flip)
on_debuts("genre_climb_robust", movement.genre_climb_robust)
on_debuts("method_agreement", movement.method_agreement)
on_history("cohort_funnel", profile.cohort_funnel)
on_history("corpus_summary", profile.corpus_summary)


def _tagged_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = warehouse(spark, sf_dir)
    return profile.tagged_songs(base.entries, base.metadata)


@query
def tag_profile(spark, sf_dir):
    return profile.tag_profile(_tagged_songs(spark, sf_dir))


@query
def tag_clusters(spark, sf_dir):
    return profile.tag_clusters(_tagged_songs(spark, sf_dir))


# --- the same results from tables that are kept up to date ---------------------------


def on_windows(name: str, report: Callable[..., DataFrame]) -> None:
    """Register a report that reads stored window results instead of the history."""
    QUERIES[f"{name}_maintained"] = lambda spark, sf_dir: report(None, windows=maintained(spark, sf_dir).window_results(spark))


for _name in ("genre_climb", "genre_family_climb", "recurrence_summary", "trajectory_shape", "artist_recurrence"):
    on_windows(_name, getattr(reports, _name))


@query
def movement_baseline_maintained(spark, sf_dir):
    return movement.stored_baseline(maintained(spark, sf_dir).delta_histograms(spark))


@query
def genre_delta_robust_maintained(spark, sf_dir):
    return movement.stored_delta_robust(maintained(spark, sf_dir).delta_histograms(spark))


@query
def genre_delta_ci_maintained(spark, sf_dir):
    return movement.stored_delta_ci(maintained(spark, sf_dir).delta_histograms(spark))


def _by_song(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = warehouse(spark, sf_dir).history
    # a task sorts a bucket, which should fit its memory; the count comes from the footers
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-history.count() // ROWS_PER_BUCKET))
    return loads.write_by_song(history, fresh_path(spark, "history_by_song"), buckets)


def on_buckets(name: str, report: Callable[..., DataFrame]) -> None:
    """Register a report over a history bucketed by song, whose rows are not shuffled."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = warehouse(spark, sf_dir)
        return report(_by_song(spark, sf_dir), debuts=base.debuts, cutoff=base.cutoff, sliced=False)

    QUERIES[f"{name}_bucketed"] = run


on_buckets("genre_climb", reports.genre_climb)
on_buckets("recurrence_summary", reports.recurrence_summary)
on_buckets("trajectory_shape", reports.trajectory_shape)


def _sketched(history: DataFrame, **options) -> DataFrame:
    """The estimates differ from engine to engine; that they hold is the same everywhere."""
    counted = reports.artist_sketches(history, **options)
    return counted.select("genre_family", "distinct_climbing_artists", (F.col("relative_error") < 0.02).alias("within_two_percent"))


on_debuts("artist_sketches", _sketched)


# --- trajectories ------------------------------------------------------------------


on_debuts("song_trajectory", trajectory.song_trajectory)
on_debuts(
    "weeks_to_peak",
    lambda h, **c: trajectory.weeks_to_peak(trajectory.song_trajectory(h, **c)),
)
on_debuts(
    "climb_slope",
    lambda h, **c: trajectory.climb_slope(
        trajectory.song_trajectory(h, **c)
    ).withColumn("climb_per_week", F.round("climb_per_week", 4)),
)
on_debuts("genre_weekly_curve", trajectory.family_weekly_curve)

# --- data quality and ad-hoc SQL -----------------------------------------------------


@query
def dq_unique(spark, sf_dir):
    return quality.unique_violations(_model_ids(spark, sf_dir), "id")


on_history("dq_unique_history", lambda h: quality.unique_violations(h, "chart_date", "rank"))


@query
def dq_not_null(spark, sf_dir):
    return quality.not_null_violations(_model_ids(spark, sf_dir), "id")


on_history(
    "dq_not_null_history",
    lambda h: quality.not_null_counts(h, "title", "artist", "genre_tags", "primary_artist_used", "last_pos"),
)


@query
def adhoc_select(spark, sf_dir):
    warehouse(spark, sf_dir).history.createOrReplaceTempView("chart_history")
    return adhoc.select_rows(
        spark,
        """
        WITH weekly AS (
          SELECT chart_date, count(*) AS n, count_if(is_debut) AS debuts FROM chart_history GROUP BY chart_date
        )
        SELECT chart_date, n, debuts FROM weekly ORDER BY n DESC, chart_date -- busiest weeks
        """,
    )


@query
def adhoc_outcomes(spark, sf_dir):
    """How the ad-hoc surface answers good, empty, wrong and forbidden statements on the history."""
    warehouse(spark, sf_dir).history.createOrReplaceTempView("chart_history")
    statements = {
        "all rows": "  SELECT * FROM chart_history;",
        "lower case": "select chart_date, count(*) from chart_history group by chart_date",
        "with": "WITH h AS (SELECT rank FROM chart_history) SELECT max(rank) FROM h",
        "no rows": "SELECT * FROM chart_history WHERE rank < 0",
        "no such column": "SELECT position FROM chart_history",
        "a command": "DROP VIEW chart_history",
        "two statements": "SELECT 1 FROM chart_history; DROP VIEW chart_history",
        "a file": f"SELECT * FROM parquet.`{table_path(sf_dir, 'part')}`",
        "a call": "SELECT reflect('java.lang.System', 'nanoTime') FROM chart_history",
    }
    found = [(name, adhoc.run_query(spark, text).status) for name, text in statements.items()]
    return spark.createDataFrame(found, "statement string, status string")
