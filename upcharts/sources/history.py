"""Staged weeks, the chart_history table, and its load bookkeeping."""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upcharts.operators import quality
from upcharts.schemas import CHART_HISTORY, MANIFEST
from upcharts.session import materialise
from upcharts.sources import table
from upcharts.sources.versions import read_version, write_version


def conform(df: DataFrame, keep_new: bool = False) -> DataFrame:
    """Exactly the history columns, in order and type; ``keep_new`` adds any others behind."""
    known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CHART_HISTORY.fields]
    new = [c for c in df.columns if c not in CHART_HISTORY.fieldNames()] if keep_new else []
    return df.select(*known, *new)


def read_history(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """The history table; ``merge_schema`` also shows columns that later loads added.

    A folder that was written elsewhere, without a list of loads, is read as it is.
    """
    if table.is_versioned(spark, path):
        if merge_schema:
            return conform(table.read_live(spark, path), keep_new=True)
        return conform(table.read_live(spark, path, CHART_HISTORY))
    if merge_schema:
        return conform(spark.read.option("mergeSchema", True).parquet(path), keep_new=True)
    return conform(spark.read.schema(CHART_HISTORY).parquet(path))


def write_weeks(df: DataFrame, path: str, load: str | None = None) -> table.Written | None:
    """Write each week present in ``df``, replacing those weeks only; readers see the old or the new ones whole."""
    return table.write_load(df, path, load, replace=True)


def append_history(df: DataFrame, path: str, allow_new: bool = False, load: str | None = None) -> table.Written | None:
    """Append rows with the history schema; ``allow_new`` lets them bring extra columns.

    With a ``load`` id, the rows come in once, however often they are appended.
    """
    return table.write_load(conform(df, keep_new=allow_new), path, load)


def load_gated(df: DataFrame, path: str, quarantine: str, load: str) -> table.Written | None:
    """Append the rows that keep the history's rules; the others go to ``quarantine`` with their reasons."""
    if table.is_applied(df.sparkSession, path, load):
        return None
    marked = quality.with_reasons(conform(df), unique=[("chart_date", "rank")], required=["chart_date", "rank", "title", "artist"])
    # two writes read the verdicts
    return table.write_gated(materialise(marked, "gated"), "reasons", path, quarantine, load)


def write_by_song(history: DataFrame, path: str, buckets: int) -> DataFrame:
    """Store the history bucketed and sorted by song, and read it so.

    Joins and aggregates on (title, artist) then leave its rows where they are. Take
    as many buckets as shuffle partitions would be needed for it.
    """
    spark = history.sparkSession
    name = "chart_history_" + hashlib.md5(path.encode()).hexdigest()
    rows = history.repartition(buckets, "title", "artist").write.option("compression", "zstd").bucketBy(buckets, "title", "artist")
    rows.sortBy("title", "artist", "chart_date").option("path", path).saveAsTable(name)
    return spark.table(name)


def export_ndjson(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON, gzipped, that keeps keys whose value is null."""
    df.write.option("ignoreNullFields", "false").option("compression", "gzip").json(path)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Rows of exported files; a line that does not fit the schema fails the query."""
    return spark.read.schema(CHART_HISTORY).option("mode", "FAILFAST").json(path)


def evolve_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union that lets ``new`` bring extra columns; old rows read NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def latest_week(staged: DataFrame) -> DataFrame:
    """Rows of the newest staged week."""
    newest = staged.select(F.max("chart_date")).scalar()
    return staged.where(F.col("chart_date") == newest)


def date_from_path(path_column: str) -> "F.Column":
    """Week encoded in a staged file or partition path."""
    return F.to_date(F.regexp_extract(path_column, r"(\d{4}-\d{2}-\d{2})(?!.*\d{4}-\d{2}-\d{2})", 1))


def staged_files(spark: SparkSession, glob: str) -> DataFrame:
    """Staged files with the week parsed from each path; file contents are not read."""
    files = spark.read.format("binaryFile").load(glob).select("path")
    return files.select("path", date_from_path("path").alias("chart_date"))


def _loaded_weeks(manifest: DataFrame) -> DataFrame:
    # one date per week ever loaded: small, but Spark decides about broadcasting it
    return manifest.select("chart_date").distinct()


def pending_weeks(staged: DataFrame, manifest: DataFrame) -> DataFrame:
    """Staged weeks that the manifest does not list."""
    weeks = staged.select("chart_date").distinct()
    return weeks.join(_loaded_weeks(manifest), "chart_date", "left_anti")


def pending_rows(staged: DataFrame, manifest: DataFrame) -> DataFrame:
    return staged.join(_loaded_weeks(manifest), "chart_date", "left_anti")


def update_manifest(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Manifest united with the newly loaded weeks."""
    return manifest.select("chart_date").union(loaded.select("chart_date")).distinct()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest; a table that does not exist yet lists no week."""
    return read_version(spark, path, MANIFEST)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Store the manifest, sorted, as a new version beside the earlier ones."""
    write_version(manifest.select("chart_date").distinct().orderBy("chart_date"), path)


def load_plan(pending: DataFrame, source: str, target: str) -> DataFrame:
    """One-row preview of a load: what would be written, before writing it."""
    weekly = pending.groupBy("chart_date").agg(F.count("*").alias("rows"))
    return weekly.agg(
        F.count("chart_date").alias("weeks"),
        F.min("chart_date").alias("first_week"),
        F.max("chart_date").alias("last_week"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
    ).select(
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        F.lit("append").alias("write_mode"),
        "*",
        F.lit(", ".join(pending.columns)).alias("columns"),
    )


def load_audit(loaded: DataFrame) -> DataFrame:
    """Rows per week, plus a total row (NULL week) with the week count."""
    return load_audit_of(loaded.groupBy("chart_date").agg(F.count("*").alias("rows")))


def load_audit_of(weekly: DataFrame) -> DataFrame:
    """The audit of weeks already counted (chart_date, rows)."""
    return weekly.rollup("chart_date").agg(F.count("*").alias("weeks"), F.sum("rows").alias("rows"))


def written_audit(spark: SparkSession, path: str, load: str) -> DataFrame:
    """``load_audit`` of a load, from the counts taken as it was written; no row is read again."""
    return load_audit_of(table.load_counts(spark, path, load))


def load_pending(staged: DataFrame, manifest: DataFrame, path: str, approved: bool = False) -> DataFrame:
    """Load the weeks the manifest lacks; returns the updated manifest.

    Nothing is written unless ``approved``. Whole weeks are replaced, so a load
    repeated after a crash, before its manifest was saved, adds no rows.
    """
    if not approved:
        return manifest.select("chart_date").distinct()
    # the weeks are fixed before the write, so the result does not change after it
    weeks = materialise(pending_weeks(staged, manifest), "pending_weeks")
    write_weeks(conform(staged).join(weeks, "chart_date", "left_semi"), path)
    return update_manifest(manifest, weeks)


def load_recorded(staged: DataFrame, manifest_path: str, path: str, approved: bool = False) -> DataFrame:
    """``load_pending`` with a stored manifest, which advances only after the load."""
    manifest = read_manifest(staged.sparkSession, manifest_path)
    updated = load_pending(staged, manifest, path, approved)
    if approved:
        write_manifest(updated, manifest_path)
    return read_manifest(staged.sparkSession, manifest_path)
