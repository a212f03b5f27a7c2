"""The physical plans the scale argument rests on."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from upcharts.operators import cohort, profile
from upcharts.plans import reports
from upcharts.plans.warehouse import warehouse
from upcharts.registry import QUERIES
from upcharts.session import list_folder
from upcharts.sources import history as loads


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


# these write files, so their plan is a plain read
SINKS = {
    "read_snapshots",
    "read_metadata",
    "staged_files",
    "stored_evolution",
    "write_staged_roundtrip",
    "ndjson_roundtrip",
    "append_history",
    "stream_load",
    "stream_then_append",
    "manifest_roundtrip",
    "model_table",
    "load_audit_written",
    "metadata_row_order",
    "week_replacement",
    "gated_load",
    "quarantine",
}


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned when no side is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SINKS))
def test_no_cross_product(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    text = plan(reports.artist_recurrence(base.history, debuts=base.debuts, cutoff=base.cutoff))
    assert "LessThanOrEqual(chart_date" in text
    assert "peak_pos" not in text and "mbid" not in text and "genre_tags" not in text


@pytest.mark.parametrize("report", ["recurrence_summary", "genre_climb_robust", "method_agreement"])
def test_observation_join_runs_once(spark, sf_dir, report):
    text = final_plan(QUERIES[report](spark, sf_dir))
    assert text.count("Join [title") == 1


@pytest.mark.parametrize("report", ["recurrence_summary", "genre_climb_robust", "method_agreement"])
def test_observation_join_runs_once_without_broadcasts(spark, sf_dir, no_broadcast, report):
    assert final_plan(QUERIES[report](spark, sf_dir)).count("Join [title") == 1


def test_history_scan_is_bounded_by_the_cutoff(spark, sf_dir, no_broadcast):
    base = warehouse(spark, sf_dir)
    text = plan(cohort.best_rank(base.history, debuts=base.debuts, cutoff=date(1995, 1, 7)))
    assert "LessThanOrEqual(chart_date,1995-03-04)" in text


def test_tag_clusters_join_once(spark, sf_dir, no_broadcast):
    base = warehouse(spark, sf_dir)
    songs = base.entries.select("title", "artist").distinct().withColumn("tags", F.array("title", "artist"))
    assert plan(profile.tag_clusters(songs)).count("SortMergeJoin") == 1


def test_songs_debut_again_and_some_fields_are_missing(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    debuts = base.debuts.groupBy("title", "artist").agg(F.count("*").alias("n"))
    assert debuts.where("n > 1").count() > 0
    assert base.entries.where("weeks_on_chart IS NULL").count() > 0
    assert base.entries.where("last_pos IS NULL").count() > 0


def test_join_key_is_sliced_by_time(spark, sf_dir):
    base = warehouse(spark, sf_dir)
    text = plan(cohort.best_rank(base.history, debuts=base.debuts, cutoff=base.cutoff))
    assert "time_slice" in text


@pytest.mark.parametrize("name", ["ndjson_roundtrip", "stream_load", "stream_then_append"])
def test_exports_write_the_history_as_it_lies(spark, sf_dir, monkeypatch, name):
    """Its files hold whole weeks already, so the export needs no shuffle; the files are gzipped."""
    exported, plain = [], loads.export_ndjson

    def export(df, path):
        exported.append(path)
        assert "Exchange" not in plan(df)
        plain(df, path)

    monkeypatch.setattr(loads, "export_ndjson", export)
    QUERIES[name](spark, sf_dir)
    (path,) = exported
    files = [f for f in list_folder(spark, path) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
