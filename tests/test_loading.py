import json
import os
from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows, week
from upcharts.operators import quality
from upcharts.schemas import MANIFEST
from upcharts.session import fresh_path, remove_path
from upcharts.sources import history as loads
from upcharts.sources import models, sales, snapshots, table, weeks
from upcharts.streaming.loads import load_batch, load_stream, staged_stream


def _snapshot(day, *entries):
    fields = ("rank", "title", "artist", "weeks_on_chart", "peak_pos", "last_pos")
    return {"chart_date": day, "entries": [dict(zip(fields, e)) for e in entries]}


def test_reads_pretty_printed_snapshots(spark, tmp_path):
    docs = [
        _snapshot("2026-01-03", (1, "a", "A", 1, 1, 0), (2, "b", "B", 4, 1, 3)),
        _snapshot("2026-01-10", (1, "c", "C", 1, 1, None)),
        _snapshot(None, (7, "d", "D", 1, 1, 0)),
        _snapshot("2026-01-17"),
    ]
    for i, doc in enumerate(docs):
        (tmp_path / f"chart_{i}.json").write_text(json.dumps(doc, indent=2))
    raw = snapshots.read_snapshots(spark, f"{tmp_path}/chart_*.json")
    got = snapshots.explode_entries(raw, fallback_date=date(2026, 9, 12))
    assert rows(got.select("chart_date", "rank", "title")) == [
        (date(2026, 1, 3), 1, "a"),
        (date(2026, 1, 3), 2, "b"),
        (date(2026, 1, 10), 1, "c"),
        (date(2026, 9, 12), 7, "d"),
    ]
    assert [r.chart_date for r in snapshots.empty_snapshots(raw).collect()] == [date(2026, 1, 17)]


def test_reads_metadata_array(spark, tmp_path):
    data = [
        {"artist": "A & B", "primary_artist_used": "A", "tags": ["pop"], "found": True, "mbid": "m"},
        {"artist": "C", "primary_artist_used": "C", "tags": [], "found": False, "error": "timeout"},
    ]
    path = tmp_path / "artists.json"
    path.write_text(json.dumps(data, indent=2))
    got = {r.artist: r for r in snapshots.read_artist_metadata(spark, str(path)).collect()}
    assert got["A & B"].tags == ["pop"] and got["C"].error == "timeout" and got["C"].mbid is None


def test_later_version_wins(spark):
    df = spark.createDataFrame([("A", 1, "old"), ("A", 3, "new"), ("A", 2, "mid"), ("B", 1, None)], "artist string, v int, mbid string")
    assert rows(snapshots.latest_metadata(df, "v")) == [("A", 3, "new"), ("B", 1, None)]


def test_weekly_write_replaces_whole_weeks(spark, make_history):
    path = fresh_path(spark, "t_weeks")
    h = make_history([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")])
    loads.write_weeks(h, path)
    loads.write_weeks(h.where("title = 'a'"), path)
    assert rows(loads.read_history(spark, path).select("title")) == [("a",), ("c",)]


def test_load_is_idempotent_and_needs_approval(spark, make_history):
    path = fresh_path(spark, "t_load")
    h = make_history([(0, 1, "a"), (1, 1, "b"), (2, 1, "c")])
    loads.append_history(h.where(F.col("chart_date") == week(0)), path)
    manifest = spark.createDataFrame([(week(0),)], MANIFEST)
    assert rows(loads.load_pending(h, manifest, path)) == [(week(0),)]
    assert loads.read_history(spark, path).count() == 1
    for _ in range(2):
        updated = loads.load_pending(h, manifest, path, approved=True)
    assert rows(updated) == [(week(0),), (week(1),), (week(2),)]
    assert rows(loads.read_history(spark, path).select("title")) == [("a",), ("b",), ("c",)]
    assert loads.pending_weeks(h, updated).count() == 0
    (plan,) = loads.load_plan(loads.pending_rows(h, updated), "s", "t").collect()
    assert (plan.weeks, plan.row_count, plan.first_week) == (0, 0, None)


def test_audit_has_a_total(make_history):
    audit = loads.load_audit(make_history([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")]))
    assert {tuple(r) for r in audit.collect()} == {(week(0), 1, 2), (week(1), 1, 1), (None, 2, 3)}


def test_ndjson_keeps_null_keys(spark, make_history, tmp_path):
    path = str(tmp_path / "out")
    h = make_history([(0, 1, "a", {"genre_tags": []})])
    loads.export_ndjson(h, path)
    assert '"last_pos":null' in spark.read.text(path).first()[0]
    assert rows(loads.read_ndjson(spark, path)) == rows(h)


def test_week_from_path(spark, make_history):
    path = fresh_path(spark, "t_2001-01-01")
    loads.write_weeks(make_history([(0, 1, "a"), (1, 1, "b")]), path)
    files = loads.staged_files(spark, f"{path}/load=*/*/*.parquet")
    assert rows(files.select("chart_date")) == [(week(0),), (week(1),)]


def test_schema_evolution(spark):
    old = spark.createDataFrame([(1,)], "a int")
    new = spark.createDataFrame([(2, "x")], "a int, b string")
    assert rows(loads.evolve_schema(old, new)) == [(1, None), (2, "x")]


def test_append_may_add_columns(spark, make_history):
    path = fresh_path(spark, "t_evolve")
    loads.append_history(make_history([(0, 1, "a")]), path)
    loads.append_history(make_history([(1, 1, "b")]).withColumn("label", F.lit("x")), path, allow_new=True)
    assert loads.read_history(spark, path).schema == loads.conform(make_history([])).schema
    merged = loads.read_history(spark, path, merge_schema=True)
    assert rows(merged.select("title", "label")) == [("a", None), ("b", "x")]


def test_stream_loads_each_file_once(spark, make_history):
    staged, target, state = (fresh_path(spark, n) for n in ("t_staged", "t_target", "t_state"))

    def load():
        load_stream(staged_stream(spark, staged, max_files=1), target, state).awaitTermination()
        return rows(loads.read_history(spark, target).select("title"))

    make_history([(0, 1, "a"), (1, 1, "b")]).write.json(staged)
    assert load() == [("a",), ("b",)]
    assert load() == [("a",), ("b",)]
    make_history([(2, 1, "c")]).write.mode("append").json(staged)
    assert load() == [("a",), ("b",), ("c",)]


def test_stream_and_batch_share_a_table(spark, make_history):
    staged, target, state = (fresh_path(spark, n) for n in ("m_staged", "m_target", "m_state"))
    make_history([(0, 1, "a"), (1, 1, "b")]).write.json(staged)
    load_stream(staged_stream(spark, staged), target, state).awaitTermination()
    loads.append_history(make_history([(2, 1, "c")]), target)
    loads.write_weeks(make_history([(1, 1, "b2")]), target)
    assert rows(loads.read_history(spark, target).select("title")) == [("a",), ("b2",), ("c",)]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["stage", "_stored_rows", "write_version"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("replace", [False, True])
def test_a_load_that_breaks_off_anywhere_loses_nothing(spark, make_history, monkeypatch, step, after, replace):
    target = fresh_path(spark, "i_target")
    loads.append_history(make_history([(0, 1, "a"), (2, 1, "z")]), target)
    batch = make_history([(0, 2, "b"), (1, 1, "c")])

    def load():
        if replace:
            loads.write_weeks(batch, target, load="s-0")
        else:
            load_batch(batch, target, "s-0")

    real = getattr(table, step)

    def broken(*args):
        if after:
            real(*args)
        raise Stopped

    monkeypatch.setattr(table, step, broken)
    with pytest.raises(Stopped):
        load()
    monkeypatch.setattr(table, step, real)
    early = [("b",), ("c",), ("z",)] if replace else [("a",), ("b",), ("c",), ("z",)]
    published = step == "write_version" and after
    assert rows(loads.read_history(spark, target).select("title")) == (early if published else [("a",), ("z",)])
    for _ in range(2):
        load()
    assert rows(loads.read_history(spark, target).select("title")) == early


def test_a_version_that_was_not_completed_does_not_count(spark, make_history):
    target = fresh_path(spark, "v_target")
    loads.append_history(make_history([(0, 1, "a")]), target)
    # the files of the next version are there, the mark of their end is not
    table.write_version(spark.createDataFrame([("x", "", 0, False)], table.LIVE), f"{target}/_live")
    remove_path(spark, f"{target}/_live/00000001/_SUCCESS")
    assert rows(loads.read_history(spark, target).select("title")) == [("a",)]
    loads.append_history(make_history([(1, 1, "b")]), target)
    assert rows(loads.read_history(spark, target).select("title")) == [("a",), ("b",)]


def test_an_applied_load_stays_applied_when_its_weeks_are_replaced(spark, make_history):
    target = fresh_path(spark, "r_target")
    load_batch(make_history([(0, 1, "a")]), target, "s-0")
    loads.write_weeks(make_history([(0, 1, "b")]), target)
    load_batch(make_history([(0, 1, "a")]), target, "s-0")
    assert rows(loads.read_history(spark, target).select("title")) == [("b",)]


def test_readers_see_whole_weeks_before_and_after_a_replacement(spark, make_history):
    target = fresh_path(spark, "s_target")
    loads.write_weeks(make_history([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")]), target)
    before = loads.read_history(spark, target)
    loads.write_weeks(make_history([(0, 1, "new")]), target)
    assert rows(before.select("title")) == [("a",), ("b",), ("c",)]
    assert rows(loads.read_history(spark, target).select("title")) == [("c",), ("new",)]
    assert len(table.remove_dead(spark, target)) == 1
    assert rows(loads.read_history(spark, target).select("title")) == [("c",), ("new",)]


def test_counts_of_a_load_come_from_its_write(spark, make_history):
    target = fresh_path(spark, "c_target")
    h = make_history([(0, 1, "a"), (0, 2, "b"), (1, 1, "c")])
    written = loads.append_history(h, target, load="l")
    assert (written.rows, written.first_week, written.last_week, written.weeks) == (3, week(0), week(1), 2)
    audit = loads.written_audit(spark, target, "l")
    assert {tuple(r) for r in audit.collect()} == {tuple(r) for r in loads.load_audit(h).collect()}
    assert "chart_date=" not in audit._jdf.queryExecution().executedPlan().toString()
    assert loads.append_history(h.limit(0), target, load="none").rows == 0
    assert loads.append_history(h, target, load="none") is None


def test_rows_that_break_rules_are_kept_out_with_their_reasons(spark, make_history):
    target, kept_out = fresh_path(spark, "g_target"), fresh_path(spark, "g_quarantine")
    h = make_history([(0, 1, "a"), (0, 2, "b"), (0, 2, "c"), (1, 2, None), (1, 3, "d")])
    for _ in range(2):
        loads.load_gated(h, target, kept_out, "l")
    assert rows(loads.read_history(spark, target).select("title")) == [("a",), ("d",)]
    got = table.read_quarantine(spark, kept_out).select("title", F.array_join("reasons", ";"), "load")
    twice = "chart_date, rank is not unique"
    assert rows(got) == [("b", twice, "l"), ("c", twice, "l"), (None, "title is null", "l")]


def test_manifest_is_stored_and_advances_after_the_load(spark, make_history):
    manifest, target = fresh_path(spark, "t_manifest"), fresh_path(spark, "t_recorded")
    h = make_history([(0, 1, "a"), (1, 1, "b")])
    assert loads.load_recorded(h, manifest, target).count() == 0
    for _ in range(2):
        assert rows(loads.load_recorded(h, manifest, target, approved=True)) == [(week(0),), (week(1),)]
    assert loads.read_history(spark, target).count() == 2


def test_malformed_input_fails(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"chart_date": "2026-01-03", "entries": [{"rank": 1, "title"')
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed"):
        snapshots.read_snapshots(spark, str(tmp_path / "cut.json")).collect()
    (tmp_path / "bad.json").write_text('{"chart_date": "2026-01-03", "rank": "first"}')
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)malformed"):
        loads.read_ndjson(spark, str(tmp_path / "bad.json")).collect()


def test_readers_feed_the_dedups(spark, tmp_path):
    for i, title in enumerate(["old", "new"]):
        (tmp_path / f"chart_{i}.json").write_text(json.dumps(_snapshot("2026-01-03", (1, title, "A", 1, 1, 0))))
        os.utime(tmp_path / f"chart_{i}.json", (1000 + i, 1000 + i))
    raw = snapshots.read_snapshots(spark, f"{tmp_path}/chart_*.json")
    assert [r.entries[0].title for r in snapshots.latest_snapshots(raw).collect()] == ["new"]
    data = [{"artist": "A", "tags": ["first"], "found": True}, {"artist": "A", "tags": ["second"], "found": True}]
    (tmp_path / "artists.json").write_text(json.dumps(data))
    latest = snapshots.latest_metadata(snapshots.read_artist_metadata(spark, str(tmp_path / "artists.json")), "ingested_at", "row_no")
    assert [r.tags for r in latest.collect()] == [["second"]]


def test_missing_order_keeps_the_payload(spark):
    df = spark.createDataFrame([("A", None, "x"), ("B", None, "y"), ("B", 1, "z")], "artist string, v int, mbid string")
    assert rows(snapshots.latest_metadata(df, "v")) == [("A", None, "x"), ("B", 1, "z")]


def test_calendar_steps_back_from_the_latest_week(make_history):
    h = make_history([(0, 1, "a"), (36, 1, "b")])
    calendar = weeks.week_calendar(h, date(2026, 1, 1))
    assert (calendar.count(), calendar.agg(F.min("chart_date")).first()[0]) == (37, week(0))
    assert weeks.missing_weeks(calendar, h).count() == 35
    (summary,) = weeks.backfill_summary(weeks.week_calendar(h, week(34)), h).collect()
    assert tuple(summary) == (1, week(36), week(36), 2, f"{week(34)}, {week(35)}")
    assert weeks.week_calendar(h, week(40)).count() == 0


def test_rank_blocks_number_like_one_window(spark, monkeypatch):
    monkeypatch.setattr(sales, "_RANK_BLOCK", 3)
    data = [(week(i % 2), i, (i * 7) % 4) for i in range(40)]
    volumes = spark.createDataFrame(data, "chart_date date, song_key long, volume long")
    got = {(r.chart_date, r.song_key): r["rank"] for r in sales.rank_within_week(volumes).collect()}
    for day in (week(0), week(1)):
        order = sorted((-v, k) for d, k, v in data if d == day)
        assert [got[day, k] for _, k in order] == list(range(1, len(order) + 1))


def test_models_and_quality(spark):
    ids = models.with_literal_ids(spark.createDataFrame([(1,), (5,)], "id long"), [1, None])
    assert rows(ids) == [(1,), (1,), (5,), (None,)]
    assert rows(quality.unique_violations(ids, "id")) == [(1, 2)]
    assert quality.not_null_violations(ids, "id").count() == 1
    models.materialise_table(ids, "t_ids", fresh_path(spark, "t_ids"))
    models.materialise_view(models.ref(spark, "t_ids").where("id = 1"), "t_ones")
    assert models.ref(spark, "t_ones").count() == 2
