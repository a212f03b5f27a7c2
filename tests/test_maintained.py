"""Tables kept up to date load by load, and histories bucketed by song, equal the plain reports."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import DEBUT, rows, week
from tests.test_plans import final_plan, plan
from upcharts.operators import matching, movement, staging
from upcharts.operators.windows import touched_debuts
from upcharts.plans import reports
from upcharts.plans.maintained import new_tables
from upcharts.session import fresh_path
from upcharts.sources import history as loads
from upcharts.sources import table

REPORTS = {
    "genre": (reports.genre_climb, {"min_songs": 1}),
    "family": (reports.genre_family_climb, {}),
    "recurrence": (reports.recurrence_summary, {}),
    "shape": (reports.trajectory_shape, {"min_songs": 1}),
    "artist": (reports.artist_recurrence, {"min_songs": 1}),
}


def chart(first: int, last: int) -> list:
    """Songs that debut each week, climb in their own ways, leave, and partly debut again."""
    out = []
    for n in range(first, last):
        for song in range(8):
            born = n - (song * 3) % 11
            title = f"s{born}-{song}"
            age = n - born
            if born < 0:
                continue
            artist = f"A{(born * 5 + song) % 7}"
            rank = max(1, 60 + song - age * ((born + song) % 9))
            tags = [["rock"], ["pop", "soul"], [], ["country"]][(born + song) % 4]
            over = {"artist": artist, "primary_artist_used": artist if song % 5 else None, "genre_tags": tags, "last_pos": rank + song % 3 if age else None}
            if age == 0:
                over |= DEBUT
            out.append((n, rank, title, over))
            # earlier weeks' songs stay on the chart, so windows hold several positions
            for back in range(1, 7):
                old = f"s{n - back}-{(song * 2) % 8}"
                if n - back >= 0 and song % 2 == 0:
                    a = f"A{((n - back) * 5 + (song * 2) % 8) % 7}"
                    out.append((n, 90 + song - back * (song + 2), old, {"artist": a, "primary_artist_used": a, "genre_tags": ["rock"]}))
    return out


def same(got, expected) -> None:
    assert rows(got) == rows(expected)


def test_twenty_loads_equal_the_full_reports(spark, make_history):
    tables, seen = new_tables(spark), []
    for n in range(20):
        data = chart(n, n + 1)
        seen += data
        measured = tables.load(make_history(data))
        # the debut week that the new week closes, and no other
        assert measured == ([week(n - 8)] if n >= 8 else [])
        if n in (8, 13, 19):
            history = make_history(seen)
            for report, options in REPORTS.values():
                same(report(None, windows=tables.window_results(spark), **options), report(history, **options))
            stored = tables.delta_histograms(spark)
            same(movement.stored_baseline(stored), movement.movement_baseline(history))
            same(movement.stored_delta_robust(stored, 2), movement.genre_delta_robust(history, 2))


def test_a_replaced_week_changes_the_debuts_that_see_it(spark, make_history):
    tables, data = new_tables(spark), chart(0, 14)
    tables.load(make_history(data))
    changed = [(n, 1 if title.startswith("s4") else rank, title, over) for n, rank, title, over in chart(6, 7)]
    loads.write_weeks(make_history(changed), tables.history)
    assert tables.refresh(spark, [week(6)]) == [week(n) for n in range(6)]
    history = make_history([r for r in data if r[0] != 6] + changed)
    for report, options in REPORTS.values():
        same(report(None, windows=tables.window_results(spark), **options), report(history, **options))


def test_a_load_reads_nine_weeks(spark, make_history, monkeypatch):
    from upcharts.operators import windows

    tables = new_tables(spark)
    tables.load(make_history(chart(0, 11)))
    plans = []
    real = windows.window_results
    monkeypatch.setattr(windows, "window_results", lambda *a: plans.append(plan(real(*a))) or real(*a))
    tables.load(make_history(chart(11, 12)))
    # every scan of the history is cut to the weeks of the closing window by their folders
    scans = [line for text in plans for line in text.splitlines() if "PartitionFilters" in line]
    cut = [re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", s).group(1) for s in scans]
    debuts, positions = re.compile(rf"chart_date#\d+ = {week(3)}"), re.compile(rf"chart_date#\d+ >= {week(3)}.*chart_date#\d+ <= {week(11)}")
    assert cut and all(debuts.search(c) or positions.search(c) for c in cut)


def test_touched_debuts():
    weeks = [date(2026, 1, 3) + timedelta(weeks=n) for n in range(20)]
    assert touched_debuts([weeks[19]], weeks) == [weeks[11]]
    assert touched_debuts([weeks[2]], weeks) == weeks[:3]
    assert touched_debuts(weeks, weeks) == weeks[:12]
    assert touched_debuts([weeks[3]], weeks[:5]) == []


@pytest.fixture
def without(spark):
    """Joins as they are planned when no side is small."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark.conf
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_bucketed_history_is_not_shuffled(spark, make_history, without):
    history = make_history(chart(0, 14))
    by_song = loads.write_by_song(history, fresh_path(spark, "t_by_song"), 4)
    debuts = fresh_path(spark, "t_debuts")
    history.where((F.col("weeks_on_chart") == 1)).write.parquet(debuts)
    for report, options in REPORTS.values():
        got = report(by_song, debuts=spark.read.parquet(debuts), cutoff=week(5), sliced=False, **options)
        same(got, report(history, cutoff=week(5), **options))
        text = plan(report(by_song, debuts=spark.read.parquet(debuts), cutoff=week(5), sliced=False, **options))
        join = next(i for i, line in enumerate(text.splitlines()) if "SortMergeJoin [title" in line)
        below = text.splitlines()[join:]
        history_scan = next(i for i, line in enumerate(below) if "Bucketed: true" in line)
        # from the join down to the bucketed scan: sorts and filters, but no exchange after the other side's scan
        other_scan = next(i for i, line in enumerate(below) if "FileScan" in line)
        side = below[other_scan + 1 : history_scan] if other_scan < history_scan else below[1:history_scan]
        assert not any(re.search(r"\bExchange\b", line) for line in side)


def test_a_heavy_credit_is_dealt_over_tasks(spark, without):
    n = 30_000
    rows_ = spark.range(n).select(
        F.lit(week(0)).alias("chart_date"), F.col("id").cast("int").alias("rank"), F.col("id").cast("string").alias("title"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 4000)).alias("artist"),
    )
    resolved = rows_.select("artist").distinct().where("artist != 'a7'").withColumn("mbid", F.concat(F.lit("m-"), "artist"))
    without.set("spark.sql.adaptive.enabled", "false")
    before = without.get("spark.sql.shuffle.partitions")
    without.set("spark.sql.shuffle.partitions", "24")
    try:
        joined = staging.join_per_credit(rows_, resolved)
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 24 and sizes[-1] < 3 * sizes[len(sizes) // 2]
        assert joined.count() == n and set(joined.columns) == {"artist", "chart_date", "rank", "title", "mbid"}
        plain = rows_.join(resolved, "artist", "left")
        assert joined.select("title", "mbid").exceptAll(plain.select("title", "mbid")).count() == 0
    finally:
        without.set("spark.sql.adaptive.enabled", "true")
        without.set("spark.sql.shuffle.partitions", before)


def test_name_scores(spark):
    def grams(x):
        x = f"  {x.strip().lower()}  "
        return {x[i : i + 3] for i in range(len(x) - 2)}

    names = ["The Beatles", "beatles", "The  Beatles ", "Beetles", "Queen", "Queens", "Quen", "A", "", "é", "Tame Impala", "Tame Impalas"]
    catalogue = ["The Beatles", "Queen", "Queen + Adam", "Tame Impala", "a", "É"]
    got = matching.name_scores(spark.createDataFrame([(n,) for n in [*names, None]], "name string"), spark.createDataFrame([(c,) for c in catalogue], "candidate string"), 50)
    expected = set()
    for n in names:
        for c in catalogue:
            a, b = grams(n), grams(c)
            if 200 * len(a & b) // (len(a) + len(b)) >= 50:
                expected.add((n, c, 200 * len(a & b) // (len(a) + len(b))))
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 8


def test_sketches_roll_up(make_history):
    data = [r for i in range(40) for r in [(i % 3, 50, f"t{i}", {"artist": f"A{i % 25}", "primary_artist_used": f"A{i % 25}", "genre_tags": ["rock"], **DEBUT}), (i % 3 + 1, 40, f"t{i}", {"artist": f"A{i % 25}", "primary_artist_used": f"A{i % 25}", "genre_tags": ["rock"]})]]
    (row,) = reports.artist_sketches(make_history(data), cutoff=week(2)).collect()
    assert (row.distinct_climbing_artists, row.estimate) == (25, 25) and row.relative_error < 0.02


def test_median_of_wide_values(spark):
    from upcharts.functions.histogram import histogram_median

    values = [(-(1 << 40), 3), (-5, 1), (7, 1), (1 << 21, 2), ((1 << 21) + 1, 1), (1 << 50, 4)]
    hist = spark.createDataFrame(values, "value long, freq long")
    flat = sorted(v for v, f in values for _ in range(f))
    middle = (flat[(len(flat) - 1) // 2] + flat[len(flat) // 2]) / 2
    assert histogram_median(hist, []).first()[0] == middle


def test_dead_folders_of_kept_tables(spark, make_history):
    tables = new_tables(spark)
    tables.load(make_history(chart(0, 10)))
    tables.refresh(spark, [week(3)])
    assert table.remove_dead(spark, tables.deltas) and tables.delta_histograms(spark).count() > 0
