import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import DEBUT, in_order, rows, week
from upcharts.functions.dates import weeks_between
from upcharts.operators import cohort, trajectory
from upcharts.plans import reports


def test_window_is_inclusive(spark, make_history):
    h = make_history([(0, 80, "s", DEBUT), (8, 30, "s"), (9, 1, "s")])
    seen = cohort.observation_window(cohort.debut_cohort(h, cutoff=week(0)), h)
    assert rows(seen.select("week_number", "rank")) == [(0, 80), (8, 30)]
    assert cohort.climbs(h, cutoff=week(0)).first().climb == 50


def test_climb_is_debut_minus_best(make_history):
    h = make_history([(0, 80, "s", DEBUT), (3, 20, "s"), (8, 40, "s")])
    assert cohort.climbs(h).first().climb == 60


def test_default_cutoff_needs_a_full_window(make_history):
    h = make_history([(0, 9, "a", DEBUT), (1, 9, "b", DEBUT), (2, 9, "c", DEBUT), (9, 1, "z")])
    assert {r.title for r in cohort.debut_cohort(h).collect()} == {"a", "b"}
    assert cohort.debut_cohort(h, cutoff=week(2)).count() == 3


def test_cohort_criteria(make_history):
    h = make_history(
        [
            (0, 1, "plain", DEBUT),
            (0, 2, "bulk", {**DEBUT, "is_release_week_bulk_entry": True}),
            (0, 3, "untagged", {**DEBUT, "genre_tags": []}),
            (0, 4, "unmatched", {**DEBUT, "primary_artist_used": None}),
            (0, 5, "old"),
            (0, 6, "unknown", {"weeks_on_chart": None}),
        ]
    )

    def titles(**options):
        return {r.title for r in cohort.debut_cohort(h, cutoff=week(0), **options).collect()}

    assert titles() == {"plain", "unmatched"}
    assert titles(require_tags=False, require_primary=True) == {"plain", "untagged"}
    stored = cohort.debut_rows(h)
    assert {r.title for r in cohort.debut_cohort(h, stored, cutoff=week(0)).collect()} == titles()


def test_second_debut_merges_only_without_its_date(make_history):
    h = make_history([(0, 50, "s", DEBUT), (1, 40, "s"), (20, 50, "s", DEBUT), (21, 10, "s")])
    merged = cohort.climbs(h, cohort.GENRE_KEYS, cutoff=week(20))
    assert [r.climb for r in merged.collect()] == [40]
    apart = cohort.climbs(h, cohort.FAMILY_KEYS, cutoff=week(20))
    assert sorted(r.climb for r in apart.collect()) == [10, 40]


def test_week_number_counts_sundays(spark):
    saturday = date(2026, 1, 3)
    pairs = [(saturday, saturday + timedelta(days=d)) for d in (0, 1, 7, 8)]
    pairs.append((date(1969, 12, 27), date(1970, 1, 3)))
    df = spark.createDataFrame(pairs, "a date, b date").select(weeks_between("b", "a"))
    assert [r[0] for r in df.collect()] == [0, 1, 1, 2, 1]


@pytest.fixture(scope="module")
def messy(make_history):
    """Arbitrary weekdays, repeated rows, several debuts, one song with a third of all rows."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        title = "hot" if i % 3 == 0 else f"s{rng.randrange(40)}"
        day = date(1969, 11, 1) + timedelta(days=rng.randrange(300))
        extra = {
            "weeks_on_chart": rng.choice([1, 2, 3, None]),
            "genre_tags": rng.choice([["rock"], ["pop", "jazz"], [], ["rock", "indie rock", "folk"]]),
            "primary_artist_used": rng.choice(["P", "Q", None]),
        }
        data.append((day, rng.randrange(1, 100), title, extra))
    return make_history(data)


BRUTE_FORCE = """
    WITH d AS (
      SELECT title, artist, chart_date AS debut_date, rank AS debut_rank, primary_artist_used, genre_tags
      FROM h WHERE weeks_on_chart = 1 AND len(genre_tags) > 0
        AND chart_date <= (SELECT max(chart_date) - 56 FROM h))
    SELECT {keys}, min(h.rank) AS best_rank_8wk
    FROM d JOIN h ON d.title = h.title AND d.artist = h.artist
     AND h.chart_date BETWEEN d.debut_date AND d.debut_date + 56
    GROUP BY {keys}"""


@pytest.mark.parametrize("keys", [cohort.GENRE_KEYS, cohort.FAMILY_KEYS])
@pytest.mark.parametrize("strategy", ["join", "window"])
def test_best_rank_equals_brute_force(messy, keys, strategy):
    con = duckdb.connect()
    con.register("h", messy.toArrow())
    expected = con.execute(BRUTE_FORCE.format(keys=", ".join(f"d.{k}" for k in keys))).fetchall()
    got = cohort.best_rank(messy, keys, strategy=strategy)
    assert len(expected) > 100
    assert rows(got.select(*keys, "best_rank_8wk")) == in_order(expected)


def test_join_survives_without_broadcast(spark, messy):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = rows(cohort.best_rank(messy))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(cohort.best_rank(messy)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unknown_strategy(messy):
    with pytest.raises(ValueError):
        cohort.best_rank(messy, strategy="guess")


def test_trajectory(make_history):
    h = make_history([(0, 50, "s", DEBUT), (2, 30, "s"), (4, 30, "s"), (0, 9, "once", DEBUT)])
    weekly = trajectory.song_trajectory(h, cutoff=week(0))
    peaks = {r.title: (r.best_rank, r.weeks_to_peak) for r in trajectory.weeks_to_peak(weekly).collect()}
    assert peaks == {"s": (30, 2), "once": (9, 0)}
    slopes = trajectory.climb_slope(weekly).collect()
    assert [(r.title, r.n_weeks, r.climb_per_week) for r in slopes] == [("s", 3, 5.0)]


def test_untagged_songs_drop_out_of_tag_rows(spark):
    df = spark.createDataFrame([("a", ["x", "x"]), ("b", []), ("c", None)], "t string, genre_tags array<string>")
    assert rows(cohort.by_tag(df)) == [("a", "x"), ("a", "x")]


def test_family_counts_tag_rows_or_songs(make_history):
    h = make_history([(0, 50, "s", {**DEBUT, "genre_tags": ["rock", "indie rock", "jazz"]}), (1, 40, "s")])
    by_rows = reports.genre_family_climb(h, cutoff=week(0)).collect()
    by_songs = reports.genre_family_climb(h, count_mode="songs", cutoff=week(0)).collect()
    assert [(r.genre_family, r.n_songs) for r in by_rows] == [("Rock/Alternative", 2)]
    assert [(r.genre_family, r.n_songs) for r in by_songs] == [("Rock/Alternative", 1)]
    with pytest.raises(ValueError):
        reports.genre_family_climb(h, count_mode="albums")
