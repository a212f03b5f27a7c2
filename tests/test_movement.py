import math
import random
import statistics

import pytest

from tests.conftest import rows, week
from upcharts.functions.histogram import histogram_median, histogram_summary, value_histogram
from upcharts.operators import movement, profile


def test_histogram_statistics_are_exact(spark):
    rng = random.Random(3)
    data = {
        "one": [5],
        "two": [-3, 4],
        "wide": [rng.randrange(-50_000, 50_000) for _ in range(501)],
        "even": [rng.randrange(-5000, 5000) for _ in range(400)],
        # one value holds most rows
        "hot": [7] * 700 + [rng.randrange(100) for _ in range(99)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v int")
    hist = value_histogram(df, ["k"], "v")
    medians = {r.k: r["median"] for r in histogram_median(hist, ["k"]).collect()}
    assert medians == {k: statistics.median(vs) for k, vs in data.items()}
    for r in histogram_summary(hist, ["k"]).collect():
        vs = data[r.k]
        assert (r.n, r.mean) == (len(vs), sum(vs) / len(vs))
        if len(vs) == 1:
            assert r.se is None and r.mean_without_top is None
        else:
            assert math.isclose(r.se, statistics.stdev(vs) / math.sqrt(len(vs)), rel_tol=1e-12)
            assert r.mean_without_top == (sum(vs) - max(vs)) / (len(vs) - 1)


@pytest.fixture(scope="module")
def chart(make_history):
    def moved(rank, last, tags, **extra):
        return (0, rank, f"t{rank}", {"last_pos": last, "genre_tags": tags, **extra})

    return make_history(
        [
            moved(1, 11, ["pop"]),
            moved(2, 1, ["pop"]),
            moved(3, 2, ["pop", "jazz"]),
            moved(4, 4, ["jazz"]),
            moved(5, None, ["pop"]),
            moved(6, 60, ["pop"], is_release_week_bulk_entry=True),
        ]
    )


def test_baseline(chart):
    assert rows(movement.movement_baseline(chart)) == [(5, 12.4, 0.0, 2, 1, 2)]


def test_leaderboards_exclude_bulk_rows(chart):
    naive = {r.genre: (r.n, r.mean_delta) for r in movement.genre_delta_naive(chart).collect()}
    assert naive == {"pop": (3, 2.67), "jazz": (2, -0.5)}
    robust = {r.genre: r for r in movement.genre_delta_robust(chart, min_songs=3).collect()}
    assert set(robust) == {"pop"}
    assert (robust["pop"]["median"], robust["pop"].mean_without_top) == (-1.0, -1.0)
    (flip,) = movement.genre_sign_flip(chart, min_songs=3).collect()
    assert flip.sign_flips
    (ci,) = movement.genre_delta_ci(chart, min_songs=3).collect()
    assert ci.crosses_zero and ci.ci_low < 0 < ci.ci_high


def test_empty_baseline(make_history):
    h = make_history([(0, 1, "t")])
    assert rows(movement.movement_baseline(h)) == [(0, None, None, 0, 0, 0)]


def test_exclusion_overlap(chart):
    got = {(r[0], r[1]): r.rows for r in movement.exclusion_overlap(chart).collect()}
    assert got == {(False, True): 4, (False, False): 1, (True, True): 1}


def test_tag_clusters(spark):
    songs = spark.createDataFrame(
        [
            ("s1", "A", ["big band", "vocal jazz", "pop"]),
            ("s2", "B", ["vocal jazz", "big band", "big band"]),
            ("s3", "C", ["pop", "solo", "solo twin"]),
            ("s4", "D", []),
        ],
        "title string, artist string, tags array<string>",
    )
    assert rows(profile.tag_clusters(songs)) == [
        ("big band", "big band", 2),
        ("big band", "vocal jazz", 2),
        ("solo", "solo", 1),
        ("solo", "solo twin", 1),
    ]
    assert rows(profile.tag_profile(songs)) == [(4, 2.25, 5, 5)]


def test_funnel_and_corpus(make_history):
    h = make_history(
        [
            (0, 1, "kept", {"weeks_on_chart": 1}),
            (0, 2, "bulk", {"weeks_on_chart": 1, "is_release_week_bulk_entry": True}),
            (0, 3, "untagged", {"weeks_on_chart": 1, "genre_tags": []}),
            (8, 3, "late", {"weeks_on_chart": 1}),
            (8, 4, "old", {"primary_artist_used": None}),
            (8, 1, "kept"),
        ]
    )
    assert rows(profile.cohort_funnel(h)) == [(5, 4, 3, 2, 1)]
    assert rows(profile.corpus_summary(h)) == [(2, 6, 5, 1, week(0), week(8))]
