import pytest

from tests.conftest import DEBUT, week
from upcharts.plans import reports


def climbing(title, artist, family_tag, start=0, debut=50, best=40, primary="same"):
    who = {"artist": artist, "primary_artist_used": artist if primary == "same" else primary}
    who["genre_tags"] = [family_tag]
    return [(start, debut, title, {**who, **DEBUT}), (start + 1, best, title, who)]


def test_genre_needs_a_minimum_of_songs(make_history):
    data = [r for i in range(8) for r in climbing(f"r{i}", f"A{i}", "rock")]
    data += [r for i in range(7) for r in climbing(f"p{i}", f"B{i}", "pop")]
    got = reports.genre_climb(make_history(data), cutoff=week(0)).collect()
    assert [tuple(r) for r in got] == [("rock", 8, 10.0, 8, 100.0)]


@pytest.mark.parametrize(
    "top,others,label",
    [
        (7, 13, "Mixed"),  # share exactly 0.35
        (6, 14, "Broad-based / recurring"),
        (5, 5, "Concentrated / one breakout act"),  # share exactly 0.5
        (1, 2, "Mixed"),  # low share but fewer than five artists
    ],
)
def test_recurrence_labels(make_history, top, others, label):
    data = [r for i in range(top) for r in climbing(f"t{i}", "Top", "soul")]
    data += [r for i in range(others) for r in climbing(f"o{i}", f"Other {i}", "soul")]
    (row,) = reports.recurrence_summary(make_history(data), cutoff=week(0)).collect()
    assert row.pattern_type == label
    assert row.climbing_songs == top + others
    assert row.distinct_climbing_artists == 1 + others


def test_unmatched_songs_can_lead_but_are_no_artist(make_history):
    data = [r for i in range(3) for r in climbing(f"t{i}", f"C{i}", "soul", primary=None)]
    data += climbing("o", "Other", "soul")
    (row,) = reports.recurrence_summary(make_history(data), cutoff=week(0)).collect()
    assert (row.distinct_climbing_artists, row.pct_from_top_artist) == (1, 75.0)


@pytest.mark.parametrize(
    "early,label",
    [
        (43, "Flash - climbs fast, early peak"),  # 7 of 10 places
        (46, "Slow-build - climbs steadily over time"),  # 4 of 10 places
        (45, "Mixed pattern"),
    ],
)
def test_trajectory_labels(make_history, early, label):
    data = []
    for i in range(5):
        data += [(0, 50, f"s{i}", DEBUT), (2, early, f"s{i}"), (5, 40, f"s{i}")]
    data += [(0, 50, "short", DEBUT), (4, 1, "short")]
    (row,) = reports.trajectory_shape(make_history(data), cutoff=week(0)).collect()
    assert (row.n_songs, row.avg_total_climb, row.shape_type) == (5, 10.0, label)


def test_artist_recurrence_labels(make_history):
    data = climbing("x1", "Once", "rock")
    for i, start in enumerate((0, 5, 10)):
        data += climbing(f"y{i}", "Spread", "rock", start=start)
    data += climbing("z1", "Burst", "rock") + climbing("z2", "Burst", "rock", start=1)
    data += climbing("n", "Nobody", "rock", primary=None)
    h = make_history(data)
    got = {r.primary_artist_used: r.pattern_type for r in reports.artist_recurrence(h, min_songs=1, cutoff=week(10)).collect()}
    assert got == {
        "Once": "One-time",
        "Spread": "Recurring across the year",
        "Burst": "Multiple songs, clustered timing",
    }
    assert "Once" not in {r.primary_artist_used for r in reports.artist_recurrence(h, cutoff=week(10)).collect()}
