from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows, week
from upcharts.operators import staging
from upcharts.schemas import ARTIST_METADATA, CHART_HISTORY, ENTRY

ENTRIES = T.StructType([T.StructField("chart_date", T.DateType()), *ENTRY.fields])


def entries(spark, data):
    return spark.createDataFrame(data, ENTRIES)


def test_debut_flags(spark):
    data = [(1, 0), (5, 0), (5, 7), (None, 0), (5, None)]
    df = entries(spark, [(week(0), i, f"t{i}", "A", w, 1, last) for i, (w, last) in enumerate(data)])
    got = staging.flag_debuts(df).orderBy("rank").select("is_debut", "is_reentry_anomaly", "last_pos")
    assert [tuple(r) for r in got.collect()] == [
        (True, False, None),
        (False, True, None),
        (False, False, 7),
        (False, True, None),
        (False, False, None),
    ]


def test_bulk_flag_covers_all_rows_of_the_credit(spark):
    data = [(week(0), i, f"t{i}", "A", 1, 1, 0) for i in range(5)]
    data += [(week(0), 5, "old", "A", 9, 1, 3)]
    data += [(week(0), 10 + i, f"u{i}", "B", 1, 1, 0) for i in range(4)]
    data += [(week(0), 20, "duet", "A Featuring B", 1, 1, 0), (week(1), 1, "next", "A", 1, 1, 0)]
    flagged = staging.flag_bulk_entries(staging.flag_debuts(entries(spark, data)))
    bulk = {r.title for r in flagged.where("is_release_week_bulk_entry").collect()}
    assert bulk == {"t0", "t1", "t2", "t3", "t4", "old"}
    assert flagged.count() == len(data)


def test_allowlist_keeps_order_and_duplicates(spark):
    df = spark.createDataFrame([("A", ["rock", "gen z", "rock", "Pop"])], "artist string, tags array<string>")
    row = staging.filter_genres(df).first()
    assert (row.genre_tags, row.dropped_tags) == (["rock", "rock"], 2)


METADATA = [
    ("J. Cole With B", "J. Cole", "m1", ["hip hop", "english"], True, None),
    ("Unfound", "Unfound", "m2", ["rock"], False, None),
    ("No key", None, "m3", ["rock", "x"], True, None),
    ("No tags", "No tags", "m4", None, True, None),
    ("Unknown found", "Unknown found", "m5", ["rock"], None, "timeout"),
]


def test_resolution_rules(spark):
    resolved = staging.resolve_metadata(spark.createDataFrame(METADATA, ARTIST_METADATA))
    got = {r.artist: tuple(r)[1:] for r in resolved.collect()}
    assert got == {
        "J. Cole With B": ("J. Cole", "m1", [], 0, True),
        "Unfound": (None, None, [], 0, False),
        "No key": ("No key", "m3", ["rock"], 1, False),
        "No tags": ("No tags", "m4", [], 0, False),
        "Unknown found": (None, None, [], 0, False),
    }


def test_custom_overrides(spark):
    custom = spark.createDataFrame(
        [("No key", ["jazz", "not allowlisted"])], "primary_artist_used string, override_tags array<string>"
    )
    resolved = staging.resolve_metadata(spark.createDataFrame(METADATA, ARTIST_METADATA), overrides=custom)
    got = {r.artist: r for r in resolved.collect()}
    assert got["No key"].genre_tags == ["jazz", "not allowlisted"]
    assert got["J. Cole With B"].genre_tags == ["hip hop"]


def test_staged_rows(spark):
    df = entries(
        spark,
        [
            (week(0), 1, "t1", "J. Cole With B", 1, 1, 0),
            (week(0), 2, "t2", "No key", 3, 1, 4),
            (week(0), 3, "t3", "Not looked up", 3, 1, 0),
        ],
    )
    metadata = spark.createDataFrame(METADATA, ARTIST_METADATA)
    staged = staging.stage_history(df, metadata)
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in CHART_HISTORY]
    picked = staged.orderBy("rank").select("primary_artist_used", "mbid", "last_pos", F.size("genre_tags"))
    assert [tuple(r) for r in picked.collect()] == [
        ("J. Cole", "m1", None, 0),
        ("No key", "m3", 4, 1),
        (None, None, None, 0),
    ]
    assert rows(staging.staging_summary(df, metadata)) == [(1, date(2026, 1, 3), date(2026, 1, 3), 1, 1)]
