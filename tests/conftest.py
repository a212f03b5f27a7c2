import os
from datetime import date, timedelta

import pytest

from upcharts.schemas import CHART_HISTORY
from upcharts.session import build_session

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


WEEK0 = date(2026, 1, 3)


def week(n: int) -> date:
    return WEEK0 + timedelta(weeks=n)


@pytest.fixture(scope="session")
def make_history(spark):
    """Build chart_history from short rows: (week or date, rank, title, {overrides})."""

    def build(rows):
        full = []
        for when, rank, title, *rest in rows:
            values = {
                "chart_date": when if isinstance(when, date) else week(when),
                "rank": rank,
                "title": title,
                "artist": "A",
                "primary_artist_used": "A",
                "weeks_on_chart": 2,
                "peak_pos": rank,
                "last_pos": None,
                "is_debut": False,
                "is_reentry_anomaly": False,
                "is_release_week_bulk_entry": False,
                "mbid": None,
                "genre_tags": ["rock"],
            }
            values.update(rest[0] if rest else {})
            values["is_debut"] = values["weeks_on_chart"] == 1
            full.append(tuple(values[name] for name in CHART_HISTORY.fieldNames()))
        return spark.createDataFrame(full, CHART_HISTORY)

    return build


DEBUT = {"weeks_on_chart": 1}


def in_order(tuples):
    """Sorted, NULLs last."""
    return sorted(tuples, key=lambda t: [(v is None, 0 if v is None else v) for v in t])


def rows(df):
    return in_order(tuple(r) for r in df.collect())
