"""Queries over every event: the first and the last day of the table, and late arrivals."""

from datetime import datetime

import pytest

import __spark_entry__ as entry

#: Two visits of a user each on the first day, on the last (arrived a day late), and between.
EVENTS = [
    (5, datetime(2024, 1, 1, 0, 10), 1),
    (7, datetime(2024, 1, 1, 0, 20), 1),
    (410, datetime(2024, 1, 30, 23, 50), 2),
    (287, datetime(2024, 1, 30, 23, 55), 2),
    (500, datetime(2024, 1, 15, 12), 3),
    (14, datetime(2024, 1, 15, 12, 5), 3),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole-days"))
    tables = {
        "events": [(i, t, u, "view", "{}") for i, t, u in EVENTS],
        "pages": [(0, "https://site.example/a")],
        "nation": [(k, f"Nation {k}") for k in (1, 4, 9)],
    }
    for name, rows in tables.items():
        made = spark.createDataFrame(rows, entry.sample_site.SCHEMAS[name])
        made.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


def rows(spark, folder, name, *columns):
    return sorted(tuple(r) for r in entry.queries()[name](spark, folder).select(*columns).collect())


def test_inactivity_gaps(spark, folder):
    found = dict(rows(spark, folder, "inactivity_gaps", "event_id", "inactivity_time"))
    assert found == {"5": None, "7": 10, "410": None, "287": 5, "500": None, "14": 5}


def test_session_starts(spark, folder):
    assert rows(spark, folder, "session_starts", "event_id") == [("410",), ("5",), ("500",)]


def test_sessions(spark, folder):
    found = rows(spark, folder, "sessions", "session_start_at", "session_end_at")
    assert found == sorted((a[1], b[1]) for a, b in zip(EVENTS[::2], EVENTS[1::2], strict=True))


def test_facebook_landing_pages(spark, folder):
    assert rows(spark, folder, "facebook_landing_pages", "*") == [("https://site.example/a", 3)]


def test_motion_events(spark, folder):
    assert rows(spark, folder, "motion_events", "event_id", "motion") == [("14", "2"), ("287", "14"), ("7", "7")]


def test_motion_stats_top(spark, folder):
    found = rows(spark, folder, "motion_stats_top", "motion", "pageviews", "sessions")
    assert found == [("14", 1, 1), ("2", 1, 1), ("7", 1, 1)]
