"""Known values of the sample at sf0.01."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def prepared(spark):
    rows = entry._prepared(spark, SF_DIR).persist()
    yield rows
    rows.unpersist()


def test_session_sizes(prepared):
    sizes = prepared.groupBy("session_id").count().groupBy("count").agg(
        F.count(F.lit(1)).alias("sessions")
    )
    assert {r["count"]: r["sessions"] for r in sizes.collect()} == {1: 9077, 2: 436, 3: 17}


def test_session_stats(prepared):
    row = entry.traffic.session_stats(prepared).collect()
    assert [tuple(r) for r in row] == [(95.25, 1.05, 2.04, 935.5, 1915.26)]


def test_device_stats(prepared):
    rows = {r["device_type"]: tuple(r)[1:] for r in entry.devices.device_stats(prepared).collect()}
    assert rows == {
        "desktop": (4014, 3827, 60, 633, 95.30, 1.05, 1028.0, 2089.08),
        "mobile": (4940, 4709, 75, 776, 95.26, 1.05, 934.0, 1890.02),
        "tablet": (1046, 994, 15, 149, 94.97, 1.05, 812.5, 1660.26),
    }


def test_top_page(prepared):
    pages = entry.pages.page_stats(prepared, 100).collect()
    assert len(pages) == 7
    assert tuple(pages[0]) == (
        "https://site.example/visa-motion/", 907.0, 1429, 1419, 150, 0, 1370, 1354, 94.75,
    )


def test_traffic(prepared):
    daily = entry.traffic.traffic_daily(prepared)
    assert [tuple(r)[2:] for r in daily.limit(2).collect()] == [(364, 348, 134), (339, 323, 138)]
    weekly = entry.traffic.traffic_weekly(prepared).collect()
    assert [r["pageviews"] for r in weekly] == [2348, 2320, 2328, 2330, 674]
    weekday = entry.traffic.traffic_weekday(daily).collect()
    assert [tuple(r)[1:4] for r in weekday[:2]] == [
        ("Måndag", 339.0, 325.0), ("Tisdag", 334.0, 315.0),
    ]


def test_motions(prepared):
    motions = entry.motions.motion_events(prepared)
    assert motions.count() == 1299
    assert motions.select("motion").distinct().count() == 40
