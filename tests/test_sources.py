"""Stored tables survive a round trip, and the report runs on them."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickstrata.operators import sessions
from clickstrata.plans.report import web_report
from clickstrata.sources import shared, tables
from tests.test_sessions import NOON, event, frame

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session_events(spark):
    return sessions.session_events(entry._events(spark, SF_DIR))


def test_parquet_round_trip(spark, session_events, tmp_path):
    path = str(tmp_path / "session-events")
    tables.write_session_events(session_events, path)
    stored = tables.read_session_events(spark, path)
    assert stored.columns == session_events.columns
    assert sorted(stored.collect()) == sorted(session_events.collect())


def test_a_large_day_is_several_files(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 40_000, 1, 16).crossJoin(F.broadcast(frame(spark, [event("a", NOON)])))
        rows = rows.withColumn("event_id", F.sha2(F.col("id").cast("string"), 256)).drop("id")
        tables.write_session_events(rows, str(tmp_path / "days"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "days" / "date_day=2022-02-17").glob("*.parquet"))) > 5


def test_csv_round_trip(spark, session_events, tmp_path):
    path = str(tmp_path / "session-events-csv")
    tables.write_csv(session_events, path)
    stored = tables.read_session_events_csv(spark, path)
    key = lambda r: r.event_id
    assert sorted(stored.collect(), key=key) == sorted(session_events.collect(), key=key)


def test_social_series(spark, tmp_path):
    dated, ordered = tmp_path / "dated.csv", tmp_path / "ordered.csv"
    dated.write_text("date_day,reach\n2022-02-17,5\n2022-02-18,7\n")
    ordered.write_text("name,pageviews\nå,3\nö,4\n")
    with_day = tables.read_social_series(spark, str(dated), "reach").collect()
    assert [tuple(r) for r in with_day] == [("2022-02-17", 5.0), ("2022-02-18", 7.0)]
    by_order = tables.read_social_series(spark, str(ordered), "pageviews", None).collect()
    assert [r.pageviews for r in by_order] == [3.0, 4.0]
    assert [r.ordinal for r in by_order] == sorted(r.ordinal for r in by_order)


def test_report_over_stored_session_events(spark, session_events, tmp_path):
    """The stored sixteen columns and the fused form give the same report."""
    path, folder = str(tmp_path / "session-events"), str(tmp_path / "report")
    tables.write_session_events(session_events, path)
    social = entry._social(spark, SF_DIR)
    stored = web_report(tables.read_session_events(spark, path), social, 10, folder)
    fused = web_report(sessions.session_details(entry._events(spark, SF_DIR)), social, 10, folder)
    assert set(stored) == set(fused) and len(stored) == 16
    for name in ("traffic_daily", "device_stats", "page_stats_mobile", "motion_stats", "city_top"):
        assert stored[name].collect() == fused[name].collect()


def test_shared_folder_is_the_clusters(spark):
    named = spark.conf.get(shared.CHECKPOINT_SETTING, None)
    rows = shared.written(frame(spark, [event("a", NOON)]), "rows")
    assert rows.where(F.col("event_id") == "a").count() == 1
    if named:
        assert named in rows.inputFiles()[0]


def test_other_time_zone_is_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Stockholm")
    try:
        with pytest.raises(ValueError):
            sessions.sessions(frame(spark, []))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_report_tables_can_be_removed(spark, session_events):
    with shared.scratch(spark, "report") as folder:
        tables = web_report(session_events, None, 10, folder)
        assert tables["traffic_daily"].count() == 28
        plan = tables["motion_stats"]._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile" in plan
        assert os.path.exists(folder)
    assert not os.path.exists(folder)
