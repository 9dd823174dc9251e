"""Metrics on literal rows."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickstrata.operators import (
    devices, locations, motions, pages, prepare, profiles, sessions, shape, social, traffic,
)
from tests.test_sessions import NOON, event, frame


def prepared(spark, rows):
    return prepare.prepare_events(sessions.session_details(frame(spark, rows)))


def test_prepared_columns(spark):
    rows = [
        event("a", NOON, from_url="https://s/x?fbclid=1#top"),
        event("b", NOON + timedelta(minutes=1), from_url=None),
        event("c", NOON + timedelta(minutes=2), from_url="https://s/y#z?q"),
    ]
    found = {r.event_id: r for r in prepared(spark, rows).collect()}
    assert [found[e].clean_url for e in "abc"] == ["https://s/x", None, "https://s/y"]
    assert [found[e].from_fb for e in "abc"] == [1, 0, 0]
    assert [found[e].event_number_reverse for e in "abc"] == [3, 2, 1]
    assert [found[e].first_session_event for e in "abc"] == [1, 0, 0]
    assert [found[e].last_session_event for e in "abc"] == [0, 0, 1]
    assert found["a"].hour == 12


def test_prepare_stored_session_events(spark, monkeypatch):
    """The stored sixteen columns give the same result, also when a session spans blocks."""
    rows = [event(f"e{i}", NOON + timedelta(seconds=i)) for i in range(10)]
    rows += [event("x", NOON, visitor="w")]
    whole = prepared(spark, rows)
    monkeypatch.setattr(prepare, "_SIZE_BLOCK", 3)
    stored = prepare.prepare_events(sessions.session_events(frame(spark, rows)))
    assert sorted(stored.collect()) == sorted(whole.select(*stored.columns).collect())


def test_first_value_that_is_not_null(spark):
    rows = [
        event("a", NOON, geoip='{"country":{"name":"S"},"city":null}'),
        event("b", NOON + timedelta(days=1), geoip='{"country":{"name":"T"},"city":"C"}'),
        event("c", NOON, visitor="w"),
    ]
    found = {r.fingerprint: r for r in prepare.unique_visitors(prepared(spark, rows)).collect()}
    assert (found["v"].country, found["v"].city, found["v"].date_day) == ("S", "C", "2022-02-17")
    assert (found["w"].country, found["w"].city) == (None, None)


def test_day_without_session_start_has_null_sessions(spark):
    rows = [
        event("a", NOON),
        event("b", NOON + timedelta(minutes=1), date_day="2022-02-18"),
    ]
    daily = traffic.traffic_daily(prepared(spark, rows)).collect()
    assert [tuple(r) for r in daily] == [
        ("2022-02-17", 3, 1, 1, 1), ("2022-02-18", 4, 1, None, 1),
    ]


def test_hours_and_weekdays_are_complete(spark):
    rows = prepared(spark, [event("a", NOON)])
    hourly = traffic.traffic_hourly(rows).collect()
    assert [r.hour for r in hourly] == list(range(24))
    assert (hourly[12].pageviews, hourly[12].sessions, hourly[0].pageviews) == (1.0, 1.0, None)
    weekday = traffic.traffic_weekday(traffic.traffic_daily(rows)).collect()
    assert [r.weekday for r in weekday] == list(range(7))
    assert (weekday[3].weekday_name, weekday[3].pageviews, weekday[0].pageviews) == (
        "Torsdag", 1.0, None,
    )


def test_event_types_are_an_option(spark):
    rows = [event("a", NOON), event("b", NOON, event_type="click")]
    daily = traffic.traffic_daily(prepared(spark, rows), ["page_load"]).collect()
    assert [r.pageviews for r in daily] == [1]


def test_iso_year_of_new_year(spark):
    rows = [event("a", datetime(2022, 1, 1, 12))]
    weekly = traffic.traffic_weekly(prepared(spark, rows)).collect()
    assert [(r.year, r.week, r.pageviews) for r in weekly] == [(2021, 52, 1)]


def test_session_figures(spark):
    rows = [
        event("a", NOON), event("b", NOON + timedelta(seconds=10.5)),
        event("c", NOON, visitor="w"), event("d", NOON + timedelta(seconds=21), visitor="w"),
        event("e", NOON, visitor="x"),
    ]
    found = traffic.session_stats(prepared(spark, rows)).collect()
    # waiting times 10 and 21, session times 10.5 and 21
    assert [tuple(r) for r in found] == [(33.33, 1.67, 2.0, 15.5, 31.25)]


def test_empty_input_gives_nulls(spark):
    rows = prepared(spark, [])
    assert [tuple(r) for r in traffic.session_stats(rows).collect()] == [(None,) * 5]
    assert pages.page_stats(rows).count() == 0
    assert [tuple(r) for r in pages.facebook_session_ratio(rows).collect()] == [(None,)]
    assert devices.device_stats(rows).count() == 0
    visitors = prepare.unique_visitors(rows)
    assert [tuple(r) for r in locations.location_top_n(visitors, "city").collect()] == [("Andra", 0)]
    assert traffic.traffic_hourly(rows).count() == 24


def test_ratio_ties_round_to_even(spark):
    """One exit in 800 views is 0.125 %."""
    rows = [event(f"e{i:03d}", NOON + timedelta(seconds=i)) for i in range(800)]
    found = pages.page_stats(prepared(spark, rows), 1).collect()
    assert (found[0].pageviews, found[0].exits, found[0].exit_pct) == (800, 1, 0.12)


def test_pages_below_the_limit_and_embedded_pages_are_left_out(spark):
    rows = [event(f"a{i}", NOON, visitor=f"v{i}", from_url="https://s/a") for i in range(3)]
    rows += [event(f"b{i}", NOON, visitor=f"v{i}", from_url="https://s/b") for i in range(2)]
    rows += [event(f"c{i}", NOON, visitor=f"v{i}", from_url="about:srcdoc") for i in range(3)]
    found = pages.page_stats(prepared(spark, rows), 3).collect()
    assert [r.clean_url for r in found] == ["https://s/a"]


def test_any_device_type_is_counted_and_null_is_not(spark):
    kinds = ["mobile", "desktop", "tablet", "smarttv", "unknown"]
    rows = [
        event(k, NOON, visitor=k, user_data=f'{{"device_type":"{k}"}}') for k in kinds
    ] + [event("none", NOON, visitor="none", user_data="{}")]
    found = devices.device_stats(prepared(spark, rows)).collect()
    assert [r.device_type for r in found] == sorted(kinds)
    assert {r.one_event_session_ratio for r in found} == {100.0}


def places_of(spark, places):
    rows = [(f"v{i}", p, "2022-02-17") for i, p in enumerate(places)]
    return spark.createDataFrame(rows, "fingerprint string, city string, date_day string")


def test_location_tie_and_others(spark):
    visitors = places_of(spark, ["b", "a", "c", "c", None])
    found = [tuple(r) for r in locations.location_top_n(visitors, "city", 2).collect()]
    assert found == [("c", 2), ("a", 1), ("Andra", 1)]
    daily = [tuple(r) for r in locations.location_per_day(visitors, "city", 2).collect()]
    # the unknown place counts among the others here
    assert daily == [("Andra", "2022-02-17", 2), ("c", "2022-02-17", 2), ("a", "2022-02-17", 1)]


def test_motion_ids(spark):
    base = "https://s/visa-motion/?motion="
    ids = ["12", "012", " 12 ", "1e3", "1.5", "-3", "INF", "12d", "12#x", "", "nan", "abc"]
    rows = [event(f"e{i:02d}", NOON, from_url=f"{base}{m}&lang=sv") for i, m in enumerate(ids)]
    rows.append(event("x", NOON, from_url="https://s/visa-motion/?lang=sv&motion=7"))
    kept = motions.motion_events(prepared(spark, rows)).orderBy("event_id").collect()
    assert [r.motion for r in kept] == ["12", "012", " 12 ", "1e3", "1.5", "-3", "INF"]


def series(spark, values):
    rows = [(f"2022-02-{17 + i}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date_day string, value double")


def test_zscores_use_the_sample_deviation_and_constant_series_are_null(spark):
    daily = series(spark, [1.0, 2.0, 3.0]).withColumnRenamed("value", "sessions")
    reach = series(spark, [10.0, 20.0, 60.0]).withColumnRenamed("value", "reach")
    same = series(spark, [5.0, 5.0, 5.0]).withColumnRenamed("value", "pageviews")
    scores = social.social_zscores(daily, reach, same, reach, same)
    rows = scores["facebook"].collect()
    assert [r.site_sessions for r in rows] == [-1.0, 0.0, 1.0]
    assert [r.facebook_pageviews for r in rows] == [None, None, None]
    deviation = statistics.stdev([10, 20, 60])
    assert rows[2].facebook_reach == pytest.approx(30 / deviation)
    assert scores["instagram"].columns == [
        "date_day", "site_sessions", "instagram_reach", "instagram_pageviews",
    ]


def test_series_without_days_are_aligned_by_position(spark):
    daily = series(spark, [1.0, 2.0, 3.0])
    ordinals = spark.createDataFrame([(7, 3.0), (2, 1.0), (5, 2.0)], "ordinal long, reach double")
    found = social.by_position(ordinals, daily, "ordinal").orderBy("date_day").collect()
    assert [tuple(r) for r in found] == [
        ("2022-02-17", 1.0), ("2022-02-18", 2.0), ("2022-02-19", 3.0),
    ]


def test_long_form_and_shares(spark):
    wide = spark.createDataFrame([("a", 1, 2.5), ("b", 3, None)], "k string, x long, y double")
    long = shape.series_long(wide, ["k"]).collect()
    assert sorted(map(tuple, long), key=str) == sorted(
        [("a", "x", 1.0), ("a", "y", 2.5), ("b", "x", 3.0), ("b", "y", None)], key=str
    )
    shares = {r.k: r.share_pct for r in shape.share_of_total(wide, "x").collect()}
    assert shares == {"a": 25.0, "b": 75.0}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_exact_median_of_skewed_groups(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("aaab"), rng.choice([rng.randrange(50), rng.randrange(5000)]))
            for _ in range(700)]
    rows += [("one", 9), ("two", 1), ("two", 4), ("nothing", None)]
    df = spark.createDataFrame(rows, "k string, x long")
    found = {r.k: r["median"] for r in profiles.exact_median(df, ["k"], "x", width).collect()}
    values = {}
    for k, x in rows:
        if x is not None:
            values.setdefault(k, []).append(x)
    assert found == {k: float(statistics.median(v)) for k, v in values.items()}
    only = profiles.exact_median(df.drop("k"), [], "x", width).collect()
    assert only[0]["median"] == float(statistics.median([x for _, x in rows if x is not None]))


def test_busy_group_profile_agrees_with_plain_aggregates(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        visitor = "busy" if i % 3 == 0 else f"v{rng.randrange(30)}"
        url = "https://s/hot" if rng.random() < 0.5 else f"https://s/{rng.randrange(9)}"
        rows.append(event(f"e{i:03d}", NOON + timedelta(seconds=rng.uniform(0, 90_000)), visitor,
                          from_url=url + rng.choice(["", "?fbclid=1"])))
    df = prepared(spark, rows).persist()
    expected = df.groupBy("clean_url").agg(
        F.median("seconds_to_next_event_in_session").alias("median_seconds"),
        F.count("event_id").alias("pageviews"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("fingerprint").alias("visitors"),
        F.sum("from_fb").alias("from_facebook"),
        F.sum("first_session_event").alias("entries"),
        F.sum("last_session_event").alias("exits"),
    )
    found = profiles.group_profile(df, ["clean_url"]).select(*expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    df.unpersist()


def test_events_without_session_are_no_sessions(spark):
    rows = [event("a", NOON), event("b", NOON, visitor="w"), event("c", NOON, visitor="x")]
    whole = prepared(spark, rows)
    lost = whole.where("event_id = 'a'").withColumn("session_id", F.lit(None).cast("string"))
    found = traffic.session_stats(whole.unionByName(lost)).collect()[0]
    assert found.one_event_session_ratio == 100 and found.avg_events_per_session == 1


def test_visitors_of_a_wide_table(spark):
    wide = prepared(spark, [event("a", NOON), event("b", NOON + timedelta(minutes=1))])
    late = F.when(F.col("event_id") == "b", "late")
    wide = wide.withColumns({f"c{i}": late for i in range(70)})
    found = prepare.unique_visitors(wide).collect()
    assert len(found) == 1 and found[0].c0 == found[0].c69 == "late"


def test_all_and_each_device_in_one_pass(spark):
    """The same figures as one pass for all and one per device; an unknown device counts in all."""
    rng = random.Random(9)
    rows = [
        event(
            f"e{i}", NOON + timedelta(seconds=rng.randrange(40_000)), visitor=f"v{rng.randrange(9)}",
            from_url=rng.choice(["https://s/a", "https://s/b", None]),
            user_data=rng.choice(['{"device_type":"mobile"}', '{"device_type":"desktop"}', '{"device_type":""}', "{}"]),
        )
        for i in range(200)
    ]
    table = prepared(spark, rows)
    both = pages.page_stats_all_and_by_device(table, 2)
    columns = pages.page_stats(table, 2).columns
    assert sorted(both.where("over_all").select(columns).collect(), key=str) == sorted(pages.page_stats(table, 2).collect(), key=str)
    by_device = pages.page_stats(table, 2, ["device_type"])
    found = both.where("not over_all").select(by_device.columns)
    assert found.count() > 3 and sorted(found.collect(), key=str) == sorted(by_device.collect(), key=str)
    profile = profiles.session_profile(table, ["device_type"], all_of="device_type")
    assert traffic.session_figures(profile.where("over_all")).collect() == traffic.session_stats(table).collect()
    devices_found = devices.device_figures(profile.where("not over_all")).collect()
    assert devices_found == devices.device_stats(table).collect() and len(devices_found) == 3


def test_session_figures_read_the_events_twice(spark, tmp_path):
    """Once for the counts and once for the histogram of session times."""
    path = str(tmp_path / "prepared")
    prepared(spark, [event(f"e{i}", NOON + timedelta(minutes=i % 7), visitor=f"v{i % 5}") for i in range(50)]).write.parquet(path)
    figures = devices.device_stats(spark.read.parquet(path))
    figures.collect()
    plan = figures._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
