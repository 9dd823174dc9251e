"""Sketches per day against the exact figures, on days that are merged, skewed and repaired."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clickstrata.operators import devices, motions, pages, prepare, sessions, sketches, traffic
from tests.test_sessions import NOON, event, frame


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Three weeks, a page and a visitor with a third of all events, sessions over several days."""
    rng = random.Random(2)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0
        at = NOON + timedelta(seconds=rng.randrange(21 * 86_400))
        rows.append(
            event(
                f"e{i}",
                at,
                visitor="hot" if hot else f"v{rng.randrange(900)}",
                from_url=rng.choice(["https://s/a", "https://s/b?fbclid=1", None]) if not hot else "https://s/hot",
                date_day=str((at + timedelta(hours=rng.choice([0, 0, 20]))).date()),
                user_data='{"device_type":"%s"}' % ("mobile" if hot else rng.choice(["mobile", "desktop"])),
            )
        )
    rows.append(event("n", NOON, visitor=None))
    path = str(tmp_path_factory.mktemp("sketches") / "prepared")
    prepare.prepare_events(sessions.session_details(frame(spark, rows))).write.parquet(path)
    return spark.read.parquet(path)


def by(rows, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in rows.collect()}


def near(estimate, exact):
    return abs(estimate - exact) <= exact * sketches.DISTINCT_ERROR


def test_weeks_and_days_are_near(prepared):
    for keys, metric in ((("year", "week"), traffic.traffic_weekly), (("date_day",), traffic.traffic_daily)):
        exact, merged = by(metric(prepared), *keys), by(metric(prepared, approximate=True), *keys)
        assert exact.keys() == merged.keys() and len(exact) > 3
        for key, row in exact.items():
            assert merged[key].keys() == row.keys()
            assert merged[key]["pageviews"] == row["pageviews"]
            assert near(merged[key]["visitors"], row["visitors"])
            assert near(merged[key]["sessions"], row["sessions"])


def test_pages_and_medians_are_near(spark, prepared):
    exact, merged = by(pages.page_stats(prepared, 1), "clean_url"), by(pages.page_stats(prepared, 1, approximate=True), "clean_url")
    assert exact.keys() == merged.keys() == {("https://s/a",), ("https://s/b",), ("https://s/hot",)}
    same = ("pageviews", "from_facebook", "entries", "exits", "exit_pct")
    for key, row in exact.items():
        assert all(merged[key][c] == row[c] for c in same)
        assert near(merged[key]["sessions"], row["sessions"]) and near(merged[key]["visitors"], row["visitors"])
    estimates = pages.page_stats(prepared, 1, approximate=True).select("clean_url", "median_seconds")
    value = "seconds_to_next_event_in_session"
    checked = sketches.within_rank_error(
        prepared.join(estimates, "clean_url"), ["clean_url"], value, "median_seconds"
    )
    assert [r.median_within for r in checked.collect()] == [True] * 3


def test_devices_have_exact_sessions(prepared):
    exact, merged = by(devices.device_stats(prepared), "device_type"), by(devices.device_stats(prepared, approximate=True), "device_type")
    same = ("pageviews", "sessions", "from_facebook", "one_event_session_ratio", "avg_events_per_session")
    assert exact.keys() == merged.keys()
    for key, row in exact.items():
        assert merged[key].keys() == row.keys()
        assert all(merged[key][c] == row[c] for c in same)


def test_motions(spark):
    rows = [event(f"e{i}", NOON + timedelta(minutes=i), visitor=f"v{i % 3}", from_url="https://s/visa-motion/?motion=7&x") for i in range(9)]
    rows += [event("o", NOON, visitor="w", from_url="https://s/visa-motion/?motion=8")]
    chosen = motions.motion_events(prepare.prepare_events(sessions.session_details(frame(spark, rows))))
    exact = [tuple(r)[:1] + tuple(r)[2:] for r in motions.motion_stats(chosen).collect()]
    assert [tuple(r)[:1] + tuple(r)[2:] for r in motions.motion_stats(chosen, approximate=True).collect()] == exact
    assert [r.motion for r in motions.motion_stats(chosen, 1, approximate=True).collect()] == ["7"]


def test_a_repaired_day_replaces_its_rows(spark, prepared, tmp_path):
    """Days are stored one by one; writing one again leaves the others alone."""
    root = str(tmp_path / "sketches")
    made = sketches.event_sketches(prepared, ["device_type"])
    days = sorted(r.date_day for r in made.select("date_day").distinct().collect())
    for day in days:
        sketches.write_sketches(sketches.event_sketches(prepared.where(F.col("date_day") == day), ["device_type"]), root)
    sketches.write_sketches(sketches.event_sketches(prepared.where(F.col("date_day") == days[3]), ["device_type"]), root)
    stored = sketches.read_sketches(spark, root, made.schema)
    # one grouping level less is a merge too
    assert by(sketches.traffic_weekly(stored), "year", "week") == by(traffic.traffic_weekly(prepared, approximate=True), "year", "week")
    some = sketches.read_sketches(spark, root, made.schema, days[2], days[5])
    assert {r.date_day for r in some.collect()} == set(days[2:5])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_day" in plan


def test_merge_reads_no_event(prepared):
    """One shuffle for a page merge, and none that carries a row per visitor."""
    plan = pages.page_stats(prepared, 1, approximate=True)._jdf.queryExecution().executedPlan().toString()
    assert "fingerprint" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_nothing_to_sketch(spark, prepared):
    none = prepared.where("false")
    assert traffic.traffic_weekly(none, approximate=True).collect() == []
    assert pages.page_stats(none, 1, approximate=True).collect() == []
    assert devices.device_stats(none, approximate=True).collect() == []


def test_larger_sets_keep_the_stated_errors(spark):
    rows = spark.range(400_000).selectExpr(
        "cast(id % 20 as string) as date_day", "'p' as page", "id as event_id", "1 as event_number",
        "0 as from_fb", "0 as first_session_event", "0 as last_session_event",
        "cast(id % 150000 as string) as fingerprint", "cast(id as string) as session_id",
        "(id * id) % 1861 as seconds_to_next_event_in_session",
    )
    merged = sketches.merge_events(sketches.event_sketches(rows, ["page"]), ["page"]).collect()[0]
    assert near(merged.visitors, 150_000) and near(merged.sessions, 400_000)
    checked = sketches.within_rank_error(
        rows.withColumn("estimate", F.lit(merged.median_seconds)), ["page"],
        "seconds_to_next_event_in_session", "estimate",
    )
    assert checked.collect()[0].median_within
