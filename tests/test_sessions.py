"""Session rules on literal rows, and properties of the session plan."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickstrata.operators import sessions as S

NOON = datetime(2022, 2, 17, 12, 0, 0)
COLUMNS = (
    "event_id string, fingerprint string, request_time timestamp_ntz, event_type string, "
    "from_url string, details string, user_data string, geoip string, date_day string"
)


def event(event_id, time, visitor="v", date_day=None, **values):
    return (
        event_id, visitor, time, values.get("event_type", "page_load"),
        values.get("from_url", "https://site.example/"), "{}",
        values.get("user_data", '{"device_type":"mobile"}'), values.get("geoip"),
        date_day or time.strftime("%Y-%m-%d"),
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def numbers(df):
    """session ordinal by event id"""
    return {r.event_id: int(r.session_id.rsplit("-", 1)[1]) for r in df.collect()}


@pytest.mark.parametrize(
    "gap, sessions",
    [
        (timedelta(minutes=30, seconds=59, milliseconds=999), 1),
        (timedelta(minutes=31), 2),
        (timedelta(minutes=31, milliseconds=1), 2),
    ],
)
def test_gap_boundary(spark, gap, sessions):
    events = frame(spark, [event("a", NOON), event("b", NOON + gap)])
    assert S.sessions(events).count() == sessions


def test_gap_counts_complete_minutes(spark):
    start = datetime(2022, 2, 17, 0, 0, 30)
    events = frame(spark, [event("a", start), event("b", start + timedelta(minutes=30, seconds=40))])
    gaps = {r.event_id: r.inactivity_time for r in S.inactivity_gaps(events).collect()}
    assert gaps == {"a": None, "b": 30}
    assert S.sessions(events).count() == 1


def test_midnight_cuts_a_session(spark):
    events = frame(
        spark,
        [event("a", datetime(2022, 2, 17, 23, 50)), event("b", datetime(2022, 2, 18, 0, 1))],
    )
    ids = sorted(r.session_id for r in S.sessions(events).collect())
    assert ids == ["v-2022-02-17-1", "v-2022-02-18-1"]
    starts = {r.event_id: r.next_session_start_at for r in S.session_starts(events).collect()}
    assert starts == {"a": datetime(2022, 2, 18, 0, 1), "b": datetime(2022, 2, 19)}


def test_same_instant_is_ordered_by_event_id(spark):
    events = frame(spark, [event("b", NOON), event("a", NOON)])
    rows = {r.event_id: r for r in S.session_events(events).collect()}
    assert (rows["a"].event_number, rows["b"].event_number) == (1, 2)
    assert rows["a"].seconds_to_next_event_in_session == 0
    assert rows["b"].seconds_to_next_event_in_session is None


def test_iso_text_with_and_without_fraction(spark):
    rows = [event("a", NOON), event("b", NOON)]
    texts = {"a": "2022-02-17T00:00:00", "b": "2022-02-17T00:00:00.123000"}
    text = F.when(F.col("event_id") == "a", texts["a"]).otherwise(texts["b"])
    events = frame(spark, rows).withColumn("request_time", text)
    found = {r.event_id: r.request_time for r in S.session_events(events).collect()}
    assert found == {"a": datetime(2022, 2, 17), "b": datetime(2022, 2, 17, 0, 0, 0, 123000)}


def test_arrival_day_and_event_day_differ(spark):
    late = datetime(2022, 2, 17, 23, 59, 59, 900000)
    events = frame(spark, [event("a", late, date_day="2022-02-18")])
    row = S.session_events(events).collect()[0]
    assert (row.session_id, row.date_day) == ("v-2022-02-17-1", "2022-02-18")
    assert S.complete_days(events, "2022-02-17", "2022-02-18").count() == 0


def test_unknown_visitor_has_no_session(spark):
    events = frame(spark, [event("a", NOON, visitor=None), event("b", NOON)])
    assert [r.event_id for r in S.session_events(events).collect()] == ["b"]


def test_empty_input(spark):
    events = frame(spark, [])
    assert S.session_events(events).count() == 0
    assert S.sessions(events).count() == 0


def test_slot_width_is_checked(spark):
    for width in (0, 7, 3600):
        with pytest.raises(ValueError):
            S.sessions(frame(spark, []), width)


def brute_force(rows):
    """Number, position, time of the next event: one visitor day after the other."""
    days = {}
    for event_id, visitor, time, *_ in rows:
        days.setdefault((visitor, time.date()), []).append((time, event_id))
    result = {}
    for (visitor, day), events in days.items():
        events.sort()
        session, number, previous = 0, 0, None
        for time, event_id in events:
            if previous is None or (time - previous) // timedelta(minutes=1) > 30:
                session, number = session + 1, 0
            number += 1
            result[event_id] = [f"{visitor}-{day}-{session}", number, None, time]
            previous = time
        ordered = [result[e] for _, e in events]
        for one, following in zip(ordered, ordered[1:]):
            if one[0] == following[0]:
                one[2] = (following[3] - one[3]) // timedelta(seconds=1)
    return {e: tuple(r[:3]) for e, r in result.items()}


@pytest.mark.parametrize("width", [1, 10, 900, 1800])
def test_every_slot_width_agrees_with_brute_force(spark, width):
    """One visitor holds a third of all events, most of them within minutes of each other."""
    rng = random.Random(width)
    rows = []
    for i in range(900):
        busy = i % 3 == 0
        visitor = "busy" if busy else f"v{rng.randrange(40)}"
        seconds = rng.choice([rng.uniform(0, 900), rng.uniform(0, 200_000)] if busy else
                             [rng.uniform(0, 200_000)])
        if rng.random() < 0.2:
            seconds = round(seconds / 1860) * 1860
        rows.append(event(f"e{i:04d}", NOON + timedelta(seconds=seconds), visitor))
    found = {
        r.event_id: (r.session_id, r.event_number, r.seconds_to_next_event_in_session)
        for r in S.session_events(frame(spark, rows), width).collect()
    }
    assert found == brute_force(rows)
    by_session = {}
    for session_id, *_ in brute_force(rows).values():
        by_session[session_id] = by_session.get(session_id, 0) + 1
    assert {r.session_id for r in S.sessions(frame(spark, rows), width).collect()} == set(by_session)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_are_shuffled_once(spark, tmp_path):
    path = str(tmp_path / "events")
    frame(spark, [event("a", NOON)]).write.parquet(path)
    events = spark.read.schema(COLUMNS).parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(S.session_events(events))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    scans = [line for line in lines if "FileScan" in line]
    # one scan of the events and one of visitor and time
    assert len(scans) == 2 and any("ReadSchema: struct<fingerprint:string,request_time" in s for s in scans)
    # the events by (visitor, slot); the slot rows for aggregate, window and join
    assert sum("Exchange hashpartitioning" in line for line in lines) == 4
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [event("a", NOON), event("b", NOON + timedelta(days=1))]
    frame(spark, rows).write.partitionBy("date_day").parquet(path)
    events = spark.read.schema(COLUMNS).parquet(path)
    kept = S.complete_days(events, "2022-02-17", "2022-02-18")
    assert [r.event_id for r in kept.collect()] == ["a"]
    filters = plan_of(kept).split("PartitionFilters: ")[1].split("]")[0]
    assert "date_day" in filters


def test_busy_slots_are_cut_below_a_second(spark):
    """Results do not change; of a visitor's single second no slot holds much more than asked."""
    rng = random.Random(12)
    rows = [event(f"h{i:05d}", NOON + timedelta(microseconds=rng.randrange(900_000)), visitor="hot") for i in range(4000)]
    rows += [event(f"t{i}", NOON + timedelta(minutes=2), visitor="hot") for i in range(300)]  # one time
    rows += [event(f"e{i}", NOON + timedelta(seconds=rng.randrange(90_000)), visitor=f"v{i % 7}") for i in range(400)]
    rows += [event("n", NOON, visitor=None)]
    events = frame(spark, rows)
    plain = S.session_events(events)
    for most in (1, 50, 5000):
        cut = S.session_events(events, slot_events=most)
        assert cut.exceptAll(plain).count() == plain.exceptAll(cut).count() == 0
    slots = S._with_slot(events, 10, 50).where("fingerprint = 'hot'").groupBy("slot").count().collect()
    held = sorted(r["count"] for r in slots)
    # evenly spread times: about fifty each; those of one time stay together
    assert held[-1] == 300 and held[-2] < 150 and len(held) >= 40
    # the registered default counts nothing first
    assert "Join" not in S._with_slot(events, 10)._jdf.queryExecution().optimizedPlan().toString()


def test_a_million_events_of_one_second_are_many_slots(spark):
    events = spark.range(1_000_000).selectExpr(
        "cast(id as string) as event_id", "'hot' as fingerprint",
        "cast(timestamp_micros(1645099200000000 + id) as timestamp_ntz) as request_time",
    )
    slots = S._with_slot(events, 10, 10_000).groupBy("slot").count()
    assert slots.count() >= 50 and slots.agg(F.max("count")).collect()[0][0] <= 20_000
    assert S.sessions(events).count() == 1
    numbered = S.sessionise(events, 10, 10_000).agg(
        F.count_distinct("event_number").alias("n"), F.max("event_number").alias("last"), F.count("next_at").alias("next")
    ).collect()[0]
    assert (numbered.n, numbered.last, numbered.next) == (1_000_000, 1_000_000, 999_999)
