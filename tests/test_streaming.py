"""The streaming forms give what the batch forms give."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickstrata.operators import places, sessions
from clickstrata.plans.ingest import delivered, ingest_events
from clickstrata.sources import sample_site
from clickstrata.sources.tables import read_events
from clickstrata.streaming.ingest import OUTCOMES, start_ingest
from clickstrata.streaming.sessions import (
    closed_session_events,
    dropped_late,
    number_session_events,
    number_sessions,
    session_events_stream,
    sessions_stream,
    start_session_events,
    start_sessions,
)
from tests.test_sessions import NOON, event, frame

SF_DIR = "/root/testdata/sf0.001"


def test_ingest_stream_equals_batch(spark, tmp_path):
    table = places.place_tree(places.disjoint_places(sample_site.address_blocks(spark, SF_DIR)))
    records = sample_site.raw_envelopes(spark, SF_DIR)
    batch = delivered(ingest_events(records, table, arrival=F.col("arrived_at")))
    source, root, state = (str(tmp_path / n) for n in ("raw", "events", "state"))
    records.repartition(3, "data").write.parquet(source)

    def run():
        stream = (
            spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 2).parquet(source)
        )
        query = start_ingest(
            stream, table, root, state, arrival=F.col("arrived_at"), available_now=True
        )
        query.awaitTermination()
        return [p.observedMetrics[OUTCOMES] for p in query.recentProgress if p.observedMetrics]

    counted = run()
    wanted = batch.groupBy("result").count().collect()
    by_result = {r["result"]: r["count"] for r in wanted}
    assert set(by_result) == {"success", "not-base64", "not-utf8", "not-json", "incomplete"}
    assert sum(c["success"] for c in counted) == by_result["success"]
    assert sum(c["failed"] for c in counted) == batch.count() - by_result["success"]
    assert sum(c["dropped"] for c in counted) == records.count() - batch.count()
    columns = batch.columns
    stored = spark.read.parquet(root).withColumn("date_day", F.col("date_day").cast("string"))
    assert sorted(stored.select(columns).collect(), key=str) == sorted(batch.collect(), key=str)
    # a restart neither loses nor repeats records
    run()
    assert read_events(spark, root).count() == by_result["success"]


def test_sessions_stream_equals_batch(spark):
    stream = entry.sessions_stream(spark, SF_DIR)
    events = entry._events(spark, SF_DIR)
    batch = sessions.sessions(events)
    sizes = sessions.session_events(events).groupBy("session_id").agg(
        F.count(F.lit(1)).alias("session_events")
    )
    expected = batch.join(sizes, "session_id").select(*stream.columns)
    assert stream.count() > 800
    assert sorted(stream.collect()) == sorted(expected.collect())


def test_events_of_closed_sessions_only(spark):
    events = frame(spark, [event("a", NOON), event("b", NOON + timedelta(hours=1))])
    closed = sessions_stream(events).where(F.col("session_start_at") == F.lit(NOON))
    assert [r.event_id for r in closed_session_events(closed, events).collect()] == ["a"]


@pytest.mark.parametrize(
    "gap, count", [(timedelta(minutes=30, microseconds=59_999_999), 1), (timedelta(minutes=31), 2)]
)
def test_stream_gap_boundary(spark, gap, count):
    events = frame(spark, [event("a", NOON), event("b", NOON + gap)])
    found = number_sessions(sessions_stream(events)).collect()
    assert len(found) == count
    assert {r.session_id for r in found} == {r.session_id for r in sessions.sessions(events).collect()}


def test_stream_over_several_batches(spark, tmp_path):
    """A session that spans micro-batches is one session; a restart goes on from its state."""
    source, root, state = (str(tmp_path / n) for n in ("visits", "out", "state"))
    batches = [
        [event("a", NOON), event("b", NOON + timedelta(minutes=20), visitor="w")],
        [event("c", NOON + timedelta(minutes=25)), event("d", NOON + timedelta(minutes=50))],
        [event("x", NOON + timedelta(days=3), visitor="mark")],
    ]
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame(spark, []).schema).parquet(source)
        start_sessions(stream, root, state, available_now=True).awaitTermination()
    found = number_sessions(spark.read.parquet(root)).collect()
    assert {r.fingerprint: (r.session_start_at, r.session_end_at, r.session_events) for r in found} == {
        "v": (NOON, NOON + timedelta(minutes=50), 3),
        "w": (NOON + timedelta(minutes=20), NOON + timedelta(minutes=20), 1),
    }


def test_late_event_does_not_move_closed_sessions(spark):
    """The stream closed 12:00 and 13:00; an event of 11:00 is only in the stored table."""
    on_time = [event("a", NOON), event("b", NOON + timedelta(hours=1))]
    late = event("late", NOON - timedelta(hours=1))
    closed = sessions_stream(frame(spark, on_time))
    found = closed_session_events(closed, frame(spark, [*on_time, late])).collect()
    assert {r.event_id: (r.session_id, r.event_number) for r in found} == {
        "a": ("v-2022-02-17-1", 1),
        "b": ("v-2022-02-17-2", 1),
    }


def test_dropped_late_rows_are_counted(spark, tmp_path):
    source, root, state = (str(tmp_path / n) for n in ("visits", "out", "state"))
    batches = [
        [event("a", NOON)],
        [event("x", NOON + timedelta(days=3), visitor="mark")],
        [event("late", NOON - timedelta(hours=1)), event("y", NOON + timedelta(days=3))],
    ]
    counts = []
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame(spark, []).schema).parquet(source)
        query = start_sessions(stream, root, state, available_now=True)
        query.awaitTermination()
        counts.append(dropped_late(query))
    assert counts == [0, 0, 1]


def run_events(spark, batches, tmp_path):
    """The stream's query started anew, from its checkpoint, for each batch of events."""
    source, root, state = (str(tmp_path / n) for n in ("events", "out", "state"))
    counts, none = [], frame(spark, [])
    reader = spark.read.schema(session_events_stream(none, other=frame(spark, [])).schema)
    for rows in batches:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(none.schema).parquet(source)
        start_session_events(stream, root, state, available_now=True).awaitTermination()
        counts.append(reader.parquet(root).count())
    return reader.parquet(root), counts


def test_events_wait_for_their_session_across_restarts(spark, tmp_path):
    """Events come out once, when their session has closed, as the batch form numbers them."""
    first = [event("a", NOON), event("b", NOON + timedelta(minutes=20)), event("o", NOON, visitor="w")]
    second = [event("c", NOON + timedelta(minutes=45)), event("d", NOON + timedelta(minutes=45)), event("n", NOON, visitor=None)]
    other = [event("e", NOON + timedelta(hours=3)), event("f", NOON + timedelta(hours=3, seconds=5))]
    mark = [event("x", NOON + timedelta(days=3), visitor="mark")]
    stored, counts = run_events(spark, [first, second, other, mark], tmp_path)
    # at 15:00, with an hour of lateness, the sessions of noon have closed
    assert counts == [0, 0, 5, 7]
    found = number_session_events(stored)
    expected = sessions.session_events(frame(spark, [*first, *second, *other]))
    assert found.columns == expected.columns
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)


def test_late_events_are_in_no_streamed_session(spark, tmp_path):
    on_time = [event("a", NOON), event("b", NOON + timedelta(minutes=10)), event("c", NOON + timedelta(hours=1))]
    mark = [event("x", NOON + timedelta(days=3), visitor="mark")]
    late = [event("inside", NOON + timedelta(minutes=5)), event("between", NOON + timedelta(minutes=30)), event("new", NOON, visitor="z")]
    stored, counts = run_events(spark, [on_time, mark, late, [event("y", NOON + timedelta(days=3, hours=1), visitor="mark")]], tmp_path)
    assert counts == [0, 3, 3, 3]
    found = {r.event_id: (r.session_id, r.event_number) for r in number_session_events(stored).collect()}
    assert found == {"a": ("v-2022-02-17-1", 1), "b": ("v-2022-02-17-1", 2), "c": ("v-2022-02-17-2", 1)}


def test_stream_of_events_as_a_batch(spark):
    """A session over midnight is cut; a busy visitor's half hours have keys of their own."""
    rows = [event(f"e{i}", NOON + timedelta(minutes=11 * i)) for i in range(150)]
    rows += [event("n", None, date_day="2022-02-17"), event("m", NOON, visitor=None)]
    events = frame(spark, rows)
    found = number_session_events(session_events_stream(events, other=frame(spark, rows)))
    expected = sessions.session_events(events)
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    assert found.select("session_id").distinct().count() == 2


def test_sample_stream_equals_batch(spark):
    events = entry._events(spark, SF_DIR)
    found = entry.sessions_stream_events(spark, SF_DIR)
    assert sorted(found.collect(), key=str) == sorted(sessions.session_events(events).collect(), key=str)
    assert not [r for r in found.collect() if r.event_id.startswith("late")]
