"""Sessions on a stream.

The state is one row per open session (first time, last time, count), never its events, and
windows of one task are merged before the shuffle; a very busy visitor therefore costs one
row, not one task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickstrata.functions.times import complete_units, with_parsed_time
from clickstrata.operators.sessions import (
    SESSION_EVENT_COLUMNS,
    SLOT_SECONDS,
    flat_events,
    time_slot,
)
from clickstrata.session import require_utc

#: Windows that touch are merged, so the gap is one microsecond short of 31 minutes: events
#: exactly 31 minutes apart are in two sessions, as in the batch form.
SESSION_GAP = "30 minutes 59.999999 seconds"

#: Events of one visitor that may meet a session in one task: those of so many seconds.
JOIN_SECONDS = 1800

#: From the first event of the longest session to the moment it counts as closed.
LONGEST = "INTERVAL '1 00:31:00' DAY TO SECOND"

#: How late an event may arrive and still be counted.
LATENESS = "1 hour"


def _closed_sessions(events: DataFrame, lateness: str) -> DataFrame:
    """Closed sessions with ``closed_at``, the event time of the row itself."""
    require_utc(events.sparkSession)
    return (
        events.where(F.col("fingerprint").isNotNull() & F.col("request_time").isNotNull())
        .select("fingerprint", F.col("request_time").cast("timestamp").alias("request_time"))
        .withWatermark("request_time", lateness)
        .groupBy(
            "fingerprint",
            F.to_date("request_time").alias("day"),
            F.session_window("request_time", SESSION_GAP),
        )
        .agg(
            F.min("request_time").alias("first_time"),
            F.max("request_time").alias("last_time"),
            F.count(F.lit(1)).alias("session_events"),
        )
        .select(
            "fingerprint",
            "day",
            F.col("first_time").cast("timestamp_ntz").alias("session_start_at"),
            F.col("last_time").cast("timestamp_ntz").alias("session_end_at"),
            "session_events",
            F.window_time("session_window").alias("closed_at"),
        )
    )


def sessions_stream(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Closed sessions of a stream: visitor, day, start, end, number of events.

    The event day is part of the key, which cuts sessions at UTC midnight. Rows come out once
    the watermark has passed the end of the session. Works on a batch too.
    """
    return _closed_sessions(events, lateness).drop("closed_at")


def _half_hour(time: Column) -> Column:
    return F.floor(F.unix_seconds(time.cast("timestamp")) / JOIN_SECONDS)


def session_events_stream(
    events: DataFrame, lateness: str = LATENESS, other: DataFrame | None = None
) -> DataFrame:
    """The events of closed sessions, each with the day, start and end of its session.

    Closed sessions of the stream meet its events in an interval join: same visitor and day,
    from the first to the last time of the session. Both sides have a watermark, and a session
    is shorter than a day, so an event waits in state until its session has closed, a day and
    ``lateness`` at most, and the rows come out in append mode, once. The join key also has the
    half hour of the event, so that a busy visitor's events are dealt to many tasks; a session
    is repeated for each half hour that it touches, 49 times at most.

    An event that comes after the watermark is in no session and moves none. ``other``: the same
    stream once more, if ``events`` cannot be read twice. Works on a batch too.
    """
    closed = _closed_sessions(events, lateness).withColumn(
        "half_hour",
        F.explode(
            F.sequence(
                _half_hour(F.col("session_start_at")), _half_hour(F.col("session_end_at"))
            )
        ),
    )
    closed = closed.select(*[F.col(c).alias(f"s_{c}") for c in closed.columns])
    at = F.col("request_time").cast("timestamp")
    flat = (
        flat_events(events if other is None else other)
        .where(F.col("fingerprint").isNotNull() & F.col("request_time").isNotNull())
        .withColumn("event_at", at)
        .withWatermark("event_at", lateness)
        .withColumns({"day": F.to_date("event_at"), "half_hour": _half_hour(F.col("event_at"))})
    )
    same = [F.col(c) == F.col(f"s_{c}") for c in ("fingerprint", "day", "half_hour")]
    inside = F.col("request_time").between(F.col("s_session_start_at"), F.col("s_session_end_at"))
    # what lets Spark drop events and sessions that can meet no more
    near = (F.col("event_at") <= F.col("s_closed_at")) & (
        F.col("event_at") >= F.col("s_closed_at") - F.expr(LONGEST)
    )
    joined = flat.join(closed, same[0] & same[1] & same[2] & inside & near)
    return joined.drop("event_at", "half_hour").select(
        *[c for c in flat.columns if c not in ("event_at", "half_hour")],
        F.col("s_session_start_at").alias("session_start_at"),
        F.col("s_session_end_at").alias("session_end_at"),
        F.col("s_session_events").alias("session_events"),
    )


def start_session_events(
    events: DataFrame,
    root: str,
    checkpoint: str,
    lateness: str = LATENESS,
    available_now: bool = False,
    other: DataFrame | None = None,
) -> StreamingQuery:
    """Start a query that appends the events of closed sessions under ``root/day=...``."""
    writer = (
        session_events_stream(events, lateness, other)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime="1 minute")
    return writer.start(root)


def start_sessions(
    events: DataFrame,
    root: str,
    checkpoint: str,
    lateness: str = LATENESS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query that appends closed sessions under ``root/day=...``."""
    writer = (
        sessions_stream(events, lateness)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime="1 minute")
    return writer.start(root)


def number_sessions(closed: DataFrame, *others: str) -> DataFrame:
    """Give stored sessions their ``session_id`` when they are read, beside ``others``.

    The number counts a visitor's sessions of a day, which is known only when the day is
    over. A day holds fewer than fifty sessions of one visitor, so the window is small.
    """
    in_day = W.partitionBy("fingerprint", "day").orderBy("session_start_at")
    return closed.withColumn(
        "session_id",
        F.concat_ws(
            "-",
            "fingerprint",
            F.col("day").cast("string"),
            F.row_number().over(in_day).cast("string"),
        ),
    ).select(
        "session_id",
        "fingerprint",
        "session_start_at",
        "session_end_at",
        "session_events",
        *others,
    )


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the query's recent batches left out because they came too late.

    A row is counted after its task has merged the windows of one visitor that touch.
    """
    return sum(
        int(state.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


def closed_session_events(
    closed: DataFrame, events: DataFrame, slot_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """The events of the sessions a stream has closed, as ``session_events`` gives them.

    Sessions are those of the stream: an event belongs to one if it is the same visitor's, of
    the same event day, and from its first to its last time. An event that came too late for
    the stream is in no session, or inside one, and never moves the others.

    ``events`` are stored events; days of arrival before the first closed day are not read.
    Waiting events in stream state until their session ends would hold a busy visitor's events
    in one task; the stored table has them already. A visitor's day has fewer than fifty
    sessions, which AQE repeats for the parts of a skewed visitor, and events are numbered
    within slots of time, as in the batch form.
    """
    found = number_sessions(closed, "day").select(
        "fingerprint",
        "day",
        "session_id",
        F.col("session_start_at").alias("starts"),
        F.col("session_end_at").alias("ends"),
    )
    first_day = closed.select(F.min("day").cast("string")).scalar()
    flat = with_parsed_time(flat_events(events.where(F.col("date_day") >= first_day)))
    matched = (
        flat.withColumn("day", F.to_date("request_time"))
        .join(found, ["fingerprint", "day"])
        .where(F.col("request_time").between(F.col("starts"), F.col("ends")))
    )
    return _number_events(matched, slot_seconds)


def number_session_events(stored: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """What ``start_session_events`` stored, in the form of ``session_events``.

    Only stored rows are read: no event table, and none of the days that are not asked for.
    """
    key = ["fingerprint", "day", "session_start_at"]
    closed = stored.groupBy(*key).agg(
        F.min("session_end_at").alias("session_end_at"),
        F.min("session_events").alias("session_events"),
    )
    found = number_sessions(closed, "day").select(*key, "session_id")
    return _number_events(with_parsed_time(stored).join(found, key), slot_seconds)


def _number_events(matched: DataFrame, slot_seconds: int) -> DataFrame:
    """Number the events of each session within slots of time, as the batch form does."""
    matched = matched.withColumn("slot", time_slot(F.col("request_time"), slot_seconds))
    in_order = W.partitionBy("session_id").orderBy("slot")
    slots = (
        matched.groupBy("session_id", "slot")
        .agg(F.min("request_time").alias("first_time"), F.count(F.lit(1)).alias("slot_events"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("slot_events").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn("following", F.lead("first_time").over(in_order))
    )
    in_slot = W.partitionBy("session_id", "slot").orderBy("request_time", "event_id")
    next_time = F.coalesce(F.col("next_in_slot"), F.col("following"))
    return (
        matched.withColumn("number", F.row_number().over(in_slot))
        .withColumn("next_in_slot", F.lead("request_time").over(in_slot))
        .join(slots.drop("first_time"), ["session_id", "slot"])
        .withColumn("event_number", (F.col("before") + F.col("number")).cast("bigint"))
        .withColumn(
            "seconds_to_next_event_in_session",
            complete_units("SECOND", F.col("request_time"), next_time),
        )
        .withColumn("week", F.weekofyear(F.col("date_day").cast("date")).cast("bigint"))
        .select(*SESSION_EVENT_COLUMNS)
    )
