"""Cut events into visitor sessions.

A session ends after more than 30 complete minutes without an event, or at UTC midnight.

How it scales. One visitor key may hold a large part of all rows (many people behind one
address and agent), so no step sorts or collects all events of a visitor, or even of one of
their days. Time is cut into short slots instead, narrower than the inactivity limit. Inside a
slot no session can start except at its first event, so everything about sessions follows
from one small row per (visitor, slot): first time, last time, count. That is a plain
aggregate, combined before the shuffle, and a day has a fixed number of slots; the windows
over a visitor's day therefore have a fixed upper size. Events themselves are shuffled once,
by (visitor, slot), and numbered inside their slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.functions.times import (
    MICROS_PER_SECOND,
    complete_units,
    micros,
    with_parsed_time,
)

#: A gap of more complete minutes than this starts a session.
INACTIVITY_MINUTES = 30

#: Width of a slot. Any divisor of a day up to the inactivity limit gives the same result;
#: a narrow slot keeps the share of a very busy visitor that one task sorts small.
SLOT_SECONDS = 10

_DAY_SECONDS = 86_400

#: Columns of the session table.
SESSION_COLUMNS = ("session_id", "fingerprint", "session_start_at", "session_end_at")

#: Columns of the session events, in stored order.
SESSION_EVENT_COLUMNS = (
    "event_id",
    "fingerprint",
    "request_time",
    "event_type",
    "from_url",
    "session_id",
    "event_number",
    "details",
    "browser",
    "device_type",
    "operating_system",
    "city",
    "country",
    "seconds_to_next_event_in_session",
    "week",
    "date_day",
)


def complete_days(events: DataFrame, start: str, as_of: str) -> DataFrame:
    """Events that arrived in ``[start, as_of)``.

    ``as_of`` is the current, unfinished day. Text comparison on the partition column prunes
    partitions without a cast.
    """
    return events.where((F.col("date_day") >= start) & (F.col("date_day") < as_of))


def _check_slot(slot_seconds: int) -> None:
    if not 0 < slot_seconds <= INACTIVITY_MINUTES * 60 or _DAY_SECONDS % slot_seconds:
        raise ValueError("slot_seconds must divide a day and not exceed the inactivity limit")


def time_slot(time: Column, slot_seconds: int) -> Column:
    """Start of the slot of a time, in microseconds."""
    width = slot_seconds * MICROS_PER_SECOND
    return micros(time) - F.pmod(micros(time), F.lit(width))


def _with_slot(
    events: DataFrame, slot_seconds: int, slot_events: int | None = None
) -> DataFrame:
    """Events of known visitors, with the start of their slot.

    Where a slot of one visitor has more than ``slot_events`` events, the time from its first to
    its last event is cut into as many slots as would hold so many each, down to a microsecond.
    That takes a count of the events first; there are fewer such slots than events divided by
    ``slot_events``.
    """
    _check_slot(slot_seconds)
    slotted = (
        with_parsed_time(events)
        .where(F.col("fingerprint").isNotNull() & F.col("request_time").isNotNull())
        .withColumn("slot", time_slot(F.col("request_time"), slot_seconds))
    )
    if slot_events is None:
        return slotted
    span = micros(F.max("request_time")) - micros(F.min("request_time"))
    busy = (
        slotted.groupBy("fingerprint", "slot")
        .agg(F.count(F.lit(1)).alias("n"), span.alias("span"))
        .where(F.col("n") > slot_events)
        .select(
            "fingerprint", "slot", F.expr(f"span div (n div {slot_events} + 1) + 1").alias("width")
        )
    )
    inside = micros(F.col("request_time")) - F.col("slot")
    start = F.col("slot") + inside - F.pmod(inside, F.col("width"))
    return (
        slotted.join(busy, ["fingerprint", "slot"], "left")
        .withColumn("slot", F.coalesce(start, F.col("slot")))
        .select(*slotted.columns)
    )


def _sessions_by_slot(slotted: DataFrame) -> DataFrame:
    """One row per (visitor, slot) with what the slot's events need to know of the others."""
    slots = slotted.groupBy("fingerprint", "slot").agg(
        F.min("request_time").alias("first_time"),
        F.max("request_time").alias("last_time"),
        F.count(F.lit(1)).alias("slot_events"),
    )
    day = W.partitionBy("fingerprint", "day").orderBy("slot")
    session = W.partitionBy("fingerprint", "day", "session_number")
    in_order = session.orderBy("slot")
    gap = complete_units("MINUTE", F.col("previous_time"), F.col("first_time"))
    starts = F.col("previous_time").isNull() | (gap > INACTIVITY_MINUTES)
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    return (
        slots.withColumn("day", F.to_date("first_time"))
        .withColumn("previous_time", F.lag("last_time").over(day))
        .withColumn("session_number", F.sum(starts.cast("int")).over(day))
        .withColumns(
            {
                "events_before": F.coalesce(F.sum("slot_events").over(before), F.lit(0)),
                "following_time": F.lead("first_time").over(in_order),
                "session_events": F.sum("slot_events").over(session),
            }
        )
    )


def _session_id() -> Column:
    return F.concat_ws(
        "-",
        F.col("fingerprint"),
        F.col("day").cast("string"),
        F.col("session_number").cast("string"),
    )


def sessionise(
    events: DataFrame, slot_seconds: int = SLOT_SECONDS, slot_events: int | None = None
) -> DataFrame:
    """Add session columns to every event of a known visitor.

    Adds ``day`` and ``session_number``, ``session_id``, ``event_number`` (1-based),
    ``session_events`` (events of the whole session), ``previous_at`` (the visitor's previous
    event that day) and ``next_at`` (the next event of the session). Equal times are ordered
    by ``event_id``. With ``slot_events``, no task has to sort more than about so many events of
    one visitor, unless they have the very same time; the result does not change.
    """
    slotted = _with_slot(events, slot_seconds, slot_events)
    in_slot = W.partitionBy("fingerprint", "slot").orderBy("request_time", "event_id")
    numbered = slotted.withColumns(
        {
            "number_in_slot": F.row_number().over(in_slot),
            "previous_in_slot": F.lag("request_time").over(in_slot),
            "next_in_slot": F.lead("request_time").over(in_slot),
        }
    )
    slots = _sessions_by_slot(slotted.select("fingerprint", "request_time", "slot"))
    return numbered.join(slots, ["fingerprint", "slot"]).select(
        *events.columns,
        "day",
        "session_number",
        _session_id().alias("session_id"),
        (F.col("events_before") + F.col("number_in_slot")).alias("event_number"),
        "session_events",
        F.coalesce("previous_in_slot", "previous_time").alias("previous_at"),
        F.coalesce("next_in_slot", "following_time").alias("next_at"),
    )


def inactivity_gaps(
    events: DataFrame, slot_seconds: int = SLOT_SECONDS, slot_events: int | None = None
) -> DataFrame:
    """Events with ``inactivity_time``: complete minutes since the visitor's previous event
    of the same event day; null on the first."""
    gap = complete_units("MINUTE", F.col("previous_at"), F.col("request_time"))
    return sessionise(events, slot_seconds, slot_events).select(
        *events.columns, gap.alias("inactivity_time")
    )


def session_starts(
    events: DataFrame, slot_seconds: int = SLOT_SECONDS, slot_events: int | None = None
) -> DataFrame:
    """The events that open a session.

    ``next_session_start_at`` is the visitor's next session on any day, else the midnight
    that ends this one. A visitor has at most some fifty starts a day, so the window over
    them stays small.
    """
    by_visitor = W.partitionBy("fingerprint").orderBy("request_time")
    midnight = F.date_add("day", 1).cast("timestamp_ntz")
    return (
        sessionise(events, slot_seconds, slot_events)
        .where(F.col("event_number") == 1)
        .select(
            "event_id",
            "fingerprint",
            F.col("request_time").alias("session_start_at"),
            "session_id",
            F.coalesce(F.lead("request_time").over(by_visitor), midnight).alias(
                "next_session_start_at"
            ),
        )
    )


def sessions(events: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """One row per session. Needs the slots only: no event is shuffled."""
    slotted = _with_slot(events, slot_seconds).select("fingerprint", "request_time", "slot")
    return (
        _sessions_by_slot(slotted)
        .groupBy("fingerprint", "day", "session_number")
        .agg(
            F.min("first_time").alias("session_start_at"),
            F.max("last_time").alias("session_end_at"),
        )
        .withColumn("session_id", _session_id())
        .select(*SESSION_COLUMNS)
    )


def flat_events(events: DataFrame) -> DataFrame:
    """Events with the values that reports use read out of their JSON columns."""
    return events.select(
        "event_id",
        "fingerprint",
        "request_time",
        "event_type",
        "from_url",
        "details",
        F.get_json_object("user_data", "$.browser").alias("browser"),
        F.get_json_object("user_data", "$.device_type").alias("device_type"),
        F.get_json_object("user_data", "$.operating_system").alias("operating_system"),
        F.get_json_object("geoip", "$.city").alias("city"),
        F.get_json_object("geoip", "$.country.name").alias("country"),
        "date_day",
    )


def session_details(
    events: DataFrame, slot_seconds: int = SLOT_SECONDS, slot_events: int | None = None
) -> DataFrame:
    """Session events plus ``session_events``, the number of events of the whole session.

    That number lets ``prepare_events`` count backwards without another shuffle. JSON is read
    before the shuffle, which then carries five short values instead of two documents.
    """
    derived = {
        "event_number": F.col("event_number").cast("bigint"),
        "seconds_to_next_event_in_session": complete_units(
            "SECOND", F.col("request_time"), F.col("next_at")
        ),
        "week": F.weekofyear(F.col("date_day").cast("date")).cast("bigint"),
    }
    return (
        sessionise(flat_events(events), slot_seconds, slot_events)
        .withColumns(derived)
        .select(*SESSION_EVENT_COLUMNS, "session_events")
    )


def session_events(
    events: DataFrame, slot_seconds: int = SLOT_SECONDS, slot_events: int | None = None
) -> DataFrame:
    """Every event with its session: the sixteen stored columns."""
    return session_details(events, slot_seconds, slot_events).select(*SESSION_EVENT_COLUMNS)
