"""Derive the columns the metrics share, and one row per visitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.times import with_parsed_time
from clickstrata.functions.urls import clean_url, from_facebook

#: Columns that ``prepare_events`` adds to the session events.
PREPARED_COLUMNS = (
    "hour",
    "from_fb",
    "clean_url",
    "event_number_reverse",
    "first_session_event",
    "last_session_event",
)

#: Events of one session that may share a join key when session sizes are looked up.
_SIZE_BLOCK = 1_000_000


def _with_session_size(session_events: DataFrame) -> DataFrame:
    """Look up the size of each session.

    The join key is (session, block of event numbers), and a session's size is repeated once
    per block, so no key holds more than a block of events however long the session is.
    """
    sizes = (
        session_events.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.max("event_number").alias("session_events"))
        .select(
            "session_id",
            "session_events",
            F.explode(
                F.sequence(F.lit(0).cast("bigint"), F.expr(f"session_events div {_SIZE_BLOCK}"))
            ).alias("block"),
        )
    )
    return (
        session_events.withColumn("block", F.expr(f"event_number div {_SIZE_BLOCK}"))
        .join(sizes, ["session_id", "block"], "left")
        .drop("block")
    )


def prepare_events(session_events: DataFrame) -> DataFrame:
    """Add hour, Facebook mark, clean address and position from the end of the session."""
    columns = [c for c in session_events.columns if c != "session_events"]
    events = with_parsed_time(session_events)
    if "session_events" not in session_events.columns:
        events = _with_session_size(events)
    reverse = F.col("session_events") - F.col("event_number") + 1
    return events.select(
        *columns,
        F.hour("request_time").alias("hour"),
        from_facebook(F.col("from_url")).alias("from_fb"),
        clean_url(F.col("from_url")).alias("clean_url"),
        reverse.cast("int").alias("event_number_reverse"),
        (F.col("event_number") == 1).cast("int").alias("first_session_event"),
        (reverse == 1).cast("int").alias("last_session_event"),
    )


def unique_visitors(
    prepared: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per visitor: for every column its first value that is not null.

    Columns of one row may thus come from different events; ``date_day`` is the day on
    which the visitor was first seen. Among a visitor's events with the same columns null,
    only the first one can contribute, so the events are first reduced to one whole row per
    (visitor, null pattern), before the shuffle, and then merged column by column.
    """
    if columns is None:
        columns = [c for c in prepared.columns if c != "fingerprint"]
    order = ["request_time", "event_id"]
    row = F.struct(*order, *[c for c in columns if c not in order])
    pattern = F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in columns])
    first_rows = (
        prepared.where(F.col("fingerprint").isNotNull())
        .groupBy("fingerprint", pattern.alias("null_pattern"))
        .agg(F.min(row).alias("first"))
        .select("fingerprint", "first.*")
    )
    firsts = [
        F.expr(
            f"min_by(`{c}`, struct(request_time, event_id)) FILTER (WHERE `{c}` IS NOT NULL)"
        ).alias(c)
        for c in columns
    ]
    return first_rows.groupBy("fingerprint").agg(*firsts)
