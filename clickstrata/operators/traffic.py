"""Traffic over days, hours, weekdays and weeks, and figures per session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.times import iso_week
from clickstrata.operators import sketches
from clickstrata.operators.profiles import session_profile

# Weekday names in the reports, Monday first.
WEEKDAY_NAMES = ("Måndag", "Tisdag", "Onsdag", "Torsdag", "Fredag", "Lördag", "Söndag")


def of_types(events: DataFrame, event_types: Sequence[str] | None) -> DataFrame:
    """Keep some event types; by default a click counts as a pageview, like any event."""
    if event_types is None:
        return events
    return events.where(F.col("event_type").isin(*event_types))


def traffic_daily(
    prepared: DataFrame, event_types: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Per arrival day: weekday (Monday = 0), pageviews, sessions started, visitors.

    Visitors are counted from (day, visitor) rows, so the shuffle carries each visitor of a
    day once per task. A day on which no session started has null sessions. ``approximate``
    estimates the visitors from sketches instead (``operators.sketches`` states the error).
    """
    if approximate:
        return sketches.traffic_daily(sketches.event_sketches(of_types(prepared, event_types)))
    per_visitor = (
        of_types(prepared, event_types)
        .where(F.col("date_day").isNotNull())
        .groupBy("date_day", "fingerprint")
        .agg(
            F.count("event_id").alias("pageviews"),
            F.count_if(F.col("event_number") == 1).alias("sessions"),
        )
    )
    return (
        per_visitor.groupBy("date_day")
        .agg(
            F.sum("pageviews").alias("pageviews"),
            F.nullif(F.sum("sessions"), F.lit(0).cast("bigint")).alias("sessions"),
            F.count("fingerprint").alias("visitors"),
        )
        .select(
            "date_day",
            F.weekday(F.col("date_day").cast("date")).alias("weekday"),
            "pageviews",
            "sessions",
            "visitors",
        )
        .orderBy("date_day")
    )


def traffic_hourly(
    prepared: DataFrame, event_types: Sequence[str] | None = None
) -> DataFrame:
    """Per UTC hour: mean pageviews and mean sessions started.

    Each mean is over the days that have the hour (for sessions: a session start in it).
    All 24 hours come out; an hour without data has nulls.
    """
    per_day = (
        of_types(prepared, event_types)
        .where(F.col("date_day").isNotNull() & F.col("hour").isNotNull())
        .groupBy("date_day", "hour")
        .agg(
            F.count("event_id").alias("pageviews"),
            F.count_if(F.col("event_number") == 1).alias("sessions"),
        )
    )
    means = per_day.groupBy("hour").agg(
        F.avg("pageviews").alias("pageviews"),
        F.avg(F.nullif(F.col("sessions"), F.lit(0).cast("bigint"))).alias("sessions"),
    )
    hours = prepared.sparkSession.range(24, numPartitions=1).select(
        F.col("id").cast("int").alias("hour")
    )
    return hours.join(means, "hour", "left").orderBy("hour")


def traffic_weekday(daily: DataFrame) -> DataFrame:
    """Per weekday: median and mean of the daily figures, from ``traffic_daily``.

    The medians are what the reports show. All seven weekdays come out.
    """
    figures = [
        aggregate(name).alias(f"{prefix}{name}")
        for prefix, aggregate in (("", F.median), ("mean_", F.avg))
        for name in ("pageviews", "sessions", "visitors")
    ]
    stats = daily.groupBy("weekday").agg(*figures)
    names = F.array(*[F.lit(name) for name in WEEKDAY_NAMES])
    weekdays = daily.sparkSession.range(7, numPartitions=1).select(
        F.col("id").cast("int").alias("weekday"),
        F.get(names, F.col("id").cast("int")).alias("weekday_name"),
    )
    return weekdays.join(stats, "weekday", "left").orderBy("weekday")


def traffic_weekly(
    prepared: DataFrame, event_types: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Per ISO week of arrival: pageviews, sessions and visitors.

    Distinct counts are nested group-bys (a session belongs to one visitor): each level is
    combined before its shuffle, and no row is multiplied. ``approximate`` estimates sessions
    and visitors from sketches instead (``operators.sketches`` states the error).
    """
    if approximate:
        return sketches.traffic_weekly(sketches.event_sketches(of_types(prepared, event_types)))
    week = iso_week(F.col("date_day"))
    return (
        of_types(prepared, event_types)
        .where(F.col("date_day").isNotNull())
        .groupBy(*week, "fingerprint", "session_id")
        .agg(F.count("event_id").alias("pageviews"))
        .groupBy("year", "week", "fingerprint")
        .agg(F.sum("pageviews").alias("pageviews"), F.count("session_id").alias("sessions"))
        .groupBy("year", "week")
        .agg(
            F.sum("pageviews").alias("pageviews"),
            F.sum("sessions").alias("sessions"),
            F.count("fingerprint").alias("visitors"),
        )
        .orderBy("year", "week")
    )


def session_stats(prepared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Five figures per session: one row, or one per value of ``keys``."""
    return session_figures(session_profile(prepared, keys), keys)


def session_figures(profile: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The columns of ``session_stats``, of a ``session_profile``."""
    return profile.select(
        *keys,
        "one_event_session_ratio",
        "avg_events_per_session",
        "avg_events_per_multievent_sessions",
        "median_time_per_page",
        "median_session_time",
    )
