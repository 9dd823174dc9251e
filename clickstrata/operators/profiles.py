"""Figures per group of events: counts, distinct counts and exact medians.

Groups are pages, devices, motions or everything, so one group may hold most of the rows. No
step brings a group together before it has been reduced:

* pageviews by waiting time, and by (visitor, session), are aggregated in one pass with
  ``GROUPING SETS`` and combined before the shuffle;
* distinct sessions and visitors are nested group-bys over those rows;
* the median waiting time comes from a histogram. Waiting times are whole seconds within a
  session, so a group has at most as many entries as the inactivity limit has seconds;
* the median session time has microsecond values, so its histogram is searched in two steps
  of fixed size (``exact_median``). The histogram is made once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickstrata.functions.ratios import percent, round2
from clickstrata.functions.times import MICROS_PER_SECOND, micros

_SECONDS = "seconds_to_next_event_in_session"
_COUNTS = ("pageviews", "from_facebook", "entries", "exits")
_SESSION_COUNTS = ("sessions", "one_event_sessions", "multi_event_sessions", "multi_event_pageviews")


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all known; a null key forms no group."""
    return reduce(lambda rows, key: rows.where(F.col(key).isNotNull()), keys, df)


def _reduced(
    prepared: DataFrame, keys: list[str], times: bool, all_of: str | None = None
) -> DataFrame:
    """Events by (key, waiting time) and by (key, visitor, session), in one pass.

    ``all_of`` names a key of text: there are also groups over all its values, known or not, in
    which it is empty and ``over_all`` true.

    ``times`` adds the first and the last time of each.
    """
    others = [k for k in keys if k != all_of]
    events = with_keys(prepared, others)
    ends = [F.min("request_time").alias("first"), F.max("request_time").alias("last")]
    sets = [
        [*some, *detail]
        for some in ([keys] if all_of is None else [keys, others])
        for detail in ([_SECONDS], ["fingerprint", "session_id"])
    ]
    whole = [] if all_of is None else [(F.grouping(all_of) == 1).alias("over_all")]
    reduced = events.groupingSets(sets, *keys, _SECONDS, "fingerprint", "session_id").agg(
        (F.grouping("session_id") == 1).alias("by_time"),
        *whole,
        F.count(F.lit(1)).alias("rows"),
        F.count("event_id").alias("pageviews"),
        F.sum("from_fb").alias("from_facebook"),
        F.sum("first_session_event").alias("entries"),
        F.sum("last_session_event").alias("exits"),
        *(ends if times else []),
    )
    if all_of is not None:
        known = F.col("over_all") | F.col(all_of).isNotNull()
        reduced = reduced.where(known).withColumn(all_of, F.coalesce(all_of, F.lit("")))
    return reduced


def _marked(keys: Sequence[str], all_of: str | None) -> list[str]:
    return [*keys] if all_of is None else [*keys, "over_all"]


def group_profile(
    prepared: DataFrame, keys: Sequence[str], all_of: str | None = None
) -> DataFrame:
    """One row per key: median seconds to the next event, pageviews, sessions, visitors,
    Facebook arrivals, entries, exits, and sessions by number of events.

    With ``all_of``, one of the keys, the same pass also gives the figures over all its values:
    rows with ``over_all`` true, in which that key is empty.
    """
    reduced = _reduced(prepared, list(keys), times=False, all_of=all_of)
    return _profile(reduced, _marked(keys, all_of))


def _profile(reduced: DataFrame, keys: list[str]) -> DataFrame:
    # events without a session id are events, but no session
    in_session = ~F.col("by_time") & F.col("session_id").isNotNull()
    several = in_session & (F.col("pageviews") > 1)
    per_visitor = reduced.groupBy(*keys, "by_time", _SECONDS, "fingerprint").agg(
        *_sums("rows", *_COUNTS),
        F.count("session_id").alias("sessions"),
        F.count_if(in_session & (F.col("pageviews") == 1)).alias("one_event_sessions"),
        F.count_if(several).alias("multi_event_sessions"),
        F.sum(F.when(several, F.col("pageviews")).otherwise(0)).alias("multi_event_pageviews"),
    )
    per_time = per_visitor.groupBy(*keys, "by_time", _SECONDS).agg(
        *_sums("rows", *_COUNTS, *_SESSION_COUNTS),
        F.count("fingerprint").alias("visitors"),
    )
    # every event is in both sets: take event counts from the first, session counts from
    # the second
    by_time = F.col("by_time")
    return per_time.groupBy(*keys).agg(
        F.percentile(_SECONDS, 0.5, F.when(by_time, F.col("rows"))).alias("median_seconds"),
        *[F.sum(F.when(by_time, F.col(c))).alias(c) for c in _COUNTS],
        *[F.sum(F.when(~by_time, F.col(c))).alias(c) for c in (*_SESSION_COUNTS, "visitors")],
    )


def _sums(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def _join_known(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on keys that are known on both sides.

    A plain join would filter its inputs for known keys once more, ahead of what they are made
    of, and so make two inputs of the one histogram.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    return left.join(renamed, same, how).drop(*(f"_right_{k}" for k in keys))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, width: int) -> DataFrame:
    """Exact median of a bigint column per key, without gathering the values of a key.

    A histogram over the distinct values is shuffled once by (key, value). Its sums per
    bucket of ``width`` values locate the middle ranks; then only the one or two buckets that
    hold them are ranked by value. The first window has a row per bucket, the second at most
    ``width``: choose the width so that both fit a task. Without keys they are single windows
    of that size.
    """
    keys = list(keys)
    histogram = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.expr(f"`{value}` div {width}"))
    )
    per_key = W.partitionBy(*keys)
    total = F.sum("bucket_n").over(per_key)
    located = (
        histogram.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .withColumn("lower_rank", F.floor((total + 1) / 2))
        .withColumn("upper_rank", F.floor(total / 2) + 1)
        .withColumn("reached", F.sum("bucket_n").over(per_key.orderBy("bucket")))
        .withColumn("before", F.col("reached") - F.col("bucket_n"))
        .where(
            (F.col("reached") >= F.col("lower_rank"))
            & (F.col("before") < F.col("upper_rank"))
        )
        .select(*keys, "bucket", "before", "lower_rank", "upper_rank")
    )
    in_bucket = W.partitionBy(*keys, "bucket").orderBy(value)
    ranked = _join_known(histogram, located, [*keys, "bucket"]).withColumn(
        "rank", F.col("before") + F.sum("n").over(in_bucket)
    )
    at = {
        name: F.min(F.when(F.col("rank") >= F.col(f"{name}_rank"), F.col(value)))
        for name in ("lower", "upper")
    }
    return ranked.groupBy(*keys).agg(((at["lower"] + at["upper"]) / 2).alias("median"))


def _median_session_seconds(reduced: DataFrame, keys: list[str]) -> DataFrame:
    """Median time from first to last event over sessions with several events."""
    in_session = ~F.col("by_time") & F.col("session_id").isNotNull()
    durations = reduced.where(in_session & (F.col("pageviews") > 1)).select(
        *keys, (micros(F.col("last")) - micros(F.col("first"))).alias("duration")
    )
    return exact_median(durations, keys, "duration", MICROS_PER_SECOND).select(
        *keys, (F.col("median") / MICROS_PER_SECOND).alias("median_session_seconds")
    )


def session_profile(
    prepared: DataFrame, keys: Sequence[str], all_of: str | None = None
) -> DataFrame:
    """``group_profile`` with the five figures per session, all at two decimals.

    The session time adds the rounded time per page, which stands for the unseen time on the
    last page.
    """
    reduced = _reduced(prepared, list(keys), times=True, all_of=all_of)
    keys = _marked(keys, all_of)
    profile = _profile(reduced, keys)
    durations = _median_session_seconds(reduced, keys)
    if keys:
        profile = _join_known(profile, durations, keys, "left")
    else:
        only = durations.select(F.max("median_session_seconds")).scalar()
        profile = profile.withColumn("median_session_seconds", only)
    page_time = round2(F.col("median_seconds"))
    return profile.withColumns(
        {
            "one_event_session_ratio": round2(percent("one_event_sessions", "sessions")),
            "avg_events_per_session": round2(
                F.try_divide(
                    F.col("one_event_sessions") + F.col("multi_event_pageviews"), "sessions"
                )
            ),
            "avg_events_per_multievent_sessions": round2(
                F.try_divide("multi_event_pageviews", "multi_event_sessions")
            ),
            "median_time_per_page": page_time,
            "median_session_time": round2(F.col("median_session_seconds") + page_time),
        }
    )
