"""Figures of weeks, pages and devices from sketches that are stored per day and merge.

The exact metrics read the events of the whole period each time, and shuffle a row per
(group, visitor) and (group, session). Here each day is read once, when it is complete: its
visitors and sessions become distinct-count sketches, its waiting and session times quantile
sketches, and everything that adds up stays an exact count. Any period, and any coarser grouping,
is then a merge of a few kilobytes per day and group; a group of any size is combined before the
shuffle. A day that has to be repaired is written anew, alone.

How far off, at the given sizes (``DISTINCT_BITS``, ``QUANTILE_SIZE``):

* distinct counts: ``DISTINCT_ERROR`` of the exact count, three standard errors of
  1.04 / sqrt(2^14); small sets are counted exactly. The same rows give the same estimate.
* medians: a value whose rank is within ``RANK_ERROR`` of the middle, twice the error that
  quantile sketches of this size keep with 99 % probability.

Sessions never cross an event day, so counts of sessions by event day just add up; only the table
by arrival day needs a sketch of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.functions.ratios import percent, round2
from clickstrata.functions.times import MICROS_PER_SECOND, iso_week, micros
from clickstrata.functions.urls import EMBEDDED_PAGE

#: Size of the sketches: 2^bits registers, and entries per level.
DISTINCT_BITS = 14
QUANTILE_SIZE = 800

#: Stated errors, see above.
DISTINCT_ERROR = 3 * 1.04 / sqrt(2**DISTINCT_BITS)
RANK_ERROR = 0.01

#: Counts that add up over days.
_EVENT_COUNTS = ("pageviews", "starts", "from_facebook", "entries", "exits")
_SESSION_COUNTS = (
    "sessions",
    "one_event_sessions",
    "multi_event_sessions",
    "multi_event_pageviews",
)


# Days --------------------------------------------------------------------------------------


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def event_sketches(prepared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per arrival day and key: counts, and sketches of visitors, sessions and
    waiting times. A null key or day forms no group."""
    return (
        _known(prepared, ["date_day", *keys])
        .groupBy("date_day", *keys)
        .agg(
            F.count("event_id").alias("pageviews"),
            F.count_if(F.col("event_number") == 1).alias("starts"),
            F.sum("from_fb").alias("from_facebook"),
            F.sum("first_session_event").alias("entries"),
            F.sum("last_session_event").alias("exits"),
            F.hll_sketch_agg("fingerprint", DISTINCT_BITS).alias("visitors"),
            F.hll_sketch_agg("session_id", DISTINCT_BITS).alias("sessions"),
            F.kll_sketch_agg_bigint("seconds_to_next_event_in_session", QUANTILE_SIZE).alias(
                "seconds"
            ),
        )
    )


def session_sketches(prepared: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per event day and key: sessions by number of events, and a sketch of session
    times (microseconds, of sessions with several events)."""
    per_session = (
        _known(prepared, ["session_id", *keys])
        .groupBy(F.to_date("request_time").cast("string").alias("event_day"), *keys, "session_id")
        .agg(
            F.count("event_id").alias("n"),
            (micros(F.max("request_time")) - micros(F.min("request_time"))).alias("time"),
        )
    )
    several = F.col("n") > 1
    return per_session.groupBy("event_day", *keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(F.col("n") == 1).alias("one_event_sessions"),
        F.count_if(several).alias("multi_event_sessions"),
        F.sum(F.when(several, F.col("n")).otherwise(0)).alias("multi_event_pageviews"),
        F.kll_sketch_agg_bigint(F.when(several, F.col("time")), QUANTILE_SIZE).alias("times"),
    )


def write_sketches(sketches: DataFrame, root: str) -> None:
    """Store sketches by day; days that are written again replace their former rows."""
    day = "date_day" if "date_day" in sketches.columns else "event_day"
    (
        sketches.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(root)
    )


def read_sketches(
    spark: SparkSession, root: str, schema, start: str | None = None, as_of: str | None = None
) -> DataFrame:
    """Stored sketches, only the days in ``[start, as_of)`` if given. ``schema`` keeps days text."""
    stored = spark.read.schema(schema).parquet(root)
    day = F.col("date_day" if "date_day" in stored.columns else "event_day")
    if start is not None:
        stored = stored.where(day >= start)
    return stored if as_of is None else stored.where(day < as_of)


# Merges ------------------------------------------------------------------------------------


def _median(sketch: str) -> Column:
    """The middle value; null if the sketch has none."""
    seen = F.kll_sketch_get_n_bigint(sketch) > 0
    return F.when(seen, F.kll_sketch_get_quantile_bigint(sketch, F.lit(0.5)))


def merge_events(sketches: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """``event_sketches`` of several days or finer keys as one row per key, with estimates."""
    merged = sketches.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _EVENT_COUNTS],
        F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors"),
        F.hll_sketch_estimate(F.hll_union_agg("sessions")).alias("sessions"),
        F.kll_merge_agg_bigint("seconds").alias("seconds"),
    )
    return merged.withColumn("median_seconds", _median("seconds")).drop("seconds")


def merge_sessions(sketches: DataFrame, keys: Sequence[str | Column] = ()) -> DataFrame:
    """``session_sketches`` of several days or finer keys as one row per key."""
    merged = sketches.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _SESSION_COUNTS],
        F.kll_merge_agg_bigint("times").alias("times"),
    )
    return merged.withColumn(
        "median_session_seconds", _median("times") / MICROS_PER_SECOND
    ).drop("times")


# Metrics -----------------------------------------------------------------------------------


def traffic_daily(sketches: DataFrame) -> DataFrame:
    """As ``traffic.traffic_daily``, with estimated visitors, from ``event_sketches``."""
    return (
        merge_events(sketches, ["date_day"])
        .select(
            "date_day",
            F.weekday(F.col("date_day").cast("date")).alias("weekday"),
            "pageviews",
            F.nullif(F.col("starts"), F.lit(0).cast("bigint")).alias("sessions"),
            "visitors",
        )
        .orderBy("date_day")
    )


def traffic_weekly(sketches: DataFrame) -> DataFrame:
    """As ``traffic.traffic_weekly``, with estimated sessions and visitors."""
    return (
        merge_events(sketches, iso_week(F.col("date_day")))
        .select("year", "week", "pageviews", "sessions", "visitors")
        .orderBy("year", "week")
    )


def page_stats(sketches: DataFrame, lim: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """As ``pages.page_stats``, from ``event_sketches`` by ``clean_url`` (and further keys).

    ``lim`` applies to the estimated sessions; medians are one of the values.
    """
    return (
        merge_events(sketches.where(F.col("clean_url") != EMBEDDED_PAGE), [*keys, "clean_url"])
        .where(F.col("sessions") >= lim)
        .select(
            *keys,
            "clean_url",
            "median_seconds",
            "pageviews",
            "sessions",
            "visitors",
            "from_facebook",
            "entries",
            "exits",
            round2(percent("exits", "pageviews")).alias("exit_pct"),
        )
        .orderBy(*keys, F.desc("sessions"), "clean_url")
    )


def motion_stats(sketches: DataFrame, top: int | None = None) -> DataFrame:
    """As ``motions.motion_stats``, from ``event_sketches`` by ``motion``."""
    figures = merge_events(sketches, ["motion"]).select(
        "motion", "median_seconds", "pageviews", "sessions", "visitors"
    )
    ordered = figures.orderBy(F.desc("sessions"), "motion")
    return ordered if top is None else ordered.limit(top)


def device_stats(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """As ``devices.device_stats``, from both kinds of sketches by ``device_type``.

    Sessions and their ratios are exact, visitors and medians estimates.
    """
    counted = merge_events(events, ["device_type"]).drop("sessions")
    figures = counted.join(merge_sessions(sessions, ["device_type"]), "device_type", "left")
    page_time = round2(F.col("median_seconds"))
    all_pageviews = F.col("one_event_sessions") + F.col("multi_event_pageviews")
    return figures.select(
        "device_type",
        "pageviews",
        F.coalesce("sessions", F.lit(0)).alias("sessions"),
        "visitors",
        "from_facebook",
        round2(percent("one_event_sessions", "sessions")).alias("one_event_session_ratio"),
        round2(F.try_divide(all_pageviews, "sessions")).alias("avg_events_per_session"),
        page_time.alias("median_time_per_page"),
        round2(F.col("median_session_seconds") + page_time).alias("median_session_time"),
    ).orderBy("device_type")


# Errors ------------------------------------------------------------------------------------


def within_distinct_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimated count is as near to the exact one as stated."""
    return F.abs(estimate - exact) <= exact * F.lit(DISTINCT_ERROR)


def within_rank_error(values: DataFrame, keys: Sequence[str], value: str, estimate: str) -> DataFrame:
    """Per key, whether ``estimate`` has a rank as near to the middle of ``value`` as stated."""
    n = F.count(value)
    below = F.count_if(F.col(value) < F.col(estimate))
    upto = F.count_if(F.col(value) <= F.col(estimate))
    near = (below <= n * (0.5 + RANK_ERROR)) & (upto >= n * (0.5 - RANK_ERROR))
    # a key without values has no estimate
    none = (n == 0) & (F.count(estimate) == 0)
    return values.groupBy(*keys).agg(((n > 0) & near | none).alias("median_within"))
