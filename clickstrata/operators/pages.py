"""Figures per page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.ratios import percent, round2
from clickstrata.functions.urls import EMBEDDED_PAGE
from clickstrata.operators import sketches
from clickstrata.operators.profiles import group_profile

#: Device types the reports show pages for.
REPORT_DEVICES = ("desktop", "mobile")


def page_stats(
    prepared: DataFrame, lim: int = 10, keys: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Figures of every page with at least ``lim`` sessions, most sessions first.

    ``exit_pct`` is the share of views that end their session. With further ``keys`` pages
    are counted, and ``lim`` applies, within each key. ``approximate`` estimates sessions,
    visitors and medians from sketches instead (``operators.sketches`` states the error).
    """
    if approximate:
        daily = sketches.event_sketches(prepared, [*keys, "clean_url"])
        return sketches.page_stats(daily, lim, keys)
    pages = prepared.where(F.col("clean_url") != EMBEDDED_PAGE)
    return _page_figures(group_profile(pages, [*keys, "clean_url"]), lim, keys)


def _page_figures(profile: DataFrame, lim: int, keys: Sequence[str]) -> DataFrame:
    return (
        profile.where(F.col("sessions") >= lim)
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


def page_stats_all_and_by_device(prepared: DataFrame, lim: int = 10) -> DataFrame:
    """``page_stats`` of all events (``over_all``) and within each device type, in one pass."""
    pages = prepared.where(F.col("clean_url") != EMBEDDED_PAGE)
    profile = group_profile(pages, ["device_type", "clean_url"], all_of="device_type")
    return _page_figures(profile, lim, ["over_all", "device_type"])


def page_stats_by_device(
    prepared: DataFrame, lim: int = 10, devices: Sequence[str] = REPORT_DEVICES
) -> DataFrame:
    """``page_stats`` within each of some device types.

    Entries and exits are those of the whole session, whatever the device.
    """
    chosen = prepared.where(F.col("device_type").isin(*devices))
    return page_stats(chosen, lim, ["device_type"])


def facebook_session_ratio(prepared: DataFrame) -> DataFrame:
    """Percentage of sessions with at least one arrival from Facebook."""
    per_session = (
        prepared.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.max("from_fb").alias("from_fb"))
    )
    arrived = F.count_if(F.col("from_fb") > 0)
    return per_session.agg(
        round2(percent(arrived, F.count(F.lit(1)))).alias("facebook_session_pct")
    )


def facebook_landing_pages(prepared: DataFrame) -> DataFrame:
    """Pages on which Facebook arrivals land, most arrivals first."""
    return (
        prepared.where((F.col("from_fb") == 1) & F.col("clean_url").isNotNull())
        .groupBy("clean_url")
        .agg(F.count("event_id").alias("arrivals"))
        .orderBy(F.desc("arrivals"), "clean_url")
    )
