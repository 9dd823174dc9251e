"""The website report: every metric over one prepared table."""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.operators.devices import device_figures
from clickstrata.operators.locations import location_per_day, location_top_n
from clickstrata.operators.motions import REPORT_MOTIONS, motion_events, motion_stats
from clickstrata.operators.pages import (
    REPORT_DEVICES,
    facebook_session_ratio,
    page_stats_all_and_by_device,
)
from clickstrata.operators.prepare import prepare_events, unique_visitors
from clickstrata.operators.social import social_zscores
from clickstrata.operators.profiles import session_profile
from clickstrata.operators.traffic import (
    session_figures,
    traffic_daily,
    traffic_hourly,
    traffic_weekday,
)
from clickstrata.sources.shared import written

#: Places the report shows before the others.
TOP_CITIES = 15
TOP_COUNTRIES = 7


#: What the metrics read of the session events.
REPORT_COLUMNS = (
    "event_id",
    "fingerprint",
    "request_time",
    "from_url",
    "session_id",
    "event_number",
    "device_type",
    "city",
    "country",
    "seconds_to_next_event_in_session",
    "date_day",
    "session_events",
)

#: Columns that tell the rows of a table apart; the others are figures.
REPORT_KEYS = {
    "city_daily": ("city", "date_day"),
    "city_top": ("city",),
    "country_daily": ("country", "date_day"),
    "country_top": ("country",),
    "device_stats": ("device_type",),
    "motion_stats": ("motion",),
    "page_stats": ("clean_url",),
    "page_stats_desktop": ("clean_url",),
    "page_stats_mobile": ("clean_url",),
    "social_facebook": ("date_day",),
    "social_instagram": ("date_day",),
    "traffic_daily": ("date_day",),
    "traffic_hourly": ("hour",),
    "traffic_weekday": ("weekday_name",),
}

#: Decimals of a figure in the long form; two engines may sum in another order.
REPORT_DECIMALS = 8


@dataclass(frozen=True)
class SocialSeries:
    """Four series by day: ``reach`` or ``pageviews``."""

    facebook_reach: DataFrame
    facebook_pageviews: DataFrame
    instagram_reach: DataFrame
    instagram_pageviews: DataFrame


def _pages(pages: DataFrame) -> DataFrame:
    return pages.drop("over_all", "device_type").orderBy(F.desc("sessions"), "clean_url")


def web_report(
    session_events: DataFrame,
    social: SocialSeries | None = None,
    lim: int = 10,
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Named result tables over session events.

    The prepared events, the visitors, the daily traffic, and the figures of pages and sessions,
    each over all devices and by device in one pass, are written once to the shared folder
    (``folder`` or the cluster's own) and every metric reads the columns it needs from there;
    nothing large is held in memory. Columns that no metric reads are left out before
    sessions are cut, if ``session_events`` is still to be computed. With a ``folder`` from
    ``sources.shared.scratch``, the written tables go when the caller is done.
    """
    needed = [c for c in session_events.columns if c in REPORT_COLUMNS]
    prepared = written(prepare_events(session_events.select(*needed)), "prepared", folder)
    visitors = written(
        unique_visitors(prepared, ["city", "country", "date_day"]), "visitors", folder
    )
    daily = written(traffic_daily(prepared), "traffic-daily", folder).orderBy("date_day")
    pages = written(page_stats_all_and_by_device(prepared, lim), "pages", folder)
    profile = session_profile(prepared, ["device_type"], all_of="device_type")
    sessions = written(profile, "session-profile", folder)
    over_all = F.col("over_all")
    report = {
        "traffic_daily": daily,
        "traffic_hourly": traffic_hourly(prepared),
        "traffic_weekday": traffic_weekday(daily),
        "session_stats": session_figures(sessions.where(over_all)),
        "page_stats": _pages(pages.where(over_all)),
        "facebook_session_ratio": facebook_session_ratio(prepared),
        "device_stats": device_figures(sessions.where(~over_all)),
        "city_top": location_top_n(visitors, "city", TOP_CITIES),
        "city_daily": location_per_day(visitors, "city", TOP_CITIES),
        "country_top": location_top_n(visitors, "country", TOP_COUNTRIES),
        "country_daily": location_per_day(visitors, "country", TOP_COUNTRIES),
        "motion_stats": motion_stats(motion_events(prepared), REPORT_MOTIONS),
    }
    for device in REPORT_DEVICES:
        of_device = ~over_all & (F.col("device_type") == device)
        report[f"page_stats_{device}"] = _pages(pages.where(of_device))
    if social is not None:
        networks = social_zscores(
            daily,
            social.facebook_reach,
            social.facebook_pageviews,
            social.instagram_reach,
            social.instagram_pageviews,
        )
        report.update({f"social_{network}": z for network, z in networks.items()})
    return report


def report_long(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables as one: ``table_name``, ``row_key``, ``variable`` and ``value``."""
    parts = []
    for name, rows in sorted(tables.items()):
        keys = REPORT_KEYS.get(name, ())
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        figures = [c for c in rows.columns if c not in keys]
        values = [F.round(F.col(c).cast("double"), REPORT_DECIMALS).alias(c) for c in figures]
        keyed = rows.select(key.alias("row_key"), *values)
        parts.append(
            keyed.unpivot("row_key", figures, "variable", "value").withColumn(
                "table_name", F.lit(name)
            )
        )
    return reduce(DataFrame.unionByName, parts)
