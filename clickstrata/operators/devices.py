"""Figures per device type."""

from pyspark.sql import DataFrame

from clickstrata.operators import sketches
from clickstrata.operators.profiles import session_profile


def device_stats(prepared: DataFrame, approximate: bool = False) -> DataFrame:
    """Counts and session figures of every device type that occurs.

    ``approximate`` estimates visitors and medians from sketches instead
    (``operators.sketches`` states the error).
    """
    if approximate:
        keys = ["device_type"]
        return sketches.device_stats(
            sketches.event_sketches(prepared, keys), sketches.session_sketches(prepared, keys)
        )
    return device_figures(session_profile(prepared, ["device_type"]))


def device_figures(profile: DataFrame) -> DataFrame:
    """The columns of ``device_stats``, of a ``session_profile`` by device type."""
    return profile.select(
        "device_type",
        "pageviews",
        "sessions",
        "visitors",
        "from_facebook",
        "one_event_session_ratio",
        "avg_events_per_session",
        "median_time_per_page",
        "median_session_time",
    ).orderBy("device_type")
