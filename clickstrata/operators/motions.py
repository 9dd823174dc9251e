"""Motions: content pages with a number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.urls import is_motion_page, is_numeric_text, motion_id
from clickstrata.operators import sketches
from clickstrata.operators.profiles import group_profile

#: Rows the report shows.
REPORT_MOTIONS = 20


def motion_events(prepared: DataFrame) -> DataFrame:
    """Events on motion pages whose id is numeric; the id stays text."""
    url = F.col("from_url")
    return (
        prepared.where(is_motion_page(url))
        .withColumn("motion", motion_id(url))
        .where(is_numeric_text(F.col("motion")))
    )


def motion_stats(
    motions: DataFrame, top_n: int | None = None, approximate: bool = False
) -> DataFrame:
    """Figures per motion, most sessions first; ``top_n`` keeps the first rows.

    ``approximate`` estimates sessions, visitors and medians from sketches instead
    (``operators.sketches`` states the error).
    """
    if approximate:
        return sketches.motion_stats(sketches.event_sketches(motions, ["motion"]), top_n)
    stats = (
        group_profile(motions, ["motion"])
        .select("motion", "median_seconds", "pageviews", "sessions", "visitors")
        .orderBy(F.desc("sessions"), "motion")
    )
    return stats if top_n is None else stats.limit(top_n)
