"""Website sessions beside social media series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NETWORKS = ("facebook", "instagram")


def by_position(series: DataFrame, days: DataFrame, ordinal: str) -> DataFrame:
    """Give a series that has only an ordinal the day of that position in ``days``.

    Both sides have one row per day of the period, so one window over all days is small.
    """
    in_order = W.orderBy("date_day")
    numbered = days.select("date_day").withColumn("position", F.row_number().over(in_order))
    ranked = series.withColumn("position", F.row_number().over(W.orderBy(ordinal)))
    return numbered.join(ranked.drop(ordinal), "position").drop("position")


def social_zscores(
    daily: DataFrame,
    facebook_reach: DataFrame,
    facebook_pageviews: DataFrame,
    instagram_reach: DataFrame,
    instagram_pageviews: DataFrame,
) -> dict[str, DataFrame]:
    """Site sessions, reach and pageviews of each network on one standardised axis.

    ``daily`` is ``traffic_daily``; a series has ``date_day`` and ``reach`` or ``pageviews``.
    Returns one DataFrame per network. A constant series has null scores.
    """
    series = {
        "facebook_reach": (facebook_reach, "reach"),
        "facebook_pageviews": (facebook_pageviews, "pageviews"),
        "instagram_reach": (instagram_reach, "reach"),
        "instagram_pageviews": (instagram_pageviews, "pageviews"),
    }
    site = daily.select("date_day", F.col("sessions").alias("site_sessions"))
    return {
        network: _network_zscores(
            site, {name: s for name, s in series.items() if name.startswith(network)}
        )
        for network in NETWORKS
    }


def _network_zscores(site: DataFrame, series: dict) -> DataFrame:
    combined = site
    for name, (frame, value) in series.items():
        combined = combined.join(
            frame.select("date_day", F.col(value).alias(name)), "date_day", "left"
        )
    columns = ["site_sessions", *series]
    # one row with every mean and sample deviation, looked up as a single scalar
    moments = combined.select(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"deviation_{c}") for c in columns],
        )
    ).scalar()
    scores = [
        F.try_divide(F.col(c) - moments[f"mean_{c}"], moments[f"deviation_{c}"]).alias(c)
        for c in columns
    ]
    return combined.select("date_day", *scores).orderBy("date_day")
