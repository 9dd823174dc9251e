"""Where visitors come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: label of the row that sums the remaining places.
OTHER_LABEL = "Andra"


def _visitors_per_place(visitors: DataFrame, column: str) -> DataFrame:
    return (
        visitors.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("fingerprint").alias("visitors"))
    )


def _top(per_place: DataFrame, column: str, top: int) -> DataFrame:
    return per_place.orderBy(F.desc("visitors"), column).limit(top)


def location_top_n(
    visitors: DataFrame, column: str, top: int = 10, other_label: str = OTHER_LABEL
) -> DataFrame:
    """Visitors of the ``top`` most frequent places and of all others together.

    ``visitors`` has one row per visitor; those of unknown place are left out. The others row
    is always present. Ties at the cut go to the first place in order of name.
    """
    per_place = _visitors_per_place(visitors, column)
    first = _top(per_place, column, top)
    shown = first.agg(F.coalesce(F.sum("visitors"), F.lit(0))).scalar()
    others = per_place.agg(F.coalesce(F.sum("visitors"), F.lit(0)).alias("known")).select(
        F.lit(other_label).alias(column),
        (F.col("known") - shown).alias("visitors"),
        F.lit(1).alias("rest"),
    )
    return (
        first.withColumn("rest", F.lit(0))
        .unionByName(others)
        .orderBy("rest", F.desc("visitors"), column)
        .drop("rest")
    )


def location_per_day(
    visitors: DataFrame, column: str, top: int = 10, other_label: str = OTHER_LABEL
) -> DataFrame:
    """New visitors per first-seen day and place, places beyond the top ones (and unknown
    ones) as others."""
    first = _top(_visitors_per_place(visitors, column), column, top).select(
        F.col(column), F.col(column).alias("shown_place")
    )
    # at most ``top`` rows: safe to broadcast
    return (
        visitors.join(F.broadcast(first), column, "left")
        .select(
            F.coalesce("shown_place", F.lit(other_label)).alias(column),
            "date_day",
            "fingerprint",
        )
        .where(F.col("date_day").isNotNull())
        .groupBy(column, "date_day")
        .agg(F.count("fingerprint").alias("visitors"))
        .orderBy("date_day", F.desc("visitors"), column)
    )
