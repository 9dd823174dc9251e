"""Bring result tables into the form charts need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.ratios import percent


def series_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None
) -> DataFrame:
    """One row per id and value column: ``variable`` is its name, ``value`` a double."""
    if values is None:
        values = [c for c in df.columns if c not in ids]
    numbers = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return numbers.unpivot(list(ids), list(values), "variable", "value")


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Add each row's percentage of the column's sum, at full precision."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, percent(F.col(value), total))
