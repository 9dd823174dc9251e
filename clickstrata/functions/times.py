"""Expressions on event times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clickstrata.session import require_utc

MICROS_PER_SECOND = 1_000_000


def micros(time: Column) -> Column:
    """Microseconds since the epoch, for exact differences."""
    return F.unix_micros(time.cast("timestamp"))


def complete_units(unit: str, start: Column, end: Column) -> Column:
    """Complete units from ``start`` to ``end``; crossing a boundary does not count."""
    return F.timestamp_diff(unit, start.cast("timestamp"), end.cast("timestamp"))


def iso_week(day: Column) -> list[Column]:
    """ISO ``year`` and ``week`` of a day, given as a date or its text."""
    date = day.cast("date")
    return [F.extract(F.lit("YEAROFWEEK"), date).alias("year"), F.weekofyear(date).alias("week")]


def with_parsed_time(df: DataFrame, column: str = "request_time") -> DataFrame:
    """Parse ISO-8601 text (fraction optional) to a timestamp; leave timestamps alone."""
    require_utc(df.sparkSession)
    if isinstance(df.schema[column].dataType, StringType):
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df


def iso_text(time: Column) -> Column:
    """ISO-8601 text as the collector writes it: the fraction is absent when it is zero."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(time, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat_ws(".", whole, fraction))
