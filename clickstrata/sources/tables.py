"""Read and write the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from clickstrata.functions.times import iso_text
from clickstrata.operators.places import blocks_of_networks
from clickstrata.operators.sessions import complete_days
from clickstrata.plans.ingest import SINK_COLUMNS, SUCCESS
from clickstrata.schemas import EVENTS, SESSION_EVENTS

#: Folder level of the event table that says what became of a record.
RESULT = StructField("result", StringType())


def write_events(events: DataFrame, root: str) -> None:
    """Append events to the event table as ingest lays it out; a busy day becomes several files."""
    (
        events.select(*EVENTS.fieldNames(), F.lit(SUCCESS).alias(RESULT.name))
        .hint("rebalance", "date_day")
        .write.mode("append")
        .partitionBy(RESULT.name, "date_day")
        .parquet(root)
    )


def read_results(spark: SparkSession, root: str) -> DataFrame:
    """Everything that ingest stored: events, and records that failed with their text."""
    fields = [*EVENTS.fields, StructField("data", StringType()), RESULT]
    return spark.read.schema(StructType(fields)).parquet(root).select(*SINK_COLUMNS)


def read_events(
    spark: SparkSession, root: str, start: str | None = None, as_of: str | None = None
) -> DataFrame:
    """The event table that ingest writes, only the days in ``[start, as_of)`` if given.

    The schema is fixed, so ``date_day`` stays text and its filter prunes folders. Reading the
    root (rather than one folder) respects the commit log of a streaming writer.
    """
    stored = spark.read.schema(StructType(EVENTS.fields + [RESULT])).parquet(root)
    events = stored.where(F.col("result") == SUCCESS).select(*EVENTS.fieldNames())
    if start is not None and as_of is not None:
        events = complete_days(events, start, as_of)
    return events


def write_session_events(session_events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store session events as Parquet by day.

    Rows are rebalanced by day: a busy day is split by its bytes into as many tasks and files
    as it needs, and a folder does not get a file from every task.
    """
    (
        session_events.hint("rebalance", "date_day")
        .write.mode(mode)
        .partitionBy("date_day")
        .parquet(path)
    )


def read_session_events(spark: SparkSession, path: str) -> DataFrame:
    """Session events stored as Parquet."""
    return spark.read.schema(SESSION_EVENTS).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a table as headed CSV (UTF-8), in as many files as the table has partitions.

    Times are ISO text as the collector writes it, with all their digits.
    """
    times = {
        f.name: iso_text(F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (TimestampType, TimestampNTZType))
    }
    df.withColumns(times).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_address_blocks(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """Address blocks for ``disjoint_places`` from a stored table.

    Headed CSV or Parquet with ``network`` (CIDR text of either family), ``country_name``,
    ``country_iso`` and ``city``.
    """
    schema = "network STRING, country_name STRING, country_iso STRING, city STRING"
    rows = spark.read.schema(schema)
    if kind == "csv":
        rows = rows.option("header", True).option("enforceSchema", False).option("escape", '"')
    return blocks_of_networks(rows.format(kind).load(path))


def read_session_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Session events from headed CSV; times may be ISO text with or without a fraction."""
    schema = StructType(
        [
            StructField(f.name, StringType()) if f.name == "request_time" else f
            for f in SESSION_EVENTS
        ]
    )
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", False)
        .csv(path)
    )
    return rows.withColumn("request_time", F.col("request_time").cast("timestamp_ntz")).select(
        *SESSION_EVENTS.fieldNames()
    )


def read_social_series(
    spark: SparkSession, path: str, value: str, day: str | None = "date_day"
) -> DataFrame:
    """One series from headed CSV: ``reach`` or ``pageviews`` with one row per day.

    With ``day=None`` the file has no day; the result then has ``ordinal``, the order of its
    rows, for ``social.by_position``.
    """
    header = spark.read.option("header", True).csv(path)
    if day is None:
        return header.select(
            F.monotonically_increasing_id().alias("ordinal"),
            F.col(value).cast("double").alias(value),
        )
    return header.select(
        F.col(day).cast("string").alias("date_day"), F.col(value).cast("double").alias(value)
    )
