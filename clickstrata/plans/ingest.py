"""Ingest: records in, stored events, errors and counts out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickstrata.functions.agents import DEFAULT_RULES, AgentRule
from clickstrata.operators import enrich
from clickstrata.operators.agent_table import extend_agents, lookup
from clickstrata.operators.places import PlaceTree, geoip_join
from clickstrata.schemas import EVENTS

#: Values of ``result``; a record that failed has its error type instead.
SUCCESS = "success"
DROPPED = "dropped"

#: Columns of the sink: the stored event, the text of a failed record, and the folders.
SINK_COLUMNS = (*[c for c in EVENTS.fieldNames() if c != "date_day"], "data", "result", "date_day")


def ingest_events(
    raw: DataFrame,
    places: PlaceTree,
    rules: Sequence[AgentRule] = DEFAULT_RULES,
    arrival: Column | None = None,
    data: str = "data",
    agents: DataFrame | None = None,
) -> DataFrame:
    """Process every record of a batch or a stream; no record is lost or moved.

    ``result`` says what became of it: ``success``, ``dropped`` (a bot) or an error type.
    ``date_day`` is the day of ``arrival``, by default the time of processing. There is no
    de-duplication. With ``agents``, a table that ``agent_table.extend_agents`` has brought up to
    these records, no rule runs here.
    """
    arrived = F.current_timestamp() if arrival is None else arrival
    records = enrich.decode_envelope(raw.withColumn("arrived", arrived), data)
    events = enrich.event_identity(records)
    events = enrich.with_agent(events, rules) if agents is None else lookup(events, agents)
    events = enrich.with_fingerprint(enrich.with_device_type(events))
    # a record that is not stored as an event needs no place
    wanted = F.col("error_type").isNull() & ~F.col("is_bot")
    events = events.withColumn("place_ip", F.when(wanted, F.col("source_ip")))
    events = enrich.with_geoip(geoip_join(enrich.with_user_data(events), places, "place_ip"))
    result = F.coalesce(
        "error_type", F.when(F.col("is_bot"), DROPPED).otherwise(F.lit(SUCCESS))
    )
    sound = F.col("error_type").isNull()
    stored = {
        c: F.when(sound, F.col(c)) for c in EVENTS.fieldNames() if c != "date_day"
    }
    return events.withColumns(
        {**stored, "result": result, "date_day": F.to_date("arrived").cast("string")}
    ).select(*SINK_COLUMNS)


def ingest_with_agents(
    raw: DataFrame,
    places: PlaceTree,
    agents_root: str,
    rules: Sequence[AgentRule] = DEFAULT_RULES,
    arrival: Column | None = None,
    data: str = "data",
) -> DataFrame:
    """``ingest_events`` of a batch; the rules run for the agents that are new in it only.

    The agents of the batch are read first, and those the stored table lacks are added to it.
    """
    sound = enrich.sound_records(enrich.decode_envelope(raw, data))
    agents = extend_agents(sound, agents_root, rules)
    return ingest_events(raw, places, rules, arrival, data, agents)


def outcome_counts() -> list[Column]:
    """Counts of the three outcomes, for ``observe``."""
    dropped = F.col("result") == DROPPED
    success = F.col("result") == SUCCESS
    return [
        F.count_if(success).alias("success"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(~success & ~dropped).alias("failed"),
    ]


def delivered(processed: DataFrame) -> DataFrame:
    """What the sink stores: everything but dropped records, which are only counted."""
    return processed.where(F.col("result") != DROPPED)


def write_batch(processed: DataFrame, root: str) -> dict[str, int]:
    """Append a batch under ``root/result=.../date_day=...`` and return the outcome counts.

    The counts are observed while writing: one pass over the records.
    """
    observed = Observation("ingest")
    (
        delivered(processed.observe(observed, *outcome_counts()))
        .write.mode("append")
        .partitionBy("result", "date_day")
        .parquet(root)
    )
    return observed.get
