"""Ingest as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickstrata.functions.agents import DEFAULT_RULES, AgentRule
from clickstrata.operators.places import PlaceTree
from clickstrata.plans.ingest import delivered, ingest_events, outcome_counts

#: Name under which a query's progress reports the outcome counts.
OUTCOMES = "outcomes"

#: Interval between micro-batches.
INTERVAL = "15 minutes"


def start_ingest(
    raw: DataFrame,
    places: PlaceTree,
    root: str,
    checkpoint: str,
    rules: Sequence[AgentRule] = DEFAULT_RULES,
    arrival: Column | None = None,
    data: str = "data",
    available_now: bool = False,
) -> StreamingQuery:
    """Start a query that stores ``raw`` records under ``root/result=.../date_day=...``.

    One query and one pass serve events and errors alike. The file sink commits each
    micro-batch exactly once, also across restarts; dropped records are counted in
    ``observedMetrics`` of the query's progress.
    """
    processed = ingest_events(raw, places, rules, arrival, data)
    writer = (
        delivered(processed.observe(OUTCOMES, *outcome_counts()))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("result", "date_day")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=INTERVAL)
    return writer.start(root)
