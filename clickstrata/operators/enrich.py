"""Turn delivered records into event rows.

Every step is a narrow transformation of the record at hand, so the same functions serve a
batch and a stream, and no record moves between tasks. The place lookup is the one join; it
has its own module.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.functions.agents import DEFAULT_RULES, AgentRule, agent_family, is_bot
from clickstrata.functions.viewers import device_type, fingerprint
from clickstrata.schemas import ENVELOPE

#: Why a record could not be processed. Null for a sound one.
NOT_BASE64 = "not-base64"
NOT_UTF8 = "not-utf8"
NOT_JSON = "not-json"
INCOMPLETE = "incomplete"


def decode_envelope(raw: DataFrame, data: str = "data") -> DataFrame:
    """Decode base64 JSON records into typed columns.

    A record that cannot be decoded stays, with the reason in ``error_type`` and its text in
    ``data``, so that one bad record never fails a job.
    """
    text = F.try_to_binary(F.col(data), F.lit("base64")).cast("string")
    parsed = F.from_json("record_text", ENVELOPE, {"columnNameOfCorruptRecord": "malformed"})
    others = [c for c in raw.columns if c != data]
    # ``inline`` turns the parsed record into columns: unlike a projection it is never merged
    # with what follows, so a later filter does not parse the record again
    fields = (
        raw.withColumn("record_text", text)
        .select(*others, data, "record_text", F.inline_outer(F.array(parsed)))
    )
    required = (
        F.col("body"),
        F.col("headers"),
        F.col("identity.sourceIp"),
        F.col("identity.userAgent"),
        F.col("identity.requestId"),
        F.col("request_time"),
    )
    missing = reduce(lambda found, c: found | c.isNull(), required, F.lit(False))
    error = (
        F.when(F.col("record_text").isNull(), NOT_BASE64)
        .when(~F.is_valid_utf8("record_text"), NOT_UTF8)
        .when(F.col("malformed").isNotNull(), NOT_JSON)
        .when(missing, INCOMPLETE)
    )
    return fields.select(
        *others,
        F.when(error.isNotNull(), F.col(data)).alias(data),
        error.alias("error_type"),
        F.col("body.event_type").alias("event_type"),
        F.col("body.from_url").alias("from_url"),
        F.col("body.details").alias("details"),
        "headers",
        F.col("identity.sourceIp").alias("source_ip"),
        F.col("identity.userAgent").alias("user_agent"),
        F.col("identity.requestId").alias("request_id"),
        F.col("request_time").alias("request_millis"),
    )


def sound_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error_type").isNull())


def event_identity(decoded: DataFrame) -> DataFrame:
    """Add ``event_id`` (the request's id) and ``request_time`` (UTC)."""
    return decoded.withColumns(
        {
            "event_id": F.col("request_id"),
            "request_time": F.timestamp_millis("request_millis").cast("timestamp_ntz"),
        }
    )


def with_agent(
    decoded: DataFrame, rules: Sequence[AgentRule] = DEFAULT_RULES
) -> DataFrame:
    """Add ``browser``, ``operating_system`` and ``is_bot``."""
    agent = F.col("user_agent")
    return decoded.withColumns(
        {
            "browser": agent_family(agent, rules, "browser"),
            "operating_system": agent_family(agent, rules, "os"),
            "is_bot": is_bot(agent, rules),
        }
    )


def classify_user_agents(
    decoded: DataFrame, rules: Sequence[AgentRule] = DEFAULT_RULES
) -> DataFrame:
    """Browser, operating system and bot mark of every distinct agent, with its events.

    Agents are counted first, so the patterns run once per distinct agent.
    """
    agents = (
        decoded.where(F.col("user_agent").isNotNull())
        .groupBy("user_agent")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return with_agent(agents, rules)


def drop_bots(events: DataFrame) -> DataFrame:
    """Events that no bot sent; needs ``with_agent``."""
    return events.where(~F.col("is_bot"))


def with_device_type(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("device_type", device_type(F.col("headers")))


def with_fingerprint(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn(
        "fingerprint", fingerprint(F.col("source_ip"), F.col("user_agent"))
    )


def with_user_data(events: DataFrame) -> DataFrame:
    """Add the stored JSON of the agent; fields without a value are left out."""
    return events.withColumn(
        "user_data", F.to_json(F.struct("browser", "operating_system", "device_type"))
    )


def with_geoip(events: DataFrame) -> DataFrame:
    """Add the stored JSON of the place; null for an unknown address."""
    place = F.struct(
        F.struct(
            F.col("place.country_name").alias("name"), F.col("place.country_iso").alias("iso")
        ).alias("country"),
        F.col("place.city").alias("city"),
    )
    text = F.to_json(place, {"ignoreNullFields": "false"})
    return events.withColumn("geoip", F.when(F.col("place").isNotNull(), text))
