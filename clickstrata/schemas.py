"""Fixed schemas of the stored tables and of the incoming records."""

from pyspark.sql.types import (
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


#: One record as the collector delivers it, after base64 decoding. ``details`` may hold
#: any JSON; declared as a string, it keeps its JSON text. ``malformed`` receives the text
#: of a record that does not fit.
ENVELOPE = StructType(
    [
        StructField(
            "body", StructType(_strings("event_type", "from_url", "details"))
        ),
        StructField("headers", MapType(StringType(), StringType())),
        StructField(
            "identity", StructType(_strings("sourceIp", "userAgent", "requestId"))
        ),
        StructField("request_time", LongType()),
        StructField("malformed", StringType()),
    ]
)

#: The stored event table. ``date_day`` is the day the record arrived, and the partition.
EVENTS = StructType(
    _strings("event_id", "fingerprint")
    + [StructField("request_time", TimestampNTZType())]
    + _strings("event_type", "from_url", "details", "user_data", "geoip", "date_day")
)

#: Events with their session: the input of every metric.
SESSION_EVENTS = StructType(
    _strings("event_id", "fingerprint")
    + [StructField("request_time", TimestampNTZType())]
    + _strings("event_type", "from_url", "session_id")
    + [StructField("event_number", LongType())]
    + _strings("details", "browser", "device_type", "operating_system", "city", "country")
    + [
        StructField("seconds_to_next_event_in_session", LongType()),
        StructField("week", LongType()),
    ]
    + _strings("date_day")
)

#: Address blocks with their place; IPv4 addresses as numbers, both ends included.
IP_BLOCKS = StructType(
    [StructField("ip_from", LongType()), StructField("ip_to", LongType())]
    + _strings("country_name", "country_iso", "city")
)
