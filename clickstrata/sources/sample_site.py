"""A website's event table, social series and raw records, derived from the sample tables.

The sample tables are general (``events``, ``pages``, ``nation``, ``orders``); these functions give their
rows the shape of website events so that every operator can run on whole tables. The oracle
SQL in ``__spark_entry__`` states the same derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickstrata.operators.places import blocks_of_networks
from clickstrata.session import configure

#: Complete days that most queries look at, and the unfinished day after them. The sample also
#: has events that arrived before and after, and some that arrived a day late.
START = "2024-01-02"
AS_OF = "2024-01-30"


#: Columns read from the sample tables; a given schema saves a look at the file footers.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "pages": "page_id BIGINT, url STRING",
    "nation": "n_nationkey BIGINT, n_name STRING",
    "orders": "o_orderkey BIGINT",
}

#: Arrival of an event: one in 41 arrives a day late.
_ARRIVED = "ts + if(event_id % 41 = 0, INTERVAL 1 DAY, INTERVAL 0 DAY)"

_WEB_EVENTS = """
SELECT
  CAST(event_id AS STRING) AS event_id,
  md5(CAST(user_id AS STRING)) AS fingerprint,
  ts AS request_time,
  if(event_type = 'click', 'click', 'page_load') AS event_type,
  CASE
    WHEN event_id % 7 = 0 THEN concat(
      'https://site.example/visa-motion/?motion=',
      if(event_id % 77 = 0, 'abc', CAST((user_id * event_id) % 40 AS STRING)),
      '&lang=sv')
    WHEN event_id % 11 = 0 THEN 'about:srcdoc'
    WHEN event_id % 5 = 0 THEN concat(
      url, if(contains(url, '?'), '&', '?'), 'fbclid=', CAST(event_id AS STRING))
    ELSE url
  END AS from_url,
  props AS details,
  concat(
    '{{"browser":"B', CAST(user_id % 4 AS STRING),
    ' 1.0","operating_system":"O', CAST(user_id % 3 AS STRING),
    '","device_type":"',
    CASE WHEN user_id % 10 < 5 THEN 'mobile' WHEN user_id % 10 < 9 THEN 'desktop'
      ELSE 'tablet' END,
    '"}}') AS user_data,
  if(user_id % 13 != 0, concat(
    '{{"country":{{"name":"', n_name, '","iso":"XX"}},"city":',
    if(event_id % 5 = 0, 'null',
       concat('"City ', CAST((user_id * user_id) % 37 AS STRING), '"')),
    '}}'), NULL) AS geoip,
  CAST(CAST(arrived AS DATE) AS STRING) AS date_day
FROM (
  SELECT *, __ARRIVED__ AS arrived, (event_id * event_id) % (SELECT count(*) FROM {pages}) AS page_id,
    (user_id * user_id) % 25 AS n_nationkey
  FROM {events})
JOIN {pages} USING (page_id)
JOIN {nation} USING (n_nationkey)
""".replace("__ARRIVED__", _ARRIVED)

_SOCIAL_DAILY = """
SELECT CAST(CAST(ts AS DATE) AS STRING) AS date_day,
  count_if(event_type = 'view') AS facebook_reach,
  count_if(event_type = 'click') AS facebook_pageviews,
  count_if(event_type = 'purchase') AS instagram_reach,
  count_if(event_type = 'signup') AS instagram_pageviews
FROM {events} GROUP BY 1
"""

_RAW_ENVELOPES = r"""
SELECT
  CASE
    WHEN event_id % 97 = 0 THEN '@@not-base64@@'
    WHEN event_id % 89 = 0 THEN 'e//+fQ=='
    WHEN event_id % 83 = 0 THEN base64(encode(concat('no json ', CAST(event_id AS STRING)), 'UTF-8'))
    ELSE translate(base64(encode(concat(
    '{{"body":{{"event_type":"page_load","from_url":"https://site.example/',
    CAST(event_id % 9 AS STRING), '","details":{{}}}},',
    if(event_id % 79 = 0, '"heads":', '"headers":'),
    '{{"CloudFront-Is-Mobile-Viewer":"', CAST(user_id % 10 < 5 AS STRING),
    '","CloudFront-Is-Desktop-Viewer":"',
    CAST(user_id % 10 >= 3 AND user_id % 10 < 9 AS STRING), '"}},',
    '"identity":{{"sourceIp":"',
    CASE
      WHEN event_id % 19 = 0 THEN '10.1.2.999'
      WHEN user_id % 3 = 0 THEN concat('2001:db8:', lower(hex(user_id % 16)), ':',
        lower(hex((user_id * 11) % 4096)), '::', lower(hex(event_id % 65536)))
      ELSE concat(if(event_id % 6 = 1, '::ffff:', ''), '10.', CAST(user_id % 4 AS STRING), '.',
        CAST((user_id * 7) % 256 AS STRING), '.', CAST((user_id * 13) % 256 AS STRING))
    END,
    '","userAgent":"',
    CASE user_id % 5
      WHEN 0 THEN '' WHEN 1 THEN 'ExampleBot/2.1'
      WHEN 2 THEN concat('Mozilla/5.0 (X11; Linux x86_64) Firefox/', CAST(event_id % 20 + 80 AS STRING))
      WHEN 3 THEN concat('Mozilla/5.0 (iPhone; CPU iPhone OS 15', elt(event_id % 3 + 1, '', '_3', '_3_1'),
        ' like Mac OS X) Version/', CAST(event_id % 7 AS STRING), '.2 Safari/604.1')
      ELSE elt(event_id % 3 + 1, 'curl',
        concat('Mozilla/5.0 (Windows NT 10.0; Win64) Chrome/98.0.4758.', CAST(event_id % 11 AS STRING)),
        'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Edg/101.1') END,
    '","requestId":"', CAST(event_id AS STRING), '"}},"request_time":',
    CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING), '}}'), 'UTF-8')), '\r\n', '')
  END AS data,
  __ARRIVED__ AS arrived_at
FROM {events}
""".replace("__ARRIVED__", _ARRIVED)

_ADDRESS_BLOCKS = """
SELECT
  CASE
    WHEN o_orderkey % 1000 = 1 THEN '::/0'
    WHEN o_orderkey % 1000 = 2 THEN '2000::/3'
    WHEN o_orderkey % 1000 = 4 THEN '0.0.0.0/0'
    WHEN o_orderkey % 3 = 0 THEN concat('2001:db8:', lower(hex(o_orderkey % 16)), ':',
      lower(hex((o_orderkey * 11) % 4096)), '::/',
      elt(CAST(o_orderkey % 8 AS INT) + 1, '20', '32', '40', '44', '48', '52', '56', '64'))
    ELSE concat('10.', CAST(o_orderkey % 4 AS STRING), '.', CAST((o_orderkey * 7) % 256 AS STRING),
      '.', CAST((o_orderkey * 13) % 256 AS STRING), '/',
      elt(CAST(o_orderkey % 8 AS INT) + 1, '12', '16', '18', '20', '22', '24', '27', '32'))
  END AS network,
  concat('Country ', CAST(o_orderkey % 23 AS STRING)) AS country_name,
  concat('C', CAST(o_orderkey % 23 AS STRING)) AS country_iso,
  if(o_orderkey % 5 = 0, NULL, concat('City ', CAST(o_orderkey % 101 AS STRING))) AS city
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table."""
    configure(spark)
    return spark.sql(
        _WEB_EVENTS, **{name: table(spark, sf_dir, name) for name in ("events", "pages", "nation")}
    )


def social_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily reach and pageviews of two networks."""
    return spark.sql(_SOCIAL_DAILY, events=table(spark, sf_dir, "events"))


def raw_envelopes(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Records as the collector delivers them, with all four errors; ``events`` may stream."""
    configure(spark)
    events = table(spark, sf_dir, "events") if events is None else events
    return spark.sql(_RAW_ENVELOPES, events=events)


def address_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested and repeated blocks of both families, one for each order, some as wide as can be."""
    networks = spark.sql(_ADDRESS_BLOCKS, orders=table(spark, sf_dir, "orders"))
    return blocks_of_networks(networks)
