"""Records in, events out."""

import base64
import hashlib
import ipaddress
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickstrata.functions.agents import DEFAULT_RULES, AgentRule
from clickstrata.functions.times import iso_text
from clickstrata.operators import enrich, places
from clickstrata.plans.ingest import ingest_events, write_batch
from clickstrata.schemas import EVENTS, IP_BLOCKS
from clickstrata.sources import sample_site
from clickstrata.sources.tables import read_address_blocks, read_events, read_results, write_events

#: Blocks as ``ip_from, ip_to, country_name, country_iso, city``; ``10.3.*`` is in none.
BLOCKS = [
    (167772160, 167837695, "Sweden", "SE", "Stockholm"),
    (167837696, 167903231, "Norway", "NO", "Oslo"),
    (167854080, 167870463, "Norway", "NO", None),
    (167903232, 167968767, "Denmark", "DK", "Odense"),
]

FIREFOX = "Mozilla/5.0 (X11; Linux x86_64) Firefox/99.0"


def record(**changes):
    whole = {
        "body": {"event_type": "click", "from_url": "https://s/", "details": {"id": "x", "n": [1]}},
        "headers": {"CloudFront-Is-Mobile-Viewer": "true"},
        "identity": {"sourceIp": "10.1.70.1", "userAgent": FIREFOX, "requestId": "r1"},
        "request_time": 1645099200123,
    }
    whole.update(changes)
    return {k: v for k, v in whole.items() if v is not None}


def encoded(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return base64.b64encode(text.encode()).decode()


def raw(spark, values):
    rows = [(v, datetime(2022, 2, 18)) for v in values]
    return spark.createDataFrame(rows, "data string, arrived timestamp_ntz")


def tree_of(spark, blocks):
    return places.place_tree(places.disjoint_places(spark.createDataFrame(blocks, IP_BLOCKS)))


@pytest.fixture(scope="module")
def table(spark):
    return tree_of(spark, BLOCKS)


def processed(spark, table, values, rules=DEFAULT_RULES):
    return ingest_events(raw(spark, values), table, rules, F.col("arrived")).collect()


def test_whole_record(spark, table):
    row = processed(spark, table, [encoded(record())])[0]
    assert row.result == "success" and row.data is None
    assert row.event_id == "r1" and row.date_day == "2022-02-18"
    assert row.request_time == datetime(2022, 2, 17, 12, 0, 0, 123000)
    assert json.loads(row.details) == {"id": "x", "n": [1]}
    assert json.loads(row.user_data) == {
        "browser": "Firefox 99.0", "operating_system": "Linux", "device_type": "mobile",
    }
    assert json.loads(row.geoip) == {"country": {"name": "Norway", "iso": "NO"}, "city": None}
    assert row.fingerprint == hashlib.md5(("10.1.70.1" + FIREFOX).encode()).hexdigest()


@pytest.mark.parametrize(
    "data, result",
    [
        ("@@not-base64@@", "not-base64"),
        (None, "not-base64"),
        (encoded("no json"), "not-json"),
        (encoded("17"), "not-json"),
        (encoded(record(request_time="soon")), "not-json"),
        (encoded(record(body=None)), "incomplete"),
        (encoded(record(headers=None)), "incomplete"),
        (encoded(record(identity={"sourceIp": "1.2.3.4", "userAgent": ""})), "incomplete"),
    ],
)
def test_bad_record_is_kept_apart(spark, table, data, result):
    bad, good = processed(spark, table, [data, encoded(record())])
    assert (bad.result, bad.data, bad.event_id, bad.user_data) == (result, data, None, None)
    assert good.result == "success"


def test_empty_agent_is_neither_named_nor_a_bot(spark, table):
    identity = {"sourceIp": "bad", "userAgent": "", "requestId": "r"}
    row = processed(spark, table, [encoded(record(identity=identity, headers={}))])[0]
    assert json.loads(row.user_data) == {"device_type": "unknown"}
    assert row.geoip is None and row.result == "success"


def test_bot_is_dropped(spark, table):
    identity = {"sourceIp": "1.2.3.4", "userAgent": "Googlebot/2.1", "requestId": "r"}
    assert processed(spark, table, [encoded(record(identity=identity))])[0].result == "dropped"


def test_rules_of_the_caller(spark, table):
    rules = [
        AgentRule(2, "browser", "Firefox/([0-9]+)", "Late", (1,)),
        AgentRule(1, "browser", "Mozilla", "Early"),
    ]
    row = processed(spark, table, [encoded(record())], rules)[0]
    found = json.loads(row.user_data)
    assert (found["browser"], found["operating_system"]) == ("Early", "Other")


def test_device_headers_are_tried_in_order(spark):
    headers = [
        ({"CloudFront-Is-Desktop-Viewer": "true", "CloudFront-Is-Mobile-Viewer": "true"}, "mobile"),
        ({"CloudFront-Is-Desktop-Viewer": "true", "CloudFront-Is-Mobile-Viewer": "false"}, "desktop"),
        ({"CloudFront-Is-Tablet-Viewer": "true", "CloudFront-Is-SmartTV-Viewer": "true"}, "smarttv"),
        ({"CloudFront-Is-Tablet-Viewer": "true"}, "tablet"),
        ({"CloudFront-Is-Tablet-Viewer": "True"}, "unknown"),
        ({"cloudfront-is-tablet-viewer": "true"}, "unknown"),
        ({}, "unknown"),
    ]
    df = spark.createDataFrame([(h, d) for h, d in headers], "headers map<string,string>, wanted string")
    assert all(r.device_type == r.wanted for r in enrich.with_device_type(df).collect())


def narrowest(blocks, number):
    holding = [b for b in blocks if b[0] <= number <= b[1]]
    return min(holding, key=lambda b: (b[1] - b[0], b[0], b[2]))[2] if holding else None


def text_of(number):
    return ".".join(str(number >> shift & 255) for shift in (24, 16, 8, 0))


def both_joins(spark, events, table):
    """Places by request, with the intervals broadcast and with both sides shuffled."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    for limit in (before, "-1"):
        spark.conf.set(setting, limit)
        try:
            joined = places.geoip_join(events, table)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == (limit == before)
            rows = joined.collect()
        finally:
            spark.conf.set(setting, before)
        assert len(rows) == len({r.request_id for r in rows})
        yield {r.request_id: r.place and r.place.country_name for r in rows}


def test_places_agree_with_brute_force(spark):
    """Nested, overlapping, adjacent, repeated and whole-range blocks; both join forms."""
    rng = random.Random(3)
    blocks = [(0, 2**32 - 1, "all"), (0, 0, "first"), (2**32 - 1, 2**32 - 1, "last")]
    for i in range(120):
        start = rng.choice([rng.randrange(2**32), 167_772_160 + rng.randrange(200_000)])
        end = min(2**32 - 1, start + rng.choice([0, 1, 255, 65_535, 70_000, rng.randrange(10**7)]))
        blocks.append((start, end, f"p{i:03d}"))
    blocks.append(blocks[5])
    edges = {n + d for a, b, _ in blocks for n in (a, b) for d in (-1, 0, 1)}
    numbers = [n for n in edges if 0 <= n < 2**32] + [rng.randrange(2**32) for _ in range(300)]
    rows = spark.createDataFrame([(a, b, p, None, None) for a, b, p in blocks], IP_BLOCKS)
    table = places.place_tree(places.disjoint_places(rows))
    events = spark.createDataFrame(
        [(str(i), text_of(n)) for i, n in enumerate(numbers)] + [("v6", "::1"), ("bad", "1.2.3")],
        "request_id string, source_ip string",
    )
    expected = {str(i): narrowest(blocks, n) for i, n in enumerate(numbers)}
    expected.update({"v6": None, "bad": None})
    for found in both_joins(spark, events, table):
        assert found == expected


def test_networks_of_both_families(spark, tmp_path):
    """CIDR blocks as text, looked up as the standard library does."""
    rng = random.Random(4)
    names = ["10.0.0.0/8", "10.1.0.0/16", "10.1.128.0/17", "10.1.128.0/30", "203.0.113.7/32"]
    names += ["2000::/24", "2001:db8::/32", "2001:db8:8000::/33", "2001:db8:1::/48", "ffff:ff00::/24"]
    names += ["2001:db8:1:2::/64", "7fff:ffff::/32", "8000::/26", "2001:db9::/32", "10.2.3.4"]
    names += ["::/0", "2000::/3", "4000::/2", "::/12", "0.0.0.0/0", "128.0.0.0/1"]
    names += [f"2001:db8:{rng.randrange(9):x}:{rng.randrange(65536):x}::/{n}" for n in (50, 56, 61, 64)]
    networks = [ipaddress.ip_network(n, strict=False) for n in names]
    rows = [(str(n), f"{i:02d}") for i, n in enumerate(networks)] + [("junk", "x"), ("1::/200", "x"), (None, "x")]
    path = str(tmp_path / "networks")
    frame = spark.createDataFrame(rows, "network string, country_name string")
    frame.selectExpr("*", "'c' AS country_iso", "'d' AS city").write.option("header", True).csv(path)
    table = places.place_tree(places.disjoint_places(read_address_blocks(spark, path)))
    addresses = [n[0] for n in networks] + [n[-1] for n in networks]
    addresses += [a + d for a in addresses for d in (-1, 1) if 0 <= int(a) + d < (2**32 if a.version == 4 else 2**128)]
    texts = [str(a) for a in addresses] + [a.exploded.upper() for a in addresses]
    texts += ["::ffff:10.1.2.3", "::", "1::2::3", "1:2", "12345::", None, ""]

    def expected(text):
        try:
            address = ipaddress.ip_address(text)
        except ValueError:
            return None
        address = getattr(address, "ipv4_mapped", None) or address
        inside = [(n.prefixlen, -i) for i, n in enumerate(networks) if n.version == address.version and address in n]
        return f"{-max(inside)[1]:02d}" if inside else None

    events = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "request_id string, source_ip string")
    for found in both_joins(spark, events, table):
        assert found == {str(i): expected(t) for i, t in enumerate(texts)}


def test_equal_neighbours_are_one_interval(spark):
    blocks = [(0, 65_535, "a", None, None), (100, 200, "a", None, None), (300, 400, "b", None, None)]
    table = places.disjoint_places(spark.createDataFrame(blocks, IP_BLOCKS))
    found = sorted((r.ip_from, r.ip_to, r.place.country_name) for r in table.collect())
    assert found == [(0, 299, "a"), (300, 400, "b"), (401, 65_535, "a")]


def test_records_without_address_are_spread(spark, table):
    events = spark.createDataFrame([(None, None, f"text {i}") for i in range(500)], "request_id string, source_ip string, data string")
    plan = places.geoip_join(events, table)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(request_id" in plan and "data" in plan


def test_no_overlap_between_places(spark):
    rows = places.disjoint_places(spark.createDataFrame(BLOCKS, IP_BLOCKS)).orderBy("ip_from").collect()
    assert len(rows) == 5 and all(a.ip_to < b.ip_from for a, b in zip(rows, rows[1:]))


def test_a_record_is_one_row_before_its_interval_is_tested(spark, table):
    """Joins are by node alone, and the bisection is not repeated."""
    events = spark.createDataFrame([("10.1.2.3",)], "source_ip string")
    plan = places.geoip_join(events, table)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 1 and ">" not in joins[0] and "<" not in joins[0]
    assert plan.count("Generate inline(") == 2  # the number of the address, and its interval
    assert "aggregate(" not in plan.split("Generate inline(")[0]
    assert all(level.groupBy("family", "node").count().where("count > 1").count() == 0 for level in table.levels)


def test_trees_of_several_levels(spark, monkeypatch):
    """Small nodes make a high tree; a network with many intervals spans several leaves."""
    monkeypatch.setattr(places, "FANOUT", 4)
    monkeypatch.setattr(places, "_STEPS", 3)
    rng = random.Random(8)
    blocks = []
    for i in range(150):
        start = rng.choice([rng.randrange(2**32), 167_772_160 + rng.randrange(3000)])
        blocks.append((start, min(2**32 - 1, start + rng.choice([0, 3, 40, 10**6])), f"p{i:03d}", None, None))
    tree = tree_of(spark, blocks)
    assert len(tree.levels) >= 4 and tree.levels[0].count() == 1
    edges = {n + d for a, b, *_ in blocks for n in (a, b) for d in (-1, 0, 1)} | {0, 2**32 - 1}
    numbers = sorted(n for n in edges if 0 <= n < 2**32)
    events = spark.createDataFrame([(str(n), text_of(n)) for n in numbers], "request_id string, source_ip string")
    expected = {str(n): narrowest([b[:3] for b in blocks], n) for n in numbers}
    for found in both_joins(spark, events, tree):
        assert found == expected


def test_no_blocks_at_all(spark):
    tree = tree_of(spark, [])
    events = spark.createDataFrame([("10.1.2.3",), (None,)], "source_ip string")
    assert [r.place for r in places.geoip_join(events, tree).collect()] == [None, None]
    tree = tree_of(spark, [(5, 4, "none", None, None)])
    assert [r.place for r in places.geoip_join(events, tree).collect()] == [None, None]


def test_ingest_moves_no_record(spark, table):
    """No shuffle but the broadcast of the places."""
    rows = raw(spark, [encoded(record())])
    plan = ingest_events(rows, table, arrival=F.col("arrived"))._jdf.queryExecution().executedPlan()
    before_places = plan.toString().split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in before_places and "BroadcastHashJoin" in before_places
    assert before_places.count("from_json") == 1


def test_written_batch(spark, table, tmp_path):
    root = str(tmp_path / "events")
    sample = sample_site.raw_envelopes(spark, "/root/testdata/sf0.001")
    counts = write_batch(ingest_events(sample, table, arrival=F.col("arrived_at")), root)
    assert sum(counts.values()) == sample.count() and min(counts.values()) > 0
    events = read_events(spark, root)
    assert events.count() == counts["success"] and events.schema.names == EVENTS.names
    day = read_events(spark, root, "2024-01-02", "2024-01-03")
    assert {r.date_day for r in day.select("date_day").distinct().collect()} == {"2024-01-02"}
    stored = spark.read.parquet(root).groupBy("result").count().collect()
    by_result = {r["result"]: r["count"] for r in stored}
    assert by_result.pop("success") == counts["success"]
    assert set(by_result) == {"not-base64", "not-utf8", "not-json", "incomplete"}
    assert sum(by_result.values()) == counts["failed"]
    assert read_results(spark, root).where("data IS NOT NULL").count() == counts["failed"]


def test_days_outside_of_the_range_are_not_read(spark, tmp_path):
    """Arrival days, some of them not the event's, are folders; the filter names them."""
    root = str(tmp_path / "events")
    sample = sample_site.web_events(spark, "/root/testdata/sf0.001")
    write_events(sample, root)
    chosen = read_events(spark, root, sample_site.START, sample_site.AS_OF)
    assert 0 < chosen.count() < sample.count()
    assert chosen.where(F.to_date("request_time").cast("string") != F.col("date_day")).count() > 0
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "date_day" in line.split("PartitionFilters: [")[1].split("]")[0]
    days = {r.date_day for r in chosen.select("date_day").distinct().collect()}
    assert days == {r.date_day for r in sample.select("date_day").distinct().collect() if "2024-01-02" <= r.date_day < "2024-01-30"}


def test_iso_text(spark):
    df = spark.createDataFrame(
        [(datetime(2022, 2, 17),), (datetime(2022, 2, 17, 0, 0, 0, 123000),)], "t timestamp_ntz"
    )
    found = [r[0] for r in df.select(iso_text(F.col("t"))).collect()]
    assert found == ["2022-02-17T00:00:00", "2022-02-17T00:00:00.123000"]


def test_entry(spark):
    assert entry.entry(spark).count() == 28


def test_invalid_utf8_is_an_error(spark, table):
    bad = base64.b64encode(json.dumps(record()).encode().replace(b"click", b"\xff\xfe")).decode()
    row = processed(spark, table, [bad])[0]
    assert row.result == enrich.NOT_UTF8 and row.data == bad and row.event_id is None


@pytest.mark.parametrize(
    "agent, browser, system",
    [
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 15_3_1 like Mac OS X) Version/15.3 Safari/604.1", "Safari 15.3", "iOS 15.3.1"),
        ("Mozilla/5.0 (iPad; CPU OS 9_0 like Mac OS X)", "Other", "iOS 9.0"),
        ("Mozilla/5.0 (Windows NT 10.0; Win64) Chrome/98.0.4758.102", "Chrome 98.0.4758.102", "Windows 10"),
        ("Mozilla/5.0 (Windows NT 6.1) Firefox/99", "Firefox 99", "Windows 7"),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Edg/101.1", "Edge 101.1", "Mac OS X 10.15.7"),
        ("Safari/ only", "Safari", "Other"),
    ],
)
def test_versions_in_full(spark, agent, browser, system):
    agents = spark.createDataFrame([(agent,)], "user_agent string")
    row = enrich.with_agent(agents).collect()[0]
    assert (row.browser, row.operating_system) == (browser, system)
