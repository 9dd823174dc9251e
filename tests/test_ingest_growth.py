"""Work of ingest that must not grow with repeated rows, and must be spread over tasks."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickstrata.functions.addresses import ipv4_number
from clickstrata.operators.places import blocks_of_networks, disjoint_places, geoip_join, place_tree

SF_DIR = "/root/testdata/sf0.001"


def test_a_repeated_network_is_one_block(spark, tmp_path):
    rows = [("10.0.0.0/8", f"Country {i % 7 + 1}", "C", None if i % 2 else "City") for i in range(50)]
    rows += [("10.1.0.0/16", "Narrow", "N", None), ("no network", "X", "X", None), (None, "X", "X", None)]
    networks = spark.createDataFrame(
        rows, "network string, country_name string, country_iso string, city string"
    )
    blocks = blocks_of_networks(networks)
    assert blocks.count() == 2
    tree = place_tree(disjoint_places(blocks), str(tmp_path / "places"))
    events = spark.createDataFrame([("10.0.0.1",), ("10.1.0.1",), ("11.0.0.1",)], "source_ip string")
    found = {r.source_ip: r.place and tuple(r.place) for r in geoip_join(events, tree).collect()}
    # of equal blocks the smallest place, without a city before one with
    assert found == {
        "10.0.0.1": ("Country 1", "C", None),
        "10.1.0.1": ("Narrow", "N", None),
        "11.0.0.1": None,
    }


def test_one_file_is_many_tasks(spark):
    with entry.scratch(spark, "spread") as folder:
        stored, _ = entry._ingested(spark, SF_DIR, folder)
        part = F.regexp_extract(F.input_file_name(), r"part-(\d+)-", 1)
        assert stored.select(part).distinct().count() > 1


def test_an_address_is_split_once(spark):
    split = spark.range(1).select(F.lit("1.2.3.4").alias("a")).select(ipv4_number(F.col("a")).alias("n"))
    assert str(split._jdf.queryExecution().analyzed()).count("split(") == 1
