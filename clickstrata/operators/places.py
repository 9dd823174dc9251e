"""Look up the place of an address, of either family, in a table of address blocks.

Blocks may be nested and of any width; the narrowest one that holds an address counts.
``disjoint_places`` turns them, once per table, into intervals that do not overlap, and
``place_tree`` stores these as a search tree: a leaf is a row with the sorted starts, ends and
place numbers of ``FANOUT`` intervals, a node above it a row with the first starts of as many
children. A record is looked up by a bisection inside an expression on each level and an
equi-join with the child it finds, so that one record is one row all the way: no record meets
the intervals of its network one by one, and none is multiplied and filtered.

Whether a level is broadcast is Spark's own choice by its size in bytes
(``spark.sql.autoBroadcastJoinThreshold``); the levels above the leaves are a few kilobytes.
Beyond it the join is a shuffle by node, whose busy nodes AQE splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clickstrata.functions.addresses import family_and_number, network_key, network_range
from clickstrata.sources.shared import fresh_path

#: Keys given to records without an address: enough for any number of tasks.
_SPREAD = 1 << 30

#: Intervals of a leaf and children of a node; a bisection takes one step more than its bits.
FANOUT = 256
_STEPS = FANOUT.bit_length()


def blocks_of_networks(networks: DataFrame, network: str = "network") -> DataFrame:
    """Blocks from CIDR text of both families, with the place columns; malformed rows go.

    Of rows with the same text only that with the smallest place stays, which is the one that
    ``disjoint_places`` takes of equal blocks: a text is read once, however many rows have it.
    """
    place = F.min(F.struct("country_name", "country_iso", "city")).alias("place")
    texts = networks.groupBy(F.col(network).alias("network")).agg(place)
    # a generator: its columns are never computed again by what follows
    found = texts.select(F.inline(F.array(network_range(F.col("network")))), "place.*")
    return found.where(F.col("family").isNotNull())


def _with_family(blocks: DataFrame) -> DataFrame:
    return blocks if "family" in blocks.columns else blocks.withColumn("family", F.lit(4))


def _block(width: str) -> Column:
    return F.struct(
        F.expr(width).cast("bigint").alias("width"),
        "ip_from",
        F.struct("country_name", "country_iso", "city").alias("place"),
    ).alias("block")


def _prefix(number: str) -> Column:
    """The number without the bits of its level; a shift by all 64 bits would be none."""
    return F.expr(f"if(level > 63, 0L, shiftright({number}, level))")


def _aligned_pieces(blocks: DataFrame) -> DataFrame:
    """Split every block into aligned power-of-two ranges, and of equal ranges keep the one
    from the narrowest block.

    On level k a range is ``prefix * 2^k`` and has ``2^k`` addresses. An IPv4 block has at most
    two ranges per level: an odd one at its left end and one at its right end. An IPv6 block
    is a CIDR network, so it is one range: the level is the number of bits in which its ends
    differ.
    """
    levels = blocks.where("family = 4 AND ip_from <= ip_to").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("level")
    )
    size = F.pow(F.lit(2), F.col("level")).cast("bigint")
    ends = levels.withColumn("size", size).withColumns(
        {
            "left": F.expr("(ip_from + size - 1) div size"),
            "right": F.expr("(ip_to + 1) div size"),
        }
    )
    odd_left = F.when(F.col("left") % 2 == 1, F.col("left"))
    odd_right = F.when(F.col("right") % 2 == 1, F.col("right") - 1)
    old = ends.where(F.col("left") < F.col("right")).select(
        "family",
        "level",
        F.explode(F.array_compact(F.array(odd_left, odd_right))).alias("prefix"),
        _block("ip_to - ip_from"),
    )
    new = (
        blocks.where("family = 6 AND ip_from <= ip_to")
        .withColumn("level", F.expr("if(ip_from = ip_to, 0, length(bin(ip_from ^ ip_to)))"))
        .select("family", "level", _prefix("ip_from").alias("prefix"), _block("level"))
    )
    both = old.unionByName(new)
    return both.groupBy("family", "level", "prefix").agg(F.min("block").alias("block"))


def disjoint_places(blocks: DataFrame) -> DataFrame:
    """Intervals ``ip_from..ip_to`` of a ``family`` that do not overlap, with their ``place``.

    The place can only change where a block starts or has ended. Each such point is looked up
    once per level in use, by equality; it then holds up to the next point. No pair of
    overlapping blocks is compared, and a block is not cut however wide it is. Points are put
    in order network by network; only the first points of the networks in use, a few bytes
    each, are ordered over a whole family.
    """
    blocks = _with_family(blocks)
    pieces = _aligned_pieces(blocks)
    last = F.expr("if(family = 4, 4294967295, 9223372036854775807)")
    starts = blocks.where("ip_from <= ip_to").select("family", F.col("ip_from").alias("point"))
    after = blocks.where((F.col("ip_from") <= F.col("ip_to")) & (F.col("ip_to") < last)).select(
        "family", (F.col("ip_to") + 1).alias("point")
    )
    points = starts.unionByName(after).distinct()
    levels = pieces.select("family", "level").distinct()  # fewer than a hundred
    keys = points.join(F.broadcast(levels), "family").withColumn("prefix", _prefix("point"))
    narrowest = (
        keys.join(pieces, ["family", "level", "prefix"])
        .groupBy("family", "point")
        .agg(F.min("block").alias("block"))
    )
    keyed = points.withColumn("network", network_key(F.col("family"), F.col("point")))
    in_family = W.partitionBy("family").orderBy("network")
    networks = keyed.groupBy("family", "network").agg(F.min("point").alias("first_point"))
    following = networks.select(
        "family",
        "network",
        (F.lead("first_point").over(in_family) - 1).alias("before_next_network"),
    )
    in_network = W.partitionBy("family", "network").orderBy("point")
    before = F.lag(F.struct("block.place")).over(in_network)
    return (
        keyed.join(narrowest, ["family", "point"], "left")
        .withColumn("same", F.coalesce(before.eqNullSafe(F.struct("block.place")), F.lit(False)))
        .where(~F.col("same"))
        .withColumn("before_next", F.lead("point").over(in_network) - 1)
        .join(following, ["family", "network"])
        .withColumn("ip_to", F.coalesce("before_next", "before_next_network", last))
        .where(F.col("block").isNotNull())
        .select("family", F.col("point").alias("ip_from"), "ip_to", "block.place")
    )


# Tree --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PlaceTree:
    """Stored levels from the top (one node a family) to the leaves.

    Nodes have ``family, node, starts``; leaves also ``ends``, ``numbers`` and, by number,
    ``places``.
    """

    levels: tuple[DataFrame, ...]


def _numbered(intervals: DataFrame) -> DataFrame:
    """Intervals with their ``position`` in their family, counted within networks first."""
    keyed = intervals.withColumn("network", network_key(F.col("family"), F.col("ip_from")))
    counts = keyed.groupBy("family", "network").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("family").orderBy("network").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select(
        "family", "network", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    number = F.row_number().over(W.partitionBy("family", "network").orderBy("ip_from"))
    return (
        keyed.withColumn("number", number)
        .join(bases, ["family", "network"])
        .withColumn("position", F.col("base") + F.col("number") - 1)
    )


def _leaves(intervals: DataFrame) -> DataFrame:
    sorted_entries = F.sort_array(F.collect_list(F.struct("ip_from", "ip_to", "place")))
    places = F.array_distinct(F.transform("entries", lambda e: e["place"]))
    return (
        _numbered(intervals)
        .groupBy("family", F.expr(f"position div {FANOUT}").alias("node"))
        .agg(sorted_entries.alias("entries"))
        .select("family", "node", "entries", places.alias("places"))
        .select(
            "family",
            "node",
            F.transform("entries", lambda e: e["ip_from"]).alias("starts"),
            F.transform("entries", lambda e: e["ip_to"]).alias("ends"),
            F.transform(
                "entries", lambda e: F.array_position(F.col("places"), e["place"]).cast("int")
            ).alias("numbers"),
            "places",
        )
    )


def _parents(level: DataFrame) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("node", F.get("starts", 0).alias("start"))))
    return (
        level.groupBy("family", F.expr(f"node div {FANOUT}").alias("parent"))
        .agg(children.alias("children"))
        .select(
            "family",
            F.col("parent").alias("node"),
            F.transform("children", lambda c: c["start"]).alias("starts"),
        )
    )


def place_tree(intervals: DataFrame, folder: str | None = None) -> PlaceTree:
    """Store the tree of ``disjoint_places`` in ``folder``, by default a fresh shared one."""
    spark = intervals.sparkSession
    folder = folder or fresh_path(spark, "places")
    level, depth = _leaves(intervals), 0
    while True:
        path = f"{folder}/level-{depth}"
        level.write.parquet(path)
        level = spark.read.schema(level.schema).parquet(path)
        if not level.where("node > 0").head(1):
            return read_place_tree(spark, folder)
        level, depth = _parents(level), depth + 1


def read_place_tree(spark: SparkSession, folder: str) -> PlaceTree:
    """A stored tree, for batches and streams."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    depths = sorted((int(f.getPath().getName().removeprefix("level-")) for f in found), reverse=True)
    node = "family INT, node BIGINT, starts ARRAY<BIGINT>"
    place = "STRUCT<country_name: STRING, country_iso: STRING, city: STRING>"
    leaf = f"{node}, ends ARRAY<BIGINT>, numbers ARRAY<INT>, places ARRAY<{place}>"
    return PlaceTree(
        tuple(
            spark.read.schema(node if depth else leaf).parquet(f"{folder}/level-{depth}")
            for depth in depths
        )
    )


def _last_not_above(starts: Column, number: Column) -> Column:
    """Index of the last of some sorted numbers that is not above ``number``; -1 if all are."""

    def step(found: Column, _: Column) -> Column:
        middle = F.shiftright(found["low"] + found["high"], 1)
        below = F.coalesce(F.get(starts, middle) <= number, F.lit(False))
        is_open = found["low"] < found["high"]
        return F.struct(
            F.when(is_open & below, middle + 1).otherwise(found["low"]).alias("low"),
            F.when(is_open & ~below, middle).otherwise(found["high"]).alias("high"),
        )

    size = F.coalesce(F.size(starts), F.lit(0))
    first = F.struct(F.lit(0).alias("low"), size.alias("high"))
    steps = F.sequence(F.lit(1), F.lit(_STEPS))
    return F.aggregate(steps, first, step, lambda found: found["low"] - 1)


def geoip_join(events: DataFrame, tree: PlaceTree, address: str = "source_ip") -> DataFrame:
    """Add ``place`` (country name, country code, city), null when unknown.

    ``tree`` comes from ``place_tree``. Records without a sound address cannot match, nor can
    those below all blocks; they get keys of their own, spread by their texts, so that a
    shuffled join does not gather them in one task.
    """
    texts = [f.name for f in events.schema if isinstance(f.dataType, StringType)]
    nowhere = F.pmod(F.xxhash64(*texts), F.lit(_SPREAD))
    ip = F.inline(F.array(family_and_number(F.col(address)))).alias("_family", "_number")
    rows = events.select(*events.columns, ip).select(
        *events.columns,
        "_number",
        F.coalesce("_family", F.lit(-1)).alias("_family"),
        F.when(F.col("_family").isNull(), nowhere).otherwise(0).cast("bigint").alias("_node"),
    )
    for level in tree.levels:
        named = level.select(*[F.col(c).alias(f"_at_{c}") for c in level.columns])
        here = (F.col("_family") == F.col("_at_family")) & (F.col("_node") == F.col("_at_node"))
        # a generator: the bisection is not computed again by what follows
        found = F.inline(
            F.array(F.struct(_last_not_above(F.col("_at_starts"), F.col("_number")).alias("_at")))
        )
        others = [c for c in named.columns if c not in ("_at_family", "_at_node", "_at_starts")]
        rows = rows.join(named, here, "left").select(
            *events.columns, "_number", "_family", "_node", *others, found
        )
        if level is not tree.levels[-1]:
            inside = F.col("_at") >= 0
            rows = rows.select(
                *events.columns,
                "_number",
                F.when(inside, F.col("_family")).otherwise(-1).alias("_family"),
                F.when(inside, F.col("_node") * FANOUT + F.col("_at")).otherwise(nowhere).alias("_node"),
            )
    at = F.col("_at")
    held = F.get("_at_ends", at) >= F.col("_number")
    place = F.get("_at_places", F.get("_at_numbers", at) - 1)
    return rows.select(*events.columns, F.when((at >= 0) & held, place).alias("place"))
