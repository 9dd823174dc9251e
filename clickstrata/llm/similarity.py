"""Set similarity join of documents: groups, their token unions, and bounds on both.

A document's set holds its distinct shingles. Identical sets are one set from here on.

* *Candidates.* Two sets that link differ in at most ``d`` tokens. Their tokens are dealt by a
  hash to more than ``d`` parts, with some to spare; then at most ``d`` parts differ, so a set
  with ``u`` parts that hold tokens shares ``u - d`` of them, at least, with every partner.
  Sets that share fewer, with all others taken together, are done; that is repeated, since
  their parts no longer count for the others. Sizes form bands, since ``d`` depends on them.
* *Families.* The tokens of the sets that are left are counted. A set with too many tokens that
  no other holds is done, and that is repeated too. Of the others, the rarest tokens count: a
  partner lacks so few tokens of a set that both hold one of the rarest of each, once these are
  one more than it can lack. Sets that share such tokens, directly or over others, are a family,
  and no link leaves a family.
* *Groups.* A family is partitioned into groups of similar sets, as many as its size asks for:
  sets whose most shared part is the same come together, in pieces of bounded size. A group's matrix is the union of its tokens with the
  sets that hold each. A query's overlap with the union bounds its overlap with every set of
  the group, so only groups that reach the threshold are opened, and then the matrix gives the
  exact overlap with every set at once.
* *Large families.* Some pivots of a family are put into each of its groups. A set that is
  connected to the first pivot within its group needs no further links, as only connections
  count; the others are sent to the other groups whose sets have one of their rarest tokens
  among their own rarest. A group's visitors come in pieces of bounded size, each with the group.

All tests are exact on 64-bit hashes of shingles. Only spanning links are given out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import (
    LOWER,
    WordHashes,
    Workspace,
    fresh_name,
    mixed,
    shingle_hashes,
    small_batches,
    texts_of,
    workspace,
)
from clickstrata.llm.components import components

#: Words of a shingle, and the similarity in percent from which sets link.
SHINGLE = 3
PERCENT = 90

#: Parts beyond those that a difference can touch: some, and one for so many of these. Partners
#: share as many more; sets that have only a passage in common rarely do.
SPARE_PARTS, SPARE_SHARE = 2, 6

#: Times that sets which share too few parts, and then too few tokens, are left out.
PRUNINGS = 2

#: Sets of a group, about, and pivots of a family with several groups.
GROUP_ROWS = 256
PIVOTS = 8

#: Visitors of a group that are compared in one task, about.
VISITOR_ROWS = 1024

SKETCH = "doc_id bigint, n bigint, set_id binary, parts array<bigint>, needs array<int>"


# Sets --------------------------------------------------------------------------------------


def shingle_set(data: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``n`` are one shingle."""
    words = data.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    own = hashes.of(words)
    return np.unique(shingle_hashes(own, min(n, len(words))))


def set_id(tokens: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None


@lru_cache(maxsize=8)
def _bands(percent: int, largest: int) -> list[int]:
    """First size of each band. A set's partners are in its band or a neighbouring one."""
    firsts = [1, 2]
    while firsts[-2] <= largest:
        firsts.append(firsts[-1] * 10000 // percent**2 + 1)
    return firsts


def part_keys(tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, list[int]]:
    """Keys of a set's parts, and how many of them it shares with every set that it links to.

    Both sets use the band of the smaller one, so a set has keys for its own band, and for the
    one below if that can hold a partner. The lowest bit of a key is that of its band; the
    second result has the number for even and for odd bands. A part without tokens is left out,
    unless the set has so many of them that the parts with tokens may all differ.
    """
    needs = [1, 1]
    if not len(tokens):
        return np.empty(0, np.uint64), needs
    firsts = _bands(percent, 1 << int(len(tokens)).bit_length())
    band = int(np.searchsorted(firsts, len(tokens), "right")) - 1
    deal, content = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), mixed(tokens)
    keys = []
    lower = band and (firsts[band] - 1) * 100 >= percent * len(tokens)
    for b in (band, band - 1)[: 1 + bool(lower)]:
        differ = (firsts[b + 1] - 1) * (100 - percent) // percent
        count = differ + 1 + SPARE_PARTS + differ // SPARE_SHARE
        part = ((deal >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        sums = np.add.reduceat(content[order], first)
        # with empty parts listed, a partner may not list those
        needs[b % 2] = max(1, len(used) - differ)
        if len(used) <= differ:
            empty = np.setdiff1d(np.arange(count), used)
            used = np.concatenate([used, empty])
            sums = np.concatenate([sums, np.zeros(len(empty), np.uint64)])
        place = (used + (b << 32)).astype(np.uint64)
        hashed = mixed(sums ^ mixed(place + np.uint64(1)))
        keys.append(hashed >> np.uint64(1) << np.uint64(1) | np.uint64(b % 2))
    return np.concatenate(keys), needs


def sketches(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, n, set_id, parts, needs`` of every row (see ``part_keys``); sets that can have
    no partner have no parts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, ids, parts, needs = [], [], [], []
            for data in texts_of(batch.column(1)):
                tokens = shingle_set(data, shingle, hashes)
                sizes.append(len(tokens))
                ids.append(set_id(tokens))
                # with one token more or less, smaller sets are already too different
                alone = len(tokens) * 100 < percent * (len(tokens) + 1)
                keys, need = (None, None) if alone else part_keys(tokens, percent)
                parts.append(None if alone else keys.view(np.int64))
                needs.append(need)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(parts, pa.list_(pa.int64())),
                    pa.array(needs, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "set_id", "parts", "needs"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sketch, SKETCH)


# Families and groups -----------------------------------------------------------------------


def _needs(sets: DataFrame) -> DataFrame:
    """``node, odd, need``: parts that a set shares with each partner, by kind of band."""
    by_band = sets.where("needs IS NOT NULL").select(
        "node", F.posexplode("needs").alias("odd", "need")
    )
    return by_band.groupBy("node", "odd").agg(F.min("need").alias("need"))


def _of_enough(counted: DataFrame, needs: DataFrame) -> DataFrame:
    """Rows with ``node, odd, n`` whose set shares at least ``n`` parts with each partner."""
    return counted.join(needs, ["node", "odd"]).where("n >= need").drop("n", "need")


def _odd() -> Column:
    return F.col("part").bitwiseAND(1).cast("int").alias("odd")


def shared_parts(sets: DataFrame, work: Workspace) -> DataFrame:
    """``part, node, count, first``: the parts that a set shares with ``count - 1`` others.

    A set with fewer parts than it needs for a single partner has no partner in that band; its
    parts go, and so may the need of others be missed. Parts that partners share never go.
    """
    parts = sets.select("node", F.explode("parts").alias("part")).repartition("part")
    needs = work.written(_needs(sets), "needs")
    for _ in range(1 + PRUNINGS):
        often = parts.groupBy("part").agg(
            F.count(F.lit(1)).alias("count"), F.min("node").alias("first")
        )
        shared = work.written(parts.join(often.where("count > 1"), "part"), "shared-parts")
        counted = shared.groupBy("node", _odd()).agg(F.count_distinct("part").alias("n"))
        enough = _of_enough(counted, needs)
        parts = shared.select("node", "part", _odd()).join(enough, ["node", "odd"], "left_semi").drop("odd")
    return shared


def rarest_tokens(sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """``node, part``: the rarest tokens of ``sets`` (``node, set_id, tokens``) that can have a
    partner, those left out that no other set holds.

    A partner holds at least ``least`` of a set's ``n`` tokens. In one order for all sets, the
    first token that both hold is at most the ``n - least + 1``-th of either.
    """
    # an id can have several sets
    held = sets.select(
        "node",
        F.xxhash64("set_id").alias("set"),
        F.size("tokens").alias("n"),
        F.explode("tokens").alias("token"),
    )
    least = F.expr(f"(n * {percent}L + 99) div 100")
    for _ in range(PRUNINGS):
        often = held.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
        shared = work.written(held.join(often, "token"), "shared-tokens")
        enough = shared.groupBy("node", "set", "n").count().where(F.col("count") >= least)
        held = shared.drop("count").join(enough.select("node", "set"), ["node", "set"], "left_semi")
    one_set = Window.partitionBy("node", "set")
    ranked = shared.select(
        "node",
        "n",
        "token",
        F.count(F.lit(1)).over(one_set).alias("shared"),
        F.row_number().over(one_set.orderBy("count", "token")).alias("place"),
    )
    # the tokens that no other set holds come before these
    rarest = ranked.where(F.col("shared") >= least).where(
        F.col("n") - F.col("shared") + F.col("place") <= F.col("n") - least + 1
    )
    return work.written(rarest.select("node", F.col("token").alias("part")).distinct(), "rarest-tokens")


def families(rarest: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets that share some of their ``rarest`` tokens: ``node, family, grp``, the groups of
    families with several, and the tokens that are shared: ``node, part``."""
    often = rarest.groupBy("part").agg(
        F.count(F.lit(1)).alias("count"), F.min("node").alias("first")
    )
    shared = work.written(rarest.join(often.where("count > 1"), "part"), "shared-rarest")
    found = components(shared.select(F.col("node").alias("a"), F.col("first").alias("b")), work)
    most = shared.groupBy("node").agg(
        F.max(F.struct("count", "part")).alias("most")
    )
    placed = most.join(found.withColumnRenamed("component", "family"), "node").select(
        "node", "family", F.col("most.part").alias("part")
    )
    sizes = placed.groupBy("family", "part").agg(F.count(F.lit(1)).alias("alike"))
    whole = placed.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    count = F.expr(f"members div {GROUP_ROWS} + 1")
    piece = F.pmod(F.xxhash64("node"), F.expr(f"alike div {GROUP_ROWS} + 1"))
    members = work.written(
        placed.join(sizes, ["family", "part"])
        .join(whole, "family")
        .select("node", "family", F.pmod(F.pmod("part", count) + piece, count).alias("grp")),
        "family-members",
    )
    groups = members.select("family", "grp").distinct()
    several = groups.groupBy("family").count().where("count > 1").select("family")
    several_groups = work.written(groups.join(several, "family"), "family-groups")
    return members, several_groups, shared.select("node", "part")


def visits(
    lost: DataFrame,
    members: DataFrame,
    shared: DataFrame,
    needs: DataFrame,
    work: Workspace,
) -> DataFrame:
    """``node, family, grp``: the other groups of its family that may hold a partner of a set.

    ``lost`` has ``node, family, own``. A partner holds as many of the set's parts as the set
    needs, so its group does. Parts and groups meet before any sets are moved.
    """
    lost = lost.select("node", "family", "own").distinct()
    groups = members.select("family", "grp").distinct()
    sizes = groups.groupBy("family").agg(F.count(F.lit(1)).alias("groups"))
    holders = work.written(
        members.join(shared, "node").select("family", "part", "grp").distinct(), "holders"
    )
    held = holders.groupBy("family", "part").agg(F.count(F.lit(1)).alias("by"))
    # parts that every group of the family holds count for all of them at once
    everywhere = work.written(
        held.join(sizes, "family").where("by = groups").select("part"), "parts-of-all-groups"
    )
    elsewhere = holders.join(everywhere, "part", "left_anti").select("part", "grp")
    wanted = work.written(lost.join(shared.select("node", "part").distinct(), "node"), "wanted")
    asked = (
        wanted.join(everywhere.withColumn("all", F.lit(1)), "part", "left")
        .groupBy("node", "family", "own", _odd())
        .agg(F.count("all").alias("sure"))
        .join(needs, ["node", "odd"])
        .select("node", "family", "own", "odd", (F.col("need") - F.col("sure")).alias("more"))
    )
    asked = work.written(asked, "parts-asked")
    to_all = asked.where("more <= 0").select("node", "family", "own").distinct()
    found = (
        wanted.join(elsewhere, "part")
        .where("grp <> own")
        .groupBy("node", "grp", _odd())
        .agg(F.count(F.lit(1)).alias("n"))
        .join(asked.where("more > 0"), ["node", "odd"])
        .where("n >= more")
        .select("node", "family", "grp")
    )
    every = to_all.join(groups, "family").where("grp <> own").select("node", "family", "grp")
    return every.unionByName(found).distinct()


def dealt(visitors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Visits with their ``piece`` of about ``VISITOR_ROWS``, and ``family, grp, piece`` of all pieces."""
    sizes = visitors.groupBy("family", "grp").agg(
        F.expr(f"count(1) div {VISITOR_ROWS} + 1").alias("pieces")
    )
    piece = F.pmod(F.xxhash64("node"), F.col("pieces"))
    pieces = sizes.select("family", "grp", F.explode(F.expr("sequence(0L, pieces - 1)")).alias("piece"))
    return visitors.join(sizes, ["family", "grp"]).withColumn("piece", piece).drop("pieces"), pieces


def pivots(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Some sets of each family with several groups, for each of its groups."""
    chosen = members.join(groups.select("family").distinct(), "family").groupBy("family").agg(
        F.array_distinct(
            F.array(*[F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(PIVOTS)])
        ).alias("nodes")
    )
    return chosen.select("family", F.explode("nodes").alias("node"))


class Matrix:
    """The tokens of a group, and for each the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens = tokens[order]
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def links(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets that the query links to; none if the union already says so."""
        low = np.searchsorted(self.tokens, query)
        counts = np.searchsorted(self.tokens, query, "right") - low
        if np.count_nonzero(counts) * 100 < percent * len(query):
            return np.empty(0, np.int64)
        low, counts = low[counts > 0], counts[counts > 0]
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        both = np.bincount(self.owners[np.repeat(low, counts) + inside], minlength=len(self.sizes))
        return np.flatnonzero(both * 100 >= percent * (self.sizes + len(query) - both))


class _Forest:
    """Union-find over numbers."""

    def __init__(self, count: int):
        self.above = list(range(count))

    def root(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


LINKS = "a bigint, b bigint, family bigint, grp bigint"


def _opened(percent: int, visits: bool):
    """Spanning links of one group. Rows with ``b`` null: sets to be sent to other groups.

    ``kind`` 0 are pivots, 1 sets of the group, 2 visitors from other groups.
    """

    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("node", "ascending")])
        kinds, nodes = table.column("kind").to_numpy(), table.column("node").to_pylist()
        sets = [s.values.to_numpy().view(np.uint64) for s in table.column("tokens")]
        held = np.flatnonzero(kinds != 2)
        matrix, forest, found = Matrix([sets[i] for i in held]), _Forest(len(sets)), []
        place = {node: i for i, node in reversed(list(enumerate(nodes)))}
        for i, node in enumerate(nodes):
            forest.join(i, place[node])  # a pivot is also a set of its own group
            if (kinds[i] != 2) == visits:
                continue
            for j in held[matrix.links(sets[i], percent)].tolist():
                if forest.join(i, j):
                    found.append((node, nodes[j]))
        if not visits and len(kinds) and kinds[0] == 0:
            first = forest.root(0)
            found += [
                (node, None)
                for i, node in enumerate(nodes)
                if kinds[i] == 1 and forest.root(i) != first
            ]
        return pa.table(
            {
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64()),
                "family": pa.array([table.column("family")[0].as_py()] * len(found), pa.int64()),
                "grp": pa.array([table.column("grp")[0].as_py()] * len(found), pa.int64()),
            }
        )

    return links


def _token_sets(docs: DataFrame, named: DataFrame, shingle: int, work: Workspace) -> DataFrame:
    """``node, set_id, tokens`` of the sets in ``named`` (``node, set_id``)."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            made = [shingle_set(d, shingle, hashes) for d in texts_of(batch.column(2))]
            # a repeated id with another text is another set
            keep = [set_id(t) == s.as_py() for t, s in zip(made, batch.column(1), strict=True)]
            listed = pa.array([t.view(np.int64) for t in made], pa.list_(pa.int64()))
            whole = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), listed], ["node", "set_id", "tokens"]
            )
            yield whole.filter(pa.array(keep))

    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), "text")
    joined = named.join(texts, "node").select("node", "set_id", "text")
    made = joined.mapInArrow(tokens, "node bigint, set_id binary, tokens array<bigint>")
    return work.written(made.dropDuplicates(["node", "set_id"]), "token-sets")


def set_links(
    docs: DataFrame, sets: DataFrame, ids: DataFrame, shingle: int, percent: int, work: Workspace
) -> DataFrame:
    """Spanning links (a, b) between different sets, named by the smallest id that has each."""
    candidates = shared_parts(sets, work).select("node").distinct()
    made = _token_sets(docs, ids.join(candidates, "node", "left_semi"), shingle, work)
    members, groups, shared = families(rarest_tokens(made, percent, work), work)
    tokens = work.written(
        members.join(made, "node").select("node", "family", "grp", "tokens"), "family-sets"
    )
    chosen = pivots(members, groups)
    pivot_rows = (
        tokens.drop("grp").join(chosen, ["family", "node"]).join(groups, "family")
    ).select("node", "family", "grp", "tokens", F.lit(0).alias("kind"))
    member_rows = tokens.select("node", "family", "grp", "tokens", F.lit(1).alias("kind"))
    by_group = pivot_rows.unionByName(member_rows).groupBy("family", "grp")
    inside = work.written(by_group.applyInArrow(_opened(percent, False), LINKS), "group-links")
    lost = inside.where("b IS NULL").select(F.col("a").alias("node"), "family", F.col("grp").alias("own"))
    several = members.join(groups.select("family").distinct(), "family", "left_semi")
    # partners share one of the rarest tokens
    one = lost.select("node", F.explode(F.array(F.lit(0), F.lit(1))).alias("odd"), F.lit(1).alias("need"))
    visiting, pieces = dealt(
        work.written(visits(lost, several, shared, one.distinct(), work), "visits")
    )
    visitors = tokens.drop("grp", "family").join(visiting, "node").select(
        "node", "family", "grp", "piece", "tokens", F.lit(2).alias("kind")
    )
    hosts = member_rows.join(pieces, ["family", "grp"])
    outside = (
        visitors.unionByName(hosts)
        .groupBy("family", "grp", "piece")
        .applyInArrow(_opened(percent, True), LINKS)
    )
    return inside.where("b IS NOT NULL").unionByName(outside).select("a", "b")


def similarity_classes(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when the Jaccard similarity of their sets is at least ``percent``;
    ``component_id`` is the smallest id that links reach. Null and empty texts, and texts
    without words, have no shingles and are alone. Rows that repeat an id are one document:
    what links to one of their texts links to all. A row without an id gets the class of its
    text, if a row with an id has that. An empty table gives an empty result; other columns
    are ignored.
    """
    spark = docs.sparkSession
    with workspace(spark, "similarity") as work, small_batches(spark):
        return work.result(_classes(docs, shingle, percent, work))


def _classes(docs: DataFrame, shingle: int, percent: int, work: Workspace) -> DataFrame:
    rows = work.written(sketches(docs, shingle, percent), "sketches")
    named = rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    sets = named.groupBy("set_id").agg(
        F.min("doc_id").alias("node"),
        F.min_by("parts", "doc_id").alias("parts"),
        F.min_by("needs", "doc_id").alias("needs"),
    )
    ids = work.written(named.groupBy("set_id").agg(F.min("doc_id").alias("node")), "sets")
    # the same id with several texts: their sets belong together
    several = named.select("doc_id", "set_id").join(ids, "set_id").groupBy("doc_id").agg(
        F.min("node").alias("low"), F.max("node").alias("high")
    ).where("low <> high").select("doc_id", "low")
    repeated = (
        named.select("doc_id", "set_id").join(several, "doc_id").join(ids, "set_id")
    ).select(F.col("node").alias("a"), F.col("low").alias("b"))
    links = set_links(docs, sets, ids, shingle, percent, work).unionByName(repeated)
    known = ids.join(components(links, work), "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("component")
    )
    return rows.join(known, "set_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each class, with all columns: that with the smallest id.

    Rows without an id, and repeated rows of a kept id, stay.
    """
    fresh = fresh_name("gone", docs)
    gone = similarity_classes(docs, shingle, percent).where("component_id < doc_id")
    gone = gone.select(F.col("doc_id").alias(fresh)).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == F.col(fresh), "left_anti")
