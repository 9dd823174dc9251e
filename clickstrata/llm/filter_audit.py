"""What each filter of a cleaning chain removes, in every order the filters can be applied.

Every row is reduced to a mask of the filters that it fails; what the filters do in an order
depends on the mask alone. Rows are counted by (part, mask): at most 2^n cells a part, whatever
the number of rows. The orders are a constant array that goes to the tasks with the plan. Each
cell folds across it: ``transform`` walks the orders, ``aggregate`` walks the steps of one with
the state "still there", and the result is one weighted struct per (order, step), 600 for five
filters. The structs of a part's cells are merged by elementwise sums. No Python runs on rows.

The five filters on documents need the text once; the audit itself reads a few bytes a document.
Identical texts are found by a digest: the smallest ``doc_id`` of each digest, combined before
the shuffle, is joined back by (digest, id). That key is as good as unique, so a text with a third of
all rows is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import Workspace, workspace

#: White space between words.
SPACE = r"[\x20\x09-\x0D]+"

#: Limits of the five filters: a document fails with fewer words than ``MIN_WORDS``, with fewer
#: distinct words than this share of its words, with more capitals than that share of its code
#: points, or with any of the marks.
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
MARKS = "[#$%&*|]"

#: Eight filters would make 8! orders of 8 steps for each part.
MOST_FILTERS = 7


# Masks -------------------------------------------------------------------------------------


def _text_mask(text: Column) -> Column:
    """Filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < MIN_WORDS,
        distinct * F.lit(100).cast("bigint") < n * F.lit(DISTINCT_PERCENT).cast("bigint"),
        capitals * F.lit(100).cast("bigint")
        > F.length(text) * F.lit(CAPITALS_PERCENT).cast("bigint"),
        text.rlike(MARKS),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def _repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``repeats``: the digest also belongs to a smaller ``doc_id``."""
    firsts = (
        docs.where("doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("first", F.lit(True))
    )
    joined = docs.join(firsts, ["digest", "doc_id"], "left")
    return joined.withColumn(
        "repeats", F.col("doc_id").isNotNull() & F.col("first").isNull()
    ).drop("first")


def document_failures(docs: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """One row per document: ``part`` (its source, null as empty), ``mask``, ``good``, ``toxic``.

    Bits of the mask, from the lowest: A few words, B few distinct words, C many capitals,
    D marks, E text identical to that of a smaller ``doc_id``. Null texts are empty: they fail A,
    and E if they are not the first. Rows without ``doc_id`` have no order: they neither fail E nor
    make others fail it, and have no labels. Rows that repeat an id are rows of their own; with
    the same text they do not make each other fail E. A document is good (toxic) if any of its
    rows in ``labels`` says so.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = work.written(
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text")).select(
            "doc_id",
            "part",
            _text_mask(F.col("text")).alias("mask"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
        ),
        "failures",
    )
    flags = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    return _repeats(narrow).join(flags, "doc_id", "left").select(
        "part",
        (F.col("mask") + F.when(F.col("repeats"), 16).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


# Folds -------------------------------------------------------------------------------------

_COUNTS = ("kept", "removed", "redundant", "unique_fails")


def _fold(orders: Column, cell: Column, lost: tuple[str, ...]) -> Column:
    """The structs of one cell: for each order and each step of it, where its rows are."""
    names = (*_COUNTS, *lost)
    step_type = ", ".join(["bit: int", *(f"{name}: bigint" for name in names)])
    zero = F.lit(0).cast("bigint")

    def step(state: Column, bit: Column) -> Column:
        there, fails = state["there"], cell["mask"].bitwiseAND(bit) != 0
        removed = there & fails
        done = F.struct(
            bit.alias("bit"),
            F.when(there & ~fails, cell["n"]).otherwise(zero).alias("kept"),
            F.when(removed, cell["n"]).otherwise(zero).alias("removed"),
            F.when(~there & fails, cell["n"]).otherwise(zero).alias("redundant"),
            F.when(cell["mask"] == bit, cell["n"]).otherwise(zero).alias("unique_fails"),
            *[F.when(removed, cell[name]).otherwise(zero).alias(name) for name in lost],
        )
        return F.struct(
            (there & ~fails).alias("there"),
            F.concat(state["steps"], F.array(done)).alias("steps"),
        )

    start = F.struct(
        F.lit(True).alias("there"),
        F.array().cast(f"array<struct<{step_type}>>").alias("steps"),
    )
    return F.flatten(
        F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"]))
    )


def _add(names: tuple[str, ...]):
    def add(a: Column, b: Column) -> Column:
        return F.struct(a["bit"].alias("bit"), *[(a[n] + b[n]).alias(n) for n in names])

    return add


def _texts(names: list[str]) -> Column:
    return F.split(F.lit(",".join(names)), ",")


def audit_filters(
    failures: DataFrame, filters: str, lost: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per (part, order of the filters, step), zeros included, for rows with masks.

    ``failures`` has ``part`` and ``mask``, in which bit i stands for ``filters[i]``. ``lost`` names
    further counts: each counts, of the rows removed at a step, those whose boolean column is
    true (null is false). Counts are those of the part: ``kept`` after the step, ``removed`` by it,
    ``redundant`` (fail its filter, but are gone already), ``unique_fails`` (fail its filter
    alone), and ``shapley``: what its filter removes, summed over all orders. A null part or mask
    counts as empty or 0. Without rows there are no parts and no result rows.
    """
    different = len(set(filters)) == len(filters) and filters.isalpha()
    if not different or len(filters) > MOST_FILTERS:
        raise ValueError(f"{filters!r}: between one and {MOST_FILTERS} different letters")
    lost = dict(lost or {})
    bits = {letter: 1 << i for i, letter in enumerate(filters)}
    names = ["".join(order) for order in permutations(filters)]
    steps = len(filters)
    orders = F.expr(
        "array(%s)" % ", ".join("array(%s)" % ", ".join(str(bits[c]) for c in name) for name in names)
    )
    counts = (*_COUNTS, *lost)

    cells = failures.groupBy(
        F.coalesce("part", F.lit("")).alias("part"),
        F.coalesce("mask", F.lit(0)).cast("int").alias("mask"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col(flag), 1)).alias(name) for name, flag in lost.items()],
    )
    parts = cells.groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", *lost)).alias("cells")  # one per mask at most
    )
    nothing = F.struct(
        F.lit(0).alias("mask"), *[F.lit(0).cast("bigint").alias(c) for c in ("n", *lost)]
    )
    merged = F.aggregate(
        "cells",
        _fold(orders, nothing, tuple(lost)),
        lambda total, cell: F.zip_with(total, _fold(orders, cell, tuple(lost)), _add(counts)),
    )
    rows = parts.select("part", F.posexplode_outer(merged).alias("at", "step"))
    same_filter = Window.partitionBy("part", "step.bit")
    return rows.select(
        "part",
        F.element_at(_texts(names), (F.floor(F.col("at") / steps) + 1).cast("int")).alias(
            "filter_order"
        ),
        (F.col("at") % steps + 1).alias("step"),
        *[F.col("step")[name].alias(name) for name in counts],
        F.sum("step.removed").over(same_filter).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit_filters`` of the five filters on documents (``document_failures``) per source.

    ``docs`` has ``doc_id``, ``text`` and ``source``, ``labels`` has ``doc_id``, ``quality`` and
    ``toxic``; other columns are ignored whatever their names. An empty table of documents has
    no parts and gives no rows; without labels nothing counts as good or toxic. A text of any
    length is read whole.
    """
    with workspace(docs.sparkSession, "filter-audit") as work:
        failures = document_failures(docs, labels, work)
        lost = {"good_lost": "good", "toxic_lost": "toxic"}
        return work.result(audit_filters(failures, "ABCDE", lost))
