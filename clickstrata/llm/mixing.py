"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Each source's documents are cut into blocks of equal size. With weight ``w``, block ``b`` of a
source is released at slot ``floor(b / w)`` and due before slot ``ceil((b + 1) / w)``. Each slot
takes, of the released blocks, the one due first. In every prefix each source then has its
share to less than one block.

Weights are whole parts, and the schedule repeats after as many slots as there are parts. One
period is computed by a fold over its slots, if it is shorter than the list of all blocks; else
the fold places every block. The slot of any block follows from that by arithmetic. Documents are
numbered within buckets of bounded size, so a source with most of the rows is no single task.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import fresh_name

#: Documents of a block.
BLOCK_ROWS = 64

#: Sources of a mixture at most; also the slots of a period, if the weights are whole parts of it.
PERIOD = 1000

#: Parts of weights that are no short fractions, about; products with block numbers are bigint.
FINEST = 1 << 31

#: Slots of the inner fold.
FOLD_SLOTS = 500

#: Documents numbered together, about.
BUCKET_ROWS = 50_000

#: Default weights: the number of a source's documents to this power.
TEMPERATURE = 0.5

MIX_COLUMNS = ("mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_order", "on_target")


def _key(source: Column) -> Column:
    """Null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _whole(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """Whole numbers in the same proportions, exactly if they are not too large."""
    exact = {source: Fraction(str(weight)) for source, weight in weights.items()}
    for source, weight in exact.items():
        if weight < 0:
            raise ValueError(f"weight of {source!r} is negative")
    unit = lcm(*(w.denominator for w in exact.values()))
    whole = {source: int(w * unit) for source, w in exact.items()}
    total, common = sum(whole.values()), gcd(*whole.values()) or 1
    if total // common <= FINEST:
        return {source: w // common for source, w in whole.items()}
    return {source: max(1, round(Fraction(w * FINEST, total))) if w else 0 for source, w in whole.items()}


def _weights(sources: DataFrame, weights: Mapping[str | None, float] | None) -> DataFrame:
    """Adds ``weight``, a whole number: the given ones, or a power of the counts."""
    if weights is None:
        power = F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE))
        share = power / F.sum(power).over(Window.partitionBy(F.lit(0)))
        return sources.withColumn(
            "weight", F.greatest(F.lit(1), F.round(share * FINEST)).cast("bigint")
        )
    given = F.lit(0).cast("bigint")
    for source, weight in _whole(weights).items():
        given = F.when(F.col("key") == _key(F.lit(source)), F.lit(weight).cast("bigint")).otherwise(given)
    return sources.withColumn("weight", given)


def source_parts(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, period: int = PERIOD
) -> DataFrame:
    """``key, n, parts``: each source's rows and its weight in whole parts.

    Parts are in the proportions of the weights: exact for given ones that are short fractions,
    to 1 / ``FINEST`` otherwise. Their sum is ``period``, if that can be. No weight is no part;
    without any weight all sources have one. There may be at most ``period`` sources; more are
    refused.
    """
    sources = docs.groupBy(_key(F.col("source")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    if sources.limit(period + 1).count() > period:
        raise ValueError(f"more than {period} sources: choose a longer period")
    sources = _weights(sources, weights)
    every = Window.partitionBy(F.lit(0))  # one row per source, at most a period of them
    some = F.when(F.max("weight").over(every) > 0, F.col("weight")).otherwise(F.lit(1).cast("bigint"))
    sources = sources.withColumn("weight", some)
    total = F.sum("weight").over(every)
    times = F.when(F.lit(period) % total == 0, _div(F.lit(period), total)).otherwise(F.lit(1))
    return sources.select("key", "n", (F.col("weight") * times).cast("bigint").alias("parts"))


def _div(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def _release(block: Column, parts: Column, period: Column) -> Column:
    return _div(block * period, parts)


def _deadline(block: Column, parts: Column, period: Column) -> Column:
    return _div((block + 1) * period + parts - 1, parts)


def schedule_turns(parts: DataFrame, block_rows: int) -> DataFrame:
    """Adds ``period``, the sum of the parts, and ``turns``: a source's blocks that are scheduled.

    These are its parts, if the period is shorter than the list of all blocks; the schedule
    repeats then. Otherwise they are all of its blocks and one after the last. That one leaves its slot
    free; then the source is out, and others may take its slots.
    """
    every = Window.partitionBy(F.lit(0))
    blocks = F.expr(f"(n + {block_rows - 1}) div {block_rows} + 1")
    totals = parts.where("parts > 0").withColumn("period", F.sum("parts").over(every)).withColumn(
        "blocks", F.sum(blocks).over(every)
    )
    turns = F.when(F.col("period") <= F.col("blocks"), F.col("parts")).otherwise(blocks)
    return totals.withColumn("turns", turns).drop("blocks")


def turn_slots(turns: DataFrame) -> DataFrame:
    """``key, turn, slot``: the slot of every turn of ``schedule_turns``.

    A fold over the slots, in one row of all sources. The state is each source's next turn; a
    slot takes the released one with the earliest deadline, then the first key. Slots before the
    next release are passed over at once.
    """
    line = turns.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("key", "parts", "period", "turns"))).alias("sources")
    )
    sources = F.col("sources")
    none = "array<struct<at:int,turn:bigint,slot:bigint>>"
    state_type = f"struct<turns:array<bigint>,slot:bigint,plan:{none}>"

    def step(state: Column, _: Column) -> Column:
        def option(source: Column, at: Column) -> Column:
            turn = F.get(state["turns"], at)
            free = F.greatest(_release(turn, source["parts"], source["period"]), state["slot"])
            due = _deadline(turn, source["parts"], source["period"])
            # of the earliest slots, the earliest deadline
            entry = F.struct(free.alias("slot"), due.alias("due"), at.alias("at"), turn.alias("turn"))
            return F.when(turn < source["turns"], entry)

        def take(best: Column) -> Column:
            entry = F.struct(best["at"].alias("at"), best["turn"].alias("turn"), best["slot"].alias("slot"))
            return F.struct(
                F.transform(
                    state["turns"], lambda turn, at: F.when(at == best["at"], turn + 1).otherwise(turn)
                ).alias("turns"),
                (best["slot"] + 1).alias("slot"),
                F.concat(state["plan"], F.array(entry)).alias("plan"),
            ).cast(state_type)

        best = F.transform(F.array(F.array_min(F.transform(sources, option))), take)
        return F.coalesce(
            F.get(F.filter(best, lambda s: s["slot"].isNotNull()), F.lit(0)), state
        ).cast(state_type)

    def inner(state: Column, _: Column) -> Column:
        begin = F.struct(state["turns"].alias("turns"), state["slot"].alias("slot"), F.expr(f"cast(array() as {none})").alias("plan"))
        steps = F.sequence(F.lit(1), F.lit(FOLD_SLOTS))
        done = F.aggregate(steps, begin.cast(state_type), step)
        # one array of entries for each inner fold, so that none is copied at every step
        return F.transform(
            F.array(done),
            lambda d: F.struct(
                d["turns"].alias("turns"),
                d["slot"].alias("slot"),
                F.concat(state["plan"], F.array(d["plan"])).alias("plan"),
            ).cast(outer_type),
        )[0]

    outer_type = f"struct<turns:array<bigint>,slot:bigint,plan:array<{none}>>"
    start = F.struct(
        F.transform(sources, lambda s: F.lit(0).cast("bigint")).alias("turns"),
        F.lit(0).cast("bigint").alias("slot"),
        F.expr(f"cast(array() as array<{none}>)").alias("plan"),
    ).cast(outer_type)
    total = F.aggregate(sources, F.lit(0).cast("bigint"), lambda n, s: n + s["turns"])
    rounds = F.sequence(F.lit(0).cast("bigint"), _div(total, F.lit(FOLD_SLOTS)))
    plan = F.flatten(F.aggregate(rounds, start, inner, lambda state: state["plan"]))
    entries = line.where(F.size("sources") > 0).select("sources", F.explode(plan).alias("e"))
    return entries.select(
        F.get("sources", F.col("e.at"))["key"].alias("key"), "e.turn", "e.slot"
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """All rows and columns of ``docs`` with their place in the mixture.

    ``mix_block`` is the number of the row's block within its source, ``mix_slot`` the slot
    that block has, between ``mix_release`` and before ``mix_deadline``; ``mix_order`` sorts the
    rows into the mixture. Slots of a source that has run out are left free, so every row is
    kept; ``on_target`` holds up to the first such slot. Columns of these names are replaced. Sources
    of weight 0, or without one, come after all others and have no release or deadline.

    Rows of a source come in the order of a hash. A null source is a source of its own; repeated
    rows have places of their own; if no source has a weight, all are equal; an empty table gives
    an empty result.
    """
    docs = docs.drop(*MIX_COLUMNS)
    given = docs.columns
    # names of working columns begin like this
    aside = [c for c in given if c.lower().startswith("_mix_")]
    renamed = {c: fresh_name(f"aside_{i}", docs) for i, c in enumerate(aside)}
    docs = docs.withColumnsRenamed(renamed)
    parts = source_parts(docs, weights, period)
    narrow = [c for c in ("doc_id", "lang", "n_chars", "source") if c in docs.columns]
    spread = F.xxhash64(*[F.col(c).cast("string") for c in narrow])
    keyed = docs.withColumn("_mix_key", _key(F.col("source"))).withColumn("_mix_hash", spread)
    # at most a period of rows
    size = F.broadcast(parts.select(F.col("key").alias("_mix_key"), F.col("n").alias("_mix_n")))
    buckets = (F.col("_mix_n") / BUCKET_ROWS).cast("bigint") + 1

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.join(size, "_mix_key").withColumn("_mix_bucket", F.pmod("_mix_hash", buckets))

    counted = dealt(keyed.select("_mix_key", "_mix_hash")).groupBy("_mix_key", "_mix_bucket").count()
    before = Window.partitionBy("_mix_key").orderBy("_mix_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counted.select(
        "_mix_key",
        "_mix_bucket",
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_mix_before"),
    )
    within = Window.partitionBy("_mix_key", "_mix_bucket").orderBy(
        "_mix_hash", *[c for c in narrow if c != "source"]
    )
    numbered = (
        dealt(keyed)
        .withColumn("_mix_row", F.row_number().over(within) - 1)
        .join(offsets, ["_mix_key", "_mix_bucket"])
        .withColumn("_mix_row", F.col("_mix_row") + F.col("_mix_before"))
    )
    turns = schedule_turns(parts, block_rows)
    schedule = turn_slots(turns)
    ends = _ends(turns, schedule, block_rows)
    # at most a period of rows each
    lengths = parts.join(turns.select("key", "period", "turns"), "key", "left").crossJoin(ends)
    idle = F.when(F.col("parts") == 0, F.expr(f"(n + {block_rows - 1}) div {block_rows}")).otherwise(0)
    earlier = Window.partitionBy(F.lit(0)).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    lengths = lengths.withColumn("late", F.col("end") + F.coalesce(F.sum(idle).over(earlier), F.lit(0)))
    lengths = lengths.select(
        F.col("key").alias("_mix_key"),
        *[F.col(c).alias(f"_mix_{c}") for c in ("parts", "period", "turns", "horizon", "late")],
    )
    plan = schedule.select(
        F.col("key").alias("_mix_key"), F.col("turn").alias("_mix_turn"), F.col("slot").alias("_mix_slot")
    )
    block, share, whole = F.col("mix_block"), F.col("_mix_parts"), F.col("_mix_period")
    turned = (
        numbered.withColumn("mix_block", F.expr(f"_mix_row div {block_rows}"))
        .join(F.broadcast(lengths), "_mix_key")
        # without parts there is no turn: such blocks stay without a match, each by itself
        .withColumn("_mix_turn", F.coalesce(block % F.col("_mix_turns"), -1 - block))
        .join(plan, ["_mix_key", "_mix_turn"], "left")
    )
    slot = _div(block, F.col("_mix_turns")) * whole + F.col("_mix_slot")
    weighed = share > 0
    placed = (
        turned.withColumn("mix_slot", F.when(weighed, slot).otherwise(F.col("_mix_late") + block))
        .withColumn("mix_release", F.when(weighed, _release(block, share, whole)))
        .withColumn("mix_deadline", F.when(weighed, _deadline(block, share, whole)))
        .withColumn("mix_order", F.col("mix_slot") * block_rows + F.col("_mix_row") % block_rows)
        .withColumn("on_target", F.col("mix_slot") < F.col("_mix_horizon"))
    )
    kept = [F.col(renamed.get(c, c)).alias(c) for c in given]
    return placed.select(*kept, *MIX_COLUMNS)


def _ends(turns: DataFrame, schedule: DataFrame, block_rows: int) -> DataFrame:
    """``horizon``: the first slot whose block is missing or not full; ``end``: after the last block."""
    slot = F.expr("block div turns * period") + F.col("slot")
    blocks = F.array(
        F.struct(F.lit(False).alias("last"), F.expr(f"n div {block_rows}").alias("block")),
        F.struct(F.lit(True).alias("last"), F.expr(f"(n - 1) div {block_rows}").alias("block")),
    )
    asked = turns.select("key", "period", "turns", F.explode(blocks).alias("b")).select(
        "key", "period", "turns", "b.last", "b.block", F.expr("b.block % turns").alias("turn")
    )
    found = asked.join(schedule, ["key", "turn"])
    return found.agg(
        F.min(F.when(~F.col("last"), slot)).alias("horizon"),
        (F.max(F.when(F.col("last"), slot)) + 1).alias("end"),
    )
