"""Mixing sources to target weights by Pfair scheduling.

The rows of a source form blocks of BLOCK rows. With weight w, block j of a source (from 0)
is released at slot floor(j / w) and due at the end of slot ceil((j + 1) / w) - 1. Each
slot goes to the released block with the earliest deadline; ties go to the block whose window
overlaps the next one of its source, then to a source of half the weight or more, then to
the source's name. By that rule no source is ever a whole block ahead of or behind its
weight.

Weights are exact fractions: nothing is rounded, however many blocks or sources there are. The
order of the blocks is worked out on the driver, one step for each block (not for each row), and
every row looks the slot of its block up. When a source runs out, a new phase begins, in
which the weights of the others count alone, from zero; there are as many phases as sources at
most. Every row keeps its place in the mix: none is dropped and none repeated.

Defined cases: null sources and those named by an empty string form one source, named "". Sources without a target
weight share what the named ones leave, or get the least weight if nothing is left. A target means its decimal
digits (0.1 is a tenth). Sources with a target of 0 come after all others, and evenly among themselves; a target below 0, or
one that is no finite number, is an error. Targets of sources that have no rows count for nothing. Null texts and doc_ids are rows like others. An empty table gives no
rows.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Mapping
from fractions import Fraction
from math import gcd, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.frames import CELLS, numbered
from bazaarlens.sources.storage import materialize

#: Rows of a block, and slots of a period where one is asked for (at least one for each source).
BLOCK = 16
PERIOD = 360
#: Without targets, a source weighs its number of rows to this power.
TEMPERATURE = 0.5


def shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots of the period by largest remainder, one at least for each source."""
    period = max(period, len(weights))
    spare, total = period - len(weights), sum(weights.values())
    ideal = {k: spare * w / total for k, w in weights.items()}
    slots = {k: 1 + int(x) for k, x in ideal.items()}
    behind = sorted(ideal, key=lambda k: (int(ideal[k]) - ideal[k], k))
    for k in behind[: period - sum(slots.values())]:
        slots[k] += 1
    return slots


def exact(weights: Mapping[str, float | Fraction]) -> dict[str, int]:
    """Whole numbers in the ratio of the weights, which mean their decimal digits."""
    parts = {k: Fraction(str(w)) for k, w in weights.items()}
    scale = lcm(*(w.denominator for w in parts.values()))
    whole = {k: int(w * scale) for k, w in parts.items()}
    common = gcd(*whole.values()) or 1
    return {k: n // common for k, n in whole.items()}


def urgency(name: str, share: int, period: int, j: int) -> tuple[int, int, int, str]:
    """What orders the released blocks: deadline, overlap, half the weight or more, name."""
    deadline = -(-(j + 1) * period // share)
    overlaps = (j + 1) * period % share != 0
    return deadline, -int(overlaps), -int(overlaps and 2 * share >= period), name


def schedule(slots: Mapping[str, int], blocks: Mapping[str, int] | None = None) -> list[str]:
    """The source of each slot of one period; with ``blocks`` until a source has run out.

    A source is in one of two heaps: by urgency if its next block is released, else by
    the slot that releases it.
    """
    period, done, order = sum(slots.values()), dict.fromkeys(slots, 0), []
    ready = [urgency(k, s, period, 0) for k, s in slots.items()]
    heapq.heapify(ready)
    waiting: list[tuple[int, str]] = []
    while blocks is not None or len(order) < period:
        while waiting and waiting[0][0] <= len(order):
            k = heapq.heappop(waiting)[1]
            heapq.heappush(ready, urgency(k, slots[k], period, done[k]))
        name = heapq.heappop(ready)[-1]
        order.append(name)
        done[name] += 1
        if blocks is not None and done[name] >= blocks[name]:
            break
        heapq.heappush(waiting, (done[name] * period // slots[name], name))
    return order


def phases(weights: Mapping[str, float], blocks: Mapping[str, int], period: int | None = None) -> list[list[str]]:
    """The parts of the mix, each the source of every slot until one has run out.

    With a ``period``, the weights are rounded to whole slots of it.
    """
    out: list[list[str]] = []
    for kept in ({k: w for k, w in weights.items() if w > 0}, {k: 1 for k, w in weights.items() if w == 0}):
        out += _phases_of(kept, {k: blocks[k] for k in kept if blocks[k] > 0}, period)
    return out


def _phases_of(weights: Mapping[str, float], left: dict[str, int], period: int | None) -> list[list[str]]:
    """The parts of the mix of sources that all have a weight."""
    out = []
    whole = exact(weights) if weights else {}
    while left:
        held = {k: whole[k] for k in left}
        out.append(schedule(shares({k: weights[k] for k in left}, period) if period else held, left))
        for name in out[-1]:
            left[name] -= 1
        left = {k: n for k, n in left.items() if n > 0}
    return out


def target_weights(
    counts: Mapping[str, int], targets: Mapping[str, float] | None
) -> dict[str, float] | dict[str, Fraction]:
    if targets is None:
        return {k: n**TEMPERATURE for k, n in counts.items()}
    wrong = {k: w for k, w in targets.items() if not 0 <= w < float("inf")}
    if wrong:
        raise ValueError(f"targets are finite and not below 0: {wrong}")
    named = {k: Fraction(str(w)) for k, w in targets.items() if k in counts}
    others = [k for k in counts if k not in named]
    spare = max(1 - sum(named.values()), Fraction(0))
    return named | {k: max(spare / len(others), Fraction(1, 10**9)) for k in others}


def slots_of(order: list[list[str]]) -> pa.Table:
    """Per block: source, block, phase and slot."""
    names = sorted({name for part in order for name in part})
    number = {name: n for n, name in enumerate(names)}
    codes = np.array(array("i", (number[name] for part in order for name in part)), np.int32)
    phase = np.repeat(np.arange(len(order), dtype=np.int32), [len(part) for part in order])
    slot = np.argsort(codes, kind="stable")
    own = codes[slot]
    first = np.searchsorted(own, np.arange(len(names)))
    return pa.table(
        {
            "source": pa.array(names, pa.string()).take(pa.array(own)),
            "block": np.arange(len(own)) - first[own],
            "phase": phase[slot],
            "slot": slot,
        }
    )


def mixed(
    docs: DataFrame,
    targets: Mapping[str, float] | None = None,
    block: int = BLOCK,
    period: int | None = None,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, source): its block, that block's slot, and its position.

    ``position`` orders the mix: block by block, from 0, gapless but for the last block
    of a source, which may be short. With a ``period``, weights are rounded to its slots.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source")
    )
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS))
    rows = materialize(numbered(materialize(rows, "mix-rows"), "source", cell, "rank"), "mix-ranks")
    # One count for each source.
    counts = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    blocks = {k: -(-n // block) for k, n in counts.items()}
    plan = slots_of(phases(target_weights(counts, targets), blocks, period))
    spark = docs.sparkSession
    schema = "source string, block long, phase int, slot long"
    # Stored, so that Spark knows its size and broadcasts it only if it is small.
    steps = materialize(spark.createDataFrame(plan, schema), "mix-steps")
    placed = rows.withColumn("block", F.floor(F.col("rank") / block).cast("long")).join(steps, ["source", "block"])
    return placed.select(
        "doc_id",
        "source",
        "block",
        "phase",
        "slot",
        (F.col("slot") * block + F.col("rank") % block).alias("position"),
    )


def placed_rows(docs: DataFrame, targets: Mapping[str, float] | None = None) -> DataFrame:
    """All rows of ``docs``, each as a struct ``_row``, with ``_position``, its place in the mix.

    Rows that share source and doc_id share their first place.
    """
    places = mixed(docs, targets).groupBy("doc_id", "source").agg(F.min("position").alias("_position"))
    places = places.select(F.col("doc_id").alias("_place"), F.col("source").alias("_from"), "_position")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce("source", F.lit("")).alias("_source"),
    )
    same: Column = rows["_id"].eqNullSafe(places["_place"]) & (rows["_source"] == places["_from"])
    return rows.join(places, same).select("_row", "_position")


def in_mixed_order(docs: DataFrame, targets: Mapping[str, float] | None = None) -> DataFrame:
    """All rows of ``docs`` with all their columns, sorted by their place in the mix.

    The sort is global: file by file and row by row, what is written of it is the mix.
    Rows that share source and doc_id share their places in any order.
    """
    return placed_rows(docs, targets).orderBy("_position", F.xxhash64("_row")).select("_row.*")


def deviation(order: list[str], slots: Mapping[str, int]) -> Fraction:
    """The largest distance, in blocks, of a source from its weight after any slot."""
    period, done, worst = sum(slots.values()), dict.fromkeys(slots, 0), Fraction(0)
    for n, name in enumerate(order, 1):
        done[name] += 1
        worst = max(worst, *(abs(Fraction(n * s, period) - done[k]) for k, s in slots.items()))
    return worst
