"""Operator 6: mixing sources to target weights by Pfair scheduling.

A stream per source is cut into blocks of ``block_rows`` rows, and one block is
placed per slot.  The targets are those of a fluid schedule: at any time the sources
that still have blocks share the slots in proportion to their exact weights, until
each has given its own.  With virtual time v a source of weight w has had
``min(blocks, w * v)`` blocks, and ``T(v) = sum(min(blocks_k, w_k * v))`` slots have
passed.  So block j (from 0) of a source is released at slot ``floor(T(j / w))`` and due
at ``ceil(T((j + 1) / w))``; each slot goes to the released block that is due first.
The fluid schedule itself fills these windows, hence unit blocks in order of their
deadlines meet all of them: no slot is idle, and after any number of slots every
source has had its target, give or take less than one block.  Weights, virtual times
and windows are whole numbers and fractions; nothing is rounded.

Every source has a stream of its own, however many there are and whatever the number of
blocks.  Streams of equal rows and weights make a class: their blocks have the same
windows, so the driver, which runs the schedule, holds classes and not sources (without
given weights at most as many as there are different numbers of rows, the square root of
twice the rows) and writes the plan out by ``MAX_BLOCKS`` runs of blocks.  A row's slot
follows from its rank in its stream and the staged plan.  Given weights have a stream for
each source that they name.  Without them the weight is ``floor(rows ** ALPHA * 2 ** 20)``.
The output's ``stream`` numbers the ``MAX_STREAMS`` largest sources; all others have the
next number, but their own blocks and slots.

The rank is a hash order, found for numbered sources in two levels: counts per (stream,
cell) give offsets, and windows rank the rows of a cell only.  A stream has cells in
proportion to its rows, so a hot source is split over many tasks.

Defined results: a null source is a stream of its own; with given weights, sources
with weight 0 or none share a stream that comes after all others; names without rows
are left out; repeated rows are all placed; an empty table gives no rows; input
columns named like the output columns are replaced.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseflow.llm.common import find_package, local_rows
from caseflow.operators.position import with_position
from caseflow.session import stage

BLOCK_ROWS = 16
MAX_BLOCKS = 1 << 18  # runs of blocks that the driver holds at once
RUN_BLOCKS = 1 << 16  # of a run, so that long ones are written by many tasks
MAX_STREAMS = 1 << 15
ALPHA = 0.5
CELLS = 4096
NULL = "\0null"
OUTPUT = ("stream", "block", "slot", "position")
RUN_COLUMNS = ("stream", "block", "slot", "start", "n", "next_stream", "next_block", "next_start")


def edf_runs(blocks: list[int], weights: list[int | float | Fraction], members: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """The schedule of classes of ``members`` streams, each with ``blocks`` and of weight ``weights``, all positive.

    Gives ``(class, block, first member, n)``: this block of n members one after another,
    from the slot where the run before ended.
    """
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    whole = [int(w * scale) for w in exact]
    order = sorted(range(len(blocks)), key=lambda i: Fraction(blocks[i], whole[i]))
    ends = [blocks[i] / whole[i] for i in order]
    given, active = [0], [sum(w * m for w, m in zip(whole, members, strict=True))]  # blocks of the ended streams, weight of the others
    for i in order:
        given.append(given[-1] + blocks[i] * members[i])
        active.append(active[-1] - whole[i] * members[i])

    def passed(i: int, j: int) -> int:
        """``T(j / weight)`` times the weight; the search by floats is set right by whole numbers."""
        w = whole[i]
        at = bisect_right(ends, j / w)
        while at and j * whole[order[at - 1]] < blocks[order[at - 1]] * w:
            at -= 1
        while at < len(order) and blocks[order[at]] * w <= j * whole[order[at]]:
            at += 1
        return given[at] * w + j * active[at]

    t, total = 0, given[-1]
    coming = [(0, i, 0) for i in range(len(blocks))]  # (release, class, block), one of each class
    ready: list[tuple[int, int, int, int]] = []  # (due, class, block, first member)
    while t < total:
        while coming and coming[0][0] <= t:
            _, i, j = coming[0]
            upto = passed(i, j + 1)
            heapq.heappush(ready, (-(-upto // whole[i]), i, j, 0))
            if j + 1 < blocks[i]:
                heapq.heapreplace(coming, (upto // whole[i], i, j + 1))
            else:
                heapq.heappop(coming)
        due, i, j, k = ready[0]
        n = min(members[i] - k, (coming[0][0] if coming else total) - t)
        yield i, j, k, n
        t += n
        if k + n < members[i]:
            heapq.heapreplace(ready, (due, i, j, k + n))
        else:
            heapq.heappop(ready)


def edf_slots(blocks: list[int], weights: list[int | float | Fraction]) -> list[list[int]]:
    """The slots of each stream's blocks; ``blocks`` and ``weights`` are positive."""
    slots: list[list[int]] = [[] for _ in blocks]
    for t, (i, *_) in enumerate(edf_runs(blocks, weights, [1] * len(blocks))):
        slots[i].append(t)
    return slots


def plan_runs(rows: list[int], weights: list, members: list[int], block_rows: int) -> Iterator[tuple]:
    """Runs of blocks as ``RUN_COLUMNS``: the first one's stream, block, slot and start, the number of blocks, and what the next one's differ by.

    ``members`` streams each have ``rows`` and ``weights`` and are numbered one after another; streams of weight 0 come last.
    """
    first, blocks = [0], [-(-r // block_rows) for r in rows]
    for m in members:
        first.append(first[-1] + m)
    weighted = [i for i, w in enumerate(weights) if w > 0]
    slot = start = 0
    for c, j, k, n in edf_runs([blocks[i] for i in weighted], [weights[i] for i in weighted], [members[i] for i in weighted]):
        i = weighted[c]
        held = min(block_rows, rows[i] - j * block_rows)
        for a in range(0, n, RUN_BLOCKS):
            yield first[i] + k + a, j, slot + a, start + a * held, min(RUN_BLOCKS, n - a), 1, 0, held
        slot, start = slot + n, start + n * held
    for i in (i for i, w in enumerate(weights) if w <= 0):
        for stream in range(first[i], first[i + 1]):
            for a in range(0, blocks[i], RUN_BLOCKS):
                yield stream, a, slot + a, start + a * block_rows, min(RUN_BLOCKS, blocks[i] - a), 0, 1, block_rows
            slot, start = slot + blocks[i], start + rows[i]


def plan_blocks(rows: list[int], weights: list, block_rows: int) -> list[dict]:
    """``(stream, slots, starts)``: slot and first position of every block of a small plan; streams of weight 0 come last."""
    plan: list[dict] = [{"stream": i, "slots": [], "starts": []} for i in range(len(rows))]
    for stream, _, slot, start, n, _, _, held in plan_runs(rows, weights, [1] * len(rows), block_rows):
        plan[stream]["slots"] += range(slot, slot + n)
        plan[stream]["starts"] += range(start, start + n * held, held)
    return plan


def staged_plan(spark: SparkSession, runs: Iterator[tuple]) -> DataFrame:
    """``(_s, _b, slots, starts)``: stream, block, slot and first position of every block."""
    parts = []
    for some in batched(runs, MAX_BLOCKS):
        table = pa.table([pa.array(c, pa.int64()) for c in zip(*some, strict=True)], names=list(RUN_COLUMNS))
        each = spark.createDataFrame(table).withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        at = lambda c, step: F.col(c) + F.col("_x") * F.col(step)
        blocks = each.select(at("stream", "next_stream").alias("_s"), at("block", "next_block").alias("_b"), (F.col("slot") + F.col("_x")).alias("slots"), at("start", "next_start").alias("starts"))
        parts.append(stage(blocks))
    return reduce(DataFrame.unionByName, parts) if parts else local_rows(spark, [], "_s long, _b long, slots long, starts long")


def count_sources(named: DataFrame, alpha: float) -> DataFrame:
    """``(_name, n, w)``: rows and weight of every source."""
    weight = F.floor(F.pow("n", F.lit(alpha)) * 2**20).cast("decimal(38,0)")
    return stage(named.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).withColumn("w", weight))


def own_streams(counts: DataFrame, weights: dict | None) -> list[tuple[str, int, Fraction]]:
    """``(name, rows, weight)`` of the sources with streams of their own, the largest first."""
    if weights is None:
        top = counts.orderBy(F.desc("n"), "_name").limit(MAX_STREAMS).collect()
        return [(r["_name"], r["n"], Fraction(int(r["w"]))) for r in top]
    given = {NULL if k is None else str(k): Fraction(w) for k, w in weights.items() if w > 0}
    top = counts.where(F.col("_name").isin(list(given))).orderBy(F.desc("n"), "_name").collect()
    return [(r["_name"], r["n"], given[r["_name"]]) for r in top]


def mix_sources(
    df: DataFrame, source: str = "source", key: str = "doc_id", weights: dict | None = None, block_rows: int = BLOCK_ROWS, carry: list[str] | None = None, alpha: float = ALPHA
) -> DataFrame:
    """``carry`` columns plus ``stream``, ``block``, ``slot`` and ``position`` (gapless from 0)."""
    spark = df.sparkSession
    find_package(spark)
    names = [c for c in (carry or df.columns) if c not in OUTPUT]
    inner = [f"_c{i}" for i in range(len(names))]
    name = F.coalesce(F.col(source).cast("string"), F.lit(NULL))
    counts = count_sources(df.select(name.alias("_name")), alpha)
    streams = own_streams(counts, weights)
    own = len(streams)
    index = F.broadcast(local_rows(spark, [{"_name": s, "stream": i} for i, (s, *_) in enumerate(streams)], "_name string, stream int"))
    size = counts.agg(F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    total = size["n"]
    if weights is None:
        # streams are numbered by rows and name, so those of a class follow one another
        found = counts.groupBy("n", "w").agg(F.count(F.lit(1)).alias("members")).orderBy(F.desc("n")).collect()
        classes = [(r["n"], Fraction(int(r["w"])), r["members"]) for r in found]
    else:
        rest = total - sum(n for _, n, _ in streams)
        streams += [("", rest, Fraction(0))] if rest else []
        classes = [(n, w, 1) for _, n, w in streams]
    plan = staged_plan(spark, plan_runs(*([c[k] for c in classes] for k in (0, 1, 2)), block_rows))
    cells = [{"stream": i, "_cells": -(-n * CELLS // total)} for i, (_, n, _) in enumerate(streams)]
    cells = F.broadcast(local_rows(spark, cells, "stream int, _cells int"))

    keyed = df.select(*[F.col(c).alias(x) for c, x in zip(names, inner, strict=True)], name.alias("_name"), F.xxhash64(F.lit("mix"), F.col(key).cast("string")).alias("_h"))
    keyed = keyed.join(index, "_name", "left").withColumn("stream", F.coalesce("stream", F.lit(own)))
    others = keyed.where(F.col("stream") >= own) if weights is None and size["sources"] > own else None
    if others is not None:
        keyed = keyed.where(F.col("stream") < own)
    keyed = keyed.join(cells, "stream").withColumn("_cell", F.pmod(F.xxhash64("_h", *inner), F.col("_cells")).cast("int")).drop("_name", "_cells")

    held = keyed.groupBy("stream", "_cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("stream").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("stream", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("stream", "_cell").orderBy("_h", *inner)
    # at most CELLS offsets and one more per stream
    ranked = keyed.withColumn("_rn", F.row_number().over(inside) - 1).join(F.broadcast(offsets), ["stream", "_cell"])
    ranked = ranked.select(*inner, F.col("stream").cast("long").alias("stream"), (F.col("_off") + F.col("_rn")).alias("_rank"))
    if others is not None:
        # each of these sources has at most as many rows as the MAX_STREAMS largest
        inside = Window.partitionBy("_name").orderBy("_h", *inner)
        smaller = counts.join(index, "_name", "left_anti").select("_name", "n").orderBy(F.desc("n"), "_name")
        numbers = with_position(smaller).select("_name", (F.col("position") + own).alias("_number"))
        others = others.withColumn("_rank", F.row_number().over(inside).cast("long") - 1).join(numbers, "_name")
        ranked = ranked.unionByName(others.select(*inner, F.col("_number").alias("stream"), "_rank"))
    ranked = ranked.withColumn("block", F.floor(F.col("_rank") / block_rows))
    placed = ranked.join(plan, (F.col("stream") == F.col("_s")) & (F.col("block") == F.col("_b")))
    return placed.select(
        *[F.col(x).alias(c) for x, c in zip(inner, names, strict=True)], F.least("stream", F.lit(own)).cast("int").alias("stream"), F.col("block").cast("long").alias("block"), F.col("slots").alias("slot"),
        (F.col("starts") + F.pmod("_rank", F.lit(block_rows))).cast("long").alias("position"),
    )
