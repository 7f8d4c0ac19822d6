"""Mixing sources to target weights by Pfair scheduling.

The rows of each source form blocks.  Block ``j`` of a source with weight ``w`` may start
at slot ``floor(j / w)`` and must be placed before slot ``ceil((j + 1) / w)``.  In every
slot the released block with the earliest deadline goes next, so that at any point of the
mixture the blocks of a source differ from its share by less than one.

Releases and deadlines come from the exact target weights (fractions, never rounded).
Where these are whole parts of a short cycle, the schedule repeats and earliest-deadline-first
runs over one cycle; otherwise it runs once over the whole mixture, in the driver, which
holds three numbers per block.  Every block of the corpus looks its slot up by its number.
Rows never meet in one place; a source that holds most of them is numbered by range
partitions.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Mapping, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.sharding import row_numbers

#: Longest cycle that is repeated; weights with a longer one are scheduled as a whole.
RESOLUTION = 1 << 16
#: Blocks of a source in one row of the schedule.
PIECE = 1 << 16
#: Blocks of a schedule that is broadcast; a longer one is joined by a shuffle.
BROADCAST_BLOCKS = 1 << 22
#: Sources of one mixture; their names and weights are held by the driver.
MAX_SOURCES = 100_000
BLOCK_ROWS = 8


def parts(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """Exactly proportional whole numbers without a common divisor."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights must be above zero")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    counts = {s: w.numerator * (scale // w.denominator) for s, w in exact.items()}
    common = math.gcd(*counts.values()) if counts else 1
    return {s: n // common for s, n in counts.items()}


def schedule(
    counts: Mapping[str | None, int], needed: Mapping[str | None, int]
) -> dict[str | None, tuple[array, array, array]]:
    """Releases, deadlines and slots of each source's blocks, earliest deadline first.

    ``counts`` are weights as whole numbers.  Slots are filled without gaps until every
    source has placed ``needed`` blocks.  Equal deadlines are settled by the order of the
    sources.
    """
    length, sizes, want = sum(counts.values()), list(counts.values()), [needed[s] for s in counts]
    found = [(array("q"), array("q"), array("q")) for _ in sizes]
    left = sum(n > 0 for n in want)
    waiting = [(0, i) for i in range(len(sizes))]  # release, source: in order, so a heap
    ready: list[tuple[int, int, int]] = []  # deadline, source, release
    slot = 0
    while left:
        while waiting and waiting[0][0] <= slot:
            release, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(found[i][2]) + 1) * length // sizes[i]), i, release))
        deadline, i, release = heapq.heappop(ready)
        releases, deadlines, slots = found[i]
        releases.append(release)
        deadlines.append(deadline)
        slots.append(slot)
        slot += 1
        left -= len(slots) == want[i]
        heapq.heappush(waiting, (len(slots) * length // sizes[i], i))
    return dict(zip(counts, found))


def cycle(counts: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """The slots of each source's blocks in one cycle, earliest deadline first.

    ``counts`` gives the blocks of each source in the cycle; their sum is its length.
    """
    return {s: slots.tolist() for s, (_, _, slots) in schedule(counts, counts).items()}


def tempered(rows: Mapping[str | None, int], exponent: float = 0.7) -> dict[str | None, float]:
    """Weights that raise the share of small sources: rows to the power ``exponent``."""
    return {s: n**exponent for s, n in rows.items()}


def mixed(
    docs: DataFrame, source: str = "source", weights: Mapping[str | None, float] | None = None,
    order: Sequence[str] = ("doc_id",), block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION,
) -> DataFrame:
    """Every row of ``docs`` at its places in the mixture.

    Columns: ``doc`` (the row as a struct), ``source``, ``epoch``, ``block``, ``release``,
    ``deadline``, ``slot`` (in blocks) and ``position`` (in rows, from 0, without gaps).
    ``weights`` default to :func:`tempered` row counts; a source that they leave out gets
    the least of the given weights, and names without rows are ignored.

    The mixture goes on until every row of every source has been placed, so none is
    dropped; a source that ends earlier starts again with its next ``epoch``.  Rows of a
    source come in an order fixed by a hash of ``order``; equal rows follow each other.
    A null source is a source of its own.  An empty table gives an empty mixture.
    At every slot the blocks of a source differ from its exact weight's share by less than
    one; weights must be above zero.  ``resolution`` is the longest cycle that is repeated.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(source).cast("string").alias("source"),
        F.xxhash64(*order).alias("_h"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )
    table, _ = row_numbers(rows, ["source", "_h", *[f"_o{i}" for i in range(len(order))]], "_n")
    found = table.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = dict(sorted(((r[0], r[1]) for r in found), key=lambda x: (x[0] is not None, x[0])))
    wanted = tempered(sizes) if weights is None else dict(weights)
    least = min(wanted.values(), default=1.0)
    share = parts({s: wanted.get(s, least) for s in sizes})
    length = sum(share.values())
    needed = {s: (n - 1) // block_rows + 1 for s, n in sizes.items()}
    repeats = length <= resolution
    places = schedule(share, share if repeats else needed)
    turns = {s: share[s] if repeats else max(len(places[s][2]), 1) for s in sizes}  # blocks until the schedule repeats

    def slot_of(s: str | None, block: int) -> int:
        return block // turns[s] * length + places[s][2][block % turns[s]]

    end = max((slot_of(s, n - 1) + 1 for s, n in needed.items()), default=0)
    plan, names, numbers, cuts, start = [], [], [], [0], 0
    for s, n in sizes.items():
        blocks = end // length * share[s] + sum(1 for x in places[s][2] if x < end % length) if repeats else len(places[s][2])
        plan.append((s, start, n, turns[s], blocks))
        start += n
        for at in range(0, len(places[s][2]), PIECE):
            names.append(s)
            numbers.append(at // PIECE)
            cuts.append(cuts[-1] + min(PIECE, len(places[s][2]) - at))
    plan = spark.createDataFrame(plan, "_source string, _start long, _rows long, _turn long, _blocks long")
    columns = [
        pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), pa.array(np.concatenate([np.zeros(0, np.int64), *(places[s][c] for s in sizes)])))
        for c in range(3)
    ]
    held = spark.createDataFrame(pa.table(
        [pa.array(names, pa.string()), pa.array(numbers, pa.int64()), *columns], ["_source_p", "_piece", "_rel", "_dead", "_slots"]
    ))
    if cuts[-1] <= BROADCAST_BLOCKS:
        held = F.broadcast(held)
    placed = (
        table.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_place", F.col("_n") - F.col("_start"))
        .withColumn("epoch", F.explode(F.expr(f"sequence(0L, (_blocks * {int(block_rows)} - 1) div _rows)")))
        .withColumn("_at", F.col("_place") + F.col("epoch") * F.col("_rows"))
        .withColumn("block", F.expr(f"_at div {int(block_rows)}"))
        .filter("block < _blocks")
        .withColumn("_spot", F.pmod("block", "_turn"))
        # slots of all turns before; a schedule that does not repeat has one turn
        .withColumn("_before", F.expr("block div _turn") * F.lit(length if repeats else 0))
        .withColumn("_piece_of", F.expr(f"_spot div {PIECE}"))
        .select("doc", "source", "epoch", "block", "_at", "_spot", "_before", "_piece_of")
    )
    spot = F.pmod("_spot", F.lit(PIECE)).cast("int")
    return (
        placed.join(held, F.col("source").eqNullSafe(F.col("_source_p")) & (F.col("_piece_of") == F.col("_piece")))
        .select(
            "doc", "source", "epoch", "block", "_at",
            (F.col("_before") + F.get("_rel", spot)).alias("release"),
            (F.col("_before") + F.get("_dead", spot)).alias("deadline"),
            (F.col("_before") + F.get("_slots", spot)).alias("slot"),
        )
        .withColumn("position", F.col("slot") * block_rows + F.pmod("_at", F.lit(block_rows)))
        .drop("_at")
    )
