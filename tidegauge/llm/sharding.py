"""Shards by a Feistel permutation of global row numbers.

Every row gets a global number (rows in ``order_by`` order); a keyed permutation of
``0 .. rows - 1`` shuffles the numbers, and shard and slot are the remainder and the
quotient of the shuffled number.  Counts of shards therefore differ by one at most, slots
have no gaps, the same key gives the same shuffle, and :func:`place` computes the shard
and slot of any row number without looking at the data.  Built-in functions only.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import keep

ROUNDS = 6
_LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition, then position
#: Steps of a walk.  With at most 63 spare points these are always enough; with more
#: spare points the chance of a longer walk is below (1/64) ** 64.
_WALK = 64
_MASK = 0x7FFFFFFFFFFFFFFF


def _sides(rows: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid that has a point for every row."""
    a = max(1, math.isqrt(max(rows, 1)))
    return a, -(-max(rows, 1) // a)


def _round_keys(key: int) -> list[int]:
    return [(key * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) & _MASK for i in range(ROUNDS)]


def permuted(number: Column, rows: int, key: int) -> Column:
    """The place of row ``number`` (0 to ``rows`` - 1) in the keyed shuffle.

    A point of an a x b grid is enciphered by ``ROUNDS`` Feistel rounds, each of which
    shifts one coordinate by a hash of the other; points beyond the last row walk on
    until they meet a row number again, which keeps the mapping one to one.
    """
    a, b = _sides(rows)
    keys = F.array(*[F.lit(k) for k in _round_keys(key)])

    def turn(s: Column, k: Column) -> Column:
        moved = F.pmod(s["x"] + F.pmod(F.xxhash64(s["y"].bitwiseXOR(k)), s["m"]), s["m"])
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["n"].alias("m"), s["m"].alias("n"))

    def encipher(value: Column) -> Column:
        start = F.struct(
            ((value - F.pmod(value, F.lit(b))) / F.lit(b)).cast("long").alias("x"), F.pmod(value, F.lit(b)).alias("y"), F.lit(a).cast("long").alias("m"), F.lit(b).cast("long").alias("n"),
        )
        return F.aggregate(keys, start, turn, lambda s: s["x"] * b + s["y"])

    once = encipher(number.cast("long"))
    spare = a * b - rows
    if spare == 0:
        return once
    return F.aggregate(
        F.array_repeat(F.lit(0), min(spare, _WALK)), once,
        lambda at, _: F.when(at < rows, at).otherwise(encipher(at)),
    )


def place(number: int, rows: int, key: int, shards: int) -> tuple[int, int]:
    """Shard and slot of a row number, computed from the parameters alone."""
    import xxhash

    a, b = _sides(rows)
    while True:
        x, y, m, n = number // b, number % b, a, b
        for k in _round_keys(key):
            hashed = xxhash.xxh64(struct.pack("<q", y ^ k), seed=42).intdigest()
            hashed -= (hashed >> 63) << 64
            x, y, m, n = y, (x + hashed % m) % m, n, m
        number = x * b + y
        if number < rows:
            return number % shards, number // shards


def row_numbers(df: DataFrame, order_by: Sequence[str], into: str, then_by: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``df`` with a global row number from 0 in the given order, and the row count.

    Rows are range-partitioned and written once; a table of one row per partition gives
    the offsets.  Rows that are equal in ``order_by`` meet in one partition, where
    ``then_by`` orders them; rows that are equal in both take neighbouring numbers in any
    order.
    """
    at, part, spot = f"{into}_at", f"{into}_part", f"{into}_before"
    ordered = keep(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by, *then_by).withColumn(at, F.monotonically_increasing_id()),
        "ordered",
    )
    number = F.shiftright(F.col(at), _LOCAL_BITS).cast("int")
    before, total = [], 0
    for p, n in sorted(ordered.groupBy(number.alias("p")).count().collect()):  # one row per partition
        before.append((p, total))
        total += n
    places = df.sparkSession.createDataFrame(before, f"`{part}` int, `{spot}` long")
    return (
        ordered.join(F.broadcast(places), number == F.col(part))
        .withColumn(into, F.col(spot) + F.col(at).bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .select(*df.columns, into),
        total,
    )


def sharded(df: DataFrame, order_by: Sequence[str], shards: int, key: int = 0) -> DataFrame:
    """``df`` as ``doc`` (the row as a struct) with ``number``, ``shard`` and ``slot``.

    Null order values come first and ties are broken by nothing: rows that are equal in
    ``order_by`` are interchangeable, so name columns that tell rows apart.  A table
    with fewer rows than shards leaves the last shards empty; an empty table stays empty.
    """
    rows = df.select(F.struct("*").alias("doc"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)])
    table, total = row_numbers(rows, [f"_o{i}" for i in range(len(order_by))], "number")
    return (
        table.withColumn("_place", permuted(F.col("number"), total, key))
        .select(
            "doc", "number", F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
            F.expr(f"_place div {int(shards)}").alias("slot"),
        )
    )
