"""Chat logs to training texts: snapshots of a growing conversation become one.

Services log a conversation again after every turn, so that logged conversations are
prefixes of longer ones.  Every turn has a hash of its place, role and text; added up
along a conversation they are the hash of every prefix.  A conversation whose whole hash
is the hash of a shorter stretch of another is left out by an anti-join; of equal ones
the smallest id stays.  The others are rendered.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.sharding import row_numbers
from tidegauge.llm.tables import keep

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Turns in one rendered page, and positions in one stretch of a running sum.
PAGE_TURNS = 256
_STRETCH = 4096
#: Characters of a text that decide its range partition.
BOUND_CHARS = 64
_SUMS = ["_a", "_b", "_c", "_d"]


def _hashes(role: Column, text: Column, position: Column) -> list[Column]:
    """Four sums' worth of hash: 32-bit halves of two hashes, so that sums never overflow."""
    marked = [role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit("")), position]
    one, two = F.xxhash64(*marked), F.xxhash64(F.lit("second"), *marked)
    mask = F.lit(0xFFFFFFFF)
    return [one.bitwiseAND(mask), F.shiftrightunsigned(one, 32), two.bitwiseAND(mask), F.shiftrightunsigned(two, 32)]


def prefixes(turns: DataFrame) -> DataFrame:
    """Adds the prefix hash ``_a .. _d`` to ``conv, role, text, pos`` by sums in stretches.

    A conversation of any length is cut into stretches; totals of stretches are added up
    first, so that no task holds a whole conversation.
    """
    hashed = turns.withColumns(dict(zip(_SUMS, _hashes(F.col("role"), F.col("text"), F.col("pos"))))).withColumn(
        "_stretch", F.floor(F.col("pos") / _STRETCH)
    )
    totals = hashed.groupBy("conv", "_stretch").agg(*[F.sum(c).alias(f"t{c}") for c in _SUMS])
    earlier = Window.partitionBy("conv").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("conv", "_stretch", *[F.coalesce(F.sum(f"t{c}").over(earlier), F.lit(0)).alias(f"b{c}") for c in _SUMS])
    bases = bases.filter("_stretch > 0").withColumnsRenamed({"conv": "_conv", "_stretch": "_at"})
    local = Window.partitionBy("conv", "_stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns({c: F.sum(c).over(local) for c in _SUMS})
    same = summed["conv"].eqNullSafe(bases["_conv"]) & (summed["_stretch"] == bases["_at"])
    return summed.join(bases, same, "left").select(
        "conv", "role", "text", "pos", *[(F.col(c) + F.coalesce(f"b{c}", F.lit(0))).alias(c) for c in _SUMS]
    )


def _rendered(role: Column, text: Column) -> Column:
    """One turn in chat markup; markers within a text lose their bar."""
    def clean(c: Column) -> Column:
        return F.replace(F.replace(c, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))

    return F.concat(
        F.lit(OPEN), clean(F.coalesce(role, F.lit("unknown"))), F.lit("\n"), clean(F.coalesce(text, F.lit(""))), F.lit(CLOSE + "\n")
    )


def collapsed(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    page_turns: int = PAGE_TURNS,
) -> DataFrame:
    """The maximal conversations, rendered.

    Columns: ``conv_id``, ``page`` (from 0; a conversation of more than ``page_turns``
    turns has several), ``n_turns`` (of the conversation), ``copies`` (conversations equal to
    it, itself included) and ``rendered``.

    Turns are ordered by turn, role and text, nulls first; repeated rows are turns of
    their own.  A null role reads ``unknown``, a null text is empty, but neither equals
    its reading when conversations are compared.  Rows without a conversation id are one
    conversation whose id counts as larger than all others.  An empty table gives an
    empty result.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    # Range bounds hold the start of a text only, so that they stay small; the sort within ranges compares whole texts.
    rows = rows.withColumn("_start_of_text", F.substring("text", 1, BOUND_CHARS))
    table, _ = row_numbers(rows, ["conv", "turn", "role", "_start_of_text"], "_n", then_by=["text"])
    starts = table.groupBy("conv").agg(F.min("_n").alias("_start")).withColumnRenamed("conv", "_conv")
    turns = table.join(starts, table["conv"].eqNullSafe(starts["_conv"])).select(
        "conv", "role", "text", (F.col("_n") - F.col("_start")).alias("pos")
    )
    turns = keep(prefixes(turns), "turns")
    size = turns.groupBy("conv").agg(F.max("pos").alias("last")).withColumnRenamed("conv", "_conv")
    placed = turns.drop("role", "text").join(size, turns["conv"].eqNullSafe(size["_conv"]))
    order = F.struct(F.col("conv").isNull().alias("none"), F.col("conv").alias("id"))
    # One row per different conversation; the smallest id stands for its copies.
    whole = placed.filter("pos = last").groupBy("pos", *_SUMS).agg(F.min(order).alias("best"), F.count("*").alias("copies"))
    inner = placed.filter("pos < last").select("pos", *_SUMS).distinct()
    kept = whole.join(inner, ["pos", *_SUMS], "left_anti").select(
        F.col("best.id").alias("conv_id"), (F.col("pos") + 1).alias("n_turns"), "copies"
    )
    pages = (
        turns.join(kept, turns["conv"].eqNullSafe(kept["conv_id"]))
        .groupBy("conv_id", F.floor(F.col("pos") / page_turns).alias("page"), "n_turns", "copies")
        .agg(F.array_sort(F.collect_list(F.struct("pos", _rendered(F.col("role"), F.col("text")).alias("t")))).alias("t"))
    )
    return pages.select("conv_id", "page", "n_turns", "copies", F.array_join(F.transform("t", lambda x: x["t"]), "").alias("rendered"))
