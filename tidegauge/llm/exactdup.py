"""Exact duplicates by two-pass Bloom filtering.

The first pass adds every row's text hash to a Bloom filter of blocks of 32 768 bits and
keeps the bits that rows have set at least twice.  The second pass tests the rows against
those bits: a row with a bit that nobody else has set is alone and passes straight through.
The rest, the rows of repeated texts and about one in two hundred others, are grouped by
the SHA-256 of their text, which decides.  What is shuffled for the filter is one small
(block, bit) pair per distinct bit of a task, never a text.  Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import keep
from tidegauge.operators.joins import lookup_join

BLOCK_BITS = 32_768  # what bitmap_construct_agg holds in one value of 4 096 bytes
BITS_PER_ROW = 16
BITS_SET = 3
#: Bound of a broadcast filter in memory.  A larger filter meets the rows in a shuffle join.
FILTER_BYTES = 64 * 2**20
#: Bound of broadcast groups, at about 130 bytes in memory each.
GROUP_ROWS = 500_000


def normalised(text: Column) -> Column:
    """``text`` with each run of spaces, tabs and line ends as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def blocks_for(rows: int) -> int:
    return max(1, math.ceil(rows * BITS_PER_ROW / BLOCK_BITS))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks)).cast("int")


def _spots(digest: Column) -> Column:
    """The different bits of a row within its block."""
    bits = F.xxhash64(digest, F.lit(1))
    return F.array_distinct(F.array(*[
        F.shiftrightunsigned(bits, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(BITS_SET)
    ]))


def repeated_bits(hashed: DataFrame, blocks: int) -> DataFrame:
    """``(block, bits)``: the bits that at least two rows of ``digest`` set in each block.

    Tasks count their own bits first, so a text of a third of all rows sends one count per
    task and bit.  Bits of one block are at most 32 768 rows of the second shuffle.
    """
    return (
        hashed.select(_block(F.col("digest"), blocks).alias("block"), F.explode(_spots(F.col("digest"))).alias("spot"))
        .groupBy("block", "spot").count().filter("count > 1")
        .select("block", "spot").repartition("block")
        .groupBy("block").agg(F.bitmap_construct_agg(F.col("spot").cast("long")).alias("bits"))
    )


def _has(bits: Column, spot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(spot, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, spot.bitwiseAND(F.lit(7))) == 1


def tested(hashed: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``hashed`` with ``maybe``: false only where no other row has the same ``digest``.

    The filter takes 2 bytes a row.  Up to ``filter_bytes`` it is broadcast and no row moves;
    a larger one is joined by block number, with the rows of hot blocks salted.
    """
    blocks = blocks_for(hashed.count())
    bits = keep(repeated_bits(hashed, blocks), "bits")
    rows = hashed.withColumn("block", _block(F.col("digest"), blocks))
    if blocks * (BLOCK_BITS // 8) <= filter_bytes:
        met = rows.join(F.broadcast(bits), "block", "left")
    else:
        met = lookup_join(rows, bits, ["block"], rows=0, derived=False)
    maybe = F.forall(_spots(F.col("digest")), lambda spot: _has(F.col("bits"), spot))
    return met.withColumn("maybe", F.coalesce(maybe, F.lit(False))).drop("block", "bits")


def exact_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """Every row of ``df`` as ``doc`` (its ``carry`` columns, all by default) with its group.

    ``keep_id`` is the smallest ``key`` of the rows with an equal normalised text, null keys
    last; ``kept`` is true for exactly one row per text, also where rows repeat a key;
    ``group_size`` counts the rows and ``text_sha256`` is the hash of the normalised text.
    Null and empty texts are one group, and so is any text of white space only.  An empty
    table stays empty.
    """
    hashed = keep(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("doc"),
            F.col(key).alias("id"), F.monotonically_increasing_id().alias("rid"),
            F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
        ),
        "hashed",
    )
    rows = tested(hashed, filter_bytes)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("first")
    groups = (
        rows.filter("maybe").groupBy("digest").agg(first, F.count("*").alias("size")).filter("size > 1")
        .select("digest", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid"), "size")
    )
    alone = rows.filter("not maybe").select(
        "doc", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    met = lookup_join(rows.filter("maybe"), groups, ["digest"], rows=GROUP_ROWS)
    several = F.col("size").isNotNull()
    looked_up = met.select(
        "doc", F.when(several, F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (~several | (F.col("rid") == F.col("keep_rid"))).alias("kept"), "digest",
    )
    return alone.union(looked_up).select(
        "doc", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay: of equal texts the one with the smallest ``key``."""
    return exact_duplicates(df, text, key).filter("kept").select("doc.*")
