"""Words, characters and sequences of whole texts.

A long text is first cut into overlapping blocks, so that no expression scans a text
from its start for every position and a long text can be spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import space_fields, words
from tidegauge.operators.joins import stored_bytes
from tidegauge.session import BROADCAST_BYTES

PAD, START = 0, 1
# Windows that are cut from one piece of a block.
PIECE_WINDOWS = 16


def tokens(df: DataFrame, column: str, into: str = "word") -> DataFrame:
    """One row per white-space separated word, with the other columns kept."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(words(F.col(column))).alias(into))


def fields(df: DataFrame, column: str, into: str = "word") -> DataFrame:
    """One row per field between single spaces; empty fields are kept."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(space_fields(F.col(column))).alias(into))


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Count per space-separated word, empty words dropped, most frequent first."""
    counted = fields(df.select(column), column).filter("word <> ''").groupBy("word")
    return counted.agg(F.count("*").alias("count")).orderBy(F.desc("count"), "word")


def top_words(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return word_count(df, column).limit(k)


def malformed_lines(df: DataFrame, column: str, fields_needed: int = 3) -> DataFrame:
    """How many lines have fewer than ``fields_needed`` space-separated fields."""
    return df.agg(
        F.count_if(F.size(space_fields(F.col(column))) < fields_needed).alias("malformed"),
        F.count("*").alias("lines"),
    )


def without_stop_words(df: DataFrame, word: str, stop: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """Rows whose lower-cased word is not in ``stop`` (``word`` and any ``on`` columns).

    A list within the bound of a broadcast is broadcast; a longer one is shuffled.
    """
    listed = stop.select(*on, F.col("word").alias("_stop"))
    condition = F.lower(F.col(word)) == F.col("_stop")
    for c in on:
        condition = condition & (df[c] == listed[c])
    if stored_bytes(listed) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return df.join(listed, condition, "left_anti")


# ---------------------------------------------------------------- characters


def text_blocks(
    df: DataFrame, column: str, size: int, overlap: int = 0, start: str = "block_start",
    into: str = "block",
) -> DataFrame:
    """Cut texts into blocks of ``size`` characters plus the next ``overlap`` ones.

    One regular-expression pass cuts the text, so the cost is linear in its length.
    """
    others = [c for c in df.columns if c != column]
    if overlap > size:
        raise ValueError("overlap must not exceed size")
    cut = df.select(
        *others, F.regexp_extract_all(column, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("_parts")
    )
    joined = F.transform(
        F.sequence(F.lit(0), F.size("_parts") - 1),
        lambda i: F.concat(
            F.get(F.col("_parts"), i),
            F.substring(F.coalesce(F.get(F.col("_parts"), i + 1), F.lit("")), 1, overlap),
        ),
    )
    blocks = cut.filter(F.size("_parts") > 0).select(*others, F.posexplode(joined).alias("_i", into))
    return blocks.select(*others, (F.col("_i") * size).alias(start), into)


def char_vocabulary(df: DataFrame, columns: Sequence[str], offset: int = 0) -> DataFrame:
    """Distinct characters in code-point order with ids from ``offset``: ``char, id``.

    Characters are made distinct per text before they are exploded.  The final
    numbering sees at most one row per character that exists.
    """
    chars = F.array_distinct(F.flatten(F.array(*[F.split(c, "", -1) for c in columns])))
    distinct = df.select(F.explode(chars).alias("char")).filter("char <> ''").distinct()
    ordered = distinct.agg(F.sort_array(F.collect_list("char")).alias("_c"))
    return ordered.select(F.posexplode("_c").alias("_i", "char")).select(
        "char", (F.col("_i") + offset).cast("int").alias("id")
    )


def _code_table(vocabulary: DataFrame) -> Column:
    """Array literal from code point to id (0 where a character is unknown).

    The vocabulary is bounded by the number of characters that exist.
    """
    ids = {ord(row["char"]): row["id"] for row in vocabulary.collect()}
    table = ",".join(str(ids.get(i, 0)) for i in range(max(ids, default=0) + 1))
    return F.split(F.lit(table), ",").cast("array<int>")


def encode_characters(text: Column, vocabulary: DataFrame, add_start: bool = False) -> Column:
    """Text to ids; unknown characters become 0; optionally led by the start id."""
    table = _code_table(vocabulary)
    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "", -1))
    ids = F.transform(chars, lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(PAD)))
    return F.concat(F.array(F.lit(START)), ids) if add_start else ids


def pad_to(ids: Column, length: Column) -> Column:
    """Pad with 0 at the end; a longer sequence loses its front, as Keras does."""
    short = F.greatest(length - F.size(ids), F.lit(0)).cast("int")
    kept = F.slice(ids, F.greatest(F.size(ids) - length + 1, F.lit(1)).cast("int"), F.greatest(length, F.lit(1)).cast("int"))
    return F.concat(kept, F.array_repeat(F.lit(PAD), short))


def padded(df: DataFrame, column: str, length: int | None = None) -> DataFrame:
    """Pad a column of id arrays to ``length``, or to the longest array."""
    longest = F.lit(length) if length is not None else df.agg(F.max(F.size(column))).scalar()
    return df.withColumn(column, pad_to(F.col(column), longest))


def sequence_pairs(
    df: DataFrame, source: str, target: str, source_vocabulary: DataFrame,
    target_vocabulary: DataFrame,
) -> DataFrame:
    """Encoder input, decoder input (start + target) and decoder label (target + pad)."""
    ids = encode_characters(F.col(target), target_vocabulary)
    return df.withColumns(
        {
            "encoder_input": encode_characters(F.col(source), source_vocabulary),
            "decoder_input": F.concat(F.array(F.lit(START)), ids),
            "decoder_label": F.concat(ids, F.array(F.lit(PAD))),
        }
    )


def one_hot_ids(ids: Column, classes: int) -> Column:
    """Each id as a 0/1 array of ``classes`` entries."""
    return F.transform(
        ids,
        lambda i: F.transform(
            F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: (c == i).cast("int")
        ),
    )


def char_windows(
    df: DataFrame, column: str, length: int = 40, stride: int = 3, block_windows: int = 256
) -> DataFrame:
    """Sliding windows with the next character as label: ``start, window, next_char``."""
    others = [c for c in df.columns if c != column]
    size = stride * max(block_windows, -(-(length + 1) // stride))
    blocks = text_blocks(df, column, size, overlap=length)
    # windows take `length / stride` times the room of the text: spread blocks first
    blocks = blocks.repartition(*others, "block_start")
    # a substring is found by counting characters, so each window is cut from a short piece of its block
    step = stride * min(max(block_windows, 1), PIECE_WINDOWS)

    def starts_in(text: str, upto: int, every: int) -> Column:
        """A window needs its label inside the text, which covers starts 0 .. upto - 1."""
        last = F.least(F.length(text) - length - 1, F.lit(upto - 1))
        return F.explode(F.sequence(F.lit(0), last, F.lit(every)))

    pieces = blocks.filter(F.length("block") > length).select(
        *others, "block_start", "block", starts_in("block", size, step).alias("_from")
    ).select(
        *others, (F.col("block_start") + F.col("_from")).alias("_from"),
        # the last piece of a block ends with the block's starts
        F.substring("block", F.col("_from") + 1, F.least(F.lit(step), size - F.col("_from")) + length).alias("_piece"),
    )
    cut = pieces.select(*others, "_from", "_piece", starts_in("_piece", step, stride).alias("_at")).select(
        *others, (F.col("_from") + F.col("_at")).alias("start"),
        F.substring("_piece", F.col("_at") + 1, F.lit(length + 1)).alias("_both"),
    )
    return cut.select(
        *others, "start", F.substring("_both", 1, length).alias("window"),
        F.substring("_both", length + 1, 1).alias("next_char"),
    )
