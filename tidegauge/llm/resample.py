"""Importance resampling towards a target text, with exact weights from bit-sliced counts.

Words and word runs of a text are hashed into ``BUCKETS`` buckets.  A bucket's gain is the
logarithm of its smoothed share in the target against that in the corpus, as an integer.
A document's weight is the floored mean gain of its features: its bucket counts are written
as bit planes (plane j holds bit j of all counts), the gains as planes of their positive and
of their negative parts, and the sum over features is ``2**(i+j)`` times the population
count of the conjunction of planes i and j.  All integers, hence exact in any order.

Draws without replacement add Gumbel noise from a hash of the key and take the highest
scores; the rank of every row comes from range partitions, so no task sees all scores.
Counts are one pass over each table with at most ``BUCKETS`` sums a task; only ``BUCKETS``
numbers a table reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.sharding import row_numbers
from tidegauge.llm.tables import keep, ship
from tidegauge.llm.wordhash import ALNUM, LOWER

BUCKETS = 10_000
_UNITS = -(-BUCKETS // 64)
#: Texts whose planes are in memory at a time.
_TOGETHER = 64

#: A space for each byte outside words, small letters for ASCII capitals.
_CLEAN = bytes(int(LOWER[b]) if ALNUM[b] else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased."""
    return text.encode().translate(_CLEAN).split(b" ") if text else []


def features(text: str | None, longest: int) -> tuple[int, Counter]:
    """Number of words, and every run of 1 to ``longest`` words with its count."""
    found = [w for w in words(text) if w]
    counts = Counter(found)
    for n in range(2, longest + 1):
        counts.update(map(b" ".join, zip(*[found[i:] for i in range(n)])))
    return len(found), counts


def bucket_counts(counts: Counter) -> np.ndarray:
    """Features per bucket: CRC-32 of the UTF-8 bytes modulo ``BUCKETS``."""
    at = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % BUCKETS
    return np.bincount(at, np.fromiter(counts.values(), np.float64, len(counts)), BUCKETS).astype(np.int64)


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of ``BUCKETS`` non-negative integers: ``[row, bit, 64-bit unit]``."""
    deep = int(values.max(initial=0)).bit_length()
    out = np.zeros((len(values), deep, _UNITS * 8), np.uint8)
    for j in range(deep):
        packed = np.packbits((values >> j) & 1 == 1, axis=1)
        out[:, j, : packed.shape[1]] = packed
    return out.view(np.uint64)


class Gains:
    """Signed integer gains as planes of their positive and negative parts."""

    def __init__(self, gains: np.ndarray):
        self.up = planes(np.maximum(gains, 0)[None])[0]
        self.down = planes(np.maximum(-gains, 0)[None])[0]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """For each row of bucket counts the sum of count times gain."""
        bits = planes(counts)
        scale = np.int64(1) << np.arange(bits.shape[1], dtype=np.int64)
        total = np.zeros(len(counts), np.int64)
        for sign, gain in ((1, self.up), (-1, self.down)):
            for i, plane in enumerate(gain):
                held = np.bitwise_count(bits & plane).sum(axis=2, dtype=np.int64)
                total += sign * ((held @ scale) << i)
        return total


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))`` per bucket."""
    big_t, big_s = float(target.sum() + BUCKETS), float(corpus.sum() + BUCKETS)
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * big_s / (float(s + 1) * big_t))) for t, s in zip(target.tolist(), corpus.tolist())
    ], np.int64)


def _counter(longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += bucket_counts(features(text.as_py(), longest)[1])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    return count


def corpus_counts(df: DataFrame, text: str = "text", longest: int = 1) -> np.ndarray:
    """Features of all rows per bucket; null texts have none."""
    ship(df.sparkSession)
    sums = df.select(F.col(text)).mapInArrow(_counter(longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    total = np.zeros(BUCKETS, np.int64)
    for bucket, n in sums.collect():  # BUCKETS rows at most
        total[bucket] = n
    return total


def _weigher(gain: Gains, longest: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spots = batch.column(1), range(0, len(batch), _TOGETHER)
            for at in spots:
                part = [features(t.as_py(), longest) for t in texts[at : at + _TOGETHER]]
                n = np.array([sum(c.values()) for _, c in part], np.int64)
                counts = np.stack([bucket_counts(c) for _, c in part])
                # rows with small counts need few planes: take rows of like depth together
                order, weight = np.argsort(counts.max(axis=1)), np.zeros(len(part), np.int64)
                for some in np.array_split(order, max(1, len(order) // 16)):
                    weight[some] = gain.sums(counts[some])
                weight //= np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, _TOGETHER), pa.array([w for w, _ in part], pa.int64()), pa.array(n), pa.array(weight)],
                    ["doc", "n_words", "n_features", "weight"],
                )

    return weigh


def weighted(df: DataFrame, gain: np.ndarray, text: str = "text", carry: Sequence[str] | None = None, longest: int = 1) -> DataFrame:
    """Every row as ``doc`` with ``n_words``, ``n_features`` and its ``weight`` (0 without features)."""
    ship(df.sparkSession)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("doc"), F.col(text).alias("text"))
    more = [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")]
    return rows.mapInArrow(_weigher(Gains(gain), longest), T.StructType([rows.schema["doc"], *more]))


def gumbel(key: Column, seed: int) -> Column:
    """``floor(-1000 ln(-ln u))`` with u from the first 32 bits of SHA-256 of ``seed:key``."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.ln(-F.ln(u)))


def resampled(
    df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", share: tuple[int, int] = (10, 100),
    least_words: int = 20, longest: int = 1, seed: int = 2024, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row as ``doc`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the N rows with ``least_words`` words or more, the ``floor(N * share)`` with the
    highest scores are drawn and ranked from 1, ties to the smaller ``key`` (null first);
    the others have no rank.  Rows that repeat a key share its noise and are ranked in any
    order.  Null and empty texts have no features and weight 0; a null key has the noise of
    an empty one.  An empty target leaves the uniform share of all buckets as the target.
    """
    gain = gains(corpus_counts(target, text, longest), corpus_counts(df, text, longest))
    rows = weighted(df, gain, text, list(dict.fromkeys([*(carry or df.columns), key])), longest)
    score = F.col("weight") + gumbel(F.col("doc")[key], seed)
    # written, as range partitions read their input twice
    rows = keep(rows, "weighted").withColumn("score", score).select(
        "*", (F.col("n_words") < least_words).alias("_short"), (-F.col("score")).alias("_down"), F.col("doc")[key].alias("_key"))
    placed, _ = row_numbers(rows, ["_short", "_down", "_key"], "_number")
    drawn = placed.filter("not _short").count() * share[0] // share[1]
    rank = F.when(F.col("_number") < drawn, F.col("_number") + 1)
    return placed.select("doc", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn(df: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that :func:`resampled` draws."""
    return resampled(df, target, **options).filter("rank is not null").select("doc.*")
