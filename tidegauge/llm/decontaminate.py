"""Benchmark passages in documents, found by winnowed fingerprints.

A *window* is ``window`` consecutive words of a benchmark item, or the whole of a shorter
item.  Both sides keep, of every run of ``w`` consecutive k-word hashes, the least one
(``w + k - 1`` is the window's length).  A shared window has the same least hash on both
sides, so joining these fingerprints misses none; every meeting is extended to the
windows around it and compared word by word, so chance agreements of hashes are no hits.

The benchmark is the stated query set: it is taken in blocks of bounded bytes, each
broadcast as an index of sorted arrays, and the documents are read once, without a
shuffle, however often a passage repeats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm import wordhash as W
from tidegauge.llm.tables import ship

#: Bytes of benchmark text in one broadcast index.
BLOCK_BYTES = 8 * 2**20

_HITS = "array<struct<first:int,end:int>>"
_CACHED = 50_000


def _split(length: int) -> tuple[int, int]:
    """k and w for shared spans of ``length`` words: w + k - 1 = length."""
    k = math.ceil(length / 2)
    return k, length - k + 1


def fingerprints(words: W.Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed positions for spans of ``length`` words and the k-word hashes there."""
    k, w = _split(length)
    grams, _ = words.runs(k)
    count = len(words.hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = words.row[:count] == words.row[length - 1 :]
    least = grams[:count].copy()
    for j in range(1, w):
        np.minimum(least, grams[j : j + count], out=least)
    chosen = np.zeros(len(grams), dtype=bool)
    for j in range(w):
        chosen[j : j + count] |= inside & (grams[j : j + count] == least)
    at = np.flatnonzero(chosen)
    return at, grams[at]


class Index:
    """Fingerprints and windows of a block of benchmark items."""

    def __init__(self, ids: Sequence[str], texts: Sequence[str], window: int):
        data, offsets = W.text_buffers(pa.array(texts, pa.large_string()))
        words = W.Words(data, offsets, W.ALNUM)
        self.ids = list(ids)
        self.row = words.row.astype(np.int32)
        joined = [words.text(i, 1) for i in range(len(words.hashes))]
        lengths = np.array([len(x) + 1 for x in joined], np.int64)
        #: All words with one space after each, and where each word starts.
        self.joined = b" ".join(joined) + b" "
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        counts = np.minimum(np.diff(words.bounds), window)
        #: window length -> (sorted fingerprints, sorted window hashes, their first words)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted(set(counts[counts > 0].tolist())):
            hashes, whole = words.runs(length)
            usable = whole & (counts[words.row] == length)
            at, grams = fingerprints(words, length)
            marks = np.unique(grams[counts[words.row[at]] == length])
            first = np.flatnonzero(usable)
            order = np.argsort(hashes[first], kind="stable")
            self.windows[length] = (marks, hashes[first][order], first[order].astype(np.int32))

    def text(self, first: int, length: int) -> bytes:
        return self.joined[self.starts[first] : self.starts[first + length] - 1]


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values


def occurrences(words: W.Words, index: Index, cache: dict) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """``(first word, words, items)`` of every benchmark window in these rows."""
    total = len(words.hashes)
    for length, (marks, hashes, first) in index.windows.items():
        _, w = _split(length)
        at, grams = fingerprints(words, length)
        at = at[_within(grams, marks)]
        if len(at) == 0:
            continue
        starts = np.unique(at[:, None] - np.arange(w)[None, :])
        starts = starts[(starts >= 0) & (starts + length <= total)]
        starts = starts[words.row[starts] == words.row[starts + length - 1]]
        sums = np.zeros(len(starts), np.uint64)
        for j, factor in enumerate(W.constants(length, length)):
            sums += words.hashes[starts + j] * factor
        sums = W.mix(sums)
        known = _within(sums, hashes)
        for start, value in zip(starts[known].tolist(), sums[known]):
            text = words.text(start, length)
            if text not in cache:
                if len(cache) >= _CACHED:
                    cache.clear()
                a, b = np.searchsorted(hashes, value, "left"), np.searchsorted(hashes, value, "right")
                same = (index.ids[index.row[i]] for i in first[a:b].tolist() if index.text(i, length) == text)
                cache[text] = tuple(dict.fromkeys(same))
            if cache[text]:
                yield start, length, cache[text]


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, end in sorted(spans):
        if out and first <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"first": first, "end": end})
    return out


def _matching(shared):
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cache = shared.value, {}
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("_text"))
            for first, end in W.slices(offsets):
                part = batch.slice(first, end - first)
                words = W.Words(data, offsets[first : end + 1], W.ALNUM)
                found: dict[int, tuple[list, set]] = {}
                for start, length, items in occurrences(words, index, cache):
                    row = int(words.row[start])
                    spans, names = found.setdefault(row, ([], set()))
                    at = start - int(words.bounds[row])
                    spans.append((at, at + length))
                    names.update(items)
                hits, names = part.column("hits"), part.column("items")
                if found:
                    hits, names = hits.to_pylist(), names.to_pylist()
                    for row, (spans, more) in found.items():
                        hits[row] = _merged(spans + [(x["first"], x["end"]) for x in hits[row]])
                        names[row] = sorted(more.union(names[row]))
                    hits, names = pa.array(hits, spans_type), pa.array(names, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("_text"),
                     pa.array(np.diff(words.bounds), pa.int64()), hits, names],
                    ["doc", "_text", "n_words", "hits", "items"],
                )

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, carry: Sequence[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Benchmark windows in every whole document text.

    Words are maximal runs of ASCII letters, digits and all characters beyond ASCII, with
    A-Z lower-cased.  Columns: ``doc`` (the columns in ``carry``, all if not given, as a
    struct), ``n_words``, ``hits`` (merged word spans, ends exclusive), ``items`` (ids, as
    sorted strings, of items with an occurring window).

    A null or empty text has no words and no hits; an item without words has no window. A
    null item id reads ``null``; repeated ids count once.  Without items nothing is hit,
    and without documents the result is empty.
    """
    spark = docs.sparkSession
    ship(spark)
    carry = docs.columns if carry is None else list(carry)
    state = docs.select(
        F.struct(*carry).alias("doc"), F.col(text).cast("string").alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_HITS).alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    kind = T.StructType([T.StructField(f.name, f.dataType, True) for f in state.schema])
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
        F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("body"),
    )
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("id", "body"), F.lit(blocks))
    for number in range(blocks):
        rows = items.filter(block == number).collect()  # one block: bounded bytes
        shared = spark.sparkContext.broadcast(Index([r.id for r in rows], [r.body for r in rows], window))
        state = state.mapInArrow(_matching(shared), kind)
    return state.drop("_text")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    return contamination(docs, benchmark, text, window=window).filter(F.size("items") == 0).select("doc.*")
