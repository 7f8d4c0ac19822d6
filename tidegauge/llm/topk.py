"""Exact top-k inner products by block-at-a-time pruning.

Vectors are laid out near their likes and cut into blocks, each with a forward index (the
ids and the packed integer components) and the least and greatest value of every
component.  For a query, the greatest possible contribution of each component, added up,
bounds the scores of a block.  A task takes the blocks of a stretch of the table in
falling order of their bound, per query, scores them through their forward indexes, and
stops with a query once the bound falls below its k-th score.

Queries are a stated set; they are taken in batches of bounded bytes, each broadcast over
all blocks, so that no vector is shuffled again for a query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.tables import keep, ship

BLOCK_ROWS = 256
#: Blocks whose bounds are ordered together in a task.
STRETCH = 64
#: Queries in one broadcast.
BATCH_QUERIES = 16_384
PIVOTS = 64
#: Vectors with a component beyond this are scored apart, in integers of any size.
LIMIT = 1 << 26
#: Candidates that are compared with all queries of a batch at a time in that way.
LARGE_ROWS = 2_048
#: Queries in one broadcast of it.
LARGE_QUERIES = 2_048
_NONE = -(1 << 62)  # below every score


def quantised(embedding: str, scale: int = 256) -> tuple[Column, Column]:
    """floor(scale * x) of every component as long, and the components of large vectors.

    A vector takes part unless it is null or a component is null or not finite.  If a scaled
    component is beyond ``LIMIT``, the first column is null and the second holds the vector;
    for all others the second is null.
    """
    x = F.col(embedding).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fits = F.forall(x, lambda v: F.abs(v * scale) <= float(LIMIT))
    return F.when(usable & fits, F.transform(x, lambda v: F.floor(v * scale))), F.when(usable & ~fits, x)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column, shorter ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    if len(flat):
        out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _nearest(pivots: np.ndarray):
    """Adds the number of the pivot with the greatest cosine, for the layout."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), pivots.shape[1]).astype(np.float64)
            near = (x @ pivots.T).argmax(axis=1).astype(np.int32) if len(pivots) else np.zeros(len(x), np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near)], ["id", "v", "near"])

    return run


_BLOCK = "ids binary, vectors binary, low binary, high binary"


def _packing(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _matrix(part.column("v"), width)
                ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                    "vectors": pa.array([x.astype(np.int32).tobytes()], pa.binary()),
                    "low": pa.array([x.min(axis=0).tobytes()], pa.binary()),
                    "high": pa.array([x.max(axis=0).tobytes()], pa.binary()),
                })

    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by doubles where every sum stays below 2**53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of each query so far; ties go to smaller ids."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), _NONE)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def kth(self) -> np.ndarray:
        return self.scores[:, -1]

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of ``ids`` for the queries ``rows``."""
        k = self.scores.shape[1]
        # Only scores that reach the k-th matter.
        useful = (scores >= self.kth()[rows][:, None]).any(axis=1)
        rows, scores = rows[useful], scores[useful]
        if len(rows) == 0:
            return
        scores = np.concatenate((self.scores[rows], scores), axis=1)
        ids = np.concatenate((self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))), axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(ids, order, axis=1)


def search(blocks: list[tuple[np.ndarray, ...]], ids: np.ndarray, queries: np.ndarray, best: Best) -> int:
    """Offer the blocks to ``best`` in falling order of their bounds; blocks scored."""
    low, high = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = _products(np.maximum(queries, 0), high) + _products(np.minimum(queries, 0), low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    live, scored = np.arange(len(queries)), 0
    for step in range(len(blocks)):
        turn = order[live, step]
        ahead = bounds[live, turn] >= best.kth()[live]
        live, turn = live[ahead], turn[ahead]  # bounds only fall: a query that stops is done
        if len(live) == 0:
            break
        for number in np.unique(turn):
            rows = live[turn == number]
            members, vectors = blocks[number][0], blocks[number][1]
            scores = _products(queries[rows], vectors)
            scores[ids[rows][:, None] == members[None, :]] = _NONE
            best.offer(rows, scores, members)
            scored += len(rows)
    return scored


def _scoring(shared, k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, queries = shared.value
        best, held = Best(len(ids), k), []

        def flush() -> None:
            if held:
                search(held, ids, queries, best)
                held.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("ids", "vectors", "low", "high")]
            for members, vectors, low, high in zip(*columns):
                held.append((
                    np.frombuffer(members, np.int64), np.frombuffer(vectors, np.int32).reshape(-1, width).astype(np.int64),
                    np.frombuffer(low, np.int64), np.frombuffer(high, np.int64),
                ))
                if len(held) == STRETCH:
                    flush()
        flush()
        found = best.scores > _NONE
        at = np.nonzero(found)[0]
        yield pa.RecordBatch.from_pydict({
            "query": rows[at], "query_id": ids[at], "vec_id": best.ids[found], "score": best.scores[found],
        })

    return run


# ---------------------------------------------------------------- large components

#: More than any score is away from zero: two components below 2**1033, and any number of them.
_OFFSET = 1 << 2200
_DIGITS = len(f"{2 * _OFFSET:x}")
_LONG = (1 << 63) - 1


def _integers(small: list | None, large: list | None, scale: int) -> list[int]:
    if small is not None:
        return small
    scaled = [(x, x * scale) for x in large]
    return [math.floor(y) if math.isfinite(y) else int(x) * scale for x, y in scaled]


def _mantissas(vectors: list[list[int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of doubles of magnitude 1 at most, and the power of two that scales each row."""
    powers = np.array([max((abs(v).bit_length() for v in vector), default=0) for vector in vectors], np.int64)
    out = np.zeros((len(vectors), width))
    for row, vector, power in zip(out, vectors, powers):
        row[: len(vector)] = [v / (1 << int(power)) for v in vector]
    return out, powers


def exact_best(queries: list[list[int]], query_ids: list, vectors: list[list[int]], ids: list[int], k: int) -> list[list[tuple[int, int]]]:
    """Per query the k best ``(-score, id)`` of the vectors, whatever the size of their components.

    Scores in doubles, with a bound on their error, leave a few vectors per query; those are
    scored in whole numbers.
    """
    width = max(map(len, [*queries, *vectors]), default=0)
    a, _ = _mantissas(queries, width)
    b, powers = _mantissas(vectors, width)
    b = np.ldexp(b, (powers - powers.max(initial=0))[:, None])
    about, error = a @ b.T, (width + 8) * 2.0**-52 * (np.abs(a) @ np.abs(b).T) + 2.0**-1000
    low = about - error
    cut = np.partition(low, -min(k + 1, len(vectors)), axis=1)[:, -min(k + 1, len(vectors))]  # one more: the query itself
    out = []
    for i, query in enumerate(queries):
        near = np.flatnonzero(about[i] + error[i] >= cut[i])
        scored = ((-sum(x * y for x, y in zip(query, vectors[j])), ids[j]) for j in near if ids[j] != query_ids[i])
        out.append(heapq.nsmallest(k, scored))
    return out


_LARGE = "query long, query_id long, vec_id long, beyond int, score long, digits string"


def _large_scoring(shared, k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, query_ids, raw = shared.value
        queries = [_integers(v, x, scale) for v, x in raw]
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for batch in batches:
            for at in range(0, batch.num_rows, LARGE_ROWS):
                part = batch.slice(at, LARGE_ROWS)
                ids, *columns = (part.column(c).to_pylist() for c in ("id", "v", "x"))
                found = exact_best(queries, query_ids, [_integers(v, x, scale) for v, x in zip(*columns)], ids, k)
                best = [heapq.nsmallest(k, old + new) for old, new in zip(best, found)]
        rows = [(n, q, i, -minus) for n, q, pairs in zip(numbers, query_ids, best) for minus, i in pairs]
        beyond = [(s > _LONG) - (s < -_LONG - 1) for *_, s in rows]
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
            pa.array(beyond, pa.int32()), pa.array([min(max(r[3], -_LONG - 1), _LONG) for r in rows], pa.int64()),
            pa.array([f"{r[3] + _OFFSET:0{_DIGITS}x}" if o else None for r, o in zip(rows, beyond)], pa.string()),
        ], ["query", "query_id", "vec_id", "beyond", "score", "digits"])

    return run


def _large_scores(usable: DataFrame, asked: DataFrame, k: int, scale: int) -> DataFrame:
    """All queries against the large vectors, and the large queries against the others."""
    spark = usable.sparkSession
    parts = []
    for candidates, queries in (
        (usable.filter("x is not null"), asked), (usable.filter("v is not null"), asked.filter("x is not null"))
    ):
        batches = -(-queries.count() // LARGE_QUERIES)
        for number in range(batches):
            rows = queries.filter(F.pmod(F.xxhash64("query"), F.lit(batches)) == number).toArrow()  # one batch: bounded rows
            columns = [rows.column(c).to_pylist() for c in ("query", "id", "v", "x")]
            shared = spark.sparkContext.broadcast((columns[0], columns[1], list(zip(*columns[2:]))))
            parts.append(keep(candidates.select("id", "v", "x").mapInArrow(_large_scoring(shared, k, scale), _LARGE), "scored"))
            shared.unpersist()
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _LARGE)


# ---------------------------------------------------------------- search


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256
) -> DataFrame:
    """The ``k`` rows with the greatest integer inner product, for every row that is a query.

    Returns ``query_id, rank, vec_id, score``; equal scores go to the smaller id.  Every
    row but those with the query's own id is a candidate.  Vectors that are null or hold
    null or non-finite components take no part, nor do rows without an id; shorter vectors
    count as filled up with zeros.  Vectors with a scaled component beyond ``LIMIT`` are
    scored in whole numbers of any size, without blocks; a score beyond 64 bits is ranked by
    its true value and returned as the nearest long.  A query id that several rows share has
    a result for each of them.  Fewer than ``k`` candidates give fewer rows; an empty table
    gives none.
    """
    spark = vectors.sparkSession
    ship(spark)
    small, large = quantised(embedding, scale)
    usable = keep(
        vectors.select(F.col(vec_id).cast("long").alias("id"), small.alias("v"), large.alias("x"), queries.alias("asks"))
        .filter("id is not null and (v is not null or x is not null)"),
        "vectors",
    )
    everything, usable = usable, usable.filter("v is not null")
    width = usable.agg(F.max(F.size("v"))).first()[0] or 0
    # Pivots for the layout only: a few vectors, drawn in their tasks.
    share = min(1.0, 2 * PIVOTS / max(usable.count(), 1))
    chosen = usable.select("v").filter(F.rand(7) < share).limit(PIVOTS).toArrow().column("v").combine_chunks()
    pivots = _matrix(chosen, width).astype(np.float64)
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-9)
    candidates = usable.select("id", "v").mapInArrow(_nearest(pivots), "id long, v array<long>, near int")
    blocks = keep(
        candidates.repartitionByRange("near", "id").sortWithinPartitions("near", "id").select("id", "v").mapInArrow(_packing(width), _BLOCK),
        "blocks",
    )
    every_query = keep(everything.filter("asks").select(F.monotonically_increasing_id().alias("query"), "id", "v", "x"), "queries")
    asked = every_query.filter("v is not null")
    batches = max(1, -(-asked.count() // BATCH_QUERIES))
    parts = []
    for number in range(batches):
        rows = asked.filter(F.pmod(F.xxhash64("query"), F.lit(batches)) == number).toArrow()  # one batch: bounded rows
        packed = (rows.column("query").to_numpy(), rows.column("id").to_numpy(), _matrix(rows.column("v").combine_chunks(), width))
        shared = spark.sparkContext.broadcast(packed)
        parts.append(keep(
            blocks.mapInArrow(_scoring(shared, k, width), "query long, query_id long, vec_id long, score long"), "scored"
        ))
        shared.unpersist()
    scored = parts[0]
    for part in parts[1:]:
        scored = scored.unionByName(part)
    order = [F.desc("score"), F.asc("vec_id")]
    if not everything.filter("x is not null").isEmpty():
        scored = scored.withColumns({"beyond": F.lit(0), "digits": F.lit(None).cast("string")}).unionByName(
            _large_scores(everything, every_query, k, scale))
        order = [F.desc("beyond"), F.desc("digits"), *order]
    order = Window.partitionBy("query").orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
