"""Robust seasonal-trend decomposition by LOESS (Cleveland et al., 1990)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.joins import lookup_join
from tidegauge.operators.ordered import CHUNK_ROWS, exact_quantiles, with_halo
from tidegauge.session import materialise, ship_package, shuffle_tasks

INNER_PASSES = 2
OUTER_PASSES = 15
SEASONAL_SPAN = 7


def _odd_at_least(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


# Cells (targets times span) that a smoother holds at once.
LOESS_CELLS = 1 << 21
# Weighted spread of the points, in rows, from which a slope is fitted.
LEAST_SPREAD = 1e-3


def _loess(y: np.ndarray, span: int, targets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Local linear fits at ``targets`` from the ``span`` nearest evenly spaced points.

    A fit depends on the points around its target only, not on the length of ``y``, so
    that a piece of a series gives what the whole series gives.
    """
    n = len(y)
    q = min(span, n)
    step = max(1, LOESS_CELLS // q)
    if len(targets) > step:
        return np.concatenate([_loess(y, span, targets[i : i + step], weights) for i in range(0, len(targets), step)])
    left = np.clip(targets - (q - 1) // 2, 0, n - q)
    index = left[:, None] + np.arange(q)
    distance = np.abs(index - targets[:, None])
    h = np.maximum(targets - left, left + q - 1 - targets).astype(float)
    h += (span - n) // 2 if span > n else 0
    h = np.maximum(h, 1e-12)[:, None]
    w = (1.0 - np.minimum(distance / h, 1.0) ** 3) ** 3
    w = np.where(distance <= 0.001 * h, 1.0, np.where(distance <= 0.999 * h, w, 0.0))
    w = w * weights[index]
    total = w.sum(axis=1, keepdims=True)
    w = np.divide(w, total, out=np.zeros_like(w), where=total > 0)
    centre = (w * index).sum(axis=1, keepdims=True)
    spread = (w * (index - centre) ** 2).sum(axis=1, keepdims=True)
    wide = np.sqrt(spread) > LEAST_SPREAD
    slope = np.divide(targets[:, None] - centre, spread, out=np.zeros_like(spread), where=wide)
    fitted = (w * (1.0 + slope * (index - centre)) * y[index]).sum(axis=1)
    near = np.clip(targets, 0, n - 1)
    return np.where(total[:, 0] > 0, fitted, y[near])


def _moving_average(x: np.ndarray, rows: int) -> np.ndarray:
    return np.convolve(x, np.full(rows, 1.0 / rows), mode="valid")


def _inner_loop(y, weights, trend, period, first_phase=0):
    """Two passes of seasonal and trend smoothing over consecutive rows."""
    n = len(y)
    trend_span = _odd_at_least(1.5 * period / (1.0 - 1.5 / SEASONAL_SPAN))
    low_pass_span = _odd_at_least(period + 1)
    everywhere, ones = np.arange(n), np.ones(n)
    seasonal = np.zeros(n)
    for _ in range(INNER_PASSES):
        detrended = y - trend
        cycles = np.zeros(n + 2 * period)
        for phase in range(min(period, n)):
            sub, w = detrended[phase::period], weights[phase::period]
            cycles[phase::period][: len(sub) + 2] = _loess(
                sub, SEASONAL_SPAN, np.arange(-1, len(sub) + 1), w
            )
        smooth = _moving_average(_moving_average(_moving_average(cycles, period), period), 3)
        low = _loess(smooth, low_pass_span, everywhere, ones)
        seasonal = cycles[period : period + n] - low
        trend = _loess(y - seasonal, trend_span, everywhere, weights)
    return seasonal, trend


def _bisquare(resid: np.ndarray, h: float) -> np.ndarray:
    r = np.abs(resid)
    u = np.minimum(r / h, 1.0) if h > 0 else np.where(r > 0, 1.0, 0.0)
    w = (1.0 - u**2) ** 2
    return np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, w, 0.0))


def stl_decompose(
    df: DataFrame, column: str, period: int, keys: Sequence[str] = (), rn: str = "rn",
    robust: bool = True, whole_rows: int = 200_000, chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds trend, seasonal, resid and the robustness weight of each row.

    ``rn`` runs from 0 without gaps.  Series of up to ``whole_rows`` rows are each
    decomposed within one task; longer ones go through :func:`_stl_by_chunk`, so the
    length of a series is not limited by one worker.  Both ways give the same numbers.
    """
    ship_package(df.sparkSession)
    cast = df.withColumn(column, F.col(column).cast("double"))
    lengths = cast.groupBy(*keys).agg(F.count("*").alias("_n"))
    sized = lookup_join(cast, lengths, list(keys))
    longest = lengths.agg(F.max("_n")).first()[0] or 0
    short = _stl_whole(sized.filter(F.col("_n") <= whole_rows), column, period, keys, rn, robust)
    if longest <= whole_rows:
        return short.drop("_n")
    long = _stl_by_chunk(
        sized.filter(F.col("_n") > whole_rows), column, period, keys, rn, robust, chunk
    )
    return short.unionByName(long).drop("_n")


def _with_parts(schema: T.StructType) -> T.StructType:
    parts = ("trend", "seasonal", "resid", "weight")
    return T.StructType(list(schema) + [T.StructField(p, T.DoubleType()) for p in parts])


def _stl_whole(df, column, period, keys, rn, robust):
    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rn)
        y = pdf[column].to_numpy()
        weights, trend = np.ones(len(y)), np.zeros(len(y))
        for last in range(OUTER_PASSES + 1 if robust else 1):
            used = weights
            seasonal, trend = _inner_loop(y, weights, trend, period)
            resid = y - seasonal - trend
            if robust and last < OUTER_PASSES:
                weights = _bisquare(resid, 6.0 * np.median(np.abs(resid)))
        return pdf.assign(trend=trend, seasonal=seasonal, resid=resid, weight=used)

    if keys:
        df = df.repartition(shuffle_tasks(df.sparkSession), *keys)
    return df.groupBy(*keys).applyInPandas(decompose, _with_parts(df.schema))


def _stl_by_chunk(df, column, period, keys, rn, robust, chunk):
    """One Spark pass per outer iteration over chunks with enough neighbouring rows.

    An inner loop looks at most about 24 periods away, also at the ends of a series,
    so own rows of a chunk get the same values as in the whole series.
    """
    reach = 24 * period
    size = -(-max(chunk, reach) // period) * period  # whole periods keep phases aligned
    state = df.withColumns({"trend": F.lit(0.0), "weight": F.lit(1.0)})
    schema = _with_parts(df.schema)

    def one_pass(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rn)
        y = pdf[column].to_numpy()
        seasonal, trend = _inner_loop(
            y, pdf["weight"].to_numpy(), pdf["trend"].to_numpy(), period
        )
        out = pdf.assign(trend=trend, seasonal=seasonal, resid=y - seasonal - trend)
        return out.loc[out["_own"], schema.names]

    for step in range(OUTER_PASSES + 1 if robust else 1):
        pieces = with_halo(state, rn, keys, before=reach, after=reach, chunk=size)
        done = materialise(
            pieces.repartition(shuffle_tasks(df.sparkSession), *keys, "_chunk")
            .groupBy(*keys, "_chunk")
            .applyInPandas(one_pass, schema),
            "stl",
        )
        if not robust or step == OUTER_PASSES:
            break
        sized = done.withColumn("_r", F.abs("resid"))
        medians = exact_quantiles(sized, "_r", [0.5], keys).select(
            *keys, (6 * F.col("quantile")).alias("_h")
        )
        r, h = F.col("_r"), F.col("_h")
        bisquare = F.pow(1 - F.pow(r / F.nullif(h, F.lit(0.0)), F.lit(2)), F.lit(2))
        state = (
            lookup_join(sized, medians, list(keys))
            .withColumn(
                "weight",
                F.when(r <= 0.001 * h, 1.0).when(r <= 0.999 * h, bisquare).otherwise(0.0),
            )
            .select(*df.columns, "trend", "weight")
        )
    return done
