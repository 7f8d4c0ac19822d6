"""Unit-root and stationarity tests whose heavy sums are Spark aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.joins import lookup_join
from tidegauge.operators.ordered import CHUNK_ROWS, with_halo
from tidegauge.operators.series import centred_series, lagged_products
from tidegauge.session import ship_package

# MacKinnon (1994), constant, one series: p-value polynomials in tau.
ADF_TAU_STAR, ADF_TAU_MIN, ADF_TAU_MAX = -1.61, -18.83, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
# MacKinnon (2010), constant: critical value as polynomial in 1/T.
ADF_CRITICAL = {
    "crit_1pct": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5pct": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10pct": (-2.56677, -1.5384, -2.809, 0.0),
}
# Kwiatkowski et al. (1992), level: critical values and their p-values.
KPSS_CRITICAL = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))


def _adf_p_value(tau: float) -> float:
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    terms = ADF_SMALL_P if tau <= ADF_TAU_STAR else ADF_LARGE_P
    z = sum(c * tau**i for i, c in enumerate(terms))
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


def _max_lag(n: int) -> int:
    return max(min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2), 0)


def _design(x: np.ndarray, at: np.ndarray, lags: int) -> np.ndarray:
    """Rows ``1, x[t-1], dx[t-1..t-lags], dx[t]`` for positions ``at`` of ``x``."""
    dx = np.diff(x, prepend=np.nan)
    columns = [np.ones(len(at)), x[at - 1]] + [dx[at - k] for k in range(1, lags + 1)] + [dx[at]]
    return np.column_stack(columns)


def _fit(gram: np.ndarray, lags: int):
    """Residual sum of squares, row count and t value of the level, from a Gram matrix."""
    use = list(range(lags + 2))
    a, b, yy = gram[np.ix_(use, use)], gram[use, -1], gram[-1, -1]
    beta = np.linalg.solve(a, b)
    ssr, rows = max(yy - beta @ b, 0.0), gram[0, 0]
    variance = ssr / (rows - len(use)) * np.linalg.inv(a)[1, 1]
    return ssr, rows, beta[1] / math.sqrt(variance) if variance > 0 else float("nan")


def adf_test(
    df: DataFrame, column: str, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """Augmented Dickey-Fuller test with constant; lag order by AIC.

    Each chunk of the series contributes its Gram matrix of lagged columns; the sum
    over chunks (a few hundred numbers per series) determines every candidate
    regression, so the data is read once.
    """
    ship_package(df.sparkSession)
    centred = centred_series(df, column, keys, rn)
    sizes = centred.groupBy(*keys).agg(F.max("_n").alias("_n"), F.stddev_pop("_e").alias("_s"))
    longest = _max_lag(sizes.agg(F.max("_n")).first()[0] or 0)
    scaled = lookup_join(centred.drop("_n"), sizes, list(keys)).select(
        *keys, rn, "_n", F.coalesce(F.try_divide("_e", "_s"), F.lit(0.0)).alias("_z")
    )
    pieces = with_halo(scaled, rn, keys, before=longest + 1)

    def chunk_gram(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rn)
        x, place, lags = pdf["_z"].to_numpy(), pdf[rn].to_numpy(), _max_lag(int(pdf["_n"].iloc[0]))
        own = pdf["_own"].to_numpy()
        cells = []
        at = np.flatnonzero(own & (place >= lags + 1))
        if len(at):
            z = _design(x, at, lags)
            gram = z.T @ z
            i, j = np.triu_indices(len(gram))
            cells.append(pd.DataFrame({"i": i, "j": j, "v": gram[i, j]}))
        head = own & (place <= lags)
        cells.append(pd.DataFrame({"i": -1, "j": place[head], "v": x[head]}))
        out = pd.concat(cells, ignore_index=True)
        for k in keys:
            out[k] = pdf[k].iloc[0]
        out["n"] = pdf["_n"].iloc[0]
        return out[[*keys, "n", "i", "j", "v"]]

    key_fields = [df.schema[k] for k in keys]
    cell_schema = T.StructType(
        key_fields
        + [
            T.StructField("n", T.LongType()), T.StructField("i", T.IntegerType()),
            T.StructField("j", T.IntegerType()), T.StructField("v", T.DoubleType()),
        ]
    )
    cells = (
        pieces.groupBy(*keys, "_chunk")
        .applyInPandas(chunk_gram, cell_schema)
        .groupBy(*keys, "n", "i", "j")
        .agg(F.sum("v").alias("v"))
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        lags = _max_lag(n)
        inner = pdf[pdf["i"] >= 0]
        gram = np.zeros((lags + 3, lags + 3))
        gram[inner["i"], inner["j"]] = inner["v"]
        gram = np.triu(gram) + np.triu(gram, 1).T
        head = pdf[pdf["i"] < 0].sort_values("j")["v"].to_numpy()
        row = {k: pdf[k].iloc[0] for k in keys}
        row.update(statistic=np.nan, p_value=np.nan, used_lag=-1, rows_used=0)
        row.update({name: np.nan for name in ADF_CRITICAL}, verdict="undetermined")
        if n > 4 and gram[0, 0] > lags + 2 and gram[-1, -1] > 0:
            def aic(lag):
                ssr, rows, _ = _fit(gram, lag)
                return rows * (math.log(2 * math.pi * max(ssr, 1e-300) / rows) + 1) + 2 * (lag + 2)

            best = min(range(lags + 1), key=aic)
            chosen = gram[np.ix_([*range(best + 2), -1], [*range(best + 2), -1])]
            at = np.arange(best + 1, lags + 1)
            if len(at):
                extra = _design(head, at, best)
                chosen = chosen + extra.T @ extra
            _, rows, tau = _fit(chosen, best)
            p = _adf_p_value(tau)
            row.update(statistic=tau, p_value=p, used_lag=best, rows_used=int(rows))
            row.update(
                {m: sum(c / rows**i for i, c in enumerate(t)) for m, t in ADF_CRITICAL.items()},
                verdict="stationary" if p < 0.05 else "non-stationary",
            )
        return pd.DataFrame([row])

    result_schema = T.StructType(
        key_fields
        + [
            T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
            T.StructField("used_lag", T.IntegerType()), T.StructField("rows_used", T.LongType()),
        ]
        + [T.StructField(name, T.DoubleType()) for name in ADF_CRITICAL]
        + [T.StructField("verdict", T.StringType())]
    )
    return cells.groupBy(*keys).applyInPandas(solve, result_schema)


def kpss_test(
    df: DataFrame, column: str, lags: int | None = None, keys: Sequence[str] = (),
    rn: str = "rn", chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """KPSS level-stationarity test; ``lags=None`` picks the bandwidth automatically.

    Partial sums use chunk totals: with offset ``o`` and local partial sums ``s`` the
    chunk adds ``m o^2 + 2 o sum(s) + sum(s^2)``.
    """
    centred = centred_series(df, column, keys, rn)
    local = (
        Window.partitionBy(*keys, "_chunk").orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    )
    per_chunk = (
        centred.withColumn("_chunk", F.floor(F.col(rn) / chunk))
        .withColumn("_s", F.sum("_e").over(local))
        .groupBy(*keys, "_chunk")
        .agg(
            F.count("*").alias("_m"), F.sum("_e").alias("_t"), F.sum("_s").alias("_s1"),
            F.sum(F.col("_s") * F.col("_s")).alias("_s2"), F.max("_n").alias("n"),
        )
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_t").over(earlier), F.lit(0.0))
    squares = (
        per_chunk.withColumn("_o", offset)
        .groupBy(*keys)
        .agg(
            F.sum(
                F.col("_m") * F.col("_o") * F.col("_o")
                + 2 * F.col("_o") * F.col("_s1") + F.col("_s2")
            ).alias("_sum_squares"),
            F.max("n").alias("n"),
        )
    )
    if lags is None:
        chosen = _automatic_bandwidth(centred, keys, rn)
        squares = lookup_join(squares, chosen, list(keys))
        widest = chosen.agg(F.max("lags")).first()[0] or 0
    else:
        squares = squares.withColumn("lags", F.lit(lags))
        widest = lags
    products = lagged_products(centred, widest, keys, rn).drop("n", "s0")
    joined = lookup_join(products, squares, list(keys)).filter(F.col("lag") <= F.col("lags"))
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2 * (1 - F.col("lag") / (F.col("lags") + 1)))
    result = joined.groupBy(*keys, "n", "lags", "_sum_squares").agg(
        F.sum(F.col("s") * weight).alias("_lrv")
    )
    statistic = F.try_divide("_sum_squares", F.col("n") * F.col("_lrv"))
    p = F.lit(KPSS_CRITICAL[-1][1])
    for (x0, p0), (x1, p1) in reversed(list(zip(KPSS_CRITICAL, KPSS_CRITICAL[1:]))):
        s = F.col("statistic")
        p = F.when(s <= x1, p0 + (s - x0) * ((p1 - p0) / (x1 - x0))).otherwise(p)
    p = F.when(F.col("statistic") <= KPSS_CRITICAL[0][0], KPSS_CRITICAL[0][1]).otherwise(p)
    return (
        result.select(*keys, "n", "lags", statistic.alias("statistic"))
        .withColumn("p_value", p)
        .withColumn(
            "verdict", F.when(F.col("p_value") < 0.05, "non-stationary").otherwise("stationary")
        )
    )


def _automatic_bandwidth(centred: DataFrame, keys: Sequence[str], rn: str) -> DataFrame:
    """Bandwidth per series after Hobijn, Franses and Ooms (1998)."""
    longest = centred.agg(F.max("_n")).first()[0] or 0
    products = lagged_products(centred, max(int(longest ** (2.0 / 9.0)), 1), keys, rn)
    n = F.col("n").cast("double")
    reach = F.floor(F.pow(n, F.lit(2.0 / 9.0)))
    used = products.filter(F.col("lag") <= reach)
    s0 = F.sum(F.when(F.col("lag") == 0, F.col("s") / n).otherwise(F.col("s") / (n / 2)))
    s1 = F.sum(F.col("lag") * F.col("s") / (n / 2))
    ratio = F.try_divide(s1, s0)
    cube = F.pow(n, F.lit(1.0 / 3.0))
    return used.groupBy(*keys, "n").agg((ratio * ratio).alias("_r2")).select(
        *keys,
        F.least(
            F.floor(1.1447 * F.pow("_r2", F.lit(1.0 / 3.0)) * cube), F.col("n") - 1
        ).cast("int").alias("lags"),
    )
