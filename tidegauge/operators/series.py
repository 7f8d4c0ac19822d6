"""Time-series operators on frames with an explicit position column ``rn``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.scalar import clip, epoch_seconds
from tidegauge.operators.joins import lookup_join
from tidegauge.operators.ordered import index_rows, sliding
from tidegauge.operators.relational import numeric_columns
from tidegauge.session import materialise, ship_package, shuffle_tasks

# A row of a look-back window is as wide as many rows.
WINDOW_CHUNK_ROWS = 4_096


def downsample(
    df: DataFrame, group: str, seconds: Column, width: int = 300, bucket: str = "bucket"
) -> DataFrame:
    """Mean of every numeric column per group and bucket of ``width`` seconds."""
    values = numeric_columns(df, [group])
    return (
        df.withColumn(bucket, F.floor(seconds / width))
        .groupBy(group, bucket)
        .agg(*[F.avg(c).alias(c) for c in values])
    )


def synthetic_timestamps(
    df: DataFrame, order_by: Sequence[str], start: str = "2025-09-01 00:00:00",
    step_minutes: int = 5, into: str = "Timestamp",
) -> DataFrame:
    """Gap-free timestamps in global row order: ``start + rn * step``."""
    indexed = index_rows(df, order_by)
    minutes = F.col("rn") * step_minutes
    step = F.make_dt_interval(
        days=F.floor(minutes / 1_440).cast("int"), mins=F.pmod(minutes, F.lit(1_440)).cast("int")
    )
    return indexed.withColumn(into, F.lit(start).cast("timestamp_ntz") + step)


def tumbling_mean(df: DataFrame, ts: str, values: Sequence[str], width: str) -> DataFrame:
    """Mean per tumbling window, keyed by the window start."""
    return (
        df.groupBy(F.window(ts, width))
        .agg(*[F.avg(v).alias(v) for v in values])
        .select(F.col("window.start").alias(ts), *values)
    )


def calendar_series(df: DataFrame, day: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key and calendar day from first to last day; missing days hold 0.

    Days are regular, so the position is plain date arithmetic and needs no sort.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("x"))
    spans = daily.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    days = spans.select(*keys, "_first", F.explode(F.sequence("_first", "_last")).alias(day))
    found = daily.withColumnsRenamed({c: f"_d_{c}" for c in (*keys, day)})
    same = days[day] == found[f"_d_{day}"]
    for key in keys:
        same = same & days[key].eqNullSafe(found[f"_d_{key}"])
    return days.join(found, same, "left").select(
        *keys, day, F.datediff(day, "_first").cast("long").alias("rn"),
        F.coalesce("x", F.lit(0)).cast("double").alias("x"),
    )


# ---------------------------------------------------------------- row frames


def shift_difference(
    df: DataFrame, column: str, into: str, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """Previous value minus current value."""
    return sliding(
        df, lambda w: {into: F.lag(column).over(w) - F.col(column)}, rn, keys, before=1
    )


def lead_targets(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), rn: str = "rn",
    prefix: str = "Target_",
) -> DataFrame:
    """Next value of each column; the last row, which has none, is dropped."""
    led = sliding(
        df, lambda w: {f"{prefix}{c}": F.lead(c).over(w) for c in columns}, rn, keys, after=1
    )
    return led.na.drop("any", subset=[f"{prefix}{c}" for c in columns])


def lag_columns(
    df: DataFrame, column: str, lags: Sequence[int], keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    return sliding(
        df, lambda w: {f"lag_{k}": F.lag(column, k).over(w) for k in lags}, rn, keys,
        before=max(lags),
    )


def _full(column: str, frame, rows: int, value: Column) -> Column:
    """``value`` once the frame holds ``rows`` non-null entries, else null."""
    return F.when(F.count(column).over(frame) == rows, value)


def rolling_statistics(
    df: DataFrame, column: str, means: dict[str, int] | None = None,
    deviations: dict[str, int] | None = None, keys: Sequence[str] = (), rn: str = "rn",
) -> DataFrame:
    """Trailing means and sample deviations, ``{new column: window rows}``.

    A window that is not yet full, or holds a null, gives null.
    """
    means, deviations = means or {}, deviations or {}

    def build(w):
        columns = {}
        for name, rows in means.items():
            frame = w.rowsBetween(-(rows - 1), 0)
            columns[name] = _full(column, frame, rows, F.avg(column).over(frame))
        for name, rows in deviations.items():
            frame = w.rowsBetween(-(rows - 1), 0)
            columns[name] = _full(column, frame, rows, F.stddev_samp(column).over(frame))
        return columns

    reach = max([*means.values(), *deviations.values()]) - 1
    return sliding(df, build, rn, keys, before=reach)


def rolling_zscore(
    df: DataFrame, column: str, short: int, long: int, into: str, keys: Sequence[str] = (),
    rn: str = "rn", limit: float = 5.0,
) -> DataFrame:
    """``(short mean - long mean) / (long deviation + 1e-6)``; null becomes 0, then clipped."""
    rolled = rolling_statistics(
        df, column, {"_short": short, "_long": long}, {"_dev": long}, keys, rn
    )
    z = (F.col("_short") - F.col("_long")) / (F.col("_dev") + F.lit(1e-6))
    return rolled.withColumn(into, clip(F.coalesce(z, F.lit(0.0)), -limit, limit)).drop(
        "_short", "_long", "_dev"
    )


def lookback_windows(
    df: DataFrame, features: Sequence[str], rows: int = 30, keys: Sequence[str] = (),
    rn: str = "rn", into: str = "window",
) -> DataFrame:
    """The ``rows`` feature rows before each row, oldest first; rows without enough are dropped."""
    vector = F.array(*[F.col(c).cast("double") for c in features])
    windows = sliding(
        df,
        lambda w: {into: F.collect_list(vector).over(w.rowsBetween(-rows, -1))},
        rn, keys, before=rows, chunk=WINDOW_CHUNK_ROWS, tasks=shuffle_tasks(df.sparkSession),
    )
    return windows.filter(F.size(into) == rows)


# ---------------------------------------------------------------- decomposition


def seasonal_decompose(
    df: DataFrame, column: str, period: int, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """Classical additive decomposition: adds trend, seasonal and resid.

    The trend is a centred moving average (half weight at both ends for an even
    period) and is null, like resid, for half a period at both ends.
    """
    half = period // 2

    def trend(w):
        if period % 2:
            frame = w.rowsBetween(-half, half)
            return {"trend": _full(column, frame, period, F.avg(column).over(frame))}
        frame = w.rowsBetween(-(half - 1), half - 1)
        ends = F.lag(column, half).over(w) + F.lead(column, half).over(w)
        total = F.sum(column).over(frame) + ends / 2
        return {"trend": _full(column, frame, period - 1, total / period)}

    trended = sliding(df, trend, rn, keys, before=half, after=half).withColumn(
        "_phase", F.pmod(rn, F.lit(period)).cast("int")
    )
    means = trended.groupBy(*keys, "_phase").agg(
        F.avg(F.col(column) - F.col("trend")).alias("_mean")
    )
    # One row per key holds its `period` phase means.
    centred = (
        means.groupBy(*keys)
        .agg(F.collect_list(F.struct("_phase", "_mean")).alias("_m"), F.avg("_mean").alias("_c"))
        .select(*keys, "_c", F.inline("_m"))
        .select(*keys, "_phase", (F.col("_mean") - F.col("_c")).alias("seasonal"))
    )
    return (
        lookup_join(trended, centred, [*keys, "_phase"])
        .withColumn("resid", F.col(column) - F.col("trend") - F.col("seasonal"))
        .drop("_phase")
    )


def component_strength(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``1 - var(resid) / var(component + resid)`` for trend and seasonal."""

    def strength(component: str) -> Column:
        return 1 - F.try_divide(F.var_pop("resid"), F.var_pop(F.col(component) + F.col("resid")))

    return parts.groupBy(*keys).agg(
        strength("trend").alias("trend_strength"), strength("seasonal").alias("seasonal_strength")
    )


def seasonal_profile(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Mean per month and year."""
    return df.groupBy(F.month(ts).alias("month"), F.year(ts).alias("year")).agg(
        F.avg(value).alias("mean")
    )


# ---------------------------------------------------------------- autocorrelation


def centred_series(
    df: DataFrame, column: str, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """``keys, rn, _e, _n``: the series minus its mean, with its length; nulls removed.

    Rows that remain are numbered anew from 0 if nulls, or a later start, left gaps.
    """
    present = df.filter(F.col(column).isNotNull()).select(
        *keys, rn, F.col(column).cast("double").alias("_x")
    )
    means = materialise(
        present.groupBy(*keys).agg(
            F.avg("_x").alias("_m"), F.count("*").alias("_n"), F.min(rn).alias("_low"), F.max(rn).alias("_high")
        ),
        "means",
    )
    if means.filter((F.col("_low") != 0) | (F.col("_high") != F.col("_n") - 1)).take(1):
        present = index_rows(present.withColumnRenamed(rn, "_old"), ["_old"], keys, into=rn)
    return lookup_join(present, means.drop("_low", "_high"), list(keys), derived=False).select(
        *keys, rn, (F.col("_x") - F.col("_m")).alias("_e"), "_n"
    )


def lagged_products(
    centred: DataFrame, lags: int, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """``keys, n, s0, lag, s``: sums of products of values ``lag`` rows apart, 0..lags."""
    lagged = sliding(
        centred,
        lambda w: {f"_l{k}": F.lag("_e", k).over(w) for k in range(1, lags + 1)},
        rn, keys, before=lags,
    )
    sums = [F.sum(F.col("_e") * F.col("_e"))] + [
        F.sum(F.col("_e") * F.col(f"_l{k}")) for k in range(1, lags + 1)
    ]
    entries = F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums])
    return (
        lagged.groupBy(*keys)
        .agg(entries.alias("_s"), F.max("_n").alias("n"))
        .select(*keys, "n", F.get("_s", F.lit(0)).alias("s0"), F.posexplode("_s").alias("lag", "s"))
    )


def autocorrelation(
    df: DataFrame, column: str, lags: int, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """Autocorrelation for lags 0..lags and the white-noise band ``1.96 / sqrt(n)``."""
    products = lagged_products(centred_series(df, column, keys, rn), lags, keys, rn)
    return products.select(
        *keys, "lag", F.try_divide("s", "s0").alias("acf"), (1.96 / F.sqrt("n")).alias("band")
    )


def partial_autocorrelation(
    df: DataFrame, column: str, lags: int, keys: Sequence[str] = (), rn: str = "rn"
) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion on the ACF.

    The series is reduced to ``lags + 1`` numbers per key in Spark; only those go to
    the small Python recursion.
    """
    import numpy as np
    import pandas as pd

    ship_package(df.sparkSession)
    acf = autocorrelation(df, column, lags, keys, rn)

    def recursion(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy()
        partial, phi = [1.0], np.zeros(0)
        for k in range(1, len(r)):
            last = (r[k] - phi @ r[k - 1 : 0 : -1]) / (1.0 - phi @ r[1:k])
            phi = np.append(phi - last * phi[::-1], last)
            partial.append(last)
        out = pdf.sort_values("lag")[[*keys, "lag", "band"]].copy()
        out["pacf"] = partial
        return out

    schema = T.StructType(
        [acf.schema[k] for k in keys]
        + [acf.schema["lag"], acf.schema["band"], T.StructField("pacf", T.DoubleType())]
    )
    return acf.groupBy(*keys).applyInPandas(recursion, schema)
