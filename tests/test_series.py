"""Time-series operators against direct numpy computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import features, series, stationarity, stl


def frame(spark, x, key="a"):
    return spark.createDataFrame(
        pd.DataFrame({"k": key, "rn": np.arange(len(x)), "x": np.asarray(x, dtype=float)})
    )


def walk(n, seed):
    return np.cumsum(np.random.default_rng(seed).normal(size=n))


def autoregressive(n, phi, seed):
    noise, x = np.random.default_rng(seed).normal(size=n), np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + noise[t]
    return x


@pytest.mark.parametrize("period", [5, 12])
def test_decomposition_adds_up(spark, period):
    t = np.arange(120)
    x = 0.3 * t + 5 * np.sin(2 * np.pi * t / period) + np.random.default_rng(1).normal(size=120)
    got = series.seasonal_decompose(frame(spark, x), "x", period).toPandas().sort_values("rn")
    half = period // 2
    kernel = np.ones(period) / period if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(120, np.nan)
    trend[half : 120 - half] = np.convolve(x, kernel, "valid")
    assert np.allclose(got["trend"], trend, equal_nan=True)
    phase = pd.Series(x - trend).groupby(t % period).mean()
    assert np.allclose(got["seasonal"], (phase - phase.mean()).to_numpy()[t % period])
    parts = got["trend"] + got["seasonal"] + got["resid"]
    assert np.allclose(parts.dropna(), x[half : 120 - half])


def brute_acf(x, lags):
    e = x - x.mean()
    return np.array([(e[k:] * e[: len(e) - k]).sum() for k in range(lags + 1)]) / (e * e).sum()


def test_autocorrelation_and_partial(spark):
    x = autoregressive(400, 0.7, 2)
    acf = series.autocorrelation(frame(spark, x), "x", 10, ["k"]).toPandas().sort_values("lag")["acf"]
    want = brute_acf(x, 10)
    assert np.allclose(acf, want)
    pacf = series.partial_autocorrelation(frame(spark, x), "x", 10).toPandas().sort_values("lag")["pacf"].to_numpy()
    for k in range(1, 11):  # last Yule-Walker coefficient of each order
        system = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(np.linalg.solve(system, want[1 : k + 1])[-1] - pacf[k]) < 1e-9


def brute_adf(x):
    n = len(x)
    top = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    dx = np.diff(x)

    def fit(lag, first):
        rows = np.arange(first, len(dx))
        a = np.column_stack([np.ones(len(rows)), x[rows]] + [dx[rows - i] for i in range(1, lag + 1)])
        beta, *_ = np.linalg.lstsq(a, dx[rows], rcond=None)
        r = dx[rows] - a @ beta
        s2 = r @ r / (len(rows) - a.shape[1])
        tau = beta[1] / math.sqrt(s2 * np.linalg.inv(a.T @ a)[1, 1])
        aic = len(rows) * (math.log(2 * math.pi * (r @ r) / len(rows)) + 1) + 2 * a.shape[1]
        return aic, tau, len(rows)

    best = min(range(top + 1), key=lambda lag: fit(lag, top)[0])
    return (*fit(best, best)[1:], best)


def test_adf_equals_least_squares(spark):
    data = {"walk": walk(300, 5) + 1000, "calm": autoregressive(500, 0.4, 6)}
    both = frame(spark, data["walk"], "walk").unionAll(frame(spark, data["calm"], "calm"))
    got = {r["k"]: r for r in stationarity.adf_test(both, "x", ["k"]).collect()}
    for key, x in data.items():
        tau, rows, lag = brute_adf(x)
        assert got[key]["used_lag"] == lag and got[key]["rows_used"] == rows
        assert abs(got[key]["statistic"] - tau) < 1e-6
    assert got["walk"]["verdict"] == "non-stationary" and got["calm"]["verdict"] == "stationary"
    assert stationarity.adf_test(frame(spark, data["calm"]), "x").count() == 1


def test_adf_p_values_at_published_points():
    for tau, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert abs(stationarity._adf_p_value(tau) - p) < 1e-3


@pytest.mark.parametrize("lags", [4, None])
def test_kpss(spark, lags):
    x = walk(500, 9)
    got = stationarity.kpss_test(frame(spark, x), "x", lags, ["k"], chunk=37).first()
    e, n = x - x.mean(), len(x)
    gamma = lambda k: (e[k:] * e[: n - k]).sum()
    if lags is None:
        reach = int(n ** (2 / 9))
        s0 = gamma(0) / n + sum(gamma(k) / (n / 2) for k in range(1, reach + 1))
        s1 = sum(k * gamma(k) / (n / 2) for k in range(1, reach + 1))
        lags = int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))
    lrv = (gamma(0) + 2 * sum((1 - k / (lags + 1)) * gamma(k) for k in range(1, lags + 1))) / n
    assert got["lags"] == lags
    assert abs(got["statistic"] - (np.cumsum(e) ** 2).sum() / n**2 / lrv) < 1e-9
    assert got["p_value"] == 0.01 and got["verdict"] == "non-stationary"
    calm = stationarity.kpss_test(frame(spark, autoregressive(400, 0.1, 3)), "x").first()
    assert calm["verdict"] == "stationary" and 0.05 <= calm["p_value"] <= 0.10


def seasonal_walk(n, period):
    t = np.arange(n)
    return 0.01 * t + 3 * np.sin(2 * np.pi * t / period) + np.random.default_rng(4).normal(scale=0.3, size=n)


def test_stl_parts_and_robustness(spark):
    x = seasonal_walk(240, 12)
    spiked = x.copy()
    spiked[100] += 60
    plain = stl.stl_decompose(frame(spark, x), "x", 12).toPandas().sort_values("rn")
    robust = stl.stl_decompose(frame(spark, spiked), "x", 12, ["k"]).toPandas().sort_values("rn")
    assert np.allclose(plain["trend"] + plain["seasonal"] + plain["resid"], x)
    assert abs(plain["trend"] - 0.01 * np.arange(240)).max() < 0.5
    moved = abs(robust["trend"].to_numpy() - plain["trend"].to_numpy()).max()
    classical = [series.seasonal_decompose(frame(spark, y), "x", 12).toPandas().sort_values("rn")["trend"] for y in (x, spiked)]
    assert moved < 0.2 * np.nanmax(abs(classical[1] - classical[0]))
    assert robust["weight"].iloc[100] == 0.0


@pytest.mark.parametrize("robust", [False, True])
def test_stl_by_chunk_equals_whole_series(spark, robust, monkeypatch):
    monkeypatch.setattr(stl, "OUTER_PASSES", 2)
    df = frame(spark, seasonal_walk(700, 4))
    whole = stl.stl_decompose(df, "x", 4, ["k"], robust=robust).toPandas().sort_values("rn")
    pieces = stl.stl_decompose(df, "x", 4, ["k"], robust=robust, whole_rows=10, chunk=150).toPandas().sort_values("rn")
    assert len(pieces) == 700
    for part in ("trend", "seasonal", "resid", "weight"):
        assert np.allclose(whole[part], pieces[part], atol=1e-9)


@pytest.mark.parametrize("period", [7, 300])
def test_stl_of_a_long_series_does_not_depend_on_pieces(spark, period, monkeypatch):
    monkeypatch.setattr(stl, "OUTER_PASSES", 1)
    rows = 6000 if period == 7 else 24_000
    df = frame(spark, seasonal_walk(rows, period))
    whole = stl.stl_decompose(df, "x", period, ["k"]).toPandas().sort_values("rn")
    pieces = stl.stl_decompose(df, "x", period, ["k"], whole_rows=10, chunk=500).toPandas().sort_values("rn")
    for part in ("trend", "seasonal", "resid", "weight"):
        assert np.allclose(whole[part], pieces[part], atol=1e-9)


def test_diagnostics_of_a_series_with_gaps(spark):
    """Nulls, and positions that start late, give what the remaining values give."""
    x = autoregressive(300, 0.8, 3)
    clean = frame(spark, x)
    late = clean.withColumn("rn", F.col("rn") + 6)
    holes = late.unionByName(late.limit(6).withColumns({"rn": F.col("rn") - 6, "x": F.lit(None).cast("double")}))
    for test in (stationarity.adf_test, stationarity.kpss_test, lambda d, c, keys: series.autocorrelation(d, c, 5, keys).orderBy("lag")):
        want = test(clean, "x", keys=["k"]).toPandas()
        for other in (late, holes):
            got = test(other, "x", keys=["k"]).toPandas()
            assert np.allclose(want.select_dtypes("number"), got.select_dtypes("number"))


def test_window_search_drops_only_rows_with_nulls(spark):
    x = list(autoregressive(200, 0.9, 8))
    x[90] = None
    df = frame(spark, x).drop("k")
    counts = features.pair_counts(df, "x", [2], [10]).toPandas()
    # windows of ten that hold the null, and the row before it, are left out
    assert counts["n"].sum() == 200 - 10 - 10 - 1


def test_window_search_does_not_depend_on_chunks(spark):
    df = frame(spark, autoregressive(900, 0.9, 8)).drop("k")
    one = features.pair_counts(df, "x", [1, 2, 3], range(2, 70)).toPandas()
    many = features.pair_counts(df, "x", [1, 2, 3], range(2, 70), chunk=100).toPandas()
    order = ["short_window", "long_window", "zb", "yb"]
    assert one.sort_values(order).reset_index(drop=True).equals(many.sort_values(order).reset_index(drop=True))
    assert (one.groupby(["short_window", "long_window"])["n"].sum().reset_index(name="n")
            .eval("n == 900 - long_window").all())


def test_mutual_information_extremes(spark):
    same = spark.createDataFrame([(i, i, 10) for i in range(4)], "x int, y int, n long")
    independent = spark.createDataFrame([(i, j, 5) for i in range(4) for j in range(3)], "x int, y int, n long")
    assert abs(features.mutual_information(same, "x", "y").first()[0] - math.log(4)) < 1e-12
    assert abs(features.mutual_information(independent, "x", "y").first()[0]) < 1e-12


def test_lookback_windows_are_dealt_over_tasks(spark):
    """Wide windows of a small table do not end up in the one task that its rows would fit into."""
    n = 3 * series.WINDOW_CHUNK_ROWS + 5
    rows = spark.range(n).select(F.col("id").alias("rn"), (F.col("id") * 2).alias("x")).coalesce(1)
    windows = series.lookback_windows(rows, ["x"], 3)
    sizes = windows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 1
    assert windows.filter("window <> array(array(2D * rn - 6), array(2D * rn - 4), array(2D * rn - 2))").isEmpty()
    assert windows.count() == n - 3
