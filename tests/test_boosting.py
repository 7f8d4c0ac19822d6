"""Boosted look-back forecasts against a direct version, ridge regressions and odd inputs."""

import numpy as np

from tidegauge.operators import boosting, ml

KIND = "rn long, window array<array<double>>, a double, b double, split string"


def frame(spark, x, y, train):
    rows = [(i, x[i].tolist(), *map(float, y[i]), "train" if i < train else "test") for i in range(len(x))]
    return spark.createDataFrame(rows, KIND).repartition(5)


def curved(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4, 2))
    a = np.where(x[:, 0, 0] > 0.3, 2.0, -1.0) + np.abs(x[:, -1, 1]) + rng.normal(size=n) * 0.1
    b = np.where(x[:, 2, 1] ** 2 > 0.5, 3.0, 0.0) + rng.normal(size=n) * 0.1
    return x, np.stack([a, b], axis=1)


def rmse(df):
    return {r.Sensor_ID: r.e for r in df.groupBy("Sensor_ID").agg({"*": "count"}).join(
        df.selectExpr("Sensor_ID", "pow(truth - prediction, 2) as e").groupBy("Sensor_ID").avg("e").withColumnRenamed("avg(e)", "e"), "Sensor_ID"
    ).collect()}


def test_beats_ridge_on_held_out_rows(spark):
    x, y = curved(1500, 3)
    data = frame(spark, x, y, 1100)
    ours, ridge = rmse(boosting.boosted_forecast(data, ["a", "b"], rounds=8)), rmse(ml.lookback_forecast(data, ["a", "b"]))
    assert set(ours) == set(ridge) == {"1", "2"}
    assert all(ours[t] < 0.5 * ridge[t] for t in ours)


def test_one_stump_equals_a_direct_search(spark):
    x, y = curved(200, 4)
    got = boosting.boosted_forecast(frame(spark, x, y, 150), ["a", "b"], rounds=1, depth=1, bins=8, rate=1.0, shrink=0.0)
    found = {(r.rn, r.Sensor_ID): r.prediction for r in got.collect()}
    for t in range(2):
        raw = np.concatenate([x[:, :, t], x[:, -1, :]], axis=1)
        cuts = [np.sort(x[:150, -1, c])[[int(np.ceil(150 * i / 8)) - 1 for i in range(1, 8)]] for c in (*[t] * 4, 0, 1)]
        best = None
        for f in range(6):
            for cut in cuts[f]:
                low = raw[:150, f] <= cut
                if low.any() and not low.all():
                    error = sum(((y[:150, t][side] - y[:150, t][side].mean()) ** 2).sum() for side in (low, ~low))
                    if best is None or error < best[0] - 1e-9:
                        best = (error, f, cut, y[:150, t][low].mean(), y[:150, t][~low].mean())
        _, f, cut, low, high = best
        want = np.where(raw[150:, f] <= cut, low, high)
        assert np.allclose([found[(i, str(t + 1))] for i in range(150, 200)], want)


def test_odd_inputs(spark):
    x, y = curved(60, 5)
    x[:, :, 1] = 7.0  # a constant column
    x[3, 1, 0] = np.nan
    y[:, 1] = 4.0
    data = frame(spark, x, y, 40)
    got = boosting.boosted_forecast(data, ["a", "b"], rounds=2).collect()
    assert len(got) == 40 and all(abs(r.prediction - 4.0) < 1e-9 for r in got if r.Sensor_ID == "2")
    assert boosting.boosted_forecast(data.filter("split = 'test'"), ["a", "b"]).count() == 0
    assert boosting.boosted_forecast(data.filter("false"), ["a", "b"]).count() == 0
