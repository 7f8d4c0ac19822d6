"""Training helpers on small inputs."""

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidegauge.operators import features, ml
from tidegauge.plans import ml as plans


def test_string_index_ties_are_alphabetical(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1, 13)], "s string")
    got = ml.string_index(df, "s", "i").orderBy("i").toPandas()["s"].tolist()
    assert got == sorted(map(str, range(1, 13)))


def test_hash_split_is_complete_and_stable(spark):
    df = spark.range(2000)
    first = ml.hash_split(df, ["id"]).filter("is_train")
    again = ml.hash_split(df.repartition(7), ["id"]).filter("is_train")
    assert first.exceptAll(again).isEmpty() and abs(first.count() - 1400) < 100


def test_auc_with_ties(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"s": rng.integers(0, 10, 300) / 10, "y": rng.integers(0, 2, 300)})
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(ml.area_under_roc(spark.createDataFrame(pdf), "s", "y").first()["auc"] - want) < 1e-12


def test_holdout_search_prefers_the_better_penalty(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=200)
    rows = spark.createDataFrame(pd.DataFrame({"x": x, "y": 3 * x + rng.normal(scale=0.01, size=200)}))
    model = LinearRegression(labelCol="y")
    evaluator = ml.RegressionEvaluator(labelCol="y", metricName="rmse")
    fitted, params, score = ml.holdout_search(
        ml.feature_stages(["x"], scale=True), model, ml.linear_grid(model), rows, rows, evaluator
    )
    assert {p.name: v for p, v in params.items()}["regParam"] == 0.01 and score < 0.1
    assert fitted.transform(rows).count() == 200


def test_cross_validation_shares_fits(spark):
    lr = LogisticRegression(labelCol="y", featuresCol="features")
    grid = ml.logistic_grid(lr)
    assert sorted(map(len, ml._same_but_iterations(lr, grid))) == [3] * 6 + [9]
    rng = np.random.default_rng(7)
    x = rng.normal(size=300)
    rows = spark.createDataFrame(pd.DataFrame({"id": np.arange(300), "x": x, "y": (x + rng.normal(size=300) > 0).astype(float)}))
    small = [g for g in grid if {p.name: v for p, v in g.items()}["elasticNetParam"] == 0.0]
    fitted, chosen, scores = ml.cross_validate(
        [VectorAssembler(inputCols=["x"], outputCol="features")], lr, small, rows,
        ml.auc_evaluator("y"), ["id"], folds=3,
    )
    assert len(scores) == 9 and max(scores) > 0.75 and chosen in small
    assert fitted.transform(rows).filter("prediction = y").count() > 200


def test_lookback_forecast_equals_direct_ridge(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 2, 3))
    y = np.stack([x[:, 0, 0] * 2 + x[:, 1, 2], rng.normal(size=60) + 5], axis=1)
    rows = [(i, x[i].tolist(), *map(float, y[i]), "train" if i < 45 else "test") for i in range(60)]
    frame = spark.createDataFrame(rows, "rn long, window array<array<double>>, a double, b double, split string").repartition(5)
    got = ml.lookback_forecast(frame, ["a", "b"], 0.1).orderBy("rn", "Sensor_ID").collect()
    flat, train = x.reshape(60, 6), slice(0, 45)
    mean, scale = flat[train].mean(axis=0), flat[train].std(axis=0)
    z = (flat - mean) / scale
    for j, name in enumerate("12"):
        centre = y[train, j].mean()
        w = np.linalg.solve(z[train].T @ z[train] / 45 + 0.1 * np.eye(6), z[train].T @ (y[train, j] - centre) / 45)
        found = [r.prediction for r in got if r.Sensor_ID == name]
        assert np.allclose(found, z[45:] @ w + centre)


def test_training_frame_searches_all_window_pairs(spark, sf_dir, monkeypatch):
    """The grid that is asked for; a single pair of each is scored here."""
    searched, search = {}, features.best_window_pair

    def noted(df, column, shorts, longs, **more):
        searched.setdefault(column, []).extend(features.window_pairs(shorts, longs))
        return search(df, column, shorts[:1], longs[1:2], **more)

    monkeypatch.setattr(features, "best_window_pair", noted)
    rows = plans.long_sensors(spark, sf_dir, count=1)
    want = [p for shorts, longs in features.HORIZONS.values() for p in features.window_pairs(shorts, longs)]
    assert len(want) > 6000 and searched == {c: want for c in plans._MEANS}
    assert rows.select(*[F.count_if(F.col(c).isNull()) for c in plans._CONTEXT if c.endswith("zscore")]).first()[:] == (0,) * 6


def test_melted_rows_are_spread_and_only_needed_columns_kept(spark, tmp_path, monkeypatch):
    rows = [(i, [float((i * j) % 7 + 1) for j in range(1, 65)], i % 3) for i in range(40)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    few = plans.long_sensors(spark, str(tmp_path), count=2)
    monkeypatch.setattr(plans, "MELTED_ROWS_PER_TASK", 5)
    many = plans.long_sensors(spark, str(tmp_path), count=2)
    assert few.rdd.getNumPartitions() < 16 <= many.rdd.getNumPartitions()
    assert few.select("vec_id", "Sensor_ID", "split").exceptAll(many.select("vec_id", "Sensor_ID", "split")).isEmpty()
    model = LinearRegression(featuresCol="features", labelCol="y", weightCol="w")
    evaluator = ml.RegressionEvaluator(labelCol="z", metricName="rmse")
    assert ml._columns_of(model, evaluator) == ["features", "y", "w", "z"]
