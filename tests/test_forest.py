"""Forests grown in tasks: exact splits, quality, and what is held at a time."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tidegauge.operators import forest


def wavy(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-2, 2, (n, 4))
    return pd.DataFrame({**{f"f{i}": x[:, i] for i in range(4)}, "y": np.sin(2 * x[:, 0]) + x[:, 1] * (x[:, 2] > 0) + 0.1 * rng.normal(size=n)})


def test_a_tree_splits_where_the_squared_error_falls_most():
    rng = np.random.default_rng(3)
    bins, y = rng.integers(0, 8, (200, 3)), rng.normal(size=200)
    cuts = [np.arange(7.0)] * 3
    node, feature, threshold, value = forest.grow_tree(bins, y, cuts, 1, rng, share=1.0, weights=np.ones(200))
    errors = {(f, c): sum(((p - p.mean()) ** 2).sum() for p in (y[bins[:, f] <= c], y[bins[:, f] > c])) for f in range(3) for c in range(7)}
    best = min(errors, key=errors.get)
    assert (feature[0], threshold[0]) == best and list(node) == [1, 2, 3] and list(feature[1:]) == [-1, -1]
    left = bins[:, best[0]] <= best[1]
    assert np.allclose(value, [y.mean(), y[left].mean(), y[~left].mean()])


def test_as_good_as_the_forest_of_one_driver(spark):
    train, test = spark.createDataFrame(wavy(2000, 1)), spark.createDataFrame(wavy(600, 2))
    names = [f"f{i}" for i in range(4)]
    grown = forest.grow_forest(train, names, "y", trees=16, depth=10, bag_rows=1500)
    own = forest.predict(grown, test)
    vector = VectorAssembler(inputCols=names, outputCol="features")
    model = RandomForestRegressor(labelCol="y", numTrees=16, maxDepth=10, seed=1).fit(vector.transform(train))
    errors = [d.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0] for d in (own, model.transform(vector.transform(test)))]
    assert errors[0] < 1.15 * errors[1] and errors[0] < 0.4
    # parts of the forest give the same sums, in bounded pieces
    again = forest.predict(grown, test, part_bytes=40_000)
    assert len(grown.parts(40_000)) > 4
    assert np.allclose(*[[r.prediction for r in d.orderBy("f0").collect()] for d in (own, again)])


def test_what_is_held_does_not_grow_with_the_rows(spark):
    """Five times the rows: more trees and parts, none of them larger."""
    largest = {}
    for n in (2000, 10_000):
        grown = forest.grow_forest(spark.createDataFrame(wavy(n, n)), ["f0", "f1"], "y", trees=16, depth=20, bag_rows=400)
        assert grown.trees == max(16, n // 400) and grown.nodes.select("tree").distinct().count() == grown.trees
        parts = grown.parts(30_000)
        largest[n] = max(nodes for *_, nodes in parts) * forest.NODE_BYTES
        assert max(nodes for *_, nodes in grown.parts(0)) <= 2 * 550  # two nodes per row of a bag
    assert max(largest.values()) <= max(30_000, 2 * 550 * forest.NODE_BYTES)


@pytest.mark.parametrize("rows", [[], [(1.0, None)], [(1.0, 4.0)], [(None, 2.0), (float("nan"), 4.0)], [(1.0, 3.0)] * 50])
def test_odd_tables(spark, rows):
    frame = spark.createDataFrame(rows, "a double, y double")
    grown = forest.grow_forest(frame, ["a"], "y", trees=4, bag_rows=10)
    labels = [y for _, y in rows if y is not None]
    got = [r.prediction for r in forest.predict(grown, frame).collect()]
    assert len(got) == len(rows)
    assert all(p is None for p in got) if not labels else all(min(labels) <= p <= max(labels) for p in got)


def test_sensor_forest_covers_all_sensors(spark, sf_dir, monkeypatch):
    from tidegauge.operators import features
    from tidegauge.plans import ml as plans

    monkeypatch.setattr(features, "HORIZONS", {h: (range(1, 2), range(3, 4)) for h in features.HORIZONS})
    rows = plans.sensor_forest(spark, sf_dir, trees=16, depth=4).collect()
    assert len({r.Sensor_ID for r in rows}) == len(rows) == plans.SENSOR_COUNT
    assert all(r.RMSE >= 0 for r in rows)


def test_rows_beyond_the_bags_of_all_trees_make_larger_bags(spark, monkeypatch):
    """Four times the rows: as many trees, so that a row takes no longer to score; tasks by rows, not by files."""
    monkeypatch.setattr(forest, "BAG_ROWS", 100)
    monkeypatch.setattr(forest, "SCORED_PER_TASK", 100)
    tasks = []
    spreading = forest.spread
    monkeypatch.setattr(forest, "spread", lambda df, *a: (tasks.append(spreading(df, *a).rdd.getNumPartitions()), spreading(df, *a))[1])
    for n in (2000, 8000):
        frame = spark.createDataFrame(wavy(n, n)).coalesce(1)
        grown = forest.grow_forest(frame, ["f0", "f1"], "y", trees=16, depth=4)
        assert grown.trees == 16 and forest.predict(grown, frame).filter("prediction is not null").count() == n
    assert tasks == [20, 80]
    monkeypatch.setattr(forest, "LARGEST_BAG", 250)
    assert forest.bag_size(8000, 16) == 250 and forest.bag_size(1000, 16) == 100
