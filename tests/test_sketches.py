"""Merged sketches against exact ranks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import sketches


@pytest.mark.parametrize("kind", ["normal", "ties", "skewed"])
def test_rank_error_after_two_roll_ups(spark, tmp_path, kind):
    rng = np.random.default_rng(6)
    n = 40_000
    value = {"normal": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "skewed": np.exp(3 * rng.normal(size=n))}[kind]
    group = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 6, n))  # a third in one group
    rows = spark.createDataFrame(pd.DataFrame({"g": group, "day": rng.integers(0, 20, n), "v": value})).repartition(6)
    path = str(tmp_path / "partials")
    for part in ("day < 12", "day >= 12"):  # the second half arrives later
        sketches.sketch_groups(rows.filter(part), ["g", "day"], "v").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    by_group = sketches.merge_groups(stored, ["g"])
    everything = sketches.merge_groups(by_group, []).withColumn("g", F.lit(None).cast("int"))
    got = by_group.unionByName(everything).select(
        "g", "n", F.array(*[sketches.quantile("sketch", p) for p in (0.1, 0.5, 0.9)]).alias("q")).collect()
    assert len(got) == 7
    for r in got:
        own = value if r.g is None else value[group == r.g]
        assert r.n == len(own)
        for p, q in zip((0.1, 0.5, 0.9), r.q):
            low, high = (own < q).mean(), (own <= q).mean()
            assert low - 1.5 * sketches.rank_error() <= p <= high + 1.5 * sketches.rank_error()


def test_values_that_are_missing(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", float("nan")), (None, 2.0), (None, 4.0), (None, 3.0)], "g string, v double")
    got = {r.g: (r.n, r.q) for r in sketches.sketch_groups(rows, ["g"], "v").select("g", "n", sketches.quantile("sketch", 0.5).alias("q")).collect()}
    assert got == {"a": (1, 1.0), None: (3, 3.0)}
    assert sketches.merge_groups(sketches.sketch_groups(rows.limit(0), ["g"], "v"), ["g"]).count() == 0
