"""Nearest-neighbour mutual information against all pairs in numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.functions.scalar import digamma
from tidegauge.operators import neighbours


def psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def brute(x, y, k=3):
    x, y = np.asarray(x, float), np.asarray(y, float)
    n = len(x)
    k = min(k, n - 1)
    dx, dy = np.abs(x[:, None] - x), np.abs(y[:, None] - y)
    d = np.maximum(dx, dy)
    np.fill_diagonal(d, np.inf)
    r = np.sort(d, axis=1)[:, k - 1][:, None]
    counts = [((a < r) | (a == 0)).sum(axis=1) for a in (dx, dy)]
    return max(0.0, psi(n) + psi(k) - sum(np.mean([psi(int(c)) for c in cs]) for cs in counts))


def data(kind, n=700):
    rng = np.random.default_rng(17)
    x = rng.normal(size=n)
    return {
        "linear": (x, x + 0.3 * rng.normal(size=n)), "independent": (x, rng.normal(size=n)),
        "heavy tails": (rng.standard_cauchy(n), rng.standard_cauchy(n)),
        "constant x": (np.zeros(n), x), "constant y": (x, np.ones(n)), "both constant": (np.zeros(n), np.ones(n)),
        "grid": (rng.integers(0, 9, n), rng.integers(0, 7, n)), "a third at zero": (np.where(rng.random(n) < 0.34, 0, x), x**2),
        "equal points": (np.repeat(x[: n // 7], 7), np.repeat(x[: n // 7] ** 3, 7)), "two values": (x, rng.integers(0, 2, n) * 1e9),
        "steps": (np.arange(n) * 0.1, np.arange(n)[::-1] * 0.1),
    }[kind]


@pytest.mark.parametrize("kind", ["linear", "independent", "heavy tails", "constant x", "constant y", "both constant", "grid",
                                  "a third at zero", "equal points", "two values", "steps"])
def test_equals_all_pairs(spark, kind):
    """Many small cells and few lookups a task, so that strips, boxes and salts all matter."""
    x, y = data(kind)
    frame = spark.createDataFrame(pd.DataFrame({"a": np.asarray(x, float), "b": np.asarray(y, float)}))
    got = neighbours.knn_mutual_information(frame, "a", "b", scaled=False, cell_rows=40, per_task=100).first()
    assert got.n == len(x) and abs(got.mutual_information - brute(x, y)) < 1e-9


def test_scaled_and_left_out_rows(spark):
    x, y = data("linear", 300)
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, None), (math.nan, 1.0), (math.inf, 2.0)]
    got = neighbours.knn_mutual_information(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()
    assert got.n == 300 and abs(got.mutual_information - brute(x / x.std(), y / y.std())) < 1e-9


@pytest.mark.parametrize("rows,want", [([], 0.0), ([(1.0, 2.0)], 0.0), ([(1.0, 2.0), (1.0, 2.0)], brute([1, 1], [2, 2])),
                                       ([(1.0, 2.0), (3.0, 5.0), (4.0, 5.0)], brute([1, 3, 4], [2, 5, 5]))])
def test_few_rows(spark, rows, want):
    got = neighbours.knn_mutual_information(spark.createDataFrame(rows, "a double, b double"), "a", "b", scaled=False).first()
    assert (got.n, round(got.mutual_information, 9)) == (len(rows), round(want, 9))


def test_no_table_of_pairs(spark):
    """Four times the rows make about four times the lookups."""
    made = {}
    for n in (2000, 8000):
        x, y = data("linear", n)
        points = spark.createDataFrame(pd.DataFrame({"x": np.sort(x), "y": y})).selectExpr(
            "row_number() over (order by x) - 1L as id", "x", "y", "1L as copies").cache()
        own = neighbours._within(3, np.array([list(r) for r in points.selectExpr(f"cast(id div {4 * int(n**0.5)} as long) c", "x", "y").groupBy("c").agg(
            F.min("x"), F.max("x"), F.min("y"), F.max("y")).orderBy("c").collect()], float).T)
        found = points.selectExpr("*", f"id div {4 * int(n**0.5)} as cell").groupBy("cell").applyInPandas(
            own, "id long, x double, y double, copies long, best array<double>, visits array<long>")
        made[n] = found.agg(F.sum(F.size("visits"))).first()[0]
    assert made[8000] < 8 * made[2000] and made[8000] < 3 * 8000


def test_digamma(spark):
    got = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 500, 10**6)], "n long").select("n", digamma(F.col("n")).alias("p")).collect()
    assert all(abs(r.p - psi(r.n)) < 1e-12 * max(1, abs(r.p)) * 10 for r in got)
