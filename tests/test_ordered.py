"""Positions, chunks and order statistics, with one key holding most of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge import session
from tidegauge.operators import joins, ordered, series


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows, two thirds under one key, in shuffled order with repeated values."""
    rng = np.random.default_rng(3)
    key = np.where(rng.random(3000) < 0.66, 0, rng.integers(1, 20, 3000))
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(3000), "v": rng.integers(0, 40, 3000) / 4})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_index_rows(skewed):
    pdf, df = skewed
    got = ordered.index_rows(df, ["t"]).toPandas().sort_values("t")
    assert (got["rn"].to_numpy() == np.arange(3000)).all()
    keyed = ordered.index_rows(df, ["t"], ["k"]).toPandas().sort_values(["k", "t"])
    assert (keyed["rn"] == keyed.groupby("k").cumcount()).all()


@pytest.mark.parametrize("chunk", [7, 50, 100_000])
def test_sliding_equals_pandas_across_chunks(skewed, chunk):
    pdf, df = skewed
    rows = ordered.index_rows(df, ["t"], ["k"])
    got = ordered.sliding(
        rows,
        lambda w: {
            "m": F.avg("v").over(w.rowsBetween(-4, 0)), "back": F.lag("v", 3).over(w),
            "ahead": F.lead("v", 2).over(w),
        },
        keys=["k"], before=5, after=2, chunk=chunk,
    ).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    want = pdf.sort_values(["k", "t"]).reset_index(drop=True)
    by = want.groupby("k")["v"]
    assert len(got) == 3000
    assert np.allclose(got["m"], by.rolling(5, min_periods=1).mean().to_numpy())
    assert got["back"].equals(by.shift(3)) and got["ahead"].equals(by.shift(-2))


def test_rolling_needs_full_windows(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0), (3, 5.0)], "rn long, v double")
    got = series.rolling_statistics(df, "v", {"m": 2}).orderBy("rn").toPandas()["m"]
    assert got.isna().tolist() == [True, True, True, False] and got.iloc[3] == 4.0


def test_running_sums(skewed):
    pdf, df = skewed
    got = ordered.running_sums(ordered.index_rows(df, ["t"], ["k"]), {"s": "v"}, keys=["k"], chunk=9)
    got = got.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    assert np.allclose(got["s"], pdf.sort_values(["k", "t"]).groupby("k")["v"].cumsum())


def test_exact_quantiles(skewed):
    pdf, df = skewed
    probs = [0.0, 0.1, 0.5, 0.93, 1.0]
    got = ordered.exact_quantiles(df, "v", probs, ["k"]).toPandas().set_index(["k", "prob"])["quantile"]
    for key, group in pdf.groupby("k"):
        assert np.allclose(got[key][probs], np.quantile(group["v"], probs))
    whole = ordered.exact_quantiles(df, "v", probs).toPandas().set_index("prob")["quantile"]
    assert np.allclose(whole[probs], np.quantile(pdf["v"], probs))


def test_chronological_split_keeps_ties_together(skewed):
    pdf, df = skewed
    rank = (pdf["v"].rank(method="min") - 1) / (len(pdf) - 1)
    want = np.where(rank <= 0.7, "train", np.where(rank <= 0.9, "validation", "test"))
    got = ordered.chronological_split(df, "v").toPandas().sort_values("t")["split"].to_numpy()
    assert (got == want[np.argsort(pdf["t"])]).all()
    ranks = ordered.percent_ranks(df, "v").toPandas().sort_values("t")["rank"]
    assert np.allclose(ranks, rank.iloc[np.argsort(pdf["t"])])


def test_salted_joins_equal_plain_joins(spark, skewed):
    _, df = skewed
    names = spark.createDataFrame([(i, f"n{i}") for i in range(0, 20, 2)] + [(None, "none")], "k long, n string")
    left = df.unionAll(spark.createDataFrame([(None, 9999, 1.0)], df.schema))
    for how in ("left", "inner"):
        plain = left.join(names.withColumnRenamed("k", "j"), F.col("k").eqNullSafe(F.col("j")), how).drop("j")
        salted = joins.salted_lookup_join(left, names, ["k"], how, per_salt=100)
        checked = joins.lookup_join(left, names, ["k"], how, rows=1)
        assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()
        assert plain.exceptAll(checked).isEmpty() and checked.count() == plain.count()


def test_no_window_over_one_partition(spark, skewed):
    _, df = skewed
    plan = series.rolling_zscore(ordered.index_rows(df, ["t"]), "v", 3, 12, "z")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "hashpartitioning(_chunk" in text


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tidegauge import session

    class Stub:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError):
        session.shared_folder(Stub)
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_nulls_in_keys_and_order(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r["quantile"]) for r in ordered.exact_quantiles(df, "v", [0.5], ["k"]).collect()}
    assert got == {(None, 2.0), ("a", 5.0)}
    times = spark.createDataFrame([(i, None if i < 3 else i) for i in range(20)], "i int, t int")
    split = {r.i: r.split for r in ordered.chronological_split(times, "t").collect()}
    ranks = {r.i: r["rank"] for r in ordered.percent_ranks(times, "t").collect()}
    assert ranks[0] == ranks[2] == 0.0 and ranks[3] == 3 / 19
    assert split == {i: "train" if r <= 0.7 else "validation" if r <= 0.9 else "test" for i, r in ranks.items()}


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_hot_keys_are_split(spark, hot):
    """One key holds 90 % of a side, also as equal rows; nulls match nulls."""
    def side(heavy, name):
        keys = ["h"] * (90 if heavy else 2) + ["a", "b", None] + [name]
        return spark.createDataFrame([(k, 1) for k in keys], f"k string, {name} int")

    left, right = side(hot != "right", "x"), side(hot != "left", "y")
    for how in ("inner", "left"):
        got = joins.pair_join(left, right, ["k"], how, per_salt=10).groupBy("k").count().collect()
        n, m = (90 if hot != "right" else 2), (90 if hot != "left" else 2)
        want = {"h": n * m, "a": 1, "b": 1, None: 1} | ({"x": 1} if how == "left" else {})
        assert {r.k: r["count"] for r in got} == want
    salted = joins.salted_lookup_join(left, right.dropDuplicates(["k"]), ["k"], per_salt=10)
    assert salted.count() == left.count()


def test_intermediates_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    session.materialise(spark.range(3))
    assert len(list(tmp_path.iterdir())) == 1
    session.remove_intermediates(spark)
    assert list(tmp_path.iterdir()) == []
