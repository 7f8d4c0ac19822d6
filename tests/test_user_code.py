"""User aggregates, counters of a write, and inferred types."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import observed
from tidegauge.operators.folding import UserAggregate, user_aggregate
from tidegauge.sources import inference


def welford(state, x):
    n, mean, m2 = state
    n += 1
    delta = x - mean
    mean += delta / n
    return n, mean, m2 + delta * (x - mean)


def together(a, b):
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, delta = a[0] + b[0], b[1] - a[1]
    return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta * delta * a[0] * b[0] / n


VARIANCE = UserAggregate(lambda: (0, 0.0, 0.0), welford, together, "double", lambda s: s[2] / s[0] if s[0] else None)
ORDERED = UserAggregate(list, lambda s, x: s + [x], lambda a, b: a + b, "array<long>")


def hot(spark, rows=3000):
    """A third of the rows under one key, null keys, and many keys of few rows."""
    pick = random.Random(3)
    data = [("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{pick.randrange(200)}", float(pick.random())) for i in range(rows)]
    return data, spark.createDataFrame(data, "k string, x double").repartition(40)


def test_three_functions_with_a_hot_key(spark):
    data, frame = hot(spark)
    by = {}
    for k, x in data:
        by.setdefault(k, []).append(x)
    # few states a task and a small fan-in: several states per key and task, several levels
    got = {r.k: r.value for r in user_aggregate(frame, ["x"], VARIANCE, keys=["k"], fan_in=3, keys_in_task=7).collect()}
    assert got.keys() == by.keys()
    for k, xs in by.items():
        mean = sum(xs) / len(xs)
        assert math.isclose(got[k], sum((x - mean) ** 2 for x in xs) / len(xs), rel_tol=1e-9, abs_tol=1e-12)
    longest = UserAggregate(lambda: "", lambda s, k: max(s, k or ""), max, "string")
    assert user_aggregate(frame, ["k"], longest).first().value == max(k for k in by if k)
    count = UserAggregate(lambda: 0, lambda s, batch: s + batch.num_rows, lambda a, b: a + b, "long", by_batch=True)
    assert user_aggregate(frame, ["k"], count, fan_in=2).first().value == len(data)


def test_merges_keep_the_order_of_tasks(spark):
    frame = spark.range(0, 1000, 1, 37)
    assert user_aggregate(frame, ["id"], ORDERED, fan_in=4).first().value == list(range(1000))


def test_a_state_that_is_changed_in_place_counts_once_when_tasks_run_again(spark):
    def add(state, x):
        state.append(x)
        return state

    def extend(a, b):
        a.extend(b)
        return a

    frame = spark.range(0, 300, 1, 20)
    result = user_aggregate(frame, ["id"], UserAggregate(list, add, extend, "array<long>"), fan_in=2)
    assert result.first().value == result.first().value == list(range(300))


def test_user_aggregates_of_no_rows(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert user_aggregate(empty, ["x"], VARIANCE).first().value is None
    assert user_aggregate(empty, ["x"], ORDERED).first().value == []
    assert user_aggregate(empty, ["x"], VARIANCE, keys=["k"]).count() == 0
    with pytest.raises(ValueError):
        user_aggregate(empty, ["x"], UserAggregate(int, lambda s, b: s, max, "long", by_batch=True), keys=["k"])


# ---------------------------------------------------------------- counters


def scanned_rows(spark, since):
    """Rows that the scans of the queries after ``since`` gave out, from the SQL metrics."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    out, executions = [], store.executionsList()
    for i in range(executions.size()):
        e = executions.apply(i)
        if e.executionId() > since:
            values = store.executionMetrics(e.executionId())
            nodes = store.planGraph(e.executionId()).allNodes()
            for j in range(nodes.size()):
                node = nodes.apply(j)
                if node.name().startswith("Scan"):
                    for m in range(node.metrics().size()):
                        metric = node.metrics().apply(m)
                        if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                            out.append(int(values.apply(metric.accumulatorId()).replace(",", "")))
    return out


def last_execution(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    store = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((store.apply(i).executionId() for i in range(store.size())), default=-1)


def test_counters_come_with_one_scan(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5000).selectExpr("id", "if(id % 7 = 0, null, id % 10) as v").write.parquet(source)
    rows, since = spark.read.parquet(source), last_execution(spark)
    counters = observed.quality_counters(rows, {"small": F.col("v") < 5})
    got = observed.write_counted(rows.filter("id >= 1000"), str(tmp_path / "out"), counters)
    kept = [i for i in range(1000, 5000)]
    assert got == {
        "rows": 4000, "null_id": 0, "null_v": sum(i % 7 == 0 for i in kept),
        "failed_small": sum(i % 7 == 0 or i % 10 >= 5 for i in kept)}
    scans = scanned_rows(spark, since)
    assert len(scans) == 1 and 4000 <= scans[0] <= 5000  # row groups without a row are skipped
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4000


def test_counters_of_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "v int")
    got = observed.write_counted(empty, str(tmp_path / "none"), {"n": F.count(F.lit(1)), "s": F.sum("v")})
    assert got == {"n": 0, "s": None}


# ---------------------------------------------------------------- types

CLASSES = {
    None: "string", "": "string", "  ": "string", "7": "int", "-2147483648": "int", "2147483648": "bigint", " 12 ": "int",
    "9223372036854775807": "bigint", "9223372036854775808": "double", "1.5": "double", ".5": "double", "1e9": "double",
    "true": "boolean", "FALSE": "boolean", "yes": "string", "2024-02-29": "date", "2023-02-29": "string", "NaN": "string",
    "2024-02-29 10:00": "timestamp_ntz", "2024-02-29T10:00:00.123": "timestamp_ntz", "2024-02-29 25:00": "string", "1,5": "string", "0x1f": "string",
}


def test_class_of_each_value(spark):
    frame = spark.createDataFrame([(v,) for v in CLASSES], "v string")
    got = {r.v: r.t for r in frame.select("v", inference.type_of(inference.value_class(F.col("v"))).alias("t")).collect()}
    assert got == CLASSES


def test_files_that_disagree(spark, tmp_path):
    bodies = ["a,b,c,d\n1,2,x,\n2,3,y,\n", "a,b,c,d\n1.5,7000000000,4,\n,true,5,\n", "a,b,c,d\n9,1,2024-01-01,\n"]
    for i, body in enumerate(bodies):
        (tmp_path / f"{i}.csv").write_text(body)
    profile = inference.file_profile(inference.read_texts(spark, str(tmp_path)))
    rows = {r.column: r for r in inference.type_report(profile).collect()}
    assert {c: r.type for c, r in rows.items()} == {"a": "double", "b": "string", "c": "string", "d": "string"}
    assert (rows["a"].drifting, rows["a"].conflict, rows["a"].own_types, rows["a"].blank) == (2, False, ["double", "int"], 1)
    assert rows["b"].conflict and rows["c"].conflict and not rows["d"].conflict and rows["d"].own_types == []
    typed = inference.read_inferred(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in typed.schema] == ["double", "string", "string", "string"]
    assert sorted(r.a for r in typed.collect() if r.a is not None) == [1.0, 1.5, 2.0, 9.0]


def test_a_file_with_other_columns_is_an_error(spark, tmp_path):
    (tmp_path / "0.csv").write_text("a,b\n1,2\n")
    (tmp_path / "1.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        inference.read_texts(spark, str(tmp_path)).collect()
