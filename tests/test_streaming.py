"""Streams give what the same batch gives."""

import time

from pyspark.sql import functions as F

from tidegauge.streaming import streams


def test_word_counts_over_several_batches(spark, tmp_path):
    lines = spark.createDataFrame([("a b",), ("b  c",), ("a",)], "value string")
    lines.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), lines.schema, 1)
    got = streams.drain(streams.running_word_counts(stream), "complete")
    assert {r["word"]: r["count"] for r in got.collect()} == {"a": 2, "b": 2, "c": 1, "": 1}


def test_window_means_do_not_depend_on_file_order(spark, tmp_path):
    """Nine files in nine batches, the latest events first: nothing is dropped."""
    rows = [(f"2024-01-{d:02d} 0{h}:10:00", float(d * h)) for d in range(1, 10) for h in range(3)]
    events = spark.createDataFrame(rows, "t string, value double").select(F.to_timestamp("t").alias("ts"), "value")
    for day in range(9, 0, -1):
        events.filter(F.dayofmonth("ts") == day).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)  # files are taken in the order of their times
    stream = streams.file_stream(spark, str(tmp_path / "in"), events.schema, 1)
    got = streams.drain(streams.windowed_means(stream, "ts", "value", "25 minutes"), "update", keys=["start"])
    want = events.groupBy(F.window("ts", "25 minutes")).agg(F.avg("value").alias("value")).select("window.start", "value")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 27


def test_console_query_stops_in_time(spark, tmp_path):
    spark.range(1).select(F.lit("x y").alias("value")).write.text(str(tmp_path / "in"))
    schema = spark.read.text(str(tmp_path / "in")).schema
    stream = streams.file_stream(spark, str(tmp_path / "in"), schema, fmt="text")
    query = streams.start_console(streams.running_word_counts(stream), every="1 second")
    begin = time.time()
    streams.run_bounded(query, 3)
    assert time.time() - begin < 60 and not query.isActive


def test_stopped_and_restarted_without_loss_or_repeats(spark, tmp_path):
    """Nine files, two batches, a new query, one more batch, then the rest."""
    rows = spark.range(900).selectExpr("concat('w', id % 7) as value")
    rows.repartition(9).write.parquet(str(tmp_path / "in"))
    root = str(tmp_path / "run")

    def counts():
        return streams.running_word_counts(streams.file_stream(spark, str(tmp_path / "in"), rows.schema, 1))

    streams.run_on(counts(), root, "complete", batches=2, every="0 seconds")
    half = streams.results(spark, root, counts().schema, "complete").agg(F.sum("count")).first()[0]
    assert 200 <= half < 900
    streams.run_on(counts(), root, "complete", batches=1)
    streams.run_on(counts(), root, "complete")
    got = streams.results(spark, root, counts().schema, "complete").collect()
    assert {r["word"]: r["count"] for r in got} == {f"w{i}": 900 // 7 + (i < 900 % 7) for i in range(7)}


def test_late_rows_are_dropped_after_a_restart(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "run")
    batches = [[("2024-01-01 10:00:00", 1.0), ("2024-01-01 10:05:00", 2.0)], [("2024-01-01 12:00:00", 4.0)],
               [("2024-01-01 10:01:00", 8.0), ("2024-01-01 11:55:00", 16.0)]]  # the first is late, the second within bounds
    for part in batches:
        events = spark.createDataFrame(part, "t string, value double").select(F.to_timestamp("t").alias("ts"), "value")
        events.coalesce(1).write.mode("append").parquet(source)
        totals = streams.windowed_totals(streams.file_stream(spark, source, events.schema), "ts", "value", "10 minutes", "10 minutes")
        streams.run_on(totals, root, "update")
    got = streams.results(spark, root, totals.schema, "update", ["start"]).collect()
    assert {(r.start.strftime("%H:%M"), r.n, r.total) for r in got} == {("10:00", 2, 3.0), ("12:00", 1, 4.0), ("11:50", 1, 16.0)}


def test_results_before_any_run(spark, tmp_path):
    schema = spark.range(1).schema
    assert streams.results(spark, str(tmp_path), schema, "append").count() == 0
