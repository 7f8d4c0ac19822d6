"""Streaming word counts and windowed means over file streams."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.scalar import space_fields
from tidegauge.session import fresh_path


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def running_word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Count per space-separated word over everything seen so far."""
    return (
        lines.select(F.explode(space_fields(F.col(column))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("count"))
    )


def windowed_means(
    events: DataFrame, ts: str, value: str, width: str, lateness: str | None = None
) -> DataFrame:
    """Tumbling-window means.

    Without ``lateness`` every event counts, whatever the order in which files arrive:
    for bounded input.  With it, a window is final once the watermark passes its end and
    events that come later still are dropped: for streams that never end.
    """
    if lateness is not None:
        events = events.withWatermark(ts, lateness)
    return (
        events.groupBy(F.window(ts, width))
        .agg(F.avg(value).alias(value))
        .select(F.col("window.start").alias("start"), value)
    )


def start_console(
    stream: DataFrame, mode: str = "complete", every: str = "2 seconds"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .trigger(processingTime=every)
        .start()
    )


def run_bounded(query: StreamingQuery, seconds: float) -> None:
    """Let a query run for at most ``seconds``, then stop it."""
    query.awaitTermination(seconds)
    query.stop()


# ---------------------------------------------------------------- runs that can stop and go on


def run_on(stream: DataFrame, root: str, mode: str, batches: int | None = None, every: str = "0 seconds", seconds: float = 600) -> None:
    """Process a stream from where the last run into ``root`` stopped.

    ``root`` (on shared storage) holds the checkpoint, with offsets, state and watermark,
    and the results.  With ``batches`` the run triggers every ``every`` and stops after so
    many micro-batches (or ``seconds``); otherwise it takes all input there is.  Each batch is
    written to a folder of its number: one that was cut off in the middle runs again under
    its number and overwrites what it had written, so no row counts twice.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{root}/state")
    if batches is None:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    query, end = writer.trigger(processingTime=every).start(), time.monotonic() + seconds
    first = None
    while query.isActive and time.monotonic() < end:
        done = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
        first = done[0] if first is None and done else first
        if first is not None and done[-1] - first + 1 >= batches:
            break
        time.sleep(0.05)
    error = query.exception()
    query.stop()
    if error is not None:
        raise error


def results(spark: SparkSession, root: str, schema: T.StructType, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """What the runs into ``root`` have written so far.

    In complete mode the last batch is the result, in append mode all batches are.  In update
    mode name the ``keys``: the last row of each is the result.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/out")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{root}/out")
    if mode == "complete":
        return rows.filter(F.col("batch") == rows.agg(F.max("batch")).first()[0]).drop("batch")
    if not keys:
        return rows.drop("batch")
    others = [f.name for f in schema if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in others])


def windowed_totals(events: DataFrame, ts: str, value: str, width: str, lateness: str) -> DataFrame:
    """Rows and sum per tumbling window; events of windows that the watermark has passed are dropped."""
    return (
        events.withWatermark(ts, lateness).groupBy(F.window(ts, width))
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("window.start").alias("start"), "n", "total")
    )


def drain(stream: DataFrame, mode: str, label: str = "stream", keys: Sequence[str] = ()) -> DataFrame:
    """Process all available input and return what was written.

    Each micro-batch is written to its own folder of the shared space; a retried
    batch overwrites its folder, so a result is never counted twice.  In complete
    mode the last batch holds the whole result.  In update mode a batch holds the rows
    that changed: name their ``keys`` to get the last state of each.
    """
    spark = stream.sparkSession
    root = fresh_path(spark, label)
    written: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")
        written.append(number)

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not written:
        return spark.createDataFrame([], stream.schema)
    numbers = [max(written)] if mode == "complete" else sorted(set(written))
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])
    rows = spark.read.schema(schema).option("basePath", f"{root}/out").parquet(
        *[f"{root}/out/batch={n}" for n in numbers]
    )
    if not keys:
        return rows.drop("batch")
    others = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_last"))
    return last.select(*keys, *[F.col("_last")[c].alias(c) for c in others])
