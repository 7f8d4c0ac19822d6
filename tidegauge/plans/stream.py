"""Streaming queries, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.plans.registry import query, table
from tidegauge.plans.text import _FIELDS, lines
from tidegauge.session import fresh_path
from tidegauge.streaming import streams


def _staged(spark, df, label: str, files: int = 9):
    """``df`` as a stream of ``files`` files in three micro-batches.

    Rows are dealt over the files by a hash, so every batch brings early and late rows.
    """
    folder = fresh_path(spark, label)
    df.repartition(files, F.xxhash64(*df.columns)).write.parquet(folder)
    return streams.file_stream(spark, folder, df.schema, -(-files // 3))


@query("stream_wordcount", _FIELDS + " SELECT word, count(*) AS count FROM f GROUP BY word")
def stream_wordcount(spark, sf_dir):
    """Complete-mode word count over a file stream; equals the batch count."""
    stream = _staged(spark, lines(spark, sf_dir), "lines")
    return streams.drain(streams.running_word_counts(stream), "complete", "words")


@query(
    "stream_tumbling_25m",
    """SELECT time_bucket(INTERVAL 25 MINUTES, ts, TIMESTAMP '1970-01-01') AS start,
              round(avg(value), 6) AS value FROM events GROUP BY 1""",
)
def stream_tumbling_25m(spark, sf_dir):
    """Update-mode window means over files in no order; equals the batch means."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    means = streams.windowed_means(_staged(spark, events, "events"), "ts", "value", "25 minutes")
    return streams.drain(means, "update", "means", ["start"]).select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.round("value", 6).alias("value")
    )


@query("stream_restart", _FIELDS + " SELECT word, count(*) AS count FROM f GROUP BY word")
def stream_restart(spark, sf_dir):
    """Word counts of a stream that triggers on time, is stopped after a batch, and goes on
    from its checkpoint in a second run; equals the batch count."""
    source = _staged(spark, lines(spark, sf_dir), "lines")
    counts, root = streams.running_word_counts(source), fresh_path(spark, "restart")
    streams.run_on(counts, root, "complete", batches=1, every="1 second")
    streams.run_on(counts, root, "complete")
    return streams.results(spark, root, counts.schema, "complete")


@query(
    "stream_late_rows",
    """SELECT time_bucket(INTERVAL 25 MINUTES, ts, TIMESTAMP '1970-01-01') AS start, count(*) AS n,
              round(sum(value), 6) AS total FROM events GROUP BY 1""",
)
def stream_late_rows(spark, sf_dir):
    """Each quarter of the events is a run of its own; then the first quarter comes once more.

    Its windows are final by then, so the watermark that the checkpoint has kept over the
    restarts drops the rows, and the totals are those of the events.
    """
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    low, high = events.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    quarter = F.least(F.floor((F.col("ts").cast("double") - low) / ((high - low) / 4 or 1.0)), F.lit(3))
    folder, root = fresh_path(spark, "arrivals"), fresh_path(spark, "late")
    totals = None
    for part in (0, 1, 2, 3, 0):
        events.filter(quarter == part).write.mode("append").parquet(folder)
        totals = streams.windowed_totals(streams.file_stream(spark, folder, events.schema), "ts", "value", "25 minutes", "10 minutes")
        streams.run_on(totals, root, "update")
    return streams.results(spark, root, totals.schema, "update", ["start"]).select(
        F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 6).alias("total"))
