"""Session settings and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Bounds for broadcasting a written lookup table: rows, and compressed file size.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 2**20


def build_session(app: str = "tidegauge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; cluster settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may do
    without: its executors share one machine, so a temporary folder serves.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder on shared storage: intermediate "
            "tables must outlive the executor that wrote them"
        )
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegauge-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(_own_folder(spark), f"{label}-{uuid.uuid4().hex}")


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"tidegauge-{spark.sparkContext.applicationId}")


def remove_intermediates(spark: SparkSession) -> None:
    """Delete the intermediate tables that this application has written.

    Results that still read them must have been written elsewhere before.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts lineage for iterative work and fixes values such as partition
    numbers that a recomputation could change.  A written table survives the loss
    of any executor and, being columnar, lets later passes read only what they use.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks per shuffle.  Passing it to ``repartition`` keeps adaptive execution from
    merging small partitions whose rows are few but costly, as in grouped Python code."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, rows: int, per_task: int, *on: str) -> DataFrame:
    """``df`` dealt over one task per ``per_task`` of ``rows``, unless it has as many partitions.

    For a table whose small files hold much work: a few columns that become many rows, or
    rows that take long.  ``on`` has a distinct value per row, or nearly so.
    """
    tasks = -(-rows // per_task)
    return df.repartition(tasks, *on) if tasks > df.rdd.getNumPartitions() else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidegauge-code-"), "tidegauge_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
