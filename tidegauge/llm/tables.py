"""Numbered rows, written tables and shipped code, shared by the operators here."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import fresh_path

_SHIPPED: set[str] = set()


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage, fixes values that a recomputation could change, and lets later passes
    read only the columns that they use.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str = "numbered") -> DataFrame:
    """Every row of ``df`` as ``(_rid, doc)``: a unique number and the whole row as a struct.

    The struct keeps whatever columns the caller has apart from the columns of the
    operators, and ``_rid`` tells apart rows whose own key is null or repeated.
    """
    return keep(df.select(F.monotonically_increasing_id().alias("_rid"), F.struct("*").alias("doc")), label)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidegauge-code-"), "tidegauge_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
