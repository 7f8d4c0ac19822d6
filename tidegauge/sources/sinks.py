"""Writers for finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import decimal_comma
from tidegauge.operators.relational import numeric_columns


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    df.write.mode(mode).options(header=True, **options).csv(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file, for a result small enough for one task."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_locale_csv(
    df: DataFrame, path: str, digits: int = 4, decimals: Sequence[str] | None = None
) -> None:
    """CSV with ``;`` between fields and decimal commas."""
    numbers = list(decimals) if decimals is not None else numeric_columns(df)
    df.withColumns({c: decimal_comma(F.col(c), digits) for c in numbers}).write.mode(
        "overwrite"
    ).options(header=True, sep=";").csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
