"""Counters that come with the one pass that writes a result.

Unlike an accumulator in a row callback, an observed counter is an expression that is
evaluated with the rows on their way to the sink.  It sits in the stage that writes, whose
tasks Spark counts once each, however often they are tried.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(
    df: DataFrame, path: str, counters: Mapping[str, Column], write_format: str = "parquet", **options: str
) -> dict[str, Any]:
    """Write ``df`` and return the ``counters`` (aggregates over its rows) of the same pass.

    An empty table gives the aggregates of no rows (0 for counts, null for sums).
    """
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counters.items()]).write.format(write_format).options(**options).save(path)
    return dict(seen.get)


def quality_counters(df: DataFrame, checks: Mapping[str, Column]) -> dict[str, Column]:
    """Counters of a quality report: rows, nulls per column, and rows that fail each check.

    A check that is null for a row counts as failed.
    """
    nulls = {f"null_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    failed = {f"failed_{n}": F.count_if(~F.coalesce(ok, F.lit(False))) for n, ok in checks.items()}
    return {"rows": F.count(F.lit(1)), **nulls, **failed}
