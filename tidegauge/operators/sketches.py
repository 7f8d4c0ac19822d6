"""Quantiles from sketches that are stored per group and merged later.

``percentile_approx`` needs the rows again for each grouping.  A KLL sketch of a fine group
is a few kilobytes, can be kept in a table with others of its kind (one per day, say), and
merges into the sketch of any coarser grouping, also with sketches that arrive later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; see :func:`rank_error`.
K = 200


def rank_error(k: int = K) -> float:
    """Share of the rows by which the rank of an estimate is off, at most, with 99 % confidence.

    Merging does not change it: a merged sketch is as good as one of all rows.
    """
    return 2.296 / k**0.9723  # fixed values: fitted for these sketches by their authors


def sketch_groups(df: DataFrame, keys: Sequence[str], value: str, k: int = K) -> DataFrame:
    """``(*keys, sketch, n)`` of the non-null, non-NaN ``value`` rows; built with partial
    sketches per task, so a hot group is no hot task.  Groups without values have no row."""
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return rows.groupBy(*keys).agg(F.expr(f"kll_sketch_agg_double(_v, {int(k)})").alias("sketch"), F.count("*").alias("n"))


def merge_groups(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones; reads no rows again."""
    return sketches.groupBy(*keys).agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"), F.sum("n").alias("n"))


def quantile(sketch: Column | str, share: float) -> Column:
    """The value of a sketch below which about ``share`` of the rows lie."""
    return F.call_function("kll_sketch_get_quantile_double", F.col(sketch) if isinstance(sketch, str) else sketch, F.lit(float(share)))
