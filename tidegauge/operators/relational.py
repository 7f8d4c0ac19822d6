"""Aggregates, profiles, reshaping and multiset operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.scalar import skewness_adjusted
from tidegauge.operators.joins import ROWS_PER_SALT, fits_broadcast, hot_anti_join, lookup_join, pair_join, stored_bytes
from tidegauge.operators.ordered import exact_quantiles, index_rows
from tidegauge.session import BROADCAST_BYTES


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def mean_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of every numeric column per key."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in numeric_columns(df, keys)])


def null_profile(df: DataFrame) -> DataFrame:
    """One row: how many nulls each column has, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def statistic_table(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Rows "Mean" and "Variance" (sample) of the columns, from one aggregate."""
    wide = df.agg(
        *[F.round(F.avg(c), digits).alias(f"m_{c}") for c in columns],
        *[F.round(F.variance(c), digits).alias(f"v_{c}") for c in columns],
    )
    means = ", ".join(f"m_{c}" for c in columns)
    variances = ", ".join(f"v_{c}" for c in columns)
    names = ", ".join(["Statistic", *columns])
    return wide.select(F.expr(f"stack(2, 'Mean', {means}, 'Variance', {variances}) as ({names})"))


def above_share_of_max(df: DataFrame, column: str, share: float) -> DataFrame:
    """Rows strictly above ``share`` times the column maximum (a scalar subquery)."""
    return df.filter(F.col(column) > df.agg(F.max(column)).scalar() * share)


def extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the overall minimum and maximum over several columns."""
    return df.agg(
        F.least(*[F.min(c) for c in columns]).alias("low"),
        F.greatest(*[F.max(c) for c in columns]).alias("high"),
    )


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def melt_pairs(
    df: DataFrame, ids: Sequence[str], groups: dict[str, tuple[str, ...]], label: str,
    values: Sequence[str],
) -> DataFrame:
    """Wide to long with several measures per label: ``{label: (column, ...)}``."""
    cells = ", ".join(
        f"'{k}', " + ", ".join(f"`{c}`" for c in columns) for k, columns in groups.items()
    )
    names = ", ".join([label, *values])
    return df.select(*ids, F.expr(f"stack({len(groups)}, {cells}) as ({names})"))


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Strict lower triangle of the Pearson matrix as rows ``(x, y, r)``, in one pass."""
    pairs = [(columns[i], columns[j]) for i in range(len(columns)) for j in range(i)]
    entries = [
        F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), F.round(F.corr(x, y), digits).alias("r")
        )
        for x, y in pairs
    ]
    return df.agg(F.array(*entries).alias("cells")).select(F.inline("cells"))


def box_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, mean, whisker ends and outlier count per column.

    Whiskers reach to the last value within 1.5 interquartile ranges of the box.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "name", "x"
    )
    quartiles = (
        exact_quantiles(long, "x", [0.25, 0.5, 0.75], ["name"])
        .groupBy("name")
        .agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.5, F.col("quantile"))).alias("median"),
            F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
        )
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return (
        lookup_join(long.filter(F.col("x").isNotNull()), quartiles, ["name"])
        .groupBy("name", "q1", "median", "q3")
        .agg(
            F.avg("x").alias("mean"),
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum; every bin is listed, empty ones too."""
    x = F.col(column).cast("double")
    bounds = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    width = (high - low) / bins
    place = F.least(F.floor(F.coalesce(F.try_divide(x - low, width), F.lit(0.0))), F.lit(bins - 1))
    counted = (
        df.filter(x.isNotNull())
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"))
        .join(F.broadcast(counted), "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("left_edge"),
            F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        )
    )


def density_curve(df: DataFrame, column: str, points: int = 200, bins: int = 1024) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum.

    Scott's bandwidth; a constant column has none and null densities.  The rows are first counted into ``bins`` narrow bins, so the
    kernel work depends on bins and points only, not on the number of rows.
    """
    x = F.col(column).cast("double")
    facts = df.agg(
        F.struct(
            F.min(x).alias("low"),
            F.max(x).alias("high"),
            F.count(x).alias("n"),
            (F.stddev(x) * F.pow(F.count(x).cast("double"), F.lit(-0.2))).alias("h"),
        )
    ).scalar()
    low, high, h = facts.getField("low"), facts.getField("high"), facts.getField("h")
    step = (high - low) / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    cells = histogram(df, column, bins).filter("rows > 0").select(
        (F.col("left_edge") + (high - low) / (2 * bins)).alias("centre"), "rows", grid.alias("point")
    )
    z = F.try_divide(low + F.col("point") * step - F.col("centre"), h)
    return cells.groupBy("point").agg(
        F.max(low + F.col("point") * step).alias("x"),
        F.try_divide(
            F.sum(F.col("rows") * F.exp(-0.5 * z * z)), F.max(facts.getField("n") * h * 2.5066282746310002)
        ).alias("density"),
    )


def skewness_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[skewness_adjusted(F.col(c)).alias(c) for c in columns])


def error_metrics(
    df: DataFrame, group: str, truth: str, predicted: str, prefix: str = "Sensor_R",
    digits: int = 4,
) -> DataFrame:
    """MAPE, MAE, RMSE, R2, mean and population standard deviation of the error per group.

    One grouped pass; groups are ordered by their number.
    """
    y, error = F.col(truth), F.col(truth) - F.col(predicted)
    per_group = df.groupBy(group).agg(
        F.avg(F.abs(F.try_divide(error, y))).alias("_mape"),
        F.avg(F.abs(error)).alias("_mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(y).alias("_var"),
        F.avg(error).alias("_mean"),
        F.stddev_pop(error).alias("_std"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var"))
    return per_group.orderBy(F.col(group).cast("int")).select(
        F.concat(F.lit(prefix), F.col(group).cast("string")).alias("Sensor_ID"),
        F.round(F.col("_mape") * 100, digits).alias("MAPE"),
        F.round("_mae", digits).alias("MAE"),
        F.round(F.sqrt("_mse"), digits).alias("RMSE"),
        F.round(r2, digits).alias("R2"),
        F.round("_mean", digits).alias("Mean_Error"),
        F.round("_std", digits).alias("Std_Error"),
    )


def sum_and_count(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"), F.count(value).alias("n"))


def grouped_values(
    df: DataFrame, key: str, value: str, page: int = 10_000, order: Sequence[str] = ()
) -> DataFrame:
    """All values of each key as ordered lists, at most ``page`` values per row.

    A key with more values continues on further rows (``page`` 0, 1, ...), so no row
    or task has to hold all values of a dominant key.  ``order`` breaks ties.
    """
    numbered = index_rows(df.select(key, value, *order), [value, *order], [key])
    return (
        numbered.groupBy(key, F.floor(F.col("rn") / page).alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct("rn", value))).alias("_v"))
        .select(key, "page", F.transform("_v", lambda v: v[value]).alias("values"))
    )


def cogroup_lists(
    left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
    page: int = 10_000,
) -> DataFrame:
    """Per key the list of left values and of right values; a missing side is empty.

    Lists are paged as in :func:`grouped_values`.
    """
    a = grouped_values(left, key, left_value, page).withColumnRenamed("values", "left_values")
    b = grouped_values(right, key, right_value, page).withColumnRenamed("values", "right_values")
    return a.join(b, [key, "page"], "full").select(
        key,
        "page",
        F.coalesce("left_values", F.array()).alias("left_values"),
        F.coalesce("right_values", F.array()).alias("right_values"),
    )


def key_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """All pairs per key (inner or left); null keys match each other.

    A small right side is broadcast; otherwise keys with very many rows on either side
    are dealt over a grid of salts.
    """
    if stored_bytes(right) <= BROADCAST_BYTES and fits_broadcast(right):
        return lookup_join(left, right, on, how, derived=False)
    return pair_join(left, right, on, how)


def bag_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionAll(right)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows present on both sides, once each; duplicates go before the join."""
    return left.distinct().intersect(right.distinct())


def bag_subtract(left: DataFrame, right: DataFrame, per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Left rows that do not occur on the right, keeping their duplicates."""
    return hot_anti_join(left, right, per_salt)


def pivot_months(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Mean per year (rows) and calendar month (columns January to December)."""
    months = [
        "January", "February", "March", "April", "May", "June", "July", "August",
        "September", "October", "November", "December",
    ]
    name = F.element_at(F.array(*[F.lit(m) for m in months]), F.month(ts))
    return (
        df.select(F.year(ts).alias("year"), name.alias("month_name"), value)
        .groupBy("year")
        .pivot("month_name", months)
        .agg(F.avg(value))
    )


def estimate_spread(df: DataFrame, key: str, estimate: str, truth: str) -> DataFrame:
    """Per key, the sample variance of the estimates and their mean absolute error."""
    return df.groupBy(key).agg(
        F.var_samp(estimate).alias("estimate_variance"), F.avg(F.abs(F.col(estimate) - F.col(truth))).alias("mean_error")
    )
