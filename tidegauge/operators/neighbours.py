"""Mutual information of two continuous columns from nearest-neighbour distances.

The estimator is that of Kraskov, Stoegbauer and Grassberger (2004), first form.  For each
row the distance to its k-th neighbour is found in the plane (the larger of both
differences), and the rows nearer than that are counted along each axis.

Equal points are merged first and carry their number, so ties cost nothing.  The plane is
cut into strips of about ``4 sqrt(n)`` points each along the axis with more distinct values;
a strip gives every point a bound on its distance, and a point visits only those other
strips whose bounding box is nearer than that.  Counts along an axis are looked up in blocks
of running totals.  Nothing is paired with everything, and the tables that tasks share (boxes
of strips, first values of blocks) have about ``sqrt(n) / 4`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import digamma
from tidegauge.operators.ordered import index_rows, running_sums
from tidegauge.session import materialise, ship_package

#: Lookups of one strip or block that one task should take.
LOOKUPS_PER_TASK = 200_000


def _cell_rows(rows: int) -> int:
    return max(256, 4 * math.isqrt(rows))


def _looked_up(
    data: DataFrame, queries: DataFrame, function: Callable, schema: str, per_task: int = LOOKUPS_PER_TASK
) -> DataFrame:
    """``function`` on the data and queries of each ``cell``; cells with very many queries
    are split over salts, with a copy of their (bounded) data for each."""
    queries = materialise(queries, "queries")
    hot = materialise(
        queries.groupBy("cell").count().filter(F.col("count") > per_task)
        .select("cell", F.ceil(F.col("count") / per_task).cast("int").alias("_salts")), "hot")
    salts = F.coalesce("_salts", F.lit(1))
    # at most queries / per_task rows
    asked = queries.join(F.broadcast(hot), "cell", "left").withColumn("_salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
    held = data.join(F.broadcast(hot), "cell", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    both = held.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    return both.drop("_salts").groupBy("cell", "_salt").applyInPandas(function, schema)


# ---------------------------------------------------------------- neighbours in the plane


def _taken(best: np.ndarray, d: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """``best`` (sorted rows) after one more neighbour at ``d`` that counts ``copies`` times."""
    k = best.shape[1]
    more = np.where(copies[:, None] > np.arange(k), d[:, None], np.inf)
    return np.sort(np.concatenate([best, more], axis=1), axis=1)[:, :k]


def _scan(px, py, copies, qx, qy, left, right, best) -> np.ndarray:
    """Walk from each query both ways along y until the gap alone reaches its k-th distance.

    Points are sorted by y; ``left`` and ``right`` are the first places to look at.
    """
    best, n = best.copy(), len(py)
    for at, step in ((left.copy(), -1), (right.copy(), 1)):
        active = np.arange(len(qx))
        while True:
            active = active[(at[active] >= 0) & (at[active] < n)]
            gap = np.abs(py[at[active]] - qy[active])
            near = gap < best[active, -1]
            active, gap = active[near], gap[near]
            if not len(active):
                break
            p = at[active]
            d = np.maximum(gap, np.abs(px[p] - qx[active]))
            closer = d < best[active, -1]
            some = active[closer]
            best[some] = _taken(best[some], d[closer], copies[p[closer]])
            at[active] += step
    return best


def _turned(x: np.ndarray, y: np.ndarray, k: int) -> bool:
    """Whether to walk along x instead of y: along the axis on which points lie further apart."""
    if len(x) <= k:
        return False
    apart = [np.median(v[k:] - v[:-k]) for v in map(np.sort, (x, y))]
    return bool(apart[0] > apart[1])


def _lists(values) -> pd.Series:
    return pd.Series(list(values), dtype=object)


def _within(k: int, boxes: np.ndarray):
    """Distances within the own strip, and the other strips that might hold nearer points."""
    cells, low_x, high_x, low_y, high_y = boxes

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        turned = _turned(pdf["x"].to_numpy(), pdf["y"].to_numpy(), k)
        pdf = pdf.sort_values("x" if turned else "y", kind="stable")
        x, y, copies = (pdf[c].to_numpy() for c in ("x", "y", "copies"))
        across, along = (y, x) if turned else (x, y)
        n, at = len(pdf), np.arange(len(pdf))
        best = np.where(copies[:, None] - 1 > np.arange(k), 0.0, np.inf)
        best = _scan(across, along, copies, across, along, at - 1, at + 1, best)
        r = best[:, -1]
        slack = 4 * np.finfo(float).eps * (np.abs(x) + r)  # of the rounded sums; the gaps below decide
        # strips lie one after another along x
        first = np.searchsorted(high_x, x - r - slack, side="left")
        last = np.searchsorted(low_x, x + r + slack, side="right")
        many = np.maximum(last - first, 0)
        point = np.repeat(at, many)
        strip = np.arange(len(point)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        gap_x = np.maximum(np.maximum(low_x[strip] - x[point], x[point] - high_x[strip]), 0)
        gap_y = np.maximum(np.maximum(low_y[strip] - y[point], y[point] - high_y[strip]), 0)
        reached = (np.maximum(gap_x, gap_y) < r[point]) & (cells[strip] != pdf["cell"].iloc[0])
        visits = np.split(cells[strip[reached]].astype(np.int64), np.cumsum(np.bincount(point[reached], minlength=n))[:-1])
        return pd.DataFrame({"id": pdf["id"].to_numpy(), "x": x, "y": y, "copies": copies, "best": _lists(best), "visits": _lists(visits)})

    return find


def _visited(k: int):
    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        points, asks = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        out = pd.DataFrame({"id": asks["id"].to_numpy(), "best": _lists([[]] * len(asks))})
        if len(points) and len(asks):
            turned = _turned(points["x"].to_numpy(), points["y"].to_numpy(), k)
            across, along = ("y", "x") if turned else ("x", "y")
            points = points.sort_values(along, kind="stable")
            px, py, qx, qy = (f[c].to_numpy() for f in (points, asks) for c in (across, along))
            right = np.searchsorted(py, qy)
            reach = np.repeat(asks["reach"].to_numpy()[:, None], k, axis=1)
            out["best"] = _lists(_scan(px, py, points["copies"].to_numpy(), qx, qy, right - 1, right, reach))
        return out

    return find


def nearest_distances(points: DataFrame, k: int, per_task: int = LOOKUPS_PER_TASK, strip_rows: int | None = None) -> DataFrame:
    """``id, x, y, copies, r``: distance of each point to its k-th neighbour, copies counted.

    ``points`` are different points ``id, x, y, copies``, written, with ids along x.
    """
    ship_package(points.sparkSession)
    rows = points.count()
    strip = strip_rows or _cell_rows(rows)
    dealt = points.withColumn("cell", F.expr(f"id div {strip}"))
    boxes = dealt.groupBy("cell").agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).orderBy("cell").collect()
    table = np.array([list(map(float, b)) for b in boxes]).T if boxes else np.zeros((5, 0))
    schema = "id long, x double, y double, copies long, best array<double>, visits array<long>"
    own = materialise(dealt.groupBy("cell").applyInPandas(_within(k, table), schema), "own")
    queries = own.select("id", "x", "y", F.element_at("best", k).alias("reach"), F.explode("visits").alias("cell"))
    other = _looked_up(dealt.drop("id"), queries, _visited(k), "id long, best array<double>", per_task)
    # a strip without nearer points gives back the reach itself, which changes no k-th distance
    lists = own.select("id", "x", "y", "copies", "best").unionByName(other, allowMissingColumns=True)
    return (
        lists.groupBy("id").agg(*[F.max(c).alias(c) for c in ("x", "y", "copies")], F.flatten(F.collect_list("best")).alias("all"))
        .select("id", "x", "y", "copies", F.element_at(F.array_sort("all"), k).alias("r"))
    )


# ---------------------------------------------------------------- counts along an axis


def _prefix(values: np.ndarray, v: np.ndarray, r: np.ndarray, upper: bool) -> np.ndarray:
    """How many of the sorted ``values`` come before an end of each open interval v - r to v + r.

    Up to the upper end are those below v, equal to v, or less than r above it; up to the
    lower end those at least r below v.  Differences decide, not rounded sums.
    """

    def before(at: np.ndarray, i: np.ndarray) -> np.ndarray:
        w = values[at]
        return (w <= v[i]) | (w - v[i] < r[i]) if upper else (w < v[i]) & (v[i] - w >= r[i])

    found = np.searchsorted(values, v + r if upper else v - r)
    for step in (1, -1):
        active = np.arange(len(v))
        while len(active):
            at = found[active] - (step < 0)
            active, at = active[(at >= 0) & (at < len(values))], at[(at >= 0) & (at < len(values))]
            active = active[before(at, active) == (step > 0)]
            found[active] += step
    return found


def _ends(firsts: np.ndarray, axis: str):
    """The blocks in which both ends of every point's interval lie."""

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            v, r = pdf[axis].to_numpy(), pdf["r"].to_numpy()
            for upper in (True, False):
                cell = _prefix(firsts, v, r, upper) - 1
                there = cell >= 0
                yield pd.DataFrame({"cell": cell, "id": pdf["id"], "v": v, "r": r, "upper": upper})[there]

    return route


def _totals(pdf: pd.DataFrame) -> pd.DataFrame:
    held, asks = pdf[~pdf["asks"]].sort_values("v"), pdf[pdf["asks"]]
    values, totals = held["v"].to_numpy(), held["total"].to_numpy()
    parts = []
    for upper, sign in ((True, 1), (False, -1)):
        some = asks[asks["upper"] == upper]
        if len(some):
            at = _prefix(values, some["v"].to_numpy(), some["r"].to_numpy(), upper) - 1
            parts.append(pd.DataFrame({"id": some["id"].to_numpy(), "n": sign * totals[at]}))
    return pd.concat(parts) if parts else pd.DataFrame({"id": pd.Series([], dtype="int64"), "n": pd.Series([], dtype="int64")})


def counts_within(points: DataFrame, axis: str, per_task: int = LOOKUPS_PER_TASK, block_rows: int | None = None) -> DataFrame:
    """``id, n``: rows whose ``axis`` value is nearer than ``r``, the row itself and its equals included."""
    sums = points.groupBy(F.col(axis).alias("v")).agg(F.sum("copies").alias("copies"))
    ordered = index_rows(sums, ["v"])
    block = block_rows or _cell_rows(ordered.count())
    totals = materialise(running_sums(ordered, {"total": "copies"}).select(
        F.expr(f"rn div {block}").alias("cell"), "v", F.col("total").cast("long").alias("total")), "totals")
    firsts = np.array([r[1] for r in totals.groupBy("cell").agg(F.min("v")).orderBy("cell").collect()], float)
    ends = points.select("id", axis, "r").mapInPandas(
        _ends(firsts, axis), "cell long, id long, v double, r double, upper boolean")
    return _looked_up(totals, ends, _totals, "id long, n long", per_task).groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- mutual information


def knn_mutual_information(
    df: DataFrame, x: str, y: str, k: int = 3, scaled: bool = True, cell_rows: int | None = None, per_task: int = LOOKUPS_PER_TASK
) -> DataFrame:
    """One row ``mutual_information`` (nats, not below 0) and ``n`` of columns ``x`` and ``y``.

    ``scaled`` divides each column by its population standard deviation, as distances in the
    plane compare both.  Rows with a null, NaN or infinite value are left out.  With fewer
    than two rows the information is 0; ``k`` is at most one less than the rows.  A row whose
    k-th distance is 0 (ties) counts the rows equal to it along each axis.
    """
    number = [F.col(c).cast("double").alias(n) for c, n in ((x, "x"), (y, "y"))]
    finite = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.abs(c) < F.lit(math.inf)) for c in "xy"])
    rows = df.select(*number).filter(finite)
    if scaled:
        spread = rows.agg(F.stddev_pop("x"), F.stddev_pop("y")).first()
        rows = rows.select(*[(F.col(c) / (s or 1.0)).alias(c) for c, s in zip("xy", spread)])
    merged = materialise(rows.groupBy("x", "y").agg(F.count("*").alias("copies")), "points")
    total, *different = merged.agg(F.sum("copies"), F.approx_count_distinct("x"), F.approx_count_distinct("y")).first()
    if (total or 0) < 2:
        return df.sparkSession.createDataFrame([(0.0, total or 0)], "mutual_information double, n long")
    k = min(k, total - 1)
    if different[1] > different[0]:  # the estimate is the same with the axes exchanged
        merged = merged.select(F.col("y").alias("x"), F.col("x").alias("y"), "copies")
    points = materialise(index_rows(merged, ["x", "y"], into="id"), "points")
    near = materialise(nearest_distances(points, k, per_task, cell_rows), "nearest")
    found = near.select("id", "copies")
    for axis in "xy":
        found = found.join(counts_within(near, axis, per_task, cell_rows).withColumnRenamed("n", f"n_{axis}"), "id")
    means = [F.sum(F.col("copies") * digamma(F.col(f"n_{a}"))) / F.sum("copies") for a in "xy"]
    information = digamma(F.lit(total)) + digamma(F.lit(k)) - means[0] - means[1]
    return found.agg(F.greatest(information, F.lit(0.0)).alias("mutual_information"), F.sum("copies").alias("n"))
