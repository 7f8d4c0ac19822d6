"""Gradient-boosted trees on look-back windows, for many targets at a time.

Windows are cut into bins once and written as bytes.  A level of the trees of *all* targets
takes one pass over the training rows: tasks add up, per target, node, feature and bin, how
many rows there are and what is still to be explained; the sums of tasks meet in groups, one
message per target, and each target's splits are found in a task of its own.  The driver
holds the trees only, whose size does not depend on the rows.

The features of a target are the whole look-back of its own column and the last row of every
column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import materialise, ship_package

# Settings of the forecaster.
ROUNDS, DEPTH, BINS, RATE, SHRINK = 12, 3, 16, 0.3, 1.0
#: Groups in which the tasks' sums are added before those of a target meet.
GROUPS = 64
#: Rows whose places in the sums stay in a core's cache.
ROWS_AT_ONCE = 1_024

_SUMS = "t int, g int, v array<double>"
_SPLITS = "t int, node int, feature int, cut int, low double, high double"


class Trees:
    """One tree per target of full depth: node ``i`` has children ``2i`` and ``2i + 1``.

    A row goes right if the bin of ``feature`` is above ``cut``; nodes without a split
    (``feature`` -1) send all rows left.
    """

    def __init__(self, targets: int, depth: int):
        self.depth = depth
        self.feature = np.full((targets, 2**depth), -1)
        self.cut = np.zeros((targets, 2**depth), np.int64)
        self.value = np.zeros((targets, 2**depth))

    def nodes(self, bins: np.ndarray, target: int, levels: int) -> np.ndarray:
        at, every = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(levels):
            feature = self.feature[target][at]
            at = 2 * at + ((feature >= 0) & (bins[every, feature] > self.cut[target][at]))
        return at

    def values(self, bins: np.ndarray, target: int) -> np.ndarray:
        return self.value[target][self.nodes(bins, target, self.depth) - 2**self.depth]


def _target_bins(x: np.ndarray, target: int) -> np.ndarray:
    """The features of one target, from bins of shape rows, look-back, columns."""
    own = x[:, :, target] if target < x.shape[2] else x[:, :, :0].reshape(len(x), 0)
    return np.concatenate([own, x[:, -1, :]], axis=1)


def _unpacked(batch: pa.RecordBatch, lookback: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(-1, lookback, columns)
    return x, batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def best_splits(sums: np.ndarray, rate: float, shrink: float) -> list[tuple[int, int, int, float, float]]:
    """Per node of a level (place, feature, cut, low, high), from ``sums[node, feature, bin, (n, residual)]``.

    The split lowers the squared error most; of equal ones the first feature and cut is taken.
    """
    out = []
    for place, node in enumerate(sums):
        n, total = node[0, :, 0].sum(), node[0, :, 1].sum()
        below = node.cumsum(axis=1)[:, :-1]
        n_low, s_low = below[..., 0], below[..., 1]
        n_high, s_high = n - n_low, total - s_low
        gain = s_low**2 / (n_low + shrink) + s_high**2 / (n_high + shrink) - total**2 / (n + shrink)
        gain = np.where((n_low > 0) & (n_high > 0), gain, 0.0)
        best = int(gain.argmax())
        if gain.flat[best] <= 1e-12 * max(total**2 / (n + shrink), 1.0):
            whole = rate * total / (n + shrink)
            out.append((place, -1, 0, whole, whole))
            continue
        f, c = divmod(best, gain.shape[1])
        out.append((place, f, c, rate * s_low[f, c] / (n_low[f, c] + shrink), rate * s_high[f, c] / (n_high[f, c] + shrink)))
    return out


def boosted_forecast(
    windows: DataFrame, targets: Sequence[str], rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS,
    rate: float = RATE, shrink: float = SHRINK, split_column: str = "split", window: str = "window", rn: str = "rn",
) -> DataFrame:
    """Truth and prediction of the test rows in long form: ``rn, Sensor_ID, truth, prediction``.

    Target ``i`` is the one of the window's column ``i``; further targets see the last row only.
    Bins are equal shares (to the rank error of Spark's quantiles) of a column over the
    training rows; missing values lie in the last bin.  Rows without every target are left out.
    Without training rows the result is empty.
    """
    spark = windows.sparkSession
    ship_package(spark)
    known = windows.filter(F.col(split_column).isin("train", "test")).dropna(subset=list(targets))
    train = known.filter(F.col(split_column) == "train")
    head = train.select(F.size(window).alias("lookback"), F.size(F.get(window, F.lit(0))).alias("columns")).first()
    lookback, columns, count = (head.lookback, head.columns, len(targets)) if head else (1, 1, len(targets))
    last = [F.get(F.element_at(window, -1), F.lit(c)) for c in range(columns)]
    base, cuts = np.zeros(count), [np.zeros(0)] * columns
    if head:
        shares = [i / bins for i in range(1, bins)]
        found = train.agg(*[F.avg(t) for t in targets], *[F.percentile_approx(F.when(~F.isnan(x), x), shares) for x in last]).first()
        base = np.array(found[:count], float)
        cuts = [np.unique(np.array(c if c is not None else [], float)) for c in found[count:]]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("w").flatten().flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, lookback, columns)
            x = np.stack([np.searchsorted(c, raw[:, :, i]) for i, c in enumerate(cuts)], axis=2).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rn"), batch.column("train"), pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y")],
                ["rn", "train", "x", "y"],
            )

    asked = known.select(
        F.col(rn).cast("long").alias("rn"), (F.col(split_column) == "train").alias("train"), F.col(window).alias("w"),
        F.array(*[F.col(t).cast("double") for t in targets]).alias("y"),
    )
    kind = "rn long, train boolean, x binary, y array<double>"
    rows = materialise((asked if head else asked.limit(0)).mapInArrow(binned, kind), "binned")
    forest: list[Trees] = []
    features = lookback + columns

    def level_sums(level: int):
        shared = spark.sparkContext.broadcast(forest)  # a few numbers per target, round and node

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            *done, growing = shared.value
            nodes = 2**level
            total = np.zeros((count, nodes * features * bins, 2))
            for batch in batches:
                whole, truth = _unpacked(batch, lookback, columns)
                for first in range(0, len(whole), ROWS_AT_ONCE):
                    x, y = whole[first : first + ROWS_AT_ONCE], truth[first : first + ROWS_AT_ONCE]
                    for t in range(count):
                        own = _target_bins(x, t)
                        rest = y[:, t] - base[t] - sum(tree.values(own, t) for tree in done)
                        node = growing.nodes(own, t, level) - nodes
                        width = own.shape[1]
                        at = (node * (features * bins))[:, None] + (np.arange(width) * bins + own)
                        at = at.ravel()
                        total[t, :, 0] += np.bincount(at, minlength=nodes * features * bins)
                        total[t, :, 1] += np.bincount(at, np.repeat(rest, width), nodes * features * bins)
            group = TaskContext.get().partitionId() % GROUPS
            for t in range(count):
                yield pa.RecordBatch.from_pydict({
                    "t": pa.array([t], pa.int32()), "g": pa.array([group], pa.int32()), "v": pa.array([total[t].ravel()], pa.list_(pa.float64())),
                })

        return partial

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"t": pdf["t"].iloc[:1], "g": pdf["g"].iloc[:1], "v": [np.sum(np.stack(pdf["v"]), axis=0)]})

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.sum(np.stack(pdf["v"]), axis=0).reshape(-1, features, bins, 2)
        # a target without a column of its own has fewer features; the rest stays empty
        best = pd.DataFrame(best_splits(sums, rate, shrink), columns=["node", "feature", "cut", "low", "high"])
        return best.assign(t=pdf["t"].iloc[0])[["t", "node", "feature", "cut", "low", "high"]]

    fitted = rows.filter("train").select("x", "y")
    for _ in range(rounds if head else 0):
        tree = Trees(count, depth)
        forest.append(tree)
        for level in range(depth):
            sums = fitted.mapInArrow(level_sums(level), _SUMS).groupBy("t", "g").applyInPandas(add, _SUMS)
            for r in sums.groupBy("t").applyInPandas(split, _SPLITS).collect():  # one row per target and node
                at = 2**level + r.node
                tree.feature[r.t, at], tree.cut[r.t, at] = r.feature, r.cut
                if level == depth - 1:
                    tree.value[r.t, 2 * at - 2**depth : 2 * at - 2**depth + 2] = r.low, r.high
    shared = spark.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _unpacked(batch, lookback, columns)
            found = [base[t] + sum(tree.values(_target_bins(x, t), t) for tree in shared.value) + np.zeros(len(x)) for t in range(count)]
            yield pa.RecordBatch.from_pydict({
                "rn": pa.array(np.repeat(batch.column("rn").to_numpy(), count)),
                "Sensor_ID": pa.array([str(t) for t in range(1, count + 1)] * len(x)),
                "truth": pa.array(y.ravel()), "prediction": pa.array(np.stack(found, axis=1).ravel()),
            })

    return rows.filter("not train").select("rn", "x", "y").mapInArrow(score, "rn long, Sensor_ID string, truth double, prediction double")
