"""Regression forests that no single process holds.

Rows are dealt into bags of bounded size; a bag's trees are grown by one task on random
weights of its rows, over binned features, one level of all nodes at a time.  Every row is
in some bag; bags grow before there are more of them than trees asked for, so that scoring
does not take longer per row.  Only bags of the largest size make more trees.  The forest is a
table of nodes in the shared folder.  Scoring takes it in parts of bounded bytes: each part
is broadcast, adds its trees' sum to every row, and is dropped.  What the driver and a task
hold therefore depends on the size of a bag and of a part, not on the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import materialise, ship_package, shuffle_tasks, spread

# Settings of the forest.
TREES, DEPTH, BINS = 200, 20, 32
BAG_ROWS = 50_000
#: A bag of this many rows takes a few hundred MB in its task.
LARGEST_BAG = 1_000_000
#: Rows that one task should score: small files, but every tree walks over each row.
SCORED_PER_TASK = 50_000
LEAST_BAGS = 16
#: Of one broadcast part of a forest.
PART_BYTES = 64 * 2**20
NODE_BYTES = 32

_NODES = "tree int, node long, feature int, threshold double, value double"


@dataclass(frozen=True)
class Forest:
    """``nodes``: one row per node, numbered 1 for the root and 2i, 2i + 1 for the children of
    i; ``feature`` is -1 for a leaf.  A row goes left if its value is at most ``threshold``."""

    nodes: DataFrame
    features: tuple[str, ...]
    trees: int

    def parts(self, part_bytes: int = PART_BYTES) -> list[tuple[int, int, int]]:
        """Runs of trees ``(first, last, nodes)`` whose nodes fit into ``part_bytes``."""
        out: list[tuple[int, int, int]] = []
        counts = self.nodes.groupBy("tree").count().orderBy("tree").collect()  # one row per tree
        for tree, nodes in counts:
            if out and (out[-1][2] + nodes) * NODE_BYTES <= part_bytes:
                out[-1] = (out[-1][0], tree, out[-1][2] + nodes)
            else:
                out.append((tree, tree, nodes))
        return out


# ---------------------------------------------------------------- growing


def _best_splits(bins, weights, sums, node, nodes, allowed, n_bins):
    """Per node the gain, feature and bin of the split that lowers the squared error most."""
    total_w, total_s = np.bincount(node, weights, nodes), np.bincount(node, sums, nodes)
    gain, feature, cut = np.full(nodes, 0.0), np.full(nodes, -1), np.zeros(nodes, np.int64)
    before = total_s**2 / total_w
    for f in range(bins.shape[1]):
        at = node * n_bins + bins[:, f]
        w = np.bincount(at, weights, nodes * n_bins).reshape(nodes, n_bins).cumsum(axis=1)[:, :-1]
        s = np.bincount(at, sums, nodes * n_bins).reshape(nodes, n_bins).cumsum(axis=1)[:, :-1]
        rest = total_w[:, None] - w
        with np.errstate(divide="ignore", invalid="ignore"):
            score = s**2 / w + (total_s[:, None] - s) ** 2 / rest - before[:, None]
        score = np.where((w > 0) & (rest > 0) & allowed[:, f][:, None], score, -np.inf)
        best = score.argmax(axis=1)
        found = score[np.arange(nodes), best]
        better = found > gain + 1e-9 * np.abs(before)
        gain[better], feature[better], cut[better] = found[better], f, best[better]
    return feature, cut, total_s / total_w


def grow_tree(bins: np.ndarray, y: np.ndarray, cuts: Sequence[np.ndarray], depth: int, rng: np.random.Generator, share: float = 1 / 3, weights: np.ndarray | None = None):
    """One tree on randomly weighted rows as arrays ``node, feature, threshold, value``."""
    weights = rng.poisson(1.0, len(y)).astype(float) if weights is None else weights
    if not weights.any():
        weights = np.ones(len(y))
    kept = weights > 0
    bins, weights, middle = bins[kept], weights[kept], float(np.average(y[kept], weights=weights[kept]))
    sums = weights * (y[kept] - middle)
    n_bins, mtry = max(len(c) for c in cuts) + 1, max(1, math.ceil(bins.shape[1] * share))
    ids, node, out = np.array([1]), np.zeros(len(weights), np.int64), []
    for level in range(depth + 1):
        order = rng.random((len(ids), bins.shape[1])).argsort(axis=1).argsort(axis=1)
        feature, cut, value = _best_splits(bins, weights, sums, node, len(ids), order < mtry, n_bins)
        if level == depth:
            feature[:] = -1
        split = feature >= 0
        threshold = np.array([cuts[f][c] if f >= 0 else np.nan for f, c in zip(feature, cut)])
        out.append((ids, feature, threshold, value + middle))
        if not split.any():
            break
        stays = split[node]
        bins, weights, sums, node = bins[stays], weights[stays], sums[stays], node[stays]
        right = bins[np.arange(len(node)), feature[node]] > cut[node]
        place = np.cumsum(split) - 1
        node = 2 * place[node] + right
        ids = np.repeat(2 * ids[split], 2) + np.tile([0, 1], split.sum())
    return [np.concatenate(column) for column in zip(*out)]


def _bag_trees(cuts: list[np.ndarray], bags: int, trees: int, depth: int, seed: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        bag, y = int(pdf["bag"].iloc[0]), pdf["y"].to_numpy()
        # a missing value lies beyond the last cut
        bins = np.stack([np.searchsorted(c, pdf[f"x{i}"].to_numpy(float)) for i, c in enumerate(cuts)], axis=1)
        out = []
        for tree in range(bag, trees, bags):
            node, feature, threshold, value = grow_tree(bins, y, cuts, depth, np.random.default_rng((seed, tree)))
            out.append(pd.DataFrame({"tree": tree, "node": node, "feature": feature, "threshold": threshold, "value": value}))
        return pd.concat(out)

    return grow


def bag_size(rows: int, trees: int) -> int:
    """Rows of a bag: so many that every tree has a bag, up to the largest size."""
    return max(BAG_ROWS, min(math.ceil(rows / trees), LARGEST_BAG))


def bags_for(rows: int, bag_rows: int) -> tuple[int, int]:
    """Number of bags, and in how many of them each row is."""
    bags = max(LEAST_BAGS, math.ceil(rows / bag_rows))
    return bags, min(bags, max(1, bags * bag_rows // max(rows, 1)))


def grow_forest(
    df: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
    bag_rows: int | None = None, seed: int = 42,
) -> Forest:
    """A forest on all rows of ``df`` with a label; missing features go right at every split.

    Bags have ``bag_rows`` rows, by default those of :func:`bag_size`.  A third of the features
    is tried per node.  No labelled row gives a forest without trees.
    """
    ship_package(df.sparkSession)
    rows = materialise(
        df.filter(F.col(label).isNotNull()).select(
            *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"),
            F.monotonically_increasing_id().alias("row")),
        "bagged")
    count = rows.count()
    if not count:
        return Forest(df.sparkSession.createDataFrame([], _NODES), tuple(features), 0)
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")), shares) for i in range(len(features))]).first()
    cuts = [np.unique(np.array(c if c is not None else [0.0], float)) for c in found]
    count_bags, copies = bags_for(count, bag_rows or bag_size(count, trees))
    total = max(trees, count_bags)
    first = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(count_bags))
    dealt = rows.withColumn("bag", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(copies - 1)), lambda j: F.pmod(first + j, F.lit(count_bags)).cast("int"))))
    # few rows but long work: no merging of small partitions, and a task per bag if there are many
    dealt = dealt.drop("row").repartition(max(shuffle_tasks(df.sparkSession), count_bags), "bag")
    nodes = dealt.groupBy("bag").applyInPandas(_bag_trees(cuts, count_bags, total, depth, seed), _NODES)
    return Forest(materialise(nodes, "forest"), tuple(features), total)


# ---------------------------------------------------------------- scoring


def _packed(nodes: pa.Table) -> list[tuple[np.ndarray, ...]]:
    """Per tree the arrays of its nodes and the place of each left child; the right one follows."""
    columns = {c: nodes.column(c).to_numpy() for c in ("tree", "node", "feature", "threshold", "value")}
    order = np.lexsort((columns["node"], columns["tree"]))
    columns = {c: v[order] for c, v in columns.items()}
    out = []
    for part in np.split(np.arange(len(order)), np.flatnonzero(np.diff(columns["tree"])) + 1):
        node = columns["node"][part]
        out.append((np.searchsorted(node, 2 * node), *[columns[c][part] for c in ("feature", "threshold", "value")]))
    return out


def _sum_of_trees(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    total, every = np.zeros(len(x)), np.arange(len(x))
    for left, feature, threshold, value in trees:
        at, active = np.zeros(len(x), np.int64), every
        while len(active := active[feature[at[active]] >= 0]):
            here = at[active]
            at[active] = left[here] + ~(x[active, feature[here]] <= threshold[here])
        total += value[at]
    return total


def predict(forest: Forest, df: DataFrame, into: str = "prediction", part_bytes: int = PART_BYTES) -> DataFrame:
    """``df`` with the mean of all trees; null for a forest without trees."""
    spark = df.sparkSession
    parts = forest.parts(part_bytes)
    if not parts:
        return df.withColumn(into, F.lit(None).cast("double"))
    ship_package(spark)
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "scored")
    inputs = spread(rows, rows.count(), SCORED_PER_TASK, "_row").select("_row", *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(forest.features)])
    sums = []
    for first, last, _ in parts:
        table = forest.nodes.filter(F.col("tree").between(first, last)).toArrow()  # at most part_bytes
        shared = spark.sparkContext.broadcast(_packed(table))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]], axis=1)
                total = _sum_of_trees(shared.value, x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total)], ["_row", "_sum"])

        sums.append(materialise(inputs.mapInArrow(score, "_row long, _sum double"), "sums"))
        shared.unpersist()
    total = reduce(DataFrame.unionByName, sums)
    if len(sums) > 1:
        total = total.groupBy("_row").agg(F.sum("_sum").alias("_sum"))
    return rows.join(total, "_row").withColumn(into, F.col("_sum") / forest.trees).drop("_row", "_sum")
