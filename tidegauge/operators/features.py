"""Feature search: how much a rolling z-score tells about the next value."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.joins import lookup_join
from tidegauge.operators.ordered import order_statistics, with_halo
from tidegauge.operators.series import rolling_zscore
from tidegauge.session import materialise, ship_package, shuffle_tasks

PAIR_CHUNK_ROWS = 8_192  # thousands of pairs per row: smaller chunks, more tasks
LONGS_PER_TASK = 32  # long windows that one task scores for a chunk

Z_LIMIT = 5.0
Z_BINS = 21  # odd, so that the frequent z = 0 lies inside a bin
Y_BINS = 16


def mutual_information(
    counts: DataFrame, x: str, y: str, n: str = "n", keys: Sequence[str] = ()
) -> DataFrame:
    """Mutual information (nats) per key from joint counts ``(keys, x, y, n)``.

    Works on grouped counts only, whose number is bounded by the bins:
    ``I = log N + sum n log n / N - sum n_x log n_x / N - sum n_y log n_y / N``.
    """

    def entropy_sum(by: Sequence[str], into: str) -> DataFrame:
        totals = counts.groupBy(*keys, *by).agg(F.sum(n).cast("double").alias("_t"))
        return totals.groupBy(*keys).agg(
            F.sum(F.col("_t") * F.log("_t")).alias(into), F.sum("_t").alias("_n")
        )

    joint = entropy_sum([x, y], "_xy")
    left = entropy_sum([x], "_x").drop("_n")
    right = entropy_sum([y], "_y").drop("_n")
    both = lookup_join(lookup_join(joint, left, list(keys)), right, list(keys))
    information = F.log("_n") + (F.col("_xy") - F.col("_x") - F.col("_y")) / F.col("_n")
    return both.select(*keys, information.alias("mutual_information"))


def window_pairs(shorts: Sequence[int], longs: Sequence[int]) -> list[tuple[int, int]]:
    return [(s, g) for g in longs for s in shorts if s < g]


def _equal_shares(df: DataFrame, column: str, bins: int) -> np.ndarray:
    """Values that cut the column into ``bins`` bins of about equally many rows.

    Unlike equal widths, these keep telling rows apart when a single value lies far out.
    """
    x = df.select(F.col(column).cast("double").alias("_x"))
    rows = x.agg(F.count("_x")).first()[0]
    places = sorted({i * rows // bins for i in range(1, bins)}) if rows else []
    wanted = df.sparkSession.createDataFrame([(p,) for p in places], "pos long")
    found = {r["pos"]: r["_x"] for r in order_statistics(x, "_x", wanted).collect()}
    return np.array([found[i * rows // bins] for i in range(1, bins)] if rows else [])


def pair_counts(
    df: DataFrame, column: str, shorts: Sequence[int], longs: Sequence[int], rn: str = "rn",
    chunk: int = PAIR_CHUNK_ROWS,
) -> DataFrame:
    """Joint counts ``(short_window, long_window, zb, yb, n)`` for every window pair.

    Chunks of the series are counted in their tasks with running sums, so a pair
    costs a few vector operations per chunk and only bounded counts are shuffled.
    Rows whose long window is constant have no z-score and are left out.  The next value is
    put into bins of about equally many rows.
    """
    ship_package(df.sparkSession)
    pairs = window_pairs(shorts, longs)
    widest = max(g for _, g in pairs)
    bounds = df.agg(
        F.min(column).alias("_low"), F.max(column).alias("_high"), F.avg(column).alias("_mid"),
    )
    edges = _equal_shares(df, column, Y_BINS)
    source = lookup_join(df.select(rn, F.col(column).cast("double").alias("_x")), bounds, [])
    blocks = [list(longs)[i : i + LONGS_PER_TASK] for i in range(0, len(longs), LONGS_PER_TASK)]
    pieces = with_halo(source, rn, before=widest, after=1, chunk=chunk).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1)))
    )
    schema = "short_window int, long_window int, zb int, yb int, n long"

    def count_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(rn)
        x = pdf["_x"].to_numpy(dtype=float)
        place, own = pdf[rn].to_numpy(), pdf["_own"].to_numpy()
        low, high, mid = (pdf[c].iloc[0] for c in ("_low", "_high", "_mid"))
        here = ~np.isnan(x)
        apart = np.where(here, x - mid, 0.0)
        sums = np.concatenate([[0.0], np.cumsum(apart)])
        squares = np.concatenate([[0.0], np.cumsum(apart**2)])
        seen = np.concatenate([[0], np.cumsum(here)])
        # own rows that have a next value
        at = np.flatnonzero(own[:-1] & here[1:]) if len(x) > 1 else np.zeros(0, dtype=int)
        yb = np.searchsorted(edges, x[at + 1], side="right")
        full = {}

        def mean(rows):
            if rows not in full:
                begin = np.maximum(at + 1 - rows, 0)
                full[rows] = (sums[at + 1] - sums[begin]) / rows, begin
            return full[rows]

        cells_found, labels = [], []
        for g in blocks[pdf["_block"].iloc[0]]:
            long_mean, begin = mean(g)
            variance = (squares[at + 1] - squares[begin] - g * long_mean**2) / (g - 1)
            # a null drops the rows whose long window holds it, and no others
            usable = (place[at] >= g - 1) & (seen[at + 1] - seen[begin] == g) & (variance > 1e-12 * max((high - low) ** 2, 1e-300))
            long_part, deviation, y_part = long_mean[usable], np.sqrt(variance[usable]), yb[usable]
            for s in shorts:
                if s >= g:
                    continue
                short_mean, _ = mean(s)
                z = (short_mean[usable] - long_part) / deviation
                zb = np.floor((np.round(z, 9) + Z_LIMIT) * (Z_BINS / (2 * Z_LIMIT)))
                zb = np.clip(zb, 0, Z_BINS - 1).astype(int)
                cells = np.bincount(zb * Y_BINS + y_part, minlength=Z_BINS * Y_BINS)
                cells_found.append(cells)
                labels.append((s, g))
        if not labels:
            return pd.DataFrame(columns=["short_window", "long_window", "zb", "yb", "n"])
        counts = np.array(cells_found)
        pair, cell = np.nonzero(counts)
        windows = np.array(labels)[pair]
        return pd.DataFrame(
            {
                "short_window": windows[:, 0], "long_window": windows[:, 1],
                "zb": cell // Y_BINS, "yb": cell % Y_BINS, "n": counts[pair, cell],
            }
        )

    return (
        pieces.repartition(shuffle_tasks(df.sparkSession), "_chunk", "_block")
        .groupBy("_chunk", "_block")
        .applyInPandas(count_pairs, schema)
        .groupBy("short_window", "long_window", "zb", "yb")
        .agg(F.sum("n").alias("n"))
    )


def window_pair_scores(
    df: DataFrame, column: str, shorts: Sequence[int], longs: Sequence[int], rn: str = "rn"
) -> DataFrame:
    """Mutual information of each pair's z-score with the next value."""
    counts = materialise(pair_counts(df, column, shorts, longs, rn), "pair-counts")
    return mutual_information(counts, "zb", "yb", keys=["short_window", "long_window"])


def best_window_pair(
    df: DataFrame, column: str, shorts: Sequence[int] = range(1, 13),
    longs: Sequence[int] = range(2, 13), train_share: float = 0.9, rn: str = "rn",
) -> DataFrame:
    """The pair with the highest score on the training part of the series.

    The training part is the first ``int((rows - 2) * train_share)`` rows; the first
    pair wins a tie.
    """
    cut = int((df.count() - 2) * train_share)
    # the row after the cut only serves as a target
    scores = window_pair_scores(df.filter(F.col(rn) <= cut), column, shorts, longs, rn)
    order = F.struct(
        F.round("mutual_information", 9), -F.col("short_window"), -F.col("long_window")
    )
    best = F.struct("short_window", "long_window", "mutual_information")
    return scores.agg(F.max_by(best, order).alias("best")).select("best.*")


HORIZONS = {
    "short": (range(1, 13), range(2, 13)),
    "medium": (range(1, 13), range(200, 301)),
    "long": (range(1, 13), range(400, 801)),
}


def horizon_zscores(
    df: DataFrame, columns: str | Sequence[str], rn: str = "rn", horizons=None
) -> DataFrame:
    """Search the best pair per column and horizon and add its z-score as a feature.

    All searches read the frame as it came; the features are added afterwards.  A series
    too short for a horizon gets z-scores of 0.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    found = {
        (column, name): best_window_pair(df, column, shorts, longs, rn=rn).first()
        for column in columns
        for name, (shorts, longs) in (horizons or HORIZONS).items()
    }
    for (column, name), best in found.items():
        into = f"{column}_{name}_zscore"
        if best["short_window"] is None:
            df = df.withColumn(into, F.lit(0.0))
        else:
            df = rolling_zscore(df, column, best["short_window"], best["long_window"], into, rn=rn)
    return df
