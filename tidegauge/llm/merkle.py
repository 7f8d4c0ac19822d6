"""Merkle manifest of a table, one tree per source, with only every second level stored.

Leaves are hashes of rows, in order within their source.  ``FAN`` consecutive nodes become
the hash of their joined hex digests, level by level, until a source has one subroot; the
ordered subroots form a tree in the same way.  Aligned subtrees of ``FAN ** EVERY`` nodes
are folded by one task each, which discards the levels in between.  A proof walks down
again: each stored level hands its path to the subtrees below it, whose task regenerates
the missing levels from the stored nodes, emits the siblings and discards them.

No task holds more than one batch of rows and one subtree.  A source of any size is many
subtrees, and a table of very many small sources is many rows, so neither is a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.sharding import row_numbers
from tidegauge.llm.tables import keep, ship
from tidegauge.operators.joins import lookup_join
from tidegauge.session import shuffle_tasks

FAN = 16
EVERY = 2
SPAN = FAN**EVERY
#: Subtrees whose proofs are put into one Arrow batch.
_TOGETHER = 8

_NODE = "tree long, at long, height int, hash string"
_PATH = "array<struct<left: string, right: string>>"
_PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


# ---------------------------------------------------------------- hashes as columns


def field(value: Column) -> Column:
    """One value without ambiguity: byte count, colon and text, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Lowercase hex SHA-256 of a row's values; null values count, too."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def siblings(path: Column) -> Column:
    """All siblings of a path from leaf to root, left to right within each level."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


# ---------------------------------------------------------------- subtrees in tasks


def _join(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode("ascii")).hexdigest()


def levels_above(nodes: list[str], levels: int) -> list[list[str]]:
    """``nodes`` and the ``levels`` levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([_join(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole subtrees and the bounds of the subtrees in them.

    Rows come sorted by tree and subtree; the last subtree of a batch waits for the next.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if len(table) == 0:
            continue
        key = np.stack([table.column(c).to_numpy() for c in ("tree", "sub")])
        starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1]).combine_chunks()
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def _folder(stage: int):
    """Each subtree of stored nodes becomes the node that roots it."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _runs(batches):
            hashes, starts = table.column("hash").to_pylist(), bounds[:-1]
            heights = table.column("height").to_numpy()[starts]
            tops = [
                levels_above(hashes[a:b], min(EVERY, int(h) - EVERY * stage))[-1][0]
                for a, b, h in zip(bounds, bounds[1:], heights)
            ]
            head = table.select(["tree", "sub", "height"]).take(pa.array(starts))
            yield from head.rename_columns(["tree", "at", "height"]).append_column("hash", pa.array(tops, pa.string())).to_batches()

    return fold


def _prover(stage: int):
    """Siblings of every node of a subtree; its first row brings the path of its root."""

    def subtree(hashes: list[str], height: int, above: list) -> Iterator[list]:
        levels = levels_above(hashes, min(EVERY, height - EVERY * stage))[:-1]
        for i in range(len(hashes)):
            path = []
            for nodes in levels:
                first = i - i % FAN
                path.append({"left": "".join(nodes[first:i]), "right": "".join(nodes[i + 1 : first + FAN])})
                i //= FAN
            yield path + above

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _runs(batches):
            for k in range(0, len(bounds) - 1, _TOGETHER):
                ends = bounds[k : k + _TOGETHER + 1]
                part = table.slice(ends[0], ends[-1] - ends[0])
                hashes, heights = part.column("hash").to_pylist(), part.column("height").to_numpy()
                above, is_node = part.column("path"), part.column("is_node")
                paths: list = []
                for a, b in zip(ends - ends[0], ends[1:] - ends[0]):
                    paths += subtree(hashes[a + 1 : b], int(heights[a]), above[int(a)].as_py())
                nodes = part.filter(is_node).drop_columns(["sub", "is_node", "path"])
                yield from nodes.append_column("path", pa.array(paths, _PATH_ARROW)).combine_chunks().to_batches()

    return prove


def _together(df: DataFrame, *within: str) -> DataFrame:
    tasks = shuffle_tasks(df.sparkSession)
    return df.repartition(tasks, "tree", "sub").sortWithinPartitions("tree", "sub", *within)


def _stored_levels(leaves: DataFrame) -> list[DataFrame]:
    """The leaves, then the nodes ``EVERY`` levels up, and so on to the last root."""
    ship(leaves.sparkSession)
    highest = leaves.agg(F.max("height")).first()[0] or 0
    stages = [leaves]
    while EVERY * (len(stages) - 1) < highest:
        stage = len(stages) - 1
        below = stages[-1].filter(F.col("height") > EVERY * stage).select(
            "tree", F.expr(f"at div {SPAN}").alias("sub"), "at", "height", "hash")
        stages.append(keep(_together(below, "at").mapInArrow(_folder(stage), _NODE), "merkle"))
    return stages


def _roots(stages: list[DataFrame]) -> DataFrame:
    """``(tree, hash)`` of every tree."""
    done = [s.filter(F.col("height") <= EVERY * i) if i == 0 else
            s.filter((F.col("height") <= EVERY * i) & (F.col("height") > EVERY * (i - 1))) for i, s in enumerate(stages)]
    return reduce(DataFrame.union, [d.select("tree", "hash") for d in done])


def _paths(stages: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest of ``stages`` with the ``path`` of each node to the root of all.

    ``tops`` is ``(tree, path)``: the way from each tree's own root.
    """
    paths = None
    for stage in reversed(range(len(stages))):
        nodes = stages[stage]
        known = nodes.filter(F.col("height") <= EVERY * stage).join(tops, "tree").select(*nodes.columns, "path")
        if paths is not None:
            inner = nodes.filter(F.col("height") > EVERY * stage)
            below = inner.select("*", F.expr(f"at div {SPAN}").alias("sub"), F.lit(True).alias("is_node"), F.lit(None).cast(_PATH).alias("path"))
            above = paths.select("tree", F.col("at").alias("sub"), "height", F.lit(False).alias("is_node"), "path")
            rows = _together(below.unionByName(above, allowMissingColumns=True), "is_node", "at")
            known = known.union(rows.mapInArrow(_prover(stage), known.schema))
        paths = known if stage == 0 else keep(known.select("tree", "at", "height", "path"), "merkle-paths")
    return paths


# ---------------------------------------------------------------- the manifest


@dataclass
class Manifest:
    """Stored levels of all trees, the tree over their roots, and the root of all."""

    stages: list[DataFrame]  # stages[0]: doc, tree, at, height, hash; then every EVERY levels
    top: list[DataFrame]  # the same for the tree over the subroots
    trees: DataFrame  # tree, source, size, subroot
    root: str | None

    def stored(self) -> DataFrame:
        """``(level, tree, at, hash)`` of the stored levels; tree -1 is the one over the subroots."""
        parts = [s.select(F.lit(EVERY * i).alias("level"), "tree", "at", "hash") for i, s in enumerate(self.stages)]
        parts += [s.select(F.lit(EVERY * i).alias("level"), F.lit(-1).cast("long").alias("tree"), "at", "hash") for i, s in enumerate(self.top)]
        return reduce(DataFrame.union, parts)

    def proofs(self) -> DataFrame:
        """Every row's ``doc`` with ``leaf``, ``subroot``, ``root`` and its ``path``."""
        base = self.top[0].sparkSession.createDataFrame([(0, [])], f"tree long, path {_PATH}")
        tops = keep(_paths(self.top, base).select(F.col("at").alias("tree"), "path"), "merkle-tops")
        found = _paths(self.stages, tops)
        subroots = self.trees.select("tree", "subroot")
        return lookup_join(found, subroots, ["tree"]).select(
            "doc", F.col("hash").alias("leaf"), "subroot", F.lit(self.root).alias("root"), "path"
        )


def _height(size: Column) -> Column:
    return reduce(lambda a, b: a + b, [(size > FAN**i).cast("int") for i in range(15)])


def build(df: DataFrame, leaf: Column, source: str = "source", key: str = "doc_id", carry: Sequence[str] = ("doc_id",)) -> Manifest:
    """The manifest of ``df``: one leaf per row, ordered by ``key`` within ``source``.

    Sources are ordered by their UTF-8 bytes, null first; null keys come first, and rows
    that repeat a key are ordered by their hash, so equal rows are interchangeable.  The
    columns in ``carry`` come back with the proofs.  An empty table has no root.
    """
    rows = keep(df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), F.col(source).alias("source"), F.col(key).alias("key"),
        leaf.alias("hash"),
    ), "leaves")
    ordered, _ = row_numbers(rows, ["source", "key", "hash"], "number")
    sizes = keep(ordered.groupBy("source").agg(F.min("number").alias("first"), F.count("*").alias("size")), "sources")
    trees, count = row_numbers(sizes, ["source"], "tree")
    trees = keep(trees, "trees")
    leaves = keep(
        lookup_join(ordered, trees, ["source"], derived=False).select(
            "doc", "tree", (F.col("number") - F.col("first")).alias("at"), _height(F.col("size")).alias("height"), "hash"),
        "merkle",
    )
    stages = _stored_levels(leaves)
    subroots = keep(_roots(stages), "subroots")
    top = _stored_levels(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), _height(F.lit(count)).alias("height"), "hash"))
    root = _roots(top).first()
    named = trees.join(subroots.withColumnRenamed("hash", "subroot"), "tree").select("tree", "source", "size", "subroot")
    return Manifest(stages, top, keep(named, "trees"), root and root["hash"])
