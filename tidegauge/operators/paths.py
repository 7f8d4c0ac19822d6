"""All shortest paths between two sets of vertices, searched from both ends.

Each step advances the side whose front touches fewer edges, so that a hub in the middle is
met from both sides instead of being expanded.  Levels are kept as edges; once the fronts
meet, only the edges on shortest paths are kept (the path graph).  Paths are counted on that
graph before any is written out, and a path exists as a row only in the last step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.joins import ROWS_PER_SALT, lookup_join, pair_join
from tidegauge.session import materialise


@dataclass(frozen=True)
class PathGraph:
    """``levels[i]``: edges ``src, dst`` that some shortest path takes as its step i."""

    starts: DataFrame  # id of the vertices where shortest paths start
    levels: list[DataFrame]

    @property
    def length(self) -> int:
        return len(self.levels)

    def counts(self) -> DataFrame:
        """``id, paths``: number of shortest paths that end in each vertex, without writing one out."""
        ways = self.starts.select("id", F.lit(1).cast("decimal(38,0)").alias("paths"))
        for level in self.levels:
            step = lookup_join(level, ways.withColumnRenamed("id", "src"), ["src"], "inner")
            ways = materialise(step.groupBy(F.col("dst").alias("id")).agg(F.sum("paths").cast("decimal(38,0)").alias("paths")), "ways")
        return ways

    def total(self) -> int:
        return int(self.counts().agg(F.sum("paths")).first()[0] or 0)

    def paths(self, per_salt: int = ROWS_PER_SALT) -> DataFrame:
        """One row ``path`` (array of vertices) per shortest path; hot vertices are split over salts."""
        rows = self.starts.select(F.col("id").alias("_at"), F.array("id").alias("path"))
        for level in self.levels:
            step = level.select(F.col("src").alias("_at"), F.col("dst").alias("_next"))
            rows = pair_join(rows, step, ["_at"], per_salt=per_salt).select(
                F.col("_next").alias("_at"), F.concat("path", F.array("_next")).alias("path"))
        return rows.select("path")


def _met(edges: DataFrame, front: DataFrame, column: str) -> DataFrame:
    """Edges with an end in ``front``; a hub's edges are not one task's."""
    return lookup_join(edges, front.select(F.col("id").alias(column)), [column], "inner", derived=False)


def _unseen(level: DataFrame, seen: DataFrame, column: str) -> DataFrame:
    marks = seen.select(F.col("id").alias(column), F.lit(True).alias("_seen"))
    return lookup_join(level, marks, [column]).filter("_seen is null").drop("_seen")


def path_graph(vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str, max_length: int = 4) -> PathGraph | None:
    """The graph of all shortest paths from vertices that fulfil ``from_expr`` to those that
    fulfil ``to_expr``, or ``None`` without a path of at most ``max_length`` edges.

    Parallel edges count once.  A vertex that fulfils both is a path of no edge.
    """
    links = materialise(edges.filter("src is not null and dst is not null").select("src", "dst").distinct(), "links")
    ends = {
        "src": materialise(vertices.filter(from_expr).select("id").distinct(), "front"),
        "dst": materialise(vertices.filter(to_expr).select("id").distinct(), "front"),
    }
    here = materialise(ends["src"].join(ends["dst"], "id", "left_semi"), "here")
    if not here.isEmpty():
        return PathGraph(here, [])
    fronts, seen = dict(ends), dict(ends)
    steps: dict[str, list[DataFrame]] = {"src": [], "dst": []}  # edges of each level, from either end
    touched = {c: materialise(_met(links, fronts[c], c), "level") for c in fronts}
    sizes = {c: touched[c].count() for c in fronts}
    meeting = None
    while len(steps["src"]) + len(steps["dst"]) < max_length and all(sizes.values()):
        near = min(fronts, key=lambda c: (sizes[c], c))
        far = "dst" if near == "src" else "src"
        level = materialise(_unseen(touched[near], seen[near], far), "level")
        steps[near].append(level)
        fronts[near] = materialise(level.select(F.col(far).alias("id")).distinct(), "front")
        seen[near] = materialise(seen[near].unionAll(fronts[near]), "seen")
        meeting = materialise(fronts[near].join(fronts[far], "id", "left_semi"), "meeting")
        if not meeting.isEmpty():
            break
        touched[near] = materialise(_met(links, fronts[near], near), "level")
        sizes[near] = touched[near].count()
    if meeting is None or meeting.isEmpty():
        return None
    # from the meeting vertices outwards: only edges that lead to them
    before = _kept(steps["src"], meeting, "dst", "src")
    after = _kept(steps["dst"], meeting, "src", "dst")
    levels = [*reversed(before), *after]
    return PathGraph(levels[0].select(F.col("src").alias("id")).distinct(), levels)


def _kept(steps: list[DataFrame], meeting: DataFrame, inner: str, outer: str) -> list[DataFrame]:
    out, reached = [], meeting
    for level in reversed(steps):
        out.append(materialise(_met(level, reached, inner).select("src", "dst"), "path-level"))
        reached = materialise(out[-1].select(F.col(outer).alias("id")).distinct(), "reached")
    return out


def shortest_paths_between(
    vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str, max_length: int = 4, per_salt: int = ROWS_PER_SALT,
    most: int | None = None,
) -> DataFrame:
    """All shortest paths, one row ``path`` each; empty without one.

    With ``most``, raises ``ValueError`` instead of writing out more paths than that; they
    are counted first.
    """
    graph = path_graph(vertices, edges, from_expr, to_expr, max_length)
    if graph is None:
        return vertices.select(F.array("id").alias("path")).limit(0)
    if most is not None and (total := graph.total()) > most:
        raise ValueError(f"{total} shortest paths of {graph.length} edges")
    return graph.paths(per_salt)
