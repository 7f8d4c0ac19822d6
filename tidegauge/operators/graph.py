"""Graph measures on a vertex frame (``id``) and an edge frame (``src``, ``dst``).

Joins on a vertex that carries a large share of the edges go through the salted
joins of :mod:`tidegauge.operators.joins`; loops cut their lineage by writing tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.joins import (
    ROWS_PER_SALT,
    lookup_join,
    pair_join,
    salted_lookup_join,
    small,
)
from tidegauge.session import fresh_path, materialise, shuffle_tasks


def degrees(edges: DataFrame) -> DataFrame:
    """In plus out degree; vertices without edges are absent."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))


def undirected(edges: DataFrame) -> DataFrame:
    """Distinct edges ``a < b`` without loops."""
    return (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )


# ---------------------------------------------------------------- PageRank

# Links in one bucket, whose senders' ranks a task holds.
LINKS_PER_BUCKET = 1_000_000


def page_rank(
    vertices: DataFrame, edges: DataFrame, reset: float = 0.15, iterations: int = 10,
    normalise: bool = True, cut_every: int = 2, per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Fixed-iteration PageRank that starts at 1 per vertex: ``id, pagerank``.

    With ``normalise`` the ranks are scaled to sum to the vertex count, which only
    matters when vertices without outgoing edges let rank drain away.

    Links and vertices are stored bucketed, so that the only shuffle of an iteration is
    that of the (partially summed) contributions to their targets.  A vertex knows its number
    of links, so that links need no lookup, and ranks are hashed, so that links are not sorted;
    the number of buckets grows with the links.  A source with more than ``per_salt`` links is
    split over salts, and its rank is copied to each of them.
    """
    pairs = materialise(edges.groupBy("src", "dst").agg(F.count("*").alias("_m")), "pairs")
    sources = materialise(pairs.groupBy("src").agg(F.sum("_m").alias("_out"), F.count("*").alias("_k")), "sources")
    hot = sources.filter(F.col("_k") > per_salt).select(
        F.col("src").alias("id"), F.ceil(F.col("_k") / per_salt).cast("int").alias("_salts")
    )
    hot = small(materialise(hot, "hot"))
    salted = not hot.isEmpty()
    on = ["src", "_salt"] if salted else ["src"]
    links = pairs
    if salted:
        salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("_salts")), F.lit(0)).cast("int")
        links = pairs.join(hot, F.col("src") == F.col("id"), "left").select("src", "dst", "_m", salt.alias("_salt"))
    buckets = max(shuffle_tasks(edges.sparkSession), -(-pairs.count() // LINKS_PER_BUCKET))
    stored, links_name = _bucketed(links, on, "links", buckets)
    known = vertices.select("id").distinct().join(sources.select(F.col("src").alias("id"), "_out"), "id", "left")
    ids, ids_name = _bucketed(known, ["id"], "vertices", buckets)
    ranks = ids.withColumn("pagerank", F.lit(1.0))
    for step in range(1, iterations + 1):
        share = (F.col("pagerank") / F.col("_out")).alias("_share")
        senders = ranks.select(F.col("id").alias("src"), share)
        if salted:
            copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
            senders = ranks.join(hot, "id", "left").select(
                F.col("id").alias("src"), F.explode(copies).alias("_salt"), share
            )
        received = (
            stored.join(senders.hint("shuffle_hash"), on)
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("_m") * F.col("_share")).alias("_in"))
        )
        ranks = ids.join(received.hint("shuffle_hash"), "id", "left").select(
            "id", "_out",
            (F.lit(reset) + (1.0 - reset) * F.coalesce("_in", F.lit(0.0))).alias("pagerank"),
        )
        if step % cut_every == 0 or step == iterations:
            ranks = materialise(ranks, "ranks")
    ranks = ranks.select("id", "pagerank")
    for name in (links_name, ids_name):  # only the catalog entries; the ranks are written
        edges.sparkSession.sql(f"DROP TABLE {name}")
    if not normalise:
        return ranks
    scale = ranks.agg(F.count("*") / F.sum("pagerank")).scalar()
    return ranks.select("id", (F.col("pagerank") * scale).alias("pagerank"))


def _bucketed(df: DataFrame, on: list[str], label: str, buckets: int) -> tuple[DataFrame, str]:
    """``df`` stored in the shared folder, bucketed and sorted; also its table name."""
    spark = df.sparkSession
    name = f"tidegauge_{label}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *on)
        .write.bucketBy(buckets, *on)
        .sortBy(*on)
        .option("path", fresh_path(spark, label))
        .saveAsTable(name)
    )
    return spark.table(name), name


# ---------------------------------------------------------------- components


def connected_components(
    vertices: DataFrame, edges: DataFrame, max_rounds: int = 100
) -> DataFrame:
    """Weakly connected components, named by their smallest vertex: ``id, component``.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edge
    set no longer changes; each round rewires every vertex to the smallest neighbour.
    """
    # u is the larger end throughout
    links = materialise(
        undirected(edges).select(F.col("b").alias("u"), F.col("a").alias("v")), "links"
    )
    before = None
    for _ in range(max_rounds):
        links = materialise(_small_star(materialise(_large_star(links), "star")), "star")
        mark = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    labelled = lookup_join(vertices.select("id"), roots, ["id"])
    return labelled.select("id", F.coalesce("component", "id").alias("component"))


def _rewired(pairs: DataFrame, target: Column, keep: Column) -> DataFrame:
    return (
        pairs.filter(keep)
        .select(F.greatest(target, F.col("_m")).alias("u"), F.least(target, F.col("_m")).alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to its smallest neighbour."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("_m"))
    return _rewired(lookup_join(both, smallest, ["u"], "inner"), F.col("v"), F.col("v") > F.col("u"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each vertex links itself and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("u").agg(F.min("v").alias("_m"))
    joined = lookup_join(links, smallest, ["u"], "inner")
    neighbours = _rewired(joined, F.col("v"), F.lit(True))
    own = smallest.select("u", F.col("_m").alias("v"))
    return neighbours.unionAll(own).distinct()


# ---------------------------------------------------------------- triangles and paths


def triangle_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Triangles through each vertex, ignoring direction; ``id, count`` with zero rows.

    Edges point from the lower to the higher degree, so a vertex has at most
    ``sqrt(2 E)`` successors even if it touches a third of all edges.  A triangle is
    found once, where the successor lists of an edge's ends intersect.
    """
    plain = materialise(undirected(edges), "edges")
    ends = plain.select(F.explode(F.array("a", "b")).alias("id"))
    degree = materialise(ends.groupBy("id").agg(F.count("*").alias("_d")), "degrees")
    with_a = lookup_join(plain, degree.select(F.col("id").alias("a"), F.col("_d").alias("_da")), ["a"])
    both = lookup_join(with_a, degree.select(F.col("id").alias("b"), F.col("_d").alias("_db")), ["b"])
    up = (F.col("_da") < F.col("_db")) | (
        (F.col("_da") == F.col("_db")) & (F.col("a") < F.col("b"))
    )
    directed = both.select(
        F.when(up, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(up, F.col("b")).otherwise(F.col("a")).alias("v"),
    )
    successors = materialise(directed.groupBy("u").agg(F.collect_list("v").alias("near")), "near")
    steps = successors.select("u", "near", F.explode("near").alias("v"))
    far = successors.select(F.col("u").alias("v"), F.col("near").alias("far"))
    corners = (
        salted_lookup_join(steps, far, ["v"], "inner")
        .select("u", "v", F.array_intersect("near", "far").alias("w"))
        .filter(F.size("w") > 0)
    )
    n = F.size("w").cast("long")
    shares = corners.select(
        F.inline(
            F.concat(
                F.array(
                    F.struct(F.col("u").alias("id"), n.alias("n")),
                    F.struct(F.col("v").alias("id"), n.alias("n")),
                ),
                F.transform(
                    "w", lambda x: F.struct(x.alias("id"), F.lit(1).cast("long").alias("n"))
                ),
            )
        )
    )
    counted = shares.groupBy("id").agg(F.sum("n").alias("count"))
    return vertices.select("id").join(counted, "id", "left").select(
        "id", F.coalesce("count", F.lit(0)).cast("long").alias("count")
    )


def two_hops(edges: DataFrame) -> DataFrame:
    """Distinct paths ``a -> b -> c``; ``a`` and ``c`` may be the same vertex."""
    single = edges.select("src", "dst").distinct()
    first = single.select(F.col("src").alias("a_id"), F.col("dst").alias("b_id"))
    second = single.select(F.col("src").alias("b_id"), F.col("dst").alias("c_id"))
    return pair_join(first, second, ["b_id"]).select("a_id", "b_id", "c_id")


def shortest_paths(
    vertices: DataFrame, edges: DataFrame, from_expr: str, to_expr: str, max_length: int = 4
) -> DataFrame:
    """All shortest paths (breadth first) between two vertex predicates.

    One row per path with its vertices in ``path``; empty if none is found within
    ``max_length`` edges.  Each level keeps the edges that first reach a vertex; only
    the levels that lead to a target are walked back.
    """
    spark = vertices.sparkSession
    links = materialise(edges.select("src", "dst").distinct(), "edges")
    goal = materialise(vertices.filter(to_expr).select("id"), "goal")
    front = materialise(vertices.filter(from_expr).select("id"), "front")
    here = front.join(goal, "id", "left_semi")
    if not here.isEmpty():
        return here.select(F.array("id").alias("path"))
    seen, levels = front, []
    for _ in range(max_length):
        sources = small(front.select(F.col("id").alias("src")))
        fresh = links.join(sources, "src", "left_semi").join(
            seen.select(F.col("id").alias("dst")), "dst", "left_anti"
        )
        level = materialise(fresh.select("src", "dst"), "level")
        front = materialise(level.select(F.col("dst").alias("id")).distinct(), "front")
        levels.append(level)
        if front.isEmpty():
            break
        if not front.join(goal, "id", "left_semi").isEmpty():
            return _walk_back(levels, goal)
        seen = seen.unionAll(front)
    empty = vertices.select(F.array("id").alias("path")).schema
    return spark.createDataFrame([], empty)


def _walk_back(levels: list[DataFrame], goal: DataFrame) -> DataFrame:
    paths = goal.select(F.col("id").alias("_head"), F.array("id").alias("path"))
    for level in reversed(levels):
        step = level.select(F.col("src").alias("_prev"), F.col("dst").alias("_head"))
        paths = step.join(paths, "_head").select(
            F.col("_prev").alias("_head"), F.concat(F.array("_prev"), "path").alias("path")
        )
    return paths.select("path")
