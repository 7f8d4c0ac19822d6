"""Graph queries on graphs that the tables imply.

``parts``: part to the part on the next line of the same order.  ``geography``:
customers and suppliers to nations, nations to regions (a forest).  ``trade``: from
customer nation to supplier nation, for every pair that trades.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.operators import graph, motif, paths
from tidegauge.operators.joins import lookup_join
from tidegauge.plans.registry import query, table

Graph = tuple[DataFrame, DataFrame]


def parts_graph(spark: SparkSession, sf_dir: str) -> Graph:
    # One shuffle by order, whose lines are few; several lines may share a number.
    following = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(1, 1)
    nexts = F.collect_list("l_partkey").over(following)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), nexts.alias("nexts"))
    edges = lines.select("src", F.explode("nexts").alias("dst")).distinct()
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")), edges


def geography_graph(spark: SparkSession, sf_dir: str) -> Graph:
    def node(kind: str, column: str):
        return F.concat(F.lit(kind), F.col(column).cast("string"))

    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    edges = (
        customers.select(node("C", "c_custkey").alias("src"), node("N", "c_nationkey").alias("dst"))
        .unionAll(suppliers.select(node("S", "s_suppkey"), node("N", "s_nationkey")))
        .unionAll(nations.select(node("N", "n_nationkey"), node("R", "n_regionkey")))
    )
    vertices = (
        customers.select(node("C", "c_custkey").alias("id"))
        .unionAll(suppliers.select(node("S", "s_suppkey")))
        .unionAll(nations.select(node("N", "n_nationkey")))
        .unionAll(regions.select(node("R", "r_regionkey")))
    )
    return vertices, edges


def trade_graph(spark: SparkSession, sf_dir: str) -> Graph:
    def scan(name: str, **columns: str) -> DataFrame:
        return table(spark, sf_dir, name).select(*[F.col(c).alias(a) for a, c in columns.items()])

    lines = scan("lineitem", order="l_orderkey", supplier="l_suppkey")
    suppliers = scan("supplier", supplier="s_suppkey", dst="s_nationkey")
    customers = scan("customer", customer="c_custkey", src="c_nationkey")
    orders = scan("orders", order="o_orderkey", customer="o_custkey")
    # nations come to the orders first, so that a dominant customer meets orders, not lines
    placed = lookup_join(orders, customers, ["customer"], "inner", derived=False)
    sent = lookup_join(lines, suppliers, ["supplier"], "inner", derived=False)
    edges = lookup_join(sent, placed.select("order", "src"), ["order"], "inner", derived=False).select("src", "dst").distinct()
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id")), edges


_PARTS_SQL = """e AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst FROM lineitem a
    JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1)"""
_TRADE_SQL = """e AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN supplier ON l_suppkey = s_suppkey)"""


@query(
    "graph_degrees",
    f"WITH {_PARTS_SQL} SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id",
)
def graph_degrees(spark, sf_dir):
    return graph.degrees(parts_graph(spark, sf_dir)[1])


@query(
    "graph_in_out_degrees",
    f"""WITH {_PARTS_SQL}, i AS (SELECT dst AS id, count(*) AS in_degree FROM e GROUP BY 1),
        o AS (SELECT src AS id, count(*) AS out_degree FROM e GROUP BY 1)
        SELECT coalesce(i.id, o.id) AS id, in_degree, out_degree FROM i FULL JOIN o ON i.id = o.id""",
)
def graph_in_out_degrees(spark, sf_dir):
    edges = parts_graph(spark, sf_dir)[1]
    return graph.in_degrees(edges).join(graph.out_degrees(edges), "id", "full")


def _rank_sql(rounds: int) -> str:
    steps = ["r0 AS (SELECT p_partkey AS id, 1.0::DOUBLE AS pr FROM part)"]
    for i in range(rounds):
        steps.append(
            f"r{i + 1} AS MATERIALIZED (SELECT p_partkey AS id, 0.15 + 0.85 * coalesce(s, 0) AS pr FROM part LEFT JOIN "
            f"(SELECT dst, sum(pr / k) AS s FROM e JOIN o ON e.src = o.src JOIN r{i} ON r{i}.id = e.src GROUP BY dst) t "
            "ON p_partkey = dst)"
        )
    return ", ".join(steps)


@query(
    "graph_pagerank",
    f"""WITH {_PARTS_SQL}, o AS (SELECT src, count(*) AS k FROM e GROUP BY src), {_rank_sql(10)}
        SELECT id, round(pr * (SELECT count(*) / sum(pr) FROM r10), 6) AS pagerank FROM r10""",
)
def graph_pagerank(spark, sf_dir):
    ranks = graph.page_rank(*parts_graph(spark, sf_dir), reset=0.15, iterations=10)
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank")).orderBy(F.desc("pagerank"))


@query(
    "graph_components",
    """WITH top AS (SELECT n_nationkey, n_regionkey FROM nation),
       m AS (SELECT 'C' || c_custkey AS id, n_regionkey AS r FROM customer JOIN top ON c_nationkey = n_nationkey
             UNION ALL SELECT 'S' || s_suppkey, n_regionkey FROM supplier JOIN top ON s_nationkey = n_nationkey
             UNION ALL SELECT 'N' || n_nationkey, n_regionkey FROM top
             UNION ALL SELECT 'R' || r_regionkey, r_regionkey FROM region)
       SELECT id, min(id) OVER (PARTITION BY r) AS component FROM m""",
)
def graph_components(spark, sf_dir):
    return graph.connected_components(*geography_graph(spark, sf_dir))


@query(
    "graph_triangles",
    f"""WITH {_PARTS_SQL}, u AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e WHERE src <> dst),
        t AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b),
        c AS (SELECT id, count(*) AS n FROM (SELECT p AS id FROM t UNION ALL SELECT q FROM t UNION ALL SELECT r FROM t) GROUP BY id)
        SELECT p_partkey AS id, coalesce(n, 0) AS "count" FROM part LEFT JOIN c ON p_partkey = id""",
)
def graph_triangles(spark, sf_dir):
    return graph.triangle_counts(*parts_graph(spark, sf_dir))


@query(
    "motif_two_hop",
    f"""WITH {_TRADE_SQL} SELECT DISTINCT x.src AS a_id, x.dst AS b_id, y.dst AS c_id
        FROM e x JOIN e y ON x.dst = y.src""",
)
def motif_two_hop(spark, sf_dir):
    return graph.two_hops(trade_graph(spark, sf_dir)[1]).orderBy("a_id", "b_id", "c_id")


@query(
    "motif_chain",
    """SELECT 'C' || c_custkey AS customer, 'N' || n_nationkey AS nation FROM customer
       JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2""",
)
def motif_chain(spark, sf_dir):
    """Conditions on both ends of a chain whose middle vertices are hubs."""
    vertices, edges = geography_graph(spark, sf_dir)
    found = motif.find_motif(vertices, edges, "(c)-[]->(n); (n)-[]->(r)", {"c": "id like 'C%'", "r": "id = 'R2'"})
    return found.select(F.col("c.id").alias("customer"), F.col("n.id").alias("nation"))


@query(
    "motif_fork",
    f"""WITH {_TRADE_SQL} SELECT x.src AS customer, x.dst AS first_supplier, y.dst AS second_supplier
        FROM e x JOIN e y ON x.src = y.src AND x.dst < y.dst""",
)
def motif_fork(spark, sf_dir):
    """Two named edges from one vertex, read from the structs of the edges."""
    found = motif.find_motif(*trade_graph(spark, sf_dir), "(a)-[e]->(); (a)-[f]->()")
    return found.filter("e.dst < f.dst").select(
        F.col("a.id").alias("customer"), F.col("e.dst").alias("first_supplier"), F.col("f.dst").alias("second_supplier"))


@query(
    "motif_triangle",
    f"""WITH {_PARTS_SQL} SELECT x.src AS id, count(*) AS cycles FROM e x JOIN e y ON y.src = x.dst
        JOIN e z ON z.src = y.dst AND z.dst = x.src GROUP BY 1""",
)
def motif_triangle(spark, sf_dir):
    """Directed cycles of three edges by their start."""
    found = motif.find_motif(*parts_graph(spark, sf_dir), "(a)-[]->(b); (b)-[]->(c); (c)-[]->(a)")
    return found.groupBy(F.col("a.id").alias("id")).agg(F.count("*").alias("cycles"))


@query(
    "motif_negated",
    f"""WITH {_PARTS_SQL} SELECT x.src AS id, count(*) AS ways, count(DISTINCT y.dst) AS candidates
        FROM e x JOIN e y ON y.src = x.dst
        WHERE NOT EXISTS (SELECT 1 FROM e z WHERE z.src = x.src AND z.dst = y.dst) GROUP BY 1""",
)
def motif_negated(spark, sf_dir):
    """Vertices two steps away that are not one step away."""
    found = motif.find_motif(*parts_graph(spark, sf_dir), "(a)-[]->(b); (b)-[]->(c); !(a)-[]->(c)")
    return found.groupBy(F.col("a.id").alias("id")).agg(
        F.count("*").alias("ways"), F.count_distinct("c.id").alias("candidates"))


@query(
    "graph_bfs",
    f"""WITH {_PARTS_SQL}, p1 AS (SELECT dst AS v1 FROM e WHERE src = 0),
        p2 AS (SELECT v1, dst AS v2 FROM p1 JOIN e ON src = v1),
        p3 AS (SELECT v1, v2, dst AS v3 FROM p2 JOIN e ON src = v2),
        p4 AS (SELECT v1, v2, v3, dst AS v4 FROM p3 JOIN e ON src = v3),
        a AS (SELECT 1 AS hops, '0,' || v1 AS path FROM p1 WHERE v1 = 1
              UNION SELECT 2, '0,' || v1 || ',' || v2 FROM p2 WHERE v2 = 1
              UNION SELECT 3, '0,' || v1 || ',' || v2 || ',' || v3 FROM p3 WHERE v3 = 1
              UNION SELECT 4, '0,' || v1 || ',' || v2 || ',' || v3 || ',' || v4 FROM p4 WHERE v4 = 1)
        SELECT hops, path FROM a WHERE hops = (SELECT min(hops) FROM a)""",
)
def graph_bfs(spark, sf_dir):
    paths = graph.shortest_paths(*parts_graph(spark, sf_dir), "id = 0", "id = 1", 4)
    return paths.select(
        (F.size("path") - 1).alias("hops"),
        F.array_join(F.col("path").cast("array<string>"), ",").alias("path"),
    )


@query(
    "graph_paths_between",
    f"""WITH {_PARTS_SQL}, s AS (SELECT p_partkey AS v FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)),
        g AS (SELECT p_partkey AS v FROM part WHERE p_brand = (SELECT max(p_brand) FROM part)),
        p1 AS (SELECT src AS v0, dst AS v1 FROM e JOIN s ON src = v), p2 AS (SELECT v0, v1, dst AS v2 FROM p1 JOIN e ON src = v1),
        a AS (SELECT 1 AS hops, v0 AS first, v1 AS last, count(*) AS paths FROM p1 JOIN g ON v1 = v GROUP BY ALL
              UNION ALL SELECT 2, v0, v2, count(*) FROM p2 JOIN g ON v2 = v GROUP BY ALL)
        SELECT hops, last, sum(paths)::BIGINT AS paths FROM a WHERE hops = (SELECT min(hops) FROM a) GROUP BY ALL""",
)
def graph_paths_between(spark, sf_dir):
    """Shortest paths from all parts of the first brand to all of the last, counted by their end."""
    vertices, edges = parts_graph(spark, sf_dir)
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand")
    first, last = parts.agg(F.min("p_brand"), F.max("p_brand")).first()
    graph_of_paths = paths.path_graph(parts, edges, f"p_brand = '{first}'", f"p_brand = '{last}'", 2)
    if graph_of_paths is None:
        return parts.select(F.lit(0).alias("hops"), F.col("id").alias("last"), F.lit(0).cast("long").alias("paths")).limit(0)
    return graph_of_paths.counts().select(
        F.lit(graph_of_paths.length).alias("hops"), F.col("id").alias("last"), F.col("paths").cast("long").alias("paths"))
