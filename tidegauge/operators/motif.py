"""Motif search: patterns of named vertices and edges, joined in an order set by statistics.

A pattern lists edges, as in ``(a)-[e]->(b); (b)-[]->(c); !(c)-[]->(a)``.  A name stands for
the same vertex everywhere; ``()`` is any vertex and ``[]`` any edge; ``!`` demands that no
such edge exists.  Rows are all assignments (a bag: parallel edges count separately, and
different names may stand for the same vertex).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.joins import ROWS_PER_SALT, lookup_join, pair_join, salted_lookup_join, small
from tidegauge.session import materialise, shuffle_tasks

# Neighbours in one list; a vertex with more is closed row by row.
LIST_LENGTH = 1_000
# Paths that one task makes from lists.
PATHS_PER_TASK = 4_000_000

_TERM = re.compile(r"(!?)\s*\(\s*(\w*)\s*\)\s*-\s*\[\s*(\w*)\s*\]\s*->\s*\(\s*(\w*)\s*\)")


@dataclass(frozen=True)
class Term:
    """One edge of a pattern; vertices and edges without a name are numbered ones."""

    src: str
    edge: str
    dst: str
    negated: bool = False

    @property
    def ends(self) -> set[str]:
        return {self.src, self.dst}


def _hidden(name: str) -> bool:
    return name.startswith("_")


def pattern_terms(pattern: str) -> list[Term]:
    """The terms of a pattern.  Raises ``ValueError`` for one that cannot be searched."""
    terms: list[Term] = []
    for i, text in enumerate(filter(None, (part.strip() for part in pattern.split(";")))):
        found = _TERM.fullmatch(text)
        if not found:
            raise ValueError(f"not an edge like (a)-[e]->(b): {text!r}")
        no, src, edge, dst = found.groups()
        if any(n.startswith("_") for n in (src, edge, dst)):
            raise ValueError("names must not start with an underscore")
        terms.append(Term(src or f"_s{i}", edge or f"_e{i}", dst or f"_d{i}", bool(no)))
    positive = [t for t in terms if not t.negated]
    if not positive:
        raise ValueError("a pattern needs an edge that exists")
    edges = [t.edge for t in positive]
    bound = set().union(*(t.ends for t in positive))
    if len(set(edges)) < len(edges) or set(edges) & bound:
        raise ValueError("an edge name stands for one edge")
    for t in terms:
        if t.negated and not _hidden(t.edge):
            raise ValueError("an edge that must not exist has no name")
        named = {v for v in t.ends if not _hidden(v)}
        if t.negated and not (named and named <= bound):
            raise ValueError("an edge that must not exist needs vertices of edges that do")
    reached, rest = set(positive[0].ends), positive[1:]
    while near := [t for t in rest if t.ends & reached]:
        reached |= near[0].ends
        rest.remove(near[0])
    if rest:
        raise ValueError("the parts of a pattern must be connected: separate parts would be a cross join")
    return terms


# ---------------------------------------------------------------- join order


@dataclass(frozen=True)
class Degrees:
    """Sums over vertices of products of their degrees, which give sizes of joins on an end.

    They count hubs as often as edges touch them, which a mean degree would not.
    """

    edges: int
    out_out: float
    in_in: float
    in_out: float

    def fan_out(self, bound_as: str, meets: str) -> float:
        """Mean number of edges that meet a vertex which another edge has bound."""
        both = {("src", "src"): self.out_out, ("dst", "dst"): self.in_in}.get((bound_as, meets), self.in_out)
        return both / max(self.edges, 1)


def vertex_degrees(edges: DataFrame) -> DataFrame:
    """Out- and in-degree per vertex that has an edge (``id, o, i``): partial sums first."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("x"))
    return ends.groupBy("x.id").agg(F.sum("x.o").cast("double").alias("o"), F.sum("x.i").cast("double").alias("i"))


def degree_sums(edges: DataFrame, counts: DataFrame | None = None) -> Degrees:
    """One pass over the ``vertex_degrees`` of the edges, which may be given."""
    counts = vertex_degrees(edges) if counts is None else counts
    row = counts.agg(F.sum("o"), F.sum(F.col("o") * F.col("o")), F.sum(F.col("i") * F.col("i")), F.sum(F.col("i") * F.col("o"))).first()
    return Degrees(int(row[0] or 0), *[v or 0.0 for v in row[1:]])


def join_order(terms: Sequence[Term], degrees: Degrees, share: Mapping[str, float] | None = None) -> list[Term]:
    """Greedy order: the next term is the one expected to leave the fewest rows.

    ``share`` is the share of all edges that a term (by its edge name) admits.  A term
    whose ends are both known only filters, so it comes as soon as it can; a negated one
    as soon as its named vertices are known.
    """
    share = share or {}
    rest, order, roles = list(terms), [], {}

    def growth(t: Term) -> float:
        own = share.get(t.edge, 1.0)
        if not order:
            return own * degrees.edges
        if t.ends <= roles.keys():
            return -1.0
        known, end = (t.src, "src") if t.src in roles else (t.dst, "dst")
        return own * degrees.fan_out(roles[known], end)

    while rest:
        ready = [t for t in rest if t.negated and order and {v for v in t.ends if not _hidden(v)} <= roles.keys()]
        if ready:
            order.append(ready[0])
        else:
            near = [t for t in rest if not t.negated and (not order or t.ends & roles.keys())]
            order.append(min(near, key=growth))
            for name, end in ((order[-1].src, "src"), (order[-1].dst, "dst")):
                roles.setdefault(name, end)
        rest.remove(order[-1])
    return order


# ---------------------------------------------------------------- search


def _vertex(name: str) -> str:
    return f"_v_{name}"


def _edge(name: str) -> str:
    return f"_e_{name}"


def find_motif(
    vertices: DataFrame, edges: DataFrame, pattern: str, where: Mapping[str, str] | None = None,
    per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """All matches of ``pattern``: a struct column per named vertex and per named edge.

    ``vertices`` has ``id`` (unique) and ``edges`` has ``src`` and ``dst``, with any further
    columns.  ``where`` maps vertex names to SQL conditions on ``vertices``; it restricts the
    edges of that vertex before any join.  Edges to unknown vertices match only unnamed ends.
    Null ids match nothing.

    Joins carry ids (and the rows of named edges) only; vertex rows are attached at the end,
    unless vertices are nothing but their ids.  A step to a new vertex that further edges
    close (or must not) moves lists of neighbours, not a row per path (see :func:`_closed`).
    A vertex with more than ``per_salt`` edges or matches is split over salts on both sides.
    """
    where = dict(where or {})
    terms = pattern_terms(pattern)
    positive = [t for t in terms if not t.negated]
    known = {v for t in positive for v in t.ends}
    if not where.keys() <= known:
        raise ValueError(f"conditions on names that are not in the pattern: {sorted(where.keys() - known)}")
    links = materialise(edges.filter("src is not null and dst is not null"), "links")
    admitted = {v: materialise(vertices.filter(c).select("id"), "admitted") for v, c in where.items()}

    def of_term(t: Term) -> DataFrame:
        columns = [F.col("src").alias(_vertex(t.src)), F.col("dst").alias(_vertex(t.dst))]
        if not _hidden(t.edge):
            columns.append(F.struct(*[F.col(f"`{c}`") for c in edges.columns]).alias(_edge(t.edge)))
        rows = links.filter("src = dst") if t.src == t.dst else links
        rows = rows.select(*(columns[1:] if t.src == t.dst else columns))
        for v in sorted(t.ends & admitted.keys()):
            rows = lookup_join(rows, admitted[v].withColumnRenamed("id", _vertex(v)), [_vertex(v)], "inner", derived=False)
        return rows

    counts = materialise(vertex_degrees(links), "degrees")
    degrees = degree_sums(links, counts)
    bare = vertices.columns == ["id"] and _all_once(vertices, counts)
    candidates = {t.edge: of_term(t) for t in positive}
    limited = [t for t in positive if t.ends & admitted.keys() or t.src == t.dst]
    for t in limited:
        candidates[t.edge] = materialise(candidates[t.edge], "term")
    share = {t.edge: candidates[t.edge].count() / max(degrees.edges, 1) for t in limited}

    found: DataFrame | None = None
    order, roles = join_order(terms, degrees, share), {}
    while order:
        t = order.pop(0)
        if t.negated:
            found = _without(found, links, t, per_salt)
            continue
        if found is None:
            found = candidates[t.edge]
        else:
            bound = [v for v in sorted(t.ends) if _vertex(v) in found.columns]
            closing = order[0] if order and len(bound) == 1 and _closes(t, order[0], found) else None
            fan = degrees.fan_out(roles[bound[0]], "src" if t.src == bound[0] else "dst")
            closed = closing and _closed(found, candidates, links, t, closing, bound[0], fan, per_salt)
            if closed is not None:
                found = closed
                order.pop(0)
            else:
                found = pair_join(found, candidates[t.edge], list(map(_vertex, bound)), per_salt=per_salt)
        for name, end in ((t.src, "src"), (t.dst, "dst")):
            roles.setdefault(name, end)
    return _named(found, None if bare else vertices, positive, per_salt)


def _all_once(vertices: DataFrame, degrees: DataFrame) -> bool:
    """Whether every vertex with an edge is there, and once: then to look it up changes nothing."""
    known = vertices.filter("id is not null").groupBy("id").agg(F.count("*").alias("_n"))
    met = degrees.select(F.col("id").alias("_end")).join(known, F.col("_end") == F.col("id"), "left")
    return met.filter("_n is null or _n > 1").isEmpty()


def _closes(t: Term, c: Term, found: DataFrame) -> bool:
    """Whether ``c`` only tests paths that ``t`` leads to a new vertex, and no edge has a name."""
    new = [v for v in t.ends if _vertex(v) not in found.columns]
    others = c.ends - set(new)
    return (
        len(new) == 1 and set(new) < c.ends and all(_vertex(v) in found.columns for v in others)
        and _hidden(t.edge) and _hidden(c.edge)
    )


def _lists(rows: DataFrame, key: str, other: str, into: str) -> tuple[DataFrame, DataFrame]:
    """The ``other`` ends per ``key`` in lists, and the keys that need several (``_lists``).

    Equal ends come into the same list.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > LIST_LENGTH)
    many = materialise(counts.select(key, F.ceil(F.col("_n") / LIST_LENGTH).cast("int").alias("_lists")), "many")
    place = F.lit(0) if many.isEmpty() else F.pmod(F.xxhash64(other), F.coalesce("_lists", F.lit(1)))
    numbered = rows if many.isEmpty() else rows.join(small(many), key, "left")
    lists = numbered.groupBy(key, place.alias("_list")).agg(F.collect_list(other).alias(into))
    return materialise(lists.drop("_list"), "lists"), many


def _parallel(lists: DataFrame, column: str) -> bool:
    return not lists.filter(F.size(F.array_distinct(column)) < F.size(column)).isEmpty()


def _closed(
    found: DataFrame, candidates: Mapping[str, DataFrame], links: DataFrame, t: Term, c: Term, bound: str, fan: float,
    per_salt: int,
) -> DataFrame | None:
    """``found`` with a step ``t`` from ``bound`` to a new vertex, and ``c``, which closes it.

    Each match takes the list of the step's ends to the other end of ``c``, where that one's
    own list leaves those that (do not) close.  A row per path is made only there.  Matches
    at an end with a long list, or with very many paths, are closed row by row.  None if there
    are parallel edges, which lists cannot count.
    """
    (new,) = t.ends - {bound}
    (end,) = c.ends - {new}
    x, y, z = map(_vertex, (bound, new, end))
    if c.negated:
        near = links.select(F.col("src").alias(_vertex(c.src)), F.col("dst").alias(_vertex(c.dst)))
    else:
        near = candidates[c.edge]
    steps, _ = _lists(candidates[t.edge], x, y, "_steps")
    ends, many = _lists(near, z, y, "_ends")
    if _parallel(steps, "_steps") or (not c.negated and _parallel(ends, "_ends")):
        return None
    found = materialise(found, "found")
    busy = found.groupBy(z).agg(F.count("*").alias("_n")).filter(F.col("_n") * max(fan, 1.0) > per_salt)
    apart = materialise(busy.select(z).unionAll(many.select(z)).distinct(), "apart")
    paths = salted_lookup_join(found, steps, [x], "inner", per_salt)
    tasks = max(shuffle_tasks(found.sparkSession), -(-int(found.count() * fan) // PATHS_PER_TASK))
    some = not apart.isEmpty()
    few = paths.join(small(apart), z, "left_anti") if some else paths
    met = few.repartition(tasks, z).join(ends.withColumnRenamed(z, "_z"), F.col(z) == F.col("_z"), "left" if c.negated else "inner")
    none = F.array().cast(ends.schema["_ends"].dataType)
    kept = F.array_except("_steps", F.coalesce("_ends", none)) if c.negated else F.array_intersect("_steps", "_ends")
    closed = met.select(*found.columns, F.explode(kept).alias(y))
    if not some:
        return closed
    rows = paths.join(small(apart), z, "left_semi").select(*found.columns, F.explode("_steps").alias(y))
    if c.negated:
        return closed.unionByName(_without(rows, links, c, per_salt))
    return closed.unionByName(pair_join(rows, near, sorted([y, z]), per_salt=per_salt))


def _without(found: DataFrame, links: DataFrame, t: Term, per_salt: int) -> DataFrame:
    """Matches for which no edge like ``t`` exists; an unnamed end stands for any vertex."""
    ends = {v: c for v, c in ((t.src, "src"), (t.dst, "dst")) if not _hidden(v)}
    rows = links.filter("src = dst") if t.src == t.dst else links
    there = rows.select(*[F.col(c).alias(_vertex(v)) for v, c in ends.items()]).distinct().withColumn("_there", F.lit(True))
    met = salted_lookup_join(found, materialise(there, "there"), list(map(_vertex, ends)), per_salt=per_salt)
    return met.filter("_there is null").drop("_there")


def _named(found: DataFrame, vertices: DataFrame | None, positive: Sequence[Term], per_salt: int) -> DataFrame:
    """A struct per name; without ``vertices``, a vertex is its id."""
    columns = []
    for t in positive:
        for name, column in ((t.src, _vertex(t.src)), (t.edge, _edge(t.edge)), (t.dst, _vertex(t.dst))):
            if not _hidden(name) and (name, column) not in columns:
                columns.append((name, column))
    if vertices is None:
        return found.select(*[
            (F.struct(F.col(c).alias("id")) if c == _vertex(n) else F.col(c)).alias(n) for n, c in columns])
    rows = vertices.select(F.col("id").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in vertices.columns]).alias("_row"))
    for name, column in columns:
        if column == _vertex(name):
            looked_up = rows.select(F.col("_id").alias(column), F.col("_row").alias(f"_as_{name}"))
            found = lookup_join(found, looked_up, [column], "inner")
    return found.select(*[F.col(f"_as_{n}" if c == _vertex(n) else c).alias(n) for n, c in columns])
