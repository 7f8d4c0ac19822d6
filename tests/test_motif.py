"""Motif search against all assignments of vertices, on a graph with a hub."""

import itertools
from collections import Counter

import numpy as np
import pytest

from tidegauge.operators import motif
from tidegauge.operators.motif import Degrees, join_order, pattern_terms


@pytest.fixture(scope="module")
def net(spark):
    """A third of the edges leave vertex 0; some are parallel, some are loops, one leads nowhere."""
    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(1, 14, (36, 2))] + [(0, int(b)) for b in rng.integers(1, 14, 18)]
    pairs += [(3, 3), (5, 0), (7, 0), (2, 99), (4, 14)]
    rows = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    vertices = spark.createDataFrame([(i, f"name{i % 3}") for i in range(15)], "id long, name string")
    edges = spark.createDataFrame([*rows, (None, 1, 500), (1, None, 501)], "src long, dst long, weight int")
    return vertices, edges, rows, {i: f"name{i % 3}" for i in range(15)}


def brute(rows, names, pattern, where=lambda match: True):
    """Matches as tuples of the named things, by trying every combination of edges."""
    terms = pattern_terms(pattern)
    positive, negative = [t for t in terms if not t.negated], [t for t in terms if t.negated]
    out = Counter()

    def extend(i, match):
        if i < len(positive):
            t = positive[i]
            for a, b, w in rows:
                more = {**match, t.src: match.get(t.src, a), t.edge: (a, b, w)}
                more[t.dst] = more.get(t.dst, b)
                if more[t.src] == a and more[t.dst] == b:
                    extend(i + 1, more)
            return
        for t in negative:
            if any(match.get(t.src, a) == a and match.get(t.dst, b) == b and (t.src != t.dst or a == b) for a, b, _ in rows):
                return
        named = {n: v for n, v in match.items() if not n.startswith("_")}
        if all(isinstance(v, tuple) or v in names for v in named.values()) and where(match):
            out[tuple(sorted(named.items()))] += 1

    extend(0, {})
    return out


def found(result):
    out = Counter()
    for row in result.collect():
        out[tuple(sorted((n, row[n].id if "id" in row[n] else tuple(row[n])) for n in result.columns))] += 1
    return out


PATTERNS = [
    ("(a)-[]->(b); (b)-[]->(c)", 5), ("(a)-[e]->(b); (a)-[f]->(c)", 5), ("(b)-[]->(a); (c)-[]->(a)", 1000),
    ("(a)-[]->(b); (b)-[]->(c); (c)-[]->(a)", 5), ("(a)-[]->(b); (b)-[]->(c); !(a)-[]->(c)", 5), ("(a)-[e]->(a)", 5),
    ("(a)-[]->(b); !(b)-[]->()", 5), ("(a)-[]->(); !(a)-[]->(a)", 1000), ("(a)-[]->(b); !(b)-[]->(a); (b)-[x]->()", 5),
]


@pytest.mark.parametrize("pattern,per_salt", PATTERNS)
def test_equals_all_assignments(net, pattern, per_salt):
    vertices, edges, rows, names = net
    want = brute(rows, names, pattern)
    assert want and found(motif.find_motif(vertices, edges, pattern, per_salt=per_salt)) == want


def test_conditions(net):
    vertices, edges, rows, names = net
    pattern = "(a)-[]->(b); (b)-[e]->(c)"
    want = brute(rows, names, pattern, lambda m: names[m["a"]] == "name1" and m["c"] > 4)
    got = motif.find_motif(vertices, edges, pattern, {"a": "name = 'name1'", "c": "id > 4"})
    assert want and found(got) == want
    assert got.select("a.name").distinct().collect()[0].name == "name1" and got.columns == ["a", "b", "e", "c"]


def test_empty_graph(spark, net):
    vertices, edges, *_ = net
    assert motif.find_motif(vertices, edges.limit(0), "(a)-[]->(b); (b)-[]->(c); !(a)-[]->(c)").count() == 0
    assert motif.find_motif(vertices, edges, "(a)-[]->(b)", {"a": "id < 0"}).count() == 0


@pytest.mark.parametrize("bad", ["", "(a)", "a->b", "(a)-[]->(b); (c)-[]->(d)", "!(a)-[]->(b)", "(a)-[e]->(b); (b)-[e]->(c)",
                                 "(a)-[a]->(b)", "(a)-[]->(b); !(a)-[x]->(b)", "(a)-[]->(b); !()-[]->()", "(a)-[]->(b); !(c)-[]->(a)"])
def test_patterns_that_cannot_be_searched(bad):
    with pytest.raises(ValueError):
        pattern_terms(bad)


def test_join_order():
    degrees = Degrees(edges=100, out_out=5000.0, in_in=300.0, in_out=200.0)
    names = lambda pattern, share=None: [t.edge for t in join_order(pattern_terms(pattern), degrees, share)]
    # the cycle is closed as soon as its ends are known, before the fork at the hub
    assert names("(a)-[x]->(b); (a)-[y]->(d); (b)-[z]->(c); (c)-[w]->(a)") == ["x", "z", "w", "y"]
    # a selective edge comes first, and what must not exist as soon as its vertices are known
    assert names("(a)-[x]->(b); (b)-[y]->(c); (c)-[z]->(d); !(c)-[]->(b)", {"z": 0.01}) == ["z", "y", "_e3", "x"]


CLOSED = ["(a)-[]->(b); (b)-[]->(c); (c)-[]->(a)", "(a)-[]->(b); (b)-[]->(c); !(a)-[]->(c)", "(a)-[]->(b); (c)-[]->(b); !(c)-[]->(a)"]


@pytest.mark.parametrize("pattern", CLOSED)
@pytest.mark.parametrize("length,per_salt,bare", [(1000, 10**6, True), (2, 10**6, False), (1000, 6, True)])
def test_closed_by_lists(spark, net, monkeypatch, pattern, length, per_salt, bare):
    """Without parallel edges no row per path is joined, unless a vertex has a long list or very many paths."""
    vertices, _, rows, names = net
    pairs = sorted({(a, b) for a, b, _ in rows if not bare or max(a, b) < 15})
    edges = spark.createDataFrame(pairs, "src long, dst long")
    monkeypatch.setattr(motif, "LIST_LENGTH", length)
    if length == 1000 and per_salt > 100:
        for name in ("pair_join", "_without"):
            monkeypatch.setattr(motif, name, lambda *_, **__: pytest.fail("a row per path"))
    if bare:
        monkeypatch.setattr(motif, "lookup_join", lambda *_, **__: pytest.fail("ids looked up for every path"))
    want = brute([(a, b, 0) for a, b in pairs], names, pattern)
    got = motif.find_motif(vertices.select("id") if bare else vertices, edges, pattern, per_salt=per_salt)
    assert want and found(got) == want
