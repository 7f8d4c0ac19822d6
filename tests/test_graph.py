"""Graph measures on a hand-checked graph, and on random ones against brute force."""

import itertools

import numpy as np
import pytest

from tidegauge.operators import graph

AIRPORTS = ["ATL", "ORD", "LAX", "DFW", "JFK", "SFO"]
FLIGHTS = [
    ("ATL", "ORD"), ("ORD", "LAX"), ("LAX", "DFW"), ("DFW", "ATL"), ("ATL", "LAX"),
    ("JFK", "ATL"), ("JFK", "SFO"), ("SFO", "ORD"), ("SFO", "LAX"),
]


@pytest.fixture(scope="module")
def air(spark):
    return (
        spark.createDataFrame([(a,) for a in AIRPORTS], "id string"),
        spark.createDataFrame(FLIGHTS, "src string, dst string"),
    )


@pytest.fixture(scope="module")
def hub(spark):
    """A third of the edges touch vertex 0; some vertices have no way out."""
    rng = np.random.default_rng(12)
    pairs = {(int(a), int(b)) for a, b in rng.integers(1, 60, (120, 2))}
    pairs |= {(0, int(b)) for b in rng.choice(np.arange(1, 60), 40, replace=False)}
    pairs |= {(70, 71), (71, 72), (90, 90)}
    vertices = spark.createDataFrame([(i,) for i in range(100)], "id long")
    return vertices, spark.createDataFrame(sorted(pairs), "src long, dst long"), sorted(pairs)


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_airports(air):
    vertices, edges = air
    assert as_dict(graph.degrees(edges)) == {"ATL": 4, "LAX": 4, "ORD": 3, "SFO": 3, "DFW": 2, "JFK": 2}
    assert as_dict(graph.in_degrees(edges)) == {"LAX": 3, "ATL": 2, "ORD": 2, "DFW": 1, "SFO": 1}
    assert as_dict(graph.triangle_counts(vertices, edges)) == {
        "LAX": 3, "ATL": 2, "ORD": 2, "DFW": 1, "SFO": 1, "JFK": 0}
    assert graph.two_hops(edges).count() == 12
    assert set(as_dict(graph.connected_components(vertices, edges)).values()) == {"ATL"}
    paths = graph.shortest_paths(vertices, edges, "id = 'JFK'", "id = 'DFW'")
    assert sorted(r["path"] for r in paths.collect()) == [
        ["JFK", "ATL", "LAX", "DFW"], ["JFK", "SFO", "LAX", "DFW"]]
    assert graph.shortest_paths(vertices, edges, "id = 'DFW'", "id = 'JFK'").isEmpty()
    assert graph.shortest_paths(vertices, edges, "id = 'JFK'", "id = 'DFW'", 2).isEmpty()
    assert graph.shortest_paths(vertices, edges, "id = 'JFK'", "id like 'J%'").first()["path"] == ["JFK"]
    assert abs(sum(as_dict(graph.page_rank(vertices, edges)).values()) - 6) < 1e-9


@pytest.mark.parametrize("per_salt", [10, 1_000_000])
def test_page_rank(hub, per_salt):
    vertices, edges, pairs = hub
    out = np.zeros(100)
    for a, _ in pairs:
        out[a] += 1
    rank = np.ones(100)
    for _ in range(10):
        nxt = np.full(100, 0.15)
        for a, b in pairs:
            nxt[b] += 0.85 * rank[a] / out[a]
        rank = nxt
    raw = as_dict(graph.page_rank(vertices, edges, normalise=False, per_salt=per_salt))
    assert np.allclose([raw[i] for i in range(100)], rank)
    assert not [t for t in vertices.sparkSession.catalog.listTables() if t.name.startswith("tidegauge_")]
    scaled = as_dict(graph.page_rank(vertices, edges, per_salt=per_salt))
    assert np.allclose([scaled[i] for i in range(100)], rank * 100 / rank.sum())


def test_components_and_triangles(hub):
    vertices, edges, pairs = hub
    root = list(range(100))
    for _ in range(100):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert as_dict(graph.connected_components(vertices, edges)) == dict(enumerate(root))
    plain = {(min(p), max(p)) for p in pairs if p[0] != p[1]}
    want = dict.fromkeys(range(100), 0)
    for a, b, c in itertools.combinations(range(100), 3):
        if {(a, b), (a, c), (b, c)} <= plain:
            for v in (a, b, c):
                want[v] += 1
    assert as_dict(graph.triangle_counts(vertices, edges)) == want


def test_two_hops(hub):
    _, edges, pairs = hub
    want = {(a, b, d) for a, b in pairs for c, d in pairs if b == c}
    assert {tuple(r) for r in graph.two_hops(edges).collect()} == want


def test_page_rank_looks_up_no_link_and_deals_buckets_by_links(hub, monkeypatch):
    vertices, edges, _ = hub
    want = as_dict(graph.page_rank(vertices, edges))
    asked, bucketed = [], graph._bucketed
    monkeypatch.setattr(graph, "lookup_join", lambda *_, **__: pytest.fail("a lookup per link"))
    monkeypatch.setattr(graph, "LINKS_PER_BUCKET", 5)
    monkeypatch.setattr(graph, "_bucketed", lambda df, on, label, n: (asked.append(n), bucketed(df, on, label, n))[1])
    got = as_dict(graph.page_rank(vertices, edges))
    assert min(asked) > 8 and all(abs(got[i] - want[i]) < 1e-9 for i in want)
