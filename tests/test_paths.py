"""Two-ended search of shortest paths against a search from one end."""

import numpy as np
import pytest

from tidegauge.operators import paths


def brute(pairs, starts, goals, longest):
    near = {}
    for a, b in set(pairs):
        near.setdefault(a, []).append(b)
    found = [(s,) for s in starts]
    for _ in range(longest + 1):
        hits = sorted(p for p in found if p[-1] in goals)
        if hits:
            return hits
        found = [p + (b,) for p in found for b in near.get(p[-1], []) if b not in p]
    return []


@pytest.fixture(scope="module")
def net(spark):
    """A third of the edges touch the hub 0; parallel edges, loops and null ends."""
    rng = np.random.default_rng(21)
    pairs = [(int(a), int(b)) for a, b in rng.integers(1, 80, (110, 2))]
    pairs += [(int(a), 0) for a in rng.integers(1, 80, 28)] + [(0, int(b)) for b in rng.integers(1, 80, 28)] + [(0, 0), (90, 91), (90, 91)]
    edges = spark.createDataFrame([*pairs, (None, 3), (3, None)], "src long, dst long")
    return spark.range(100), edges, pairs


@pytest.mark.parametrize("start,goal,longest", [
    ([1], [2], 6), ([5, 6, 7], [40, 41, 42, 43], 6), ([33], [0], 6), ([91], [90], 3),
    ([4, 5], [5, 6], 3), (list(range(1, 30)), list(range(60, 80)), 4)])
def test_equals_search_from_one_end(net, start, goal, longest):
    vertices, edges, pairs = net
    where = [f"id in ({','.join(map(str, ids))})" for ids in (start, goal)]
    want = brute(pairs, start, set(goal), longest)
    graph = paths.path_graph(vertices, edges, *where, longest)
    got = paths.shortest_paths_between(vertices, edges, *where, longest, per_salt=5)
    assert sorted(tuple(r.path) for r in got.collect()) == want
    assert (graph.total() if graph else 0) == len(want)


def test_paths_are_counted_before_they_are_written_out(spark):
    """Four steps between layers of ten vertices: 10^4 paths, none of which is made."""
    layers = [(10 * i + a, 10 * i + 10 + b) for i in range(4) for a in range(10) for b in range(10)]
    edges, vertices = spark.createDataFrame(layers, "src long, dst long"), spark.range(50)
    graph = paths.path_graph(vertices, edges, "id = 0", "id >= 40", 4)
    assert graph.length == 4 and graph.total() == 10**4
    with pytest.raises(ValueError, match="10000"):
        paths.shortest_paths_between(vertices, edges, "id = 0", "id >= 40", 4, most=1000)
