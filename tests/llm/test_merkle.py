"""Manifest and proofs against a tree that is built whole, row by row."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def whole_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, at):
    out = []
    for nodes in levels[:-1]:
        first = at - at % 16
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return out


def wanted(rows):
    """``{(source, doc_id): (leaf, subroot, root, path)}`` of ``(doc_id, source, text)``."""
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((row[0], digest("".join(map(enc, row)))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: whole_tree([h for _, h in sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in sources}
    top = whole_tree([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        for i, (key, h) in enumerate(sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            out.append((s, key, h, trees[s][-1][0], top[-1][0], path_of(trees[s], i) + path_of(top, at)))
    return out


def built(frame, **more):
    leaf = merkle.leaf_hash(F.col("doc_id"), F.col("source"), F.col("text"))
    return merkle.build(frame, leaf, carry=["doc_id", "source"], **more)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [300, 1, 16, 2], [4500, 257, 256] + [1] * 40])
def test_equals_whole_tree(spark, sizes):
    """Lone leaves, full and started runs, a height above two stored levels, many sources."""
    rows = [(1000 * s + i * 7, None if s == 2 else f"s{s}é", f"text {i} of {s}") for s, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = built(frame).proofs().withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    seen = [(r.doc.source, r.doc.doc_id, r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.path]) for r in got]
    assert sorted(seen, key=str) == sorted(wanted(rows), key=str)
    assert all(r.again == r.root for r in got)


def test_only_every_second_level_is_stored(spark):
    frame = spark.range(5000).selectExpr("id as doc_id", "'a' as source", "cast(id as string) as text")
    levels = {r.level: r["count"] for r in built(frame).stored().filter("tree >= 0").groupBy("level").count().collect()}
    assert levels == {0: 5000, 2: 20, 4: 1}


def test_nulls_repeats_clashes_and_a_changed_row(spark):
    rows = [(None, None, None), (None, None, ""), (1, "x", "a"), (1, "x", "a"), (1, "x", "b"), (2, "", "y" * 200_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr(
        "*", "1 as tree", "'h' as hash", "2 as at", "'k' as key", "3 as number", "4 as height", "5 as path", "6 as doc")
    got = built(frame).proofs()
    seen = [(r.doc.source, r.doc.doc_id, r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.path]) for r in got.collect()]
    assert sorted(seen, key=str) == sorted(wanted(rows), key=str)
    assert got.filter(merkle.folded(F.sha2(F.lit("other"), 256), F.col("path")) == F.col("root")).count() == 0


def test_empty_table(spark):
    manifest = built(spark.createDataFrame([], "doc_id long, source string, text string"))
    assert manifest.root is None and manifest.proofs().count() == 0
