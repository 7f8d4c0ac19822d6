"""Exact duplicates against a direct grouping of the texts."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.llm import exactdup

ODD = [None, "", " ", "\t\n ", "a b", "a  b", "a b", "a\x0bb", "A b", "é", "x" * 300_000, "x" * 300_000, "ab " * 90_000]


def wanted(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for key, text in rows:
        same = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        keys = groups[same]
        first = min((k for k in keys if k is not None), default=None)
        out.append((key, first, len(keys), hashlib.sha256(same.encode()).hexdigest()))
    return out


def shown(result):
    rows = result.select("doc.doc_id", "keep_id", "group_size", "text_sha256", "kept").collect()
    return sorted((tuple(r)[:4] for r in rows), key=str), rows


@pytest.mark.parametrize("filter_bytes", [exactdup.FILTER_BYTES, 0])
def test_equals_direct_grouping(spark, filter_bytes):
    """Odd texts, a group of a third of the rows, and a filter joined instead of broadcast."""
    texts = ODD + ["same text"] * 400 + [f"text {i % 700}" for i in range(800)]
    rows = [(i * 7 % 100_003, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got, full = shown(exactdup.exact_duplicates(frame, filter_bytes=filter_bytes))
    assert got == sorted(wanted(rows), key=str)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in full)


def test_null_and_repeated_keys_and_clashing_columns(spark):
    rows = [(None, "a"), (None, "a"), (3, "b"), (3, "b"), (None, "b"), (9, "c"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as id", "2 as rid", "'k' as kept", "5 as block", "'d' as digest", "struct(1 as a) as doc", "7 as size", "8 as maybe")
    got, full = shown(exactdup.exact_duplicates(frame))
    assert got == sorted(wanted(rows), key=str)
    assert sum(r.kept for r in full) == 4  # one row per text
    left = exactdup.deduplicated(frame)
    assert left.columns == frame.columns and left.count() == 4
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == ["3", "9", "None", "None"]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert exactdup.exact_duplicates(frame).count() == 0
    assert exactdup.deduplicated(frame).columns == ["doc_id", "text", "extra"]


def test_filter_finds_all_repeats_and_few_others(spark):
    rows = spark.range(20_000).select(F.unhex(F.sha2(F.expr("cast(id % 18000 as string)"), 256)).alias("digest"), "id")
    found = exactdup.tested(rows)
    assert found.count() == 20_000
    repeated = F.col("id") % 18_000 < 2_000
    assert found.filter(repeated & ~F.col("maybe")).count() == 0
    assert found.filter(~repeated & F.col("maybe")).count() < 0.02 * 16_000


def test_plan_has_no_python(spark, sf_dir):
    from tidegauge.llm import catalog

    plan = catalog.QUERIES["op13_exact_bloom_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
