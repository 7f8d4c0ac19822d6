"""Weights, noise and draws against the same computed feature by feature."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidegauge.llm import resample

ODD = [None, "", "  ?! ", "One two ONE", "é É ü x9", "long " * 30_000, "w" * 200_000]


def runs(text, longest):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(found), Counter(" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1))


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def wanted(rows, target, longest, least, share):
    s, t = Counter(), Counter()
    for into, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            for f, n in runs(text, longest)[1].items():
                into[bucket(f)] += n
    big_s, big_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    out = []
    for key, text in rows:
        n_words, counts = runs(text, longest)
        n = sum(counts.values())
        gain = sum(c * math.floor(1000 * math.log((t[bucket(f)] + 1) * big_s / ((s[bucket(f)] + 1) * big_t))) for f, c in counts.items())
        weight = gain // n if n else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n_words, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0]))
    for i, row in enumerate(able[: len(able) * share[0] // share[1]]):
        row[5] = i + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("longest,share", [(1, (10, 100)), (3, (1, 2))])
def test_equals_feature_by_feature(spark, longest, share):
    pick = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = ODD + [" ".join(pick.choice(vocabulary[: 20 + 280 * (i % 2)]) for _ in range(pick.randrange(60))) for i in range(300)]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    target = ["w1 w2 w3 W4, w5", None, "w2 " * 40]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr(
        "*", "1 as doc", "2 as n_words", "'s' as score", "3 as rank", "4 as weight", "5 as _key", "6 as _number")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(frame, goal, longest=longest, share=share)
    seen = got.select("doc.doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, seen), key=str) == wanted(rows, target, longest, 20, share)
    kept = resample.drawn(frame, goal, longest=longest, share=share)
    assert kept.columns == frame.columns and kept.count() == sum(r[5] is not None for r in seen)


def test_bit_sliced_sums_equal_products():
    pick = np.random.default_rng(1)
    gain = pick.integers(-20_000, 20_000, resample.BUCKETS)
    counts = pick.integers(0, 3, (40, resample.BUCKETS)) * pick.integers(0, 70_000, (40, 1))
    assert (resample.Gains(gain).sums(counts) == counts @ gain).all()
    assert (resample.Gains(gain * 0).sums(counts * 0) == 0).all()


def test_null_repeated_keys_and_empty_tables(spark):
    long = "a b " * 20
    rows = [(None, long), (None, long), (5, long), (5, long), (5, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = resample.resampled(frame, frame.limit(0), share=(1, 1)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    assert [r["rank"] for r in got if r.n_words < 20] == [None]
    assert resample.resampled(frame.limit(0), frame).count() == 0
