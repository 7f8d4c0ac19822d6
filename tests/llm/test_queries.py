"""Registered queries against SQL, or against the same result computed row by row here."""

import base64
import binascii
import hashlib
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from tests.compare import difference, duck
from tidegauge.llm import catalog, sharding

KINDS3 = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
KINDS8 = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m.group())
    return {
        "assign": lambda: len(m.group(2)) >= 8, "access": lambda: len(m.group()) >= 16, "hex": lambda: len(m.group()) >= 32,
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base_spans(text, kinds):
    return [(m.start(), i, m.end(), kind) for i, (kind, p) in enumerate(kinds.items()) for m in p.finditer(text or "") if passes(kind, m)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()


def rows(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    assert difference(spark, duck(sf_dir), sf_dir, catalog.QUERIES[name], catalog.ORACLES[name])[0] is None


def test_language(spark, sf_dir):
    got = {r.doc_id: r for r in catalog.QUERIES["op1_language_id"](spark, sf_dir).collect()}
    docs = rows(sf_dir, "documents")
    assert len(got) == len(docs)
    right = held = 0
    for d in docs:
        r = got[d["doc_id"]]
        assert r.held_out == (binascii.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in d["text"] or ""):
            assert r.lang_pred == "und"
        elif r.held_out and d["lang"]:
            held += 1
            right += r.lang_pred == d["lang"]
    assert right >= 0.95 * held > 0


@pytest.mark.parametrize(
    "name,kinds,order", [("op3_secret_scan", KINDS3, None), ("op8_disclosure_sanitisation", KINDS8, lambda s: (s[1], s[0]))]
)
def test_base_spans(spark, name, kinds, order):
    sf_dir = "/root/testdata/sf0.01"  # the smallest table has no secrets
    got = {r.doc_id: r for r in catalog.QUERIES[name](spark, sf_dir).collect()}
    docs = rows(sf_dir, "documents")
    assert len(got) == len(docs)
    for d in docs:
        spans = sorted(base_spans(d["text"], kinds), key=order)
        r = got[d["doc_id"]]
        counts = Counter(s[3] for s in spans)
        assert [r[f"n_{k}"] for k in kinds] == [counts[k] for k in kinds]
        assert r.base_sha256 == digest(spans)
        assert {f"{k}:{s}:{e}" for s, _, e, k in spans} <= set(filter(None, r.spans.split(",")))
    assert sum(r[f"n_{k}"] for r in got.values() for k in kinds) > 0


def test_warc(spark, sf_dir):
    pages = rows(sf_dir, "pages")
    top = {}
    for p in pages:
        top[p["html"]] = max(p["page_id"], top.get(p["html"], -1))
    want = []
    for p in pages:
        body, again = p["html"].encode(), top[p["html"]] != p["page_id"]
        sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((p["page_id"], len(body), sha1, "revisit" if again else "response", top[p["html"]] if again else None))
    got = [tuple(r) for r in catalog.QUERIES["op5_zstd_warc"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


def test_sharding(spark, sf_dir):
    docs = {d["doc_id"]: d for d in rows(sf_dir, "documents")}
    got = catalog.QUERIES["op7_feistel_sharding"](spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    number = {i: n for n, i in enumerate(sorted(docs))}
    slots = {}
    for r in got:
        body = (docs[r.doc_id]["text"] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, binascii.crc32(body), "rows", None)
        assert (r.shard, r.slot) == sharding.place(number[r.doc_id], len(docs), 20240229, 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_mixing(spark, sf_dir):
    docs = rows(sf_dir, "documents")
    got = catalog.QUERIES["op4_pfair_mixing"](spark, sf_dir).collect()
    assert {r.doc_id for r in got} == {d["doc_id"] for d in docs}
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = {d["doc_id"] for d in rows(sf_dir, "documents")}
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    found = got.collect()
    assert {r.doc_id for r in found} <= docs and len({(r.shard, r.slot) for r in found}) == len(found)
