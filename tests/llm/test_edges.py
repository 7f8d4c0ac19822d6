"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import (
    chat, components, decontaminate, disclosure, langid, mixing, neardup, patterns, secrets, sharding, topk, warc,
)

WORD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORD) + str(pick.randrange(50)) for _ in range(n))


def docs(spark, texts, more=()):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 2}") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", *more)


ODD = [None, "", "   \n\t", "?!", "é", prose(300, 1), prose(300, 1), "x" * 200_000, "ab " * 60_000]
CLASH = ["struct(1 as a) as doc", "5 as _rid", "'z' as n_shingles", "7 as items", "'q' as base", "1 as number", "2 as epoch", "3 as lang_pred"]


# ---------------------------------------------------------------- near duplicates


def shingles(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def brute_components(texts, k, percent):
    sets, parent = [shingles(t, k) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


def edited(words, seed, changes):
    pick, words = random.Random(seed), list(words)
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("percent,k", [(85, 3), (80, 5)])
def test_near_duplicates_equal_brute_force(spark, percent, k):
    """Groups whose members lie on both sides of the threshold, and chains between them."""
    texts = list(ODD[:7])
    for group in range(4):
        base = prose(120, 10 + group).split()
        texts += [edited(base, 100 * group + i, 1 + i % 6) for i in range(40)]
    got = neardup.near_duplicates(docs(spark, texts, CLASH), shingle=k, percent=percent)
    rows = got.select("doc.doc_id", "n_shingles", "component_id", "kept", "first").collect()
    assert sorted(tuple(r)[:3] for r in rows) == brute_components(texts, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    heads = [r.component_id for r in rows if r.first]
    assert len(heads) == len(set(heads)) == len({r.component_id for r in rows})


def test_near_duplicates_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "e f g h"), (4, "e f g h"), (9, "e f g h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(frame, shingle=3, percent=85).select("doc.doc_id", "component_id", "kept", "first").collect()
    assert sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in got))) == sorted(map(str, [
        (None, None, True), (None, None, True), (4, 4, True), (4, 4, True), (9, 4, False)]))
    assert sum(r.first for r in got) == 2
    assert neardup.near_duplicates(frame.limit(0)).count() == 0
    assert neardup.deduplicated(frame).columns == ["doc_id", "text"]


def test_odd_sketches_estimate_high_similarities():
    pick, scheme = np.random.default_rng(5), neardup.Scheme(85)
    for size, gone in itertools.product((60, 500, 3000), (0.0, 0.02, 0.05, 0.08)):
        a = np.unique(pick.integers(0, 2**64, size, dtype=np.uint64))
        b = a.copy()
        b[: int(gone * size)] = pick.integers(0, 2**64, int(gone * size), dtype=np.uint64)
        b = np.unique(b)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        (x, n), (y, m) = neardup.odd_sketch(a), neardup.odd_sketch(b)
        odd = int(np.bitwise_count(np.frombuffer(x, np.uint64) ^ np.frombuffer(y, np.uint64)).sum())
        assert abs(neardup.estimate(odd, n, m) - true) < 0.03
        if true >= 0.85:
            assert odd <= scheme.most_odd(float(len(a)), float(len(b)), float(n), float(m))


def test_components(spark):
    pick = random.Random(3)
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(5, 5), (200, 201), (201, 200)]
    pick.shuffle(links)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- decontamination


def test_contamination_of_odd_inputs(spark):
    passage = prose(40, 77)
    texts = [*ODD, f"lead {passage.upper()} tail", " ".join(passage.split()[5:14]), "say hello, world again", passage * 2]
    items = spark.createDataFrame(
        [(1, passage), (2, "Hello World"), (3, None), (4, "..."), (None, "tail"), (1, passage)], "item_id long, text string"
    )
    got = decontaminate.contamination(docs(spark, texts, CLASH), items, block_bytes=150).select("doc.doc_id", "n_words", "hits", "items")
    rows = {r.doc_id: r for r in got.collect()}
    n = len(ODD)
    assert all(not rows[i]["items"] for i in range(n)) and rows[0].n_words == rows[3].n_words == 0
    assert [tuple(h) for h in rows[n].hits] == [(1, 42)] and rows[n]["items"] == ["1", "null"]
    assert rows[n + 1]["items"] == [] and rows[n + 2]["items"] == ["2"] and [tuple(h) for h in rows[n + 2].hits] == [(1, 3)]
    assert rows[n + 3]["items"] == ["1"]
    assert decontaminate.contamination(docs(spark, texts), items.limit(0)).filter(F.size("items") > 0).isEmpty()
    assert decontaminate.decontaminated(docs(spark, []), items).count() == 0


def test_every_shared_span_has_a_common_fingerprint():
    from tidegauge.llm import wordhash as W

    span = prose(10, 8)
    for seed in range(30):
        sides = [f"{prose(17, seed)} {span} {prose(9, seed + 99)}", f"{prose(3, seed + 7)} {span} {prose(30, seed + 5)}"]
        found = []
        for text in sides:
            data = np.frombuffer(text.encode(), np.uint8)
            found.append(set(decontaminate.fingerprints(W.Words(data, np.array([0, len(data)]), W.ALNUM), 10)[1].tolist()))
        assert found[0] & found[1]


# ---------------------------------------------------------------- language


def test_language_of_odd_inputs(spark):
    frame = docs(spark, ODD, CLASH)
    model = langid.train(frame, F.col("text"), F.col("lang"))
    rows = {r.doc_id: r for r in langid.identify(frame, model).select("doc.doc_id", "lang_pred", "score").collect()}
    assert [rows[i].lang_pred for i in range(4)] == ["und"] * 4 and rows[4].lang_pred == "en"
    assert rows[0].score == 0 and all(0 <= r.score <= 1 for r in rows.values())
    nothing = langid.train(frame.limit(0), F.col("text"), F.col("lang"))
    assert nothing is None
    assert {r.lang_pred for r in langid.identify(frame, nothing).collect()} == {"und"}


def test_texts_with_letters_stay_without_any_language(spark):
    import corpus_pipeline

    frame = docs(spark, ODD).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, frame, "")
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == set(range(4, 9))


def test_long_text_is_scored_whole():
    """Pieces of a long text give the n-grams of the text, each once."""
    import pyarrow as pa

    text = prose(70_000, 4)
    points, offsets = langid._lowered(pa.array(["a", text, "b"]))
    pieces = [[] for _ in range(3)]
    for part, bounds, first in langid._pieces(points, offsets):
        for owner, buckets in langid._entries(part, bounds):
            for row in np.unique(owner):
                pieces[first + row].extend(buckets[owner == row].tolist())
    whole = [b for order in langid.ORDERS for b in langid._buckets(points[offsets[1] : offsets[2]], order).tolist()]
    assert len(text) > langid.PIECE and sorted(pieces[1]) == sorted(whole)


# ---------------------------------------------------------------- mixing and sharding


def test_cycle_keeps_pfair_windows_and_share():
    for counts in ({"a": 1}, {"a": 5, "b": 3, "c": 1, None: 1}, {str(i): i + 1 for i in range(20)}):
        slots, length = mixing.cycle(counts), sum(counts.values())
        assert sorted(x for s in slots.values() for x in s) == list(range(length))
        for s, n in counts.items():
            for j, slot in enumerate(slots[s]):
                assert j * length // n <= slot < -(-(j + 1) * length // n)
            for t in range(length + 1):
                assert abs(sum(x < t for x in slots[s]) - t * n / length) < 1


def test_mixing_of_odd_inputs(spark):
    frame = docs(spark, ODD * 3, CLASH)
    got = mixing.mixed(frame, weights={None: 1.0, "s0": 3.0, "elsewhere": 9.0}, block_rows=2).collect()
    assert {r.doc.doc_id for r in got} == set(range(27)) and sorted(r.position for r in got) == list(range(len(got)))
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_mixing_keeps_exact_weights_over_long_mixtures(spark):
    sizes = {"hot": 500_000, **{f"s{i}": 900 + 37 * i for i in range(30)}}
    frame = None
    for name, n in sizes.items():
        part = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(name).alias("source"))
        frame = part if frame is None else frame.unionByName(part)
    weights = {name: n**0.5 if name != "hot" else 61.7 * 7 for name, n in sizes.items()}
    got = mixing.mixed(frame, weights=weights, block_rows=4).select("source", "block", "release", "deadline", "slot").distinct().toPandas()
    slots, total = len(got), sum(Fraction(w) for w in weights.values())
    assert slots > 3 * mixing.RESOLUTION and sorted(got["slot"]) == list(range(slots))
    for name, rows in got.sort_values("slot").groupby("source"):
        share = Fraction(weights[name]) / total
        assert rows["block"].tolist() == list(range(len(rows)))
        for j, release, deadline, slot in rows[["block", "release", "deadline", "slot"]].itertuples(index=False):
            assert release == int(j / share) <= slot < deadline == math.ceil((j + 1) / share)
            # the deviation is extreme just before and just after a block
            assert abs(j - slot * share) < 1 and abs(j + 1 - (slot + 1) * share) < 1


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 15, 16, 17, 100, 1000])
def test_permutation_is_one_to_one(spark, rows):
    got = spark.range(rows).select("id", sharding.permuted(F.col("id"), rows, 9).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(rows))
    assert all((r.p % 4, r.p // 4) == sharding.place(r.id, rows, 9, 4) for r in got[:50])


def test_sharding_of_odd_inputs(spark):
    frame = docs(spark, ODD, CLASH).withColumn("doc_id", F.when(F.col("doc_id") > 2, F.col("doc_id")))
    got = sharding.sharded(frame, ["doc_id", "text"], 4).collect()
    assert sorted(r.number for r in got) == list(range(9))
    assert {(r.shard, r.slot) for r in got} == {(i % 4, i // 4) for i in range(9)}
    assert sharding.sharded(frame.limit(0), ["doc_id"], 4).count() == 0


# ---------------------------------------------------------------- spans


def test_spans_of_very_many_matches(spark):
    text = "🙂 token=abcdefgh1 é" * 3000
    row = secrets.find_secrets(docs(spark, [text, None, "", "password: 'hunter22'"], CLASH)).orderBy("doc.doc_id").collect()
    want = [(m.start(), m.end()) for m in re.finditer("token=abcdefgh1", text)]
    assert [(s.start, s.end) for s in row[0].base] == want
    assert row[1].base == row[2].base == [] and [(s.start, s.end) for s in row[3].base] == [(0, 19)]
    assert secrets.find_secrets(docs(spark, [])).count() == 0


def test_random_strings_are_told_from_written_ones(spark):
    pick = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(pick.choice(letters) for _ in range(40)) for _ in range(60)]
    names = [f"{pick.choice(WORD)}_{pick.choice(WORD)}_{pick.choice(WORD)}_{pick.choice(WORD)}_{pick.choice(WORD)}_{2000 + i}" for i in range(60)]
    got = secrets.find_secrets(docs(spark, [f"see {x} here" for x in keys + names])).orderBy("doc.doc_id").collect()
    assert sum(bool(r.added) for r in got[:60]) >= 50
    assert sum(bool(r.added) for r in got[60:]) <= 3


def test_random_parts_of_urls_and_paths_are_found(spark):
    pick = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    frames = ["get https://example.com/v1/user-data/{} now", "see //b/build_logs/{} here", "at /var/my_cache/long-term/{}/index_new.html"]
    keys = ["".join(pick.choice(letters) for _ in range(n)) for n in (24, 28, 40) * 20]
    texts = [frames[i % 3].format(k) for i, k in enumerate(keys)]
    texts += [frames[i % 3].format(f"{pick.choice(WORD)}_{pick.choice(WORD)}-{pick.choice(WORD)}_{2000 + i}") for i in range(60)]
    got = secrets.find_secrets(docs(spark, texts)).orderBy("doc.doc_id").collect()
    found = [{texts[i][s.start : s.end] for s in r.added} for i, r in enumerate(got)]
    assert sum(k in f for k, f in zip(keys, found)) >= 50 and sum(map(bool, found[60:])) <= 3
    assert all(len(f) <= 1 for f in found)


def test_personal_data_and_the_terms_that_disclose_it(spark):
    texts = [f"{prose(20, i)} Wilhelmina Quast writes from w.quast@mail.example.org today {prose(20, i + 50)}" for i in range(6)]
    texts += [f"{prose(30, i + 500)} writes from home today" for i in range(40)]
    texts += [None, "", "1 " * 30_000, "a@" * 20_000, "1.1." * 9000, "call +49 (30) 123-4567 or 4111 1111 1111 1111 at 10.0.0.256"]
    got = disclosure.find_personal(docs(spark, texts, CLASH)).orderBy("doc.doc_id").collect()
    for i in range(6):
        assert [texts[i][s.start : s.end] for s in got[i].base] == ["w.quast@mail.example.org"]
        assert {texts[i][s.start : s.end] for s in got[i].added if s.kind == "name"} == {"Wilhelmina", "Quast"}
    assert all(not r.base and not r.added for r in got[6:50])
    assert len(got[50].base) == 4500 and {s.kind for s in got[50].base} == {"ip"}
    assert [s.kind for s in got[51].base] == ["card", "phone"]
    frame = spark.createDataFrame([(texts[0], got[0].base + got[0].added)], "text string, spans array<struct<kind:string,rank:int,start:long,end:long>>")
    clean = frame.select(disclosure.sanitised(F.col("text"), F.col("spans"))).first()[0]
    assert "<NAME> <NAME>" in clean and "<EMAIL>" in clean and "quast" not in clean.lower()
    assert disclosure.find_personal(docs(spark, [])).count() == 0


def test_disclosing_terms_are_found_over_whole_documents(spark):
    def page(i):
        far = " ".join(f"row {i} {n}" for n in range(60))
        return f"Wilhelmina {far} w.quast@mail.example.org {far} 1.2.3.999 Wilhelmina and again wilhelmina"

    texts = [page(i) for i in range(12)] + ["no entity, but Wilhelmina"] + [f"{prose(30, i)} w.quast@mail.example.org" for i in range(1)]
    texts += [f"other {i} text {prose(20, i + 900)}" for i in range(60)]
    got = disclosure.find_personal(docs(spark, texts, CLASH)).orderBy("doc.doc_id").collect()
    for i, text in enumerate(texts):
        want = [(m.start(), m.end(), "name" if m.group()[0] == "W" else "term") for m in re.finditer("[Ww]ilhelmina", text)]
        found = sorted((s.start, s.end, s.kind) for s in got[i].added if text[s.start : s.end].lower() == "wilhelmina")
        assert found == want and len(want) == (3 if i < 12 else i == 12)
        assert not any("@" in text[s.start - 1 : s.end + 1] for s in got[i].added)


def test_copies_do_not_make_their_words_disclosing(spark):
    lone = f"{prose(400, 1)} ask m.lone@mail.example.org please {prose(400, 2)}"
    changed = lone.replace(" please ", " kindly ")
    texts = [lone] * 5 + [changed] + [f"{prose(30, i + 70)} Quast at q.quast@mail.example.org {prose(30, i + 90)}" for i in range(4)]
    texts += [f"{prose(40, i + 700)}" for i in range(60)]
    got = disclosure.find_personal(docs(spark, texts)).orderBy("doc.doc_id").collect()
    assert all(len(r.base) == 1 and not r.added for r in got[:6])
    assert all("Quast" in {texts[i][s.start : s.end] for s in got[i].added} for i in range(6, 10))
    assert all(not r.added for r in got[10:])


def test_terms_of_long_documents_with_many_entities(spark):
    mails = " ".join(f"m{i}@mail.example.org" for i in range(2000))
    texts = [f"{mails} {' '.join(f'w{i}x' for i in range(4000))} {prose(50, k)} Quast" for k in range(3)]
    texts += [f"{prose(40, k + 90)} Quast m1@mail.example.org" for k in range(3)]
    texts += [" ".join([*(f"u{i}v" for i in range(200_000)), "Quast"]), *(prose(40, i + 700) for i in range(60))]
    got = disclosure.find_personal(docs(spark, texts)).orderBy("doc.doc_id").collect()
    assert [len(r.base) for r in got[:7]] == [2000, 2000, 2000, 1, 1, 1, 0]
    assert [(s.start, s.end) for s in got[6].added] == [(len(texts[6]) - 5, len(texts[6]))]
    assert all("Quast" in {texts[i][s.start : s.end] for s in got[i].added} for i in range(3, 6))


def test_disclosing_terms_equal_a_count_of_all_pairs(spark):
    pick = random.Random(5)
    people = [f"P{chr(97 + i)}xx" for i in range(12)]
    texts = []
    for i in range(150):
        who = pick.sample(range(12), pick.choice([0, 0, 1, 1, 2]))
        body = [f"{people[w] if pick.random() < 0.97 else 'someone'} u{w % 9}@mail.example.org" for w in who]
        texts.append(" ".join([prose(25, i), *body, prose(5, i + 1000)]))
    texts += texts[:20]
    got = disclosure.find_personal(docs(spark, texts), share=0.8, support=3).orderBy("doc.doc_id").collect()
    mail, usable = re.compile(r"u\d@mail\.example\.org"), lambda t: len(t) >= 3 and re.search("[^\\W\\d_]", t)
    different = [(set(mail.findall(t)), {w.lower() for w in re.findall(r"[^\W_]+", mail.sub(" ", t)) if usable(w)}) for t in dict.fromkeys(texts)]
    count_e, count_t, count_b = {}, {}, {}
    for e, t in different:
        for counts, keys in ((count_e, e), (count_t, t), (count_b, itertools.product(e, t))):
            for k in keys:
                counts[k] = counts.get(k, 0) + 1
    telling = set()
    for (e, t), n in count_b.items():
        content = math.log2(len(different) / count_e[e])
        if n >= 3 and count_e[e] >= 3 and content + math.log2(n / count_t[t]) >= 0.8 * content:
            telling.add(t)
    assert telling & {p.lower() for p in people}
    for text, r in zip(texts, got):
        plain = mail.sub(lambda m: " " * len(m.group()), text)
        want = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", plain) if m.group().lower() in telling]
        assert [(s.start, s.end) for s in r.added] == want


def test_running_starts(spark):
    for n in (1, 2, 255, 256, 257, 1000):
        got = spark.range(1).select(patterns.running_starts(F.sequence(F.lit(1), F.lit(n).cast("long")))).first()[0]
        assert got == [i * (i + 1) // 2 for i in range(n)]


# ---------------------------------------------------------------- archives


def test_archives_of_odd_pages(spark, tmp_path):
    bodies = [None, "", "é🙂" * 5, "x" * 300_000, "same", "same", "same", "\r\n\r\n"] + [prose(50, i) for i in range(40)]
    rows = [(None if i == 5 else i, f"http://h/{i}\r\nX: y" if i else None, b) for i, b in enumerate(bodies)] + [(6, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("kind", F.lit(1)).repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=4000)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    same = sorted(((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_digest == warc.digest(b"same")), key=str)
    assert same == sorted([(4, "revisit", 6), (None, "revisit", 6), (6, "response", None), (6, "response", None)], key=str)
    back = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert back[1] == b"" and bytes(back[3]) == b"x" * 300_000 and bytes(back[2]).decode() == "é🙂" * 5
    small = warc.round_trip(pages, revisit_min_bytes=5).filter("record_type = 'revisit'")
    assert small.isEmpty() and warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("harm", ["cut", "length", "digest", "magic"])
def test_broken_archives_are_refused(harm):
    import zstandard

    raw = warc.record(1, "http://h", b"payload", warc.digest(b"payload"), "response", None, "2024-01-01T00:00:00Z")
    if harm == "length":
        raw = raw.replace(b"Content-Length: 7\r\n", b"Content-Length: 8\r\n")
    if harm == "digest":
        raw = raw.replace(b"\r\n\r\npayload", b"\r\n\r\nPayload")
    data = zstandard.ZstdCompressor(write_checksum=True).compress(raw)
    data = {"cut": data[:-3], "magic": b"abcd" + data}.get(harm, data)
    with pytest.raises(warc.InvalidArchive):
        list(warc.records(data))


# ---------------------------------------------------------------- top k


def test_top_k_of_odd_vectors(spark):
    pick = np.random.default_rng(2)
    rows = [(i, [float(v) for v in pick.normal(size=8)]) for i in range(700)]
    rows += [(700, None), (701, [float("nan")] * 8), (702, [None] * 8), (703, [float("inf")] * 8), (704, [1e30] * 8), (None, rows[0][1])]
    rows += [(i, rows[0][1]) for i in range(710, 760)] + [(760, [0.5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).repartition(4)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == whole_number_top_k([(i, np.array(v, np.float32).tolist()) for i, v in rows if i is not None and not 700 <= i < 704])
    assert topk.top_k(frame.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(frame.filter("vec_id = 0"), F.lit(True)).count() == 0


def whole_number_top_k(rows, k=5):
    """Every query against every row in Python integers; scores are cut to 64 bits last."""
    used = {i: [math.floor(256 * Fraction(x)) for x in v] for i, v in rows}
    want = []
    for q in [i for i in used if i % 50 == 0]:
        best = sorted((-sum(a * b for a, b in zip(used[q], v)), i) for i, v in used.items() if i != q)[:k]
        want += [(q, r, i, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, i) in enumerate(best, 1)]
    return sorted(want)


@pytest.mark.parametrize("large", [[3e5], [3e5, 1e12], [1e300, -1.7e308], [262_144.0, 262_145.0]])
def test_top_k_of_large_components(spark, large, monkeypatch):
    """Large queries and candidates among others, ties between them, scores on both sides of 64 bits."""
    monkeypatch.setattr(topk, "LARGE_QUERIES", 2)
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(size=4).tolist()) for i in range(120)]
    for n, i in enumerate([0, 7, 50, 63, 64, 99]):
        rows[i] = (i, [*rows[i][1][:n % 4], large[n % len(large)] * (-1) ** n, *rows[i][1][n % 4 + 1:]])
    rows += [(200 + j, rows[50][1]) for j in range(4)] + [(300, [1e6]), (301, []), (302, None), (303, [None, 3e5]), (304, [math.inf, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == whole_number_top_k([r for r in rows if r[0] not in (302, 303, 304)])


def test_top_k_when_all_components_are_large(spark):
    rows = [(i, [1e9 + i, -1e9 * (i % 3)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == whole_number_top_k(rows)


def test_pruned_search_scores_fewer_blocks():
    pick = np.random.default_rng(1)
    centres = pick.normal(size=(20, 16)) * 400
    blocks = []
    for c in centres:
        x = np.floor(c + pick.normal(size=(50, 16)) * 20).astype(np.int64)
        blocks.append((np.arange(50) + 50 * len(blocks), x, x.min(axis=0), x.max(axis=0)))
    queries = np.stack([b[1][0] for b in blocks])
    best = topk.Best(20, 5)
    scored = topk.search(blocks, np.full(20, -1), queries, best)
    every = np.concatenate([b[1] for b in blocks])
    assert scored < 0.5 * 20 * 20
    assert np.array_equal(best.scores, -np.sort(-(queries @ every.T), axis=1)[:, :5])


# ---------------------------------------------------------------- long secrets


def test_a_random_run_of_any_length_is_measured(spark):
    """An embedded blob of 200 000 symbols: the work grows with its length, not its square."""
    import base64

    blob = base64.b64encode(random.Random(200_000).randbytes(150_000)).decode()
    got = secrets.find_secrets(docs(spark, [f"x {blob} y"])).first()
    assert [(s.start, s.end) for s in got.added] == [(2, 200_002)]


# ---------------------------------------------------------------- chat


def test_snapshots_collapse(spark):
    turns = {
        1: [("user", "a"), ("bot", "b")], 2: [("user", "a"), ("bot", "b"), ("user", "c")], 3: [("user", "a")],
        4: [("user", "x <|im_end|>"), (None, None)], 5: [("user", "x <|im_end|>"), ("", "")], 6: [("user", "a"), ("bot", "b"), ("user", "c")],
        None: [("user", "z")],
    }
    rows = [(c, i, r, t) for c, ts in turns.items() for i, (r, t) in enumerate(ts)]
    rows += [(7, 0, "user", f"turn {i}") for i in range(600)]  # ties in turn
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("page", F.lit(1)).repartition(4)
    got = {(r.conv_id, r.page): r for r in chat.collapsed(frame).collect()}
    assert set(got) == {(2, 0), (4, 0), (5, 0), (None, 0), (7, 0), (7, 1), (7, 2)}
    assert got[2, 0].copies == 2 and got[2, 0].n_turns == 3
    assert got[4, 0].rendered == "<|im_start|>user\nx < |im_end| ><|im_end|>\n<|im_start|>unknown\n<|im_end|>\n"
    ties = "".join(got[7, p].rendered for p in range(3))
    assert re.findall("turn [0-9]+", ties) == sorted(f"turn {i}" for i in range(600))
    assert chat.collapsed(frame.limit(0)).count() == 0
    # turns that are equal in turn and role follow their texts, nulls first, also beyond the part that decides the range
    long = "x" * 100
    texts = ["b", "x", "aa", "q", None, "", long + "b", long + "a", "é"]
    tied = spark.createDataFrame([(1, 0, "user", t) for t in texts], "conv_id long, turn long, role string, text string").repartition(3)
    lines = chat.collapsed(tied).first().rendered.split("<|im_end|>\n")[:-1]
    assert [t.removeprefix("<|im_start|>user\n") for t in lines] == ["", *sorted(t for t in texts if t is not None)]
