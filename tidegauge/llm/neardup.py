"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

The shingle set of a text is sampled by MinHash.  Bands of samples bring together texts
that may be alike.  The samples of a one-permutation MinHash are folded into an odd sketch,
a bitmap of parities whose XOR population count estimates a high similarity within about a
hundredth from 256 bytes.  Candidates whose sketches rule out a link are left out, all
others are compared on their full sets.

Equal sets are one *class* from the start, so copies cost nothing.  Within a bucket every
class is compared with one member drawn by a hash of bucket and class; over the bands
each class meets many different partners, and a group of thousands of near copies is
joined by a number of comparisons that grows with its size, not with its square.  What
these leave apart is then settled whole: in each bucket that still holds several
components, the classes outside the component of the drawn member are compared with all
classes of other components, in blocks of packed sketches, and what the sketches leave
is confirmed as before.  Only classes that already share a component are not compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import wordhash as W
from tidegauge.llm.components import components
from tidegauge.llm.tables import keep, numbered, ship

#: Bits of an odd sketch, and bins of the one-permutation MinHash that fills it.
SKETCH_BITS = 2048
BINS_LOG2 = 16
BLOCK = 256
_MISS = 1e-6
_Z = 4.5


class Scheme:
    """Bands and the sketch cut for a similarity of ``percent`` / 100.

    A pair at the threshold shares no band with a probability below one in a million.
    """

    def __init__(self, percent: int):
        self.share = percent / 100
        self.rows = 5 if self.share >= 0.83 else 4 if self.share >= 0.75 else 3
        miss = 1 - min(self.share**self.rows, 1 - 1e-9)
        self.bands = max(1, math.ceil(math.log(_MISS) / math.log(miss)))

    def most_odd(self, size_a, size_b, held_a, held_b) -> np.ndarray:
        """The most differing bits that two sketches at the threshold can be expected to show.

        ``size`` is the number of shingles, ``held`` the number of samples in a sketch.  The
        samples that two sets at the threshold share are a known share of the bins that
        their union fills, give or take the samples lost where bins collide; all others
        differ, and the count of odd bits follows from their number.
        """
        share, bins, bits = self.share, float(1 << BINS_LOG2), float(SKETCH_BITS)
        union = (size_a + size_b) / (1 + share)
        filled = bins * -np.expm1(-union / bins)
        lost = 1 - filled / np.maximum(union, 1)
        common = share * filled - _Z * np.sqrt(2 * share * (1 - share) * filled * np.maximum(lost, 0)) - 1
        apart = np.maximum(held_a + held_b - 2 * common, 0)
        even, pair = (1 - 2 / bits) ** apart, (1 - 4 / bits) ** apart
        odd = (1 - even) / 2
        spread = bits * odd * (1 - odd) + bits * (bits - 1) * ((1 - 2 * even + pair) / 4 - odd * odd)
        return np.ceil(bits * odd + _Z * np.sqrt(np.maximum(spread, 0)))


def estimate(odd_bits: float, held_a: int, held_b: int, bits: int = SKETCH_BITS) -> float:
    """The similarity that ``odd_bits`` differing bits of two sketches stand for."""
    free = 1 - 2 * odd_bits / bits
    if free <= 0:
        return 0.0
    apart = -bits / 2 * math.log(free)
    return max(0.0, (held_a + held_b - apart) / max(held_a + held_b + apart, 1))


def minhash(items: np.ndarray, samples: int) -> np.ndarray:
    """The least value of every hash function over a set of 64-bit items."""
    a, b = W.constants(samples, 11), W.constants(samples, 12)
    out = np.full(samples, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(items), 2048):
        out = np.minimum(out, (np.multiply.outer(items[i : i + 2048], a) + b).min(axis=0))
    return out


def odd_sketch(items: np.ndarray) -> tuple[bytes, int]:
    """Parity bitmap of the one-permutation MinHash samples of a sorted set, and their number.

    The least item of each bin (the leading bits) is a sample and flips one bit.
    """
    bins = items >> np.uint64(64 - BINS_LOG2)
    samples = items[np.flatnonzero(np.diff(bins, prepend=np.uint64(1 << BINS_LOG2)))] if len(items) else items
    flips = np.bincount((W.mix(samples) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(flips.astype(bool)).tobytes(), len(samples)


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` samples; the band's number is part of it."""
    count = samples.shape[1] // rows
    parts = samples.reshape(samples.shape[0], count, rows) * W.constants(rows, 14)
    return W.mix(parts.sum(axis=2, dtype=np.uint64) ^ W.constants(count, 15)).view(np.int64)


_SIGNED = "_rid long, n_shingles long, class_a long, class_b long, bands array<long>, sketch binary, held int"


def _signatures(shingle: int, scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("_text"))
            for first, end in W.slices(offsets):
                sets = W.shingle_sets(W.Words(data, offsets[first : end + 1], W.SPACED), shingle)
                keys = band_keys(np.stack([minhash(s, scheme.rows * scheme.bands) for s in sets]), scheme.rows)
                sketches = [odd_sketch(s) for s in sets]
                mixed = [(int(W.mix(s).sum(dtype=np.uint64)), int(W.mix(s ^ np.uint64(77)).sum(dtype=np.uint64))) for s in sets]
                mixed = np.array(mixed, np.uint64).view(np.int64).reshape(len(sets), 2)
                counts = [len(s) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "_rid": batch.column("_rid").slice(first, end - first),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "class_a": pa.array(mixed[:, 0]),
                    "class_b": pa.array(mixed[:, 1]),
                    "bands": pa.array([k if n else None for k, n in zip(keys, counts)], pa.list_(pa.int64())),
                    "sketch": pa.array([x for x, _ in sketches], pa.binary()),
                    "held": pa.array([n for _, n in sketches], pa.int32()),
                })

    return run


def _confirming(shingle: int, percent: int):
    """Keeps the pairs whose full sets are alike: 100 * intersection >= percent * union."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        data, offsets = W.text_buffers(column)
        return [
            s
            for first, end in W.slices(offsets)
            for s in W.shingle_sets(W.Words(data, offsets[first : end + 1], W.SPACED), shingle)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                mask = []
                for a, b in zip(sets(batch.column("_text_a")), sets(batch.column("_text_b"))):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    mask.append(100 * common >= percent * (len(a) + len(b) - common))
                yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return run


def _bits(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), SKETCH_BITS // 64)


def _pairs_near(scheme: Scheme):
    """Keeps the pairs whose sketches do not rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c).to_pylist() for c in ("sa", "sb")]
            odd = np.bitwise_count(_bits(sides[0]) ^ _bits(sides[1])).sum(axis=1, dtype=np.int64)
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb", "ha", "hb")]
            yield batch.select(["a", "b"]).filter(pa.array(odd <= scheme.most_odd(*sizes)))

    return run


def _blocks_near(scheme: Scheme):
    """Pairs of two packed blocks with different labels whose sketches do not rule out a link.

    A pair is given in the first of the bands that its two classes share, and only there.
    """

    def side(pack: list[dict]) -> dict[str, np.ndarray]:
        out = {k: np.array([m[k] for m in pack], np.int64) for k in ("rid", "label", "size", "held", "bands")}
        return out | {"bits": _bits([m["sketch"] for m in pack])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, one, two in zip(*(batch.column(c) for c in ("key", "one", "two"))):
                x, y = side(one.as_py()), side(two.as_py())
                odd = np.zeros((len(x["rid"]), len(y["rid"])), np.int32)
                for j in range(x["bits"].shape[1]):
                    odd += np.bitwise_count(x["bits"][:, j, None] ^ y["bits"][None, :, j])
                most = scheme.most_odd(x["size"][:, None], y["size"][None, :], x["held"][:, None], y["held"][None, :])
                i, k = np.nonzero((odd <= most) & (x["label"][:, None] != y["label"][None, :]))
                shared = x["bands"][i] == y["bands"][k]
                first = x["bands"][i, shared.argmax(axis=1)] == key.as_py() if len(i) else np.zeros(0, bool)
                a, b = x["rid"][i][first], y["rid"][k][first]
                yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def similar_classes(docs: DataFrame, text: Column, shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Classes of equal shingle sets and the component that each belongs to.

    ``docs`` comes from :func:`tidegauge.llm.tables.numbered`; ``text`` is a string column
    of it.  Returns ``(signed, labels)``: per row ``_rid, n_shingles, class_a, class_b``
    (the class; a row without shingles is never linked), and per class with a partner
    ``class_rid`` (the smallest ``_rid`` of the class) and ``label`` (the smallest
    ``class_rid`` that links lead to).
    """
    spark = docs.sparkSession
    ship(spark)
    scheme = Scheme(percent)
    texts = docs.select("_rid", text.cast("string").alias("_text"))
    signed = keep(texts.mapInArrow(_signatures(shingle, scheme), _SIGNED), "signed")
    classes = keep(
        signed.filter("n_shingles > 0").groupBy("class_a", "class_b")
        .agg(F.min(F.struct("_rid", "n_shingles", "held", "sketch", "bands")).alias("m"))
        .select(F.col("m._rid").alias("rid"), F.col("m.n_shingles").alias("size"), "m.held", "m.sketch", "m.bands"),
        "classes",
    )
    keys = classes.select("rid", F.explode("bands").alias("key"))
    # The drawn member of a bucket: the least hash of bucket and class.
    drawn = (
        keys.groupBy("key")
        .agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("key", "rid").alias("h"), "rid")).alias("m"))
        .filter("size > 1").select("key", "size", F.col("m.rid").alias("hub"))
    )
    buckets = keep(keys.join(drawn, "key"), "buckets")
    stars = (
        buckets.filter("rid <> hub").select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")).distinct()
    )
    def sided(side: str) -> DataFrame:
        return classes.select(F.col("rid").alias(side), F.col("sketch").alias(f"s{side}"), F.col("size").alias(f"n{side}"), F.col("held").alias(f"h{side}"))

    near = (
        stars.join(sided("a"), "a").join(sided("b"), "b").select("a", "b", "sa", "sb", "na", "nb", "ha", "hb")
        .mapInArrow(_pairs_near(scheme), "a long, b long")
    )
    first = keep(_confirm(near, texts, shingle, percent), "linked")
    labels = keep(components(first), "labels")
    second = keep(_confirm(_across(buckets, labels, classes, scheme), texts, shingle, percent), "linked")
    if second.take(1):
        tree = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = components(tree.unionByName(second))
    return signed.drop("bands", "sketch", "held"), keep(labels.withColumnRenamed("node", "class_rid"), "labels")


def _across(buckets: DataFrame, labels: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs ``(a, b)`` of one bucket and different components whose sketches are near."""
    known = labels.select(F.col("node").alias("rid"), "label")
    placed = (
        buckets.filter("size > 2").join(known, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    )
    mixed = (
        placed.groupBy("key").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.max("size").alias("size"),
            F.max(F.when(F.col("rid") == F.col("hub"), F.col("label"))).alias("main"),
        ).filter("low < high").select("key", "main", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    members = placed.select("key", "rid", "label").join(mixed, "key").join(classes, "rid")
    packs = keep(
        members.groupBy(
            "key", "blocks", (F.col("label") != F.col("main")).alias("apart"),
            F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("block"),
        ).agg(F.collect_list(F.struct("rid", "label", "size", "held", "bands", "sketch")).alias("pack")),
        "packs",
    )
    one = packs.filter("apart").select(
        "key", F.col("pack").alias("one"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    two = packs.select("key", "block", F.col("pack").alias("two"))
    pairs = one.join(two, ["key", "block"]).select("key", "one", "two")
    return pairs.mapInArrow(_blocks_near(scheme), "a long, b long").distinct()


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs that are alike on their full sets."""
    sided = (
        pairs.join(texts.withColumnsRenamed({"_rid": "a", "_text": "_text_a"}), "a")
        .join(texts.withColumnsRenamed({"_rid": "b", "_text": "_text_b"}), "b")
    )
    return sided.select("a", "b", "_text_a", "_text_b").mapInArrow(_confirming(shingle, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per row of ``docs``, its near-duplicate component.

    Two texts are linked when their shingle sets have 100 * intersection >= ``percent``
    * union.  Columns: ``doc`` (the row as a struct), ``n_shingles``, ``component_id``
    (the smallest id that can be reached), ``kept`` (the id is the component's id) and
    ``first`` (true for exactly one row of every component, also if ids repeat).

    Words are maximal runs without ASCII white space, A-Z lower-cased.  A text of fewer
    words than a shingle is one shingle.  A null or empty text, or one of white space
    only, is linked with nothing and is its own component.  Null ids count as larger
    than all others; a component without any id has a null ``component_id``, and its
    rows count as kept.  Repeated rows are copies of each other.  An empty table gives
    an empty result.
    """
    rows = numbered(docs, "documents")
    return _decide(rows, *similar_classes(rows, F.col("doc")[text], shingle, percent), doc_id)


def _decide(rows: DataFrame, signed: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_rid").alias("rid"))
    ids = signed.join(rows.select("_rid", F.col("doc")[doc_id].alias("_id")), "_rid")
    classes = (
        ids.filter("n_shingles > 0").groupBy("class_a", "class_b")
        .agg(F.min("_rid").alias("class_rid"), F.min(order).alias("best"))
        .join(labels, "class_rid", "left").withColumn("label", F.coalesce("label", "class_rid"))
    )
    best = classes.groupBy("label").agg(F.min("best").alias("top"))
    placed = keep(classes.join(best, "label").select("class_a", "class_b", "top"), "components")
    decided = ids.join(placed, ["class_a", "class_b"], "left").select(
        "_rid", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("top.id")).otherwise(F.col("_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("top.rid") == F.col("_rid")).otherwise(F.lit(True)).alias("first"),
    )
    return rows.join(decided, "_rid").select(
        "doc", "n_shingles", "component_id",
        F.coalesce(F.col("doc")[doc_id] == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
        "first",
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but one of each near-duplicate component."""
    return near_duplicates(docs, doc_id, text, shingle, percent).filter("first").select("doc.*")
