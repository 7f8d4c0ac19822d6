"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams per language inside the tasks and adds the counts up in a
shuffle; only the finished matrix (buckets x languages, a size fixed by parameters)
reaches the driver and is broadcast.  Scoring looks up the rows of the matrix for the
n-grams of a text and adds them up, whole texts in bounded pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import wordhash as W
from tidegauge.llm.tables import keep, ship

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
#: Bound of the broadcast matrix: languages times buckets times four bytes.
MAX_LANGUAGES = 1024
#: Characters scored at a time, also within one long text.
PIECE = 1 << 18
UNKNOWN = "und"

_LETTER = r"\p{L}"


class Model:
    """Log probabilities (buckets x languages) and log priors."""

    def __init__(self, languages: list[str], counts: np.ndarray, texts: np.ndarray, smoothing: float):
        self.languages = languages
        smooth = counts.T + smoothing
        self.weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
        self.priors = np.log((texts + 1) / (texts + 1).sum())


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with a few megabytes of text, or one longer text."""
    for batch in batches:
        _, offsets = W.text_buffers(batch.column("_text"))
        for first, end in W.slices(offsets):
            yield batch.slice(first, end - first)


def _lowered(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after one space, and the offsets of the texts."""
    texts = [" " + x for x in batch.to_pylist()]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum([0] + [len(x) for x in texts])


def _buckets(points: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the ``order`` characters from each character on."""
    count = len(points) - order + 1
    sums = np.zeros(max(count, 0), np.uint64)
    for j, factor in enumerate(W.constants(order, 20 + order)):
        sums += points[j : j + count] * factor
    sums ^= sums >> np.uint64(29)
    sums *= np.uint64(0xBF58476D1CE4E5B9)
    return (sums >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int32)


def _pieces(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Runs of whole texts, or parts of one long text that overlap by an n-gram's reach."""
    reach = max(ORDERS) - 1
    for first, end in W.slices(offsets, PIECE):
        a, b = int(offsets[first]), int(offsets[end])
        if end - first > 1 or b - a <= PIECE:
            yield points[a:b], offsets[first : end + 1] - a, first
            continue
        for at in range(a, b, PIECE):
            part = points[at : min(b, at + PIECE + reach)]
            yield part, np.array([0, min(PIECE, b - at)]), first


def _entries(part: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse entries (text in the part, bucket), one array pair per n-gram order.

    N-grams belong to the text in which they start and must end within it; the
    characters beyond ``bounds[-1]`` only complete n-grams of a long text.
    """
    rows = len(bounds) - 1
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    limit = bounds[1:].copy()
    limit[-1] = len(part)
    for order in ORDERS:
        found = _buckets(part, order)[: len(owner)]
        inside = np.arange(len(found)) + order <= limit[owner[: len(found)]]
        yield owner[: len(found)][inside], found[inside]


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in _small(batches):
        languages = np.array(batch.column("_lang").to_pylist(), dtype=object)
        for language in set(languages.tolist()):
            chosen = pa.array(np.flatnonzero(languages == language))
            texts[language] = texts.get(language, 0) + len(chosen)
            total = totals.setdefault(language, np.zeros(BUCKETS, np.int64))
            points, offsets = _lowered(batch.column("_text").take(chosen))
            for part, bounds, _ in _pieces(points, offsets):
                for _, buckets in _entries(part, bounds):
                    total += np.bincount(buckets, minlength=BUCKETS)
    for language, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "language": pa.array([language] * (len(at) + 1), pa.string()),
            "bucket": np.append(at, -1).astype(np.int32),
            "n": np.append(total[at], texts[language]),
        })


def train(labelled: DataFrame, text: Column, lang: Column, smoothing: float = 0.5) -> Model | None:
    """Fit on the rows of ``labelled`` whose text and language are not null.

    Returns ``None`` when there are none.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.lower(text.cast("string")).alias("_text"), lang.cast("string").alias("_lang")).dropna()
    counts = keep(
        rows.mapInArrow(_counting, "language string, bucket int, n long")
        .groupBy("language", "bucket").agg(F.sum("n").alias("n")),
        "ngrams",
    )
    languages = [r[0] for r in counts.filter("bucket = -1").select("language").limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    languages.sort()
    table = counts.toArrow()  # at most BUCKETS + 1 rows per language
    place = {x: i for i, x in enumerate(languages)}
    row = np.array([place[x] for x in table.column("language").to_pylist()])
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    matrix, texts = np.zeros((len(languages), BUCKETS)), np.zeros(len(languages))
    grams = bucket >= 0
    matrix[row[grams], bucket[grams]] = n[grams]
    texts[row[~grams]] = n[~grams]
    return Model(languages, matrix, texts, smoothing)


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        for batch in _small(batches):
            texts = batch.column("_text")
            rows = len(texts)
            if model is None or rows == 0:
                best, share = [UNKNOWN] * rows, np.zeros(rows)
            else:
                sums = np.tile(model.priors, (rows, 1))
                points, offsets = _lowered(texts.fill_null(""))
                for part, bounds, first in _pieces(points, offsets):
                    for owner, buckets in _entries(part, bounds):
                        if len(owner):
                            starts = np.flatnonzero(np.diff(owner, prepend=-1))
                            sums[first + owner[starts]] += np.add.reduceat(
                                model.weights[buckets], starts, axis=0, dtype=np.float64
                            )
                top = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                known = np.array(batch.column("_letters").to_pylist(), dtype=bool)
                share = np.where(known, share, 0.0)
                best = [model.languages[i] if k else UNKNOWN for i, k in zip(top, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(best, pa.string()), pa.array(share, pa.float64())],
                ["doc", "lang_pred", "score"],
            )

    return run


def has_letter(text: Column) -> Column:
    """Whether a text has a letter; a null text has none."""
    return F.coalesce(text.cast("string").rlike(_LETTER), F.lit(False))


def identify(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The language of every whole text: ``doc`` (a struct), ``lang_pred``, ``score``.

    ``score`` is the posterior probability of the prediction.  A null text, a text
    without any letter, or any text under a missing model is ``und`` with score 0.
    Equal posteriors go to the alphabetically first language.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    body = F.col(text).cast("string")
    rows = docs.select(
        F.struct(*(docs.columns if carry is None else carry)).alias("doc"),
        F.lower(body).alias("_text"), has_letter(body).alias("_letters"),
    )
    kind = rows.select("doc", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(_scoring(shared), kind)


def remainder(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))
