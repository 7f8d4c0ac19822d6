"""Character operators against plain Python, with characters outside the basic plane."""

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import text

TEXTS = ["hello world, this is a longer line of text \U0001f600 with\nbreaks", "añb\U0001f680c", "", "x" * 41, "0123456789" * 30]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


@pytest.mark.parametrize("length,stride,block", [(40, 3, 1), (5, 1, 4), (4, 3, 256)])
def test_windows(docs, length, stride, block):
    got = {tuple(r) for r in text.char_windows(docs, "text", length, stride, block).collect()}
    want = {
        (i, s, t[s : s + length], t[s + length])
        for i, t in enumerate(TEXTS) for s in range(0, len(t) - length, stride)
    }
    assert got == want


@pytest.mark.parametrize("pieces", [1, 3, 5, 1000])
def test_windows_are_cut_from_pieces(docs, monkeypatch, pieces):
    """However short the pieces, and whether or not they divide a block, each window comes once."""
    monkeypatch.setattr(text, "PIECE_WINDOWS", pieces)
    got = sorted(tuple(r) for r in text.char_windows(docs, "text", 10, 3, 7).collect())
    assert got == sorted((i, s, t[s : s + 10], t[s + 10]) for i, t in enumerate(TEXTS) for s in range(0, len(t) - 10, 3))


def test_blocks_cover_the_text(docs):
    rows = text.text_blocks(docs, "text", 7, 3).collect()
    for i, t in enumerate(TEXTS):
        blocks = {r["block_start"]: r["block"] for r in rows if r["id"] == i}
        assert blocks == {s: t[s : s + 10] for s in range(0, len(t), 7)}


def test_vocabulary_and_encoding(spark, docs):
    vocabulary = text.char_vocabulary(docs, ["text"], offset=2)
    ids = {r["char"]: r["id"] for r in vocabulary.collect()}
    assert ids == {c: i + 2 for i, c in enumerate(sorted(set("".join(TEXTS))))}
    other = spark.createDataFrame([("aZ\U0001f680",), ("",)], "t string")
    got = [r[0] for r in other.select(text.encode_characters(F.col("t"), vocabulary, True)).collect()]
    assert got == [[1, ids["a"], 0, ids["\U0001f680"]], [1]]


def test_padding(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([4],), ([],)], "ids array<int>")
    assert [r[0] for r in text.padded(df, "ids").collect()] == [[1, 2, 3], [4, 0, 0], [0, 0, 0]]
    assert [r[0] for r in text.padded(df, "ids", 2).collect()] == [[2, 3], [4, 0], [0, 0]]


def test_sequence_pairs_and_one_hot(spark):
    df = spark.createDataFrame([("ab", "ba")], "en string, fr string")
    row = text.sequence_pairs(df, "en", "fr", text.char_vocabulary(df, ["en"], 2), text.char_vocabulary(df, ["fr"], 2)).first()
    assert (row["encoder_input"], row["decoder_input"], row["decoder_label"]) == ([2, 3], [1, 3, 2], [3, 2, 0])
    assert spark.range(1).select(text.one_hot_ids(F.array(F.lit(1), F.lit(0)), 3)).first()[0] == [[0, 1, 0], [1, 0, 0]]


def test_stop_words_ignore_case(spark):
    words = spark.createDataFrame([("The", "en"), ("cat", "en"), ("le", "fr")], "word string, lang string")
    stop = spark.createDataFrame([("en", "the"), ("fr", "le")], "lang string, word string")
    assert [r["word"] for r in text.without_stop_words(words, "word", stop).collect()] == ["cat"]
    english = stop.filter("lang = 'en'")
    assert text.without_stop_words(words, "word", english, ["lang"]).count() == 2
