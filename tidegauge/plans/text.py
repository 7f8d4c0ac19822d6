"""Text and character-sequence queries over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import scalar as S
from tidegauge.operators import text
from tidegauge.plans.registry import query, table
from tidegauge.session import fresh_path
from tidegauge.sources import readers
from tidegauge.sources.stopwords import ENGLISH


def lines(spark, sf_dir):
    """One row per line of the documents."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(S.text_lines(F.col("text"))).alias("line_no", "value")
    )


# White space as Python splits on it, written for DuckDB's regular expressions.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_LINES = """lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS value
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""
_TOKENS = f"""tokens AS (SELECT doc_id, unnest([w for w in regexp_split_to_array(text, '{_SPACE}') if w <> '']) AS word
    FROM documents)"""
_FIELDS = f"WITH {_LINES}, f AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines)"


@query("line_lengths", f"WITH {_LINES} SELECT doc_id, line_no, length(value) AS n FROM lines")
def line_lengths(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "line_no", F.length("value").alias("n"))


@query(
    "malformed_lines",
    f"""WITH {_LINES} SELECT count(*) FILTER (WHERE len(string_split(value, ' ')) <= 2) AS malformed,
        count(*) AS lines FROM lines""",
)
def malformed_lines(spark, sf_dir):
    """Lines written to text files and read back from them."""
    path = fresh_path(spark, "lines")
    lines(spark, sf_dir).select("value").write.text(path)
    return text.malformed_lines(readers.read_lines(spark, path), "value")


@query(
    "long_tokens",
    f"WITH {_TOKENS} SELECT doc_id, word FROM tokens WHERE length(word) > 5",
)
def long_tokens(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.tokens(documents, "text").filter(F.length("word") > 5)


@query(
    "tokenise",
    f"""SELECT doc_id, len(string_split(text, ' ')) AS fields, len(w) AS words,
               md5(array_to_string(w, ' ')) AS digest
        FROM (SELECT doc_id, text, [w for w in regexp_split_to_array(text, '{_SPACE}') if w <> ''] AS w FROM documents)""",
)
def tokenise(spark, sf_dir):
    """Both tokenisers: fields between single spaces, and words between white space."""
    found = table(spark, sf_dir, "documents").select(
        "doc_id", S.space_fields(F.col("text")).alias("f"), S.words(F.col("text")).alias("w")
    )
    return found.select(
        "doc_id", F.size("f").alias("fields"), F.size("w").alias("words"),
        F.md5(F.array_join("w", " ")).alias("digest"),
    )


@query(
    "word_count",
    _FIELDS + " SELECT word, count(*) AS count FROM f WHERE word <> '' GROUP BY word",
)
def word_count(spark, sf_dir):
    return text.word_count(lines(spark, sf_dir), "value")


@query(
    "top10_words",
    _FIELDS + " SELECT word, count(*) AS count FROM f WHERE word <> '' GROUP BY word ORDER BY 2 DESC, 1 LIMIT 10",
)
def top10_words(spark, sf_dir):
    return text.top_words(lines(spark, sf_dir), "value", 10)


_STOP_LIST = ", ".join("('" + w.replace("'", "''") + "')" for w in dict.fromkeys(ENGLISH))


@query(
    "stopword_filter",
    f"""WITH {_TOKENS}, stop(w) AS (VALUES {_STOP_LIST})
        SELECT word, count(*) AS count FROM tokens WHERE lower(word) NOT IN (SELECT w FROM stop) GROUP BY word""",
)
def stopword_filter(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("text")
    stop = spark.createDataFrame([(w,) for w in dict.fromkeys(ENGLISH)], "word string")
    kept = text.without_stop_words(text.tokens(documents, "text"), "word", stop)
    return kept.groupBy("word").agg(F.count("*").alias("count"))


@query("stopword_filter_by_language")
def stopword_filter_by_language(spark, sf_dir):
    """Word counts per language without the stop words of that language."""
    documents = table(spark, sf_dir, "documents").select("lang", "text")
    stop = readers.stop_words(spark, sorted(readers.STOP_WORD_LANGUAGES))
    kept = text.without_stop_words(text.tokens(documents, "text"), "word", stop, on=["lang"])
    return kept.groupBy("lang", "word").agg(F.count("*").alias("count"))


@query(
    "hash_sample",
    f"""WITH {_LINES} SELECT doc_id, line_no, value FROM lines
        WHERE CAST('0x' || substr(md5(doc_id || '|' || line_no || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.1""",
)
def hash_sample(spark, sf_dir):
    """Seeded ten per cent sample that a rerun on any cluster repeats."""
    share = S.hash_unit(F.col("doc_id"), F.col("line_no"), F.lit(42))
    return lines(spark, sf_dir).filter(share < 0.1)


@query("bernoulli_sample")
def bernoulli_sample(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").sample(False, 0.01, seed=42)


# ---------------------------------------------------------------- characters

_CHARS = """chars AS (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM {source}),
    vocab AS (SELECT c AS "char", CAST(row_number() OVER (ORDER BY c) - 1 + {offset} AS INTEGER) AS id
              FROM chars WHERE c <> '')"""


@query(
    "char_vocab",
    "WITH " + _CHARS.format(source="documents", offset=1) + ' SELECT "char", id FROM vocab',
)
def char_vocab(spark, sf_dir):
    return text.char_vocabulary(table(spark, sf_dir, "documents"), ["text"], offset=1)


@query(
    "encode_chars",
    "WITH "
    + _CHARS.format(source="documents", offset=1)
    + """, p AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS c
                 FROM (SELECT doc_id, string_split(text, '') AS l FROM documents))
       SELECT d.doc_id, coalesce(n, 0) AS n, md5(coalesce(ids, '')) AS digest FROM documents d LEFT JOIN
         (SELECT doc_id, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY i) AS ids
          FROM p JOIN vocab ON c = "char" GROUP BY doc_id) e ON d.doc_id = e.doc_id""",
)
def encode_chars(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = text.char_vocabulary(documents, ["text"], offset=1)
    encoded = documents.select(
        "doc_id", text.encode_characters(F.col("text"), vocabulary).alias("ids")
    )
    return encoded.select(
        "doc_id", F.size("ids").alias("n"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("digest"),
    )


def turn_pairs(spark, sf_dir):
    """Each turn of a conversation with the next one; turns are numbered without gaps."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    nexts = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return turns.join(nexts, ["conv_id", "turn"])


_PAIRS = """pairs AS (SELECT a.conv_id, a.turn, a.text, b.text AS reply FROM conversations a
    JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""
_CODES = """x AS (SELECT conv_id, turn, generate_subscripts(l, 1) AS i, unnest(l) AS c
        FROM (SELECT conv_id, turn, string_split({column}, '') AS l FROM pairs)),
    ids AS (SELECT conv_id, turn, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY i) AS ids
        FROM x JOIN vocab ON c = "char" GROUP BY ALL)"""


@query(
    "seq_pairs",
    "WITH " + _CHARS.format(source="conversations", offset=2) + f", {_PAIRS}, "
    + _CODES.format(column="reply")
    + """ SELECT p.conv_id, p.turn, md5('1' || coalesce(',' || ids, '')) AS decoder_input,
                 md5(coalesce(ids || ',', '') || '0') AS decoder_label
          FROM pairs p LEFT JOIN ids ON p.conv_id = ids.conv_id AND p.turn = ids.turn""",
)
def seq_pairs(spark, sf_dir):
    pairs = turn_pairs(spark, sf_dir)
    vocabulary = text.char_vocabulary(table(spark, sf_dir, "conversations"), ["text"], offset=2)
    coded = text.sequence_pairs(pairs, "text", "reply", vocabulary, vocabulary)

    def digest(column):
        return F.md5(F.array_join(F.col(column).cast("array<string>"), ",")).alias(column)

    return coded.select("conv_id", "turn", digest("decoder_input"), digest("decoder_label"))


@query(
    "pad_sequences",
    "WITH " + _CHARS.format(source="conversations", offset=2) + f", {_PAIRS}, "
    + _CODES.format(column="text")
    + """, m AS (SELECT max(n) AS m FROM ids)
       SELECT p.conv_id, p.turn, m AS n, md5(array_to_string(list_concat(
           CASE WHEN ids IS NULL THEN []::VARCHAR[] ELSE string_split(ids, ',') END,
           ['0' for i in range(m - coalesce(n, 0))]), ',')) AS digest
       FROM pairs p CROSS JOIN m LEFT JOIN ids ON p.conv_id = ids.conv_id AND p.turn = ids.turn""",
)
def pad_sequences(spark, sf_dir):
    vocabulary = text.char_vocabulary(table(spark, sf_dir, "conversations"), ["text"], offset=2)
    coded = turn_pairs(spark, sf_dir).select(
        "conv_id", "turn", text.encode_characters(F.col("text"), vocabulary).alias("ids")
    )
    return text.padded(coded, "ids").select(
        "conv_id", "turn", F.size("ids").alias("n"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("digest"),
    )


@query(
    "char_windows",
    """SELECT doc_id, CAST(i AS INTEGER) AS start, substr(low, i + 1, 40) AS "window", substr(low, i + 41, 1) AS next_char
       FROM (SELECT doc_id, lower(text) AS low, unnest(range(0, length(text) - 40, 3)) AS i FROM documents)""",
)
def char_windows(spark, sf_dir):
    """Windows of 40 characters, every third position of every whole text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return text.char_windows(documents, "text", 40, 3)
