"""A training corpus from ``documents``: each stage takes what the one before it kept.

The stages drop documents without a recognised language, keep one of each group of near
duplicates, drop documents with benchmark passages, repeat small sources up to their
target weights, and deal the result over shards in a reproducible shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, langid, mixing, neardup, sharding
from tidegauge.llm.tables import keep

SHARDS = 16
SHUFFLE_KEY = 20240229


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach; ``und`` goes.

    A text is ``und`` if it is null or has no letter; a short or mixed text keeps its most
    likely language and stays.  Where no document has a language, all with a letter stay.
    """
    model = langid.train(docs, F.col("text"), F.col("lang"))
    if model is None:
        return docs.filter(langid.has_letter(F.col("text")))
    return langid.identify(docs, model).filter(F.col("lang_pred") != langid.UNKNOWN).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    return neardup.deduplicated(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or a shorter item, go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with those of small sources repeated up to their tempered weights."""
    return mixing.mixed(docs).select("doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents with ``shard`` and ``slot``."""
    docs = docs.drop("shard", "slot")
    order = ["doc_id", *[c for c in ("source", "lang", "n_chars") if c in docs.columns]]
    return sharding.sharded(docs, order, SHARDS, SHUFFLE_KEY).select("doc.*", "shard", "slot")


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Trained models, sampled hashes and keyed permutations have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
