"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SENSORS = tuple(f"R{i}" for i in range(1, 15))
CONTEXT = ("CO_ppm", "Humidity", "Temperature", "Flow_rate", "Heater_voltage")
SENSOR_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in ("Time", *CONTEXT, *SENSORS)]
)

# Languages for which Spark ships a stop-word list.
STOP_WORD_LANGUAGES = {
    "da": "danish", "nl": "dutch", "en": "english", "fi": "finnish", "fr": "french",
    "de": "german", "hu": "hungarian", "it": "italian", "no": "norwegian", "pt": "portuguese",
    "ru": "russian", "es": "spanish", "sv": "swedish", "tr": "turkish",
}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
    header: bool = True, sep: str = ",", **options: str,
) -> DataFrame:
    """CSV files named by path or glob.  Without a schema the types are inferred,
    which costs a pass over the files."""
    reader = spark.read.options(header=header, sep=sep, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def with_source_file(df: DataFrame, into: str = "source_file") -> DataFrame:
    """Add the path of the file each row came from."""
    return df.withColumn(into, F.col("_metadata.file_path"))


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def read_sensor_runs(spark: SparkSession, path: str) -> DataFrame:
    """Sensor recordings, one CSV file per run, with the run's file as a column."""
    return with_source_file(read_csv(spark, path, SENSOR_SCHEMA))


def read_pairs(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless tab-separated text columns."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return read_csv(spark, path, schema, header=False, sep="\t")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text, lower-cased."""
    return spark.read.text(path, wholetext=True).select(F.lower("value").alias("value"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed and without repeats."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter("word <> ''").distinct()


def stop_words(spark: SparkSession, languages: Sequence[str] = ("en",)) -> DataFrame:
    """Rows ``(lang, word)`` from the lists that ship with Spark."""
    rows = [
        (lang, word)
        for lang in languages
        for word in sorted(set(StopWordsRemover.loadDefaultStopWords(STOP_WORD_LANGUAGES[lang])))
    ]
    return spark.createDataFrame(rows, "lang string, word string")
