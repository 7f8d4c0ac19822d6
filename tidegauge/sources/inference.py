"""Column types of CSV files, inferred from all values of all files in one job.

Every value belongs to one class; a column's type is the least type that holds all of its
classes.  Files are profiled separately and then joined, so that a column whose type differs
between files (drift) or that only text can hold (conflict) is reported with the files' own
types.  Readers take explicit schemas by default; this is for files without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.session import materialise

# Bits of the classes of values.
BOOLEAN, INT, LONG, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << i for i in range(7))

#: A type holds the values of all the classes in its mask; the first that fits is taken.
LATTICE = (
    (0, "string"), (BOOLEAN, "boolean"), (INT, "int"), (INT | LONG, "bigint"), (INT | LONG | DOUBLE, "double"),
    (DATE, "date"), (DATE | TIMESTAMP, "timestamp_ntz"),
)


def value_class(text: Column) -> Column:
    """The class of one value; null and blank values have none.

    Whole numbers beyond 64 bits count as ``DOUBLE``, days that do not exist as ``TEXT``.
    """
    value = F.trim(text)
    whole = value.rlike(r"^[+-]?[0-9]+$")
    number = value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    day = value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull()
    moment = value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?$")
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(whole & value.try_cast("int").isNotNull(), INT)
        .when(whole & value.try_cast("bigint").isNotNull(), LONG)
        .when(number, DOUBLE)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .when(day, DATE)
        .when(moment & value.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )


def type_of(classes: Column) -> Column:
    """The least type for a set of classes; ``string`` where no other holds them all."""
    out = F.lit("string")
    for mask, name in reversed(LATTICE):
        out = F.when(classes.bitwiseAND(F.lit(~mask & 127)) == 0, F.lit(name)).otherwise(out)
    return out


def read_texts(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """All columns as text and the file of each row in ``_file``; nothing is inferred.

    ``enforceSchema=false``: a file whose header differs from the first one's is an error
    instead of values under wrong names.
    """
    reader = spark.read.options(**{"header": "true", "inferSchema": "false", "enforceSchema": "false", **options})
    return reader.csv(path).withColumn("_file", F.col("_metadata.file_path"))


def file_profile(texts: DataFrame, by: Column | None = None) -> DataFrame:
    """``(file, column, classes, n, blank)``: one row per file and column, from one pass.

    Partial results are as wide as the table, and only they are shuffled.  ``by`` groups
    files, for instance by folder.
    """
    names = [c for c in texts.columns if c != "_file"]
    measures = []
    for i, c in enumerate(names):
        value = value_class(F.col(f"`{c}`"))
        measures += [F.bit_or(value).alias(f"c{i}"), F.count_if(value == 0).alias(f"b{i}")]
    wide = texts.groupBy((F.col("_file") if by is None else by).alias("file")).agg(F.count("*").alias("n"), *measures)
    long = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.col(f"c{i}").alias("classes"), F.col(f"b{i}").alias("blank"))
        for i, c in enumerate(names)
    ])
    return materialise(wide.select("file", "n", F.inline(long)), "profile")


def type_report(profile: DataFrame) -> DataFrame:
    """One row per column: ``type``, values, blanks, files, and where files disagree.

    ``drifting`` counts the files whose own type is not the column's (files without values
    agree with any type); ``conflict`` is true where only text holds what are typed values
    in some file; ``own_types`` lists the types of the files.
    """
    own = profile.withColumn("own", type_of(F.col("classes"))).withColumn("has", F.col("classes") > 0)
    total = own.groupBy("position", "column").agg(
        F.bit_or("classes").alias("all"), F.sum("n").alias("n"), F.sum("blank").alias("blank"), F.count("*").alias("files"),
        F.array_sort(F.collect_set(F.when(F.col("has"), F.col("own")))).alias("own_types"),
    ).withColumn("type", type_of(F.col("all")))
    types = total.select("position", "type")
    differing = (
        own.join(F.broadcast(types), "position")  # one row per column
        .groupBy("position").agg(F.count_if(F.col("has") & (F.col("own") != F.col("type"))).alias("drifting"))
    )
    typed = F.size(F.array_remove("own_types", "string")) > 0
    mixed = (F.col("type") == "string") & (F.col("all") > 0) & (typed | (F.col("all") != TEXT))
    return total.join(F.broadcast(differing), "position").select(
        "position", "column", "type", "n", "blank", "files", "drifting", mixed.alias("conflict"), "own_types")


def infer_schema(profile: DataFrame) -> T.StructType:
    """The schema that holds all values of all files, columns in file order."""
    rows = type_report(profile).select("position", "column", "type").orderBy("position").collect()  # one per column
    return T.StructType([T.StructField(r["column"], T.DataType.fromDDL(r["type"])) for r in rows])


def read_inferred(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """The files with the types that :func:`infer_schema` finds; one pass more than with a schema."""
    schema = infer_schema(file_profile(read_texts(spark, path, **options)))
    return spark.read.options(**{
        "header": "true", "enforceSchema": "false", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
        "mode": "FAILFAST", **options,
    }).schema(schema).csv(path)
