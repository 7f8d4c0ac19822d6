"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import BROADCAST_BYTES, BROADCAST_ROWS, materialise, shuffle_tasks

# Rows of one key that one task of a shuffled join should handle.
ROWS_PER_SALT = 1_000_000
# Wide rows that one task should sort.
ROWS_PER_TASK = 500_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows: partial counts, no rows moved."""
    return df.count() <= rows


def stored_bytes(df: DataFrame) -> int:
    """File size of a written table, from the optimizer's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    return reduce(
        lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs]
    )


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    rows: int = BROADCAST_ROWS,
    derived: bool = True,
) -> DataFrame:
    """Attach the columns of ``lookup`` (one row per key) to every row of ``big``.

    The lookup, usually an aggregate of a large table, is written once so that
    counting it does not compute it twice.  It is broadcast when its rows and its file
    size are both within bounds.  Otherwise the join shuffles, and keys of ``big`` with very many rows are spread over several
    salts (see :func:`salted_lookup_join`).  Nulls match nulls.  Without keys the
    lookup is a single row, attached as literals.  ``derived=False`` is for a lookup
    that is a plain scan and need not be written.
    """
    if not on:
        row = lookup.first()
        return big.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in lookup.schema})
    if derived:
        lookup = materialise(lookup, "lookup")
    if stored_bytes(lookup) > BROADCAST_BYTES or not fits_broadcast(lookup, rows):
        return salted_lookup_join(big, lookup, on, how)
    return _attach(big, F.broadcast(lookup), on, how)


def _attach(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    renamed = lookup.withColumnsRenamed({k: f"_r_{k}" for k in on})
    joined = big.join(renamed, _null_safe(big, renamed, [(k, f"_r_{k}") for k in on]), how)
    return joined.drop(*[f"_r_{k}" for k in on])


def hot_keys(df: DataFrame, on: Sequence[str], per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Keys with more than ``per_salt`` rows and the number of salts each needs.

    There are at most ``rows / per_salt`` of them.
    """
    return (
        df.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > per_salt)
        .select(*on, F.ceil(F.col("_n") / per_salt).cast("int").alias("_salts"))
    )


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast if it is within both bounds."""
    return F.broadcast(df) if stored_bytes(df) <= BROADCAST_BYTES and fits_broadcast(df) else df


def salted_lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Shuffled lookup join in which each hot key of ``big`` is split over salts.

    ``big`` is written once with a number per row; the salt is taken from that number, so
    that equal rows are split as well as different ones.
    """
    stored = materialise(big.withColumn("_row", F.monotonically_increasing_id()), "big")
    hot = small(materialise(hot_keys(stored, on, per_salt), "hot"))
    spread = (
        _attach(stored, hot, on, "left")
        .withColumn("_salt", F.pmod("_row", F.coalesce("_salts", F.lit(1))).cast("int"))
        .drop("_salts", "_row")
    )
    copies = (
        _attach(lookup, hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    return _attach(spread, copies, [*on, "_salt"], how).drop("_salt")


def hot_anti_join(left: DataFrame, right: DataFrame, per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Rows of ``left`` that are not in ``right``, which has the same columns; nulls match nulls.

    Rows move once and are not written: hot ones are found by hashes and stay where they are,
    to meet the few rows of ``right`` with those hashes.  The rows of a task do not grow.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.select(F.struct(*left.columns).alias("_k")).withColumn("_h", F.xxhash64("_k"))

    rows, known = hashed(left), hashed(right)
    hot = materialise(hot_keys(rows, ["_h"], per_salt).select("_h"), "hot")
    tasks = -(-left.count() // ROWS_PER_TASK)
    if hot.isEmpty():
        cold, apart = rows, None
    else:
        hot = small(hot)
        cold = rows.join(hot, "_h", "left_anti")
        few = small(materialise(known.join(hot, "_h", "left_semi").select("_k").distinct(), "hot-keys"))
        apart = rows.join(hot, "_h", "left_semi").select("_k").join(few, "_k", "left_anti")
    cold = cold.select("_k")
    if tasks > shuffle_tasks(left.sparkSession):
        cold = cold.repartition(tasks, "_k")
    # as one struct, rows with nulls are equal too, and the join finds the distinct rows dealt as it needs them
    kept = cold.join(known.select("_k").distinct(), "_k", "left_anti")
    return (kept if apart is None else kept.unionByName(apart)).select("_k.*")


def pair_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """All pairs per key (``inner`` or ``left``), with hot keys of either side split.

    A key with ``a`` times too many rows on the left and ``b`` times on the right is dealt
    over a grid of ``a * b`` tasks.  For a left join, the left rows without a partner are
    added by an anti-join with the distinct keys of the right.
    """
    numbered = [materialise(d.withColumn("_row", F.monotonically_increasing_id()), "side") for d in (left, right)]
    counts = [d.groupBy(*on).agg(F.count("*").alias(n)) for d, n in zip(numbered, ("_nl", "_nr"))]
    hot = _attach(counts[0], counts[1], on, "inner").filter((F.col("_nl") > per_salt) | (F.col("_nr") > per_salt))
    hot = small(materialise(
        hot.select(*on, *[F.ceil(F.col(n) / per_salt).cast("int").alias(s) for n, s in (("_nl", "_sl"), ("_nr", "_sr"))]),
        "hot",
    ))

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        salts = _attach(side, hot, on, "left")
        return (
            salts.withColumn(f"_at{own}", F.pmod("_row", F.coalesce(own, F.lit(1))).cast("int"))
            .withColumn(f"_at{other}", F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
            .drop("_row", "_sl", "_sr")
        )

    cell = ["_at_sl", "_at_sr"]
    pairs = _attach(dealt(numbered[0], "_sl", "_sr"), dealt(numbered[1], "_sr", "_sl"), [*on, *cell], "inner").drop(*cell)
    if how == "inner":
        return pairs
    found = numbered[1].select(*on).distinct().withColumn("_found", F.lit(True))
    alone = salted_lookup_join(numbered[0].drop("_row"), found, on, per_salt=per_salt).filter("_found is null").drop("_found")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in on]
    return pairs.unionByName(alone.select("*", *missing))
