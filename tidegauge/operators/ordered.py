"""Row order as data: positions, order statistics and sliding frames.

Spark has no row order and a window without a partition key runs in one task.
These functions give every row an explicit position (``rn``, from 0) and evaluate
row frames on chunks of consecutive positions, so that neither one long series nor
one dominant key ends up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.operators.joins import fits_broadcast, lookup_join
from tidegauge.session import materialise

CHUNK_ROWS = 65_536

_LOCAL_BITS = 33  # layout of monotonically_increasing_id: partition, then position


def _range_sorted(df: DataFrame, sort_cols: Sequence[str]) -> DataFrame:
    """``df`` written in global sort order, with the place of each row in ``_at``."""
    return materialise(
        df.repartitionByRange(*sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted",
    )


def _part() -> Column:
    return F.shiftright(F.col("_at"), _LOCAL_BITS).cast("int")


def _place() -> Column:
    return F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))


def index_rows(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), into: str = "rn"
) -> DataFrame:
    """Number rows from 0 in ``order_by`` order, within ``keys`` if given.

    Equals ``row_number() - 1`` when ``order_by`` is unique, but works by range
    partitioning: each partition numbers its own rows and a table of one row per
    partition supplies the offsets.  A key that holds most of the rows simply spans
    many partitions.
    """
    table = _range_sorted(df, [*keys, *order_by])
    spark = df.sparkSession
    offsets, total = [], 0
    # One row per written partition: bounded by the partition count, not the data.
    for part, rows in sorted(table.groupBy(_part().alias("p")).count().collect()):
        offsets.append((part, total))
        total += rows
    if len(offsets) > 1:
        places = spark.createDataFrame(offsets, "_p int, _offset long")
        table = table.join(F.broadcast(places), _part() == F.col("_p")).withColumn(
            "_pos", F.col("_offset") + _place()
        )
    else:
        table = table.withColumn("_pos", _place())
    if not keys:
        return table.select(*df.columns, F.col("_pos").alias(into))
    starts = table.groupBy(*keys).agg(F.min("_pos").alias("_start"))
    return lookup_join(table, starts, list(keys)).select(
        *df.columns, (F.col("_pos") - F.col("_start")).alias(into)
    )


def with_halo(
    df: DataFrame,
    rn: str = "rn",
    keys: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Assign rows to chunks and copy edge rows into the neighbouring chunks.

    Adds ``_chunk`` and ``_own`` (false for copies).  Each chunk then holds the
    ``before`` rows ahead of it and the ``after`` rows behind it.
    """
    size = max(chunk, before, after, 1)
    home = F.floor(F.col(rn) / size)
    offset = F.pmod(F.col(rn), F.lit(size))
    homes = F.array_compact(
        F.array(
            home,
            F.when(offset >= size - before, home + 1),
            F.when((offset < after) & (home > 0), home - 1),
        )
    )
    return df.withColumn("_chunk", F.explode(homes)).withColumn("_own", F.col("_chunk") == home)


def sliding(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    rn: str = "rn",
    keys: Sequence[str] = (),
    before: int = 0,
    after: int = 0,
    chunk: int = CHUNK_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` / ``after`` rows.

    ``build`` receives the ordered window of a chunk and returns the new columns.  Chunks are
    dealt over ``tasks`` if given: small ones may become large by their new columns.
    """
    pieces = with_halo(df, rn, keys, before, after, chunk)
    if tasks:
        pieces = pieces.repartition(tasks, *keys, "_chunk")
    window = Window.partitionBy(*keys, "_chunk").orderBy(rn)
    named = build(window)
    return (
        pieces.select("*", *[c.alias(n) for n, c in named.items()])
        .filter("_own")
        .drop("_chunk", "_own")
    )


def running_sums(
    df: DataFrame,
    values: dict[str, str],
    rn: str = "rn",
    keys: Sequence[str] = (),
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Running totals (``{new column: summed column}``) along ``rn``.

    Chunk totals are summed first (one row per chunk), then each chunk adds the
    total of the chunks before it to its own running sum.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(rn) / chunk))
    totals = chunked.groupBy(*keys, "_chunk").agg(
        *[F.sum(c).alias(f"_t_{n}") for n, c in values.items()]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = totals.select(
        *keys,
        "_chunk",
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0.0)).alias(f"_b_{n}") for n in values],
    )
    local = (
        Window.partitionBy(*keys, "_chunk").orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        lookup_join(chunked, bases, [*keys, "_chunk"])
        .select(
            *df.columns,
            *[(F.col(f"_b_{n}") + F.sum(c).over(local)).alias(n) for n, c in values.items()],
        )
    )


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = F.lit(True)
    for key in keys:
        same = same & left[key].eqNullSafe(renamed[f"_same_{key}"])
    return left.join(renamed, same).drop(*[f"_same_{k}" for k in keys])


def order_statistics(
    df: DataFrame, value: str, positions: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Values at given ranks (from 0) of the sorted non-null ``value`` column.

    ``positions`` has the key columns and ``pos``; the result adds the value there.
    Equal values are counted together before the sort, and only the partition
    that holds a wanted rank is looked at row by row.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_n"))
    )
    table = _range_sorted(counted, [*keys, value]).withColumn("_p", _part())
    per_part = table.groupBy(*keys, "_p").agg(F.sum("_n").alias("_rows"))
    upto = Window.partitionBy(*keys).orderBy("_p")
    spans = per_part.select(
        *keys, "_p", "_rows", (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before")
    )
    wanted = positions.select(*keys, "pos").distinct().alias("w")
    inside = (F.col("pos") >= F.col("_before")) & (F.col("pos") < F.col("_before") + F.col("_rows"))
    for key in keys:
        inside = F.col(f"w.{key}").eqNullSafe(F.col(f"s.{key}")) & inside
    located = wanted.join(spans.alias("s"), inside).select(
        *[f"w.{k}" for k in keys], "pos", "_p", "_before"
    )
    if fits_broadcast(located):
        located = F.broadcast(located)
    cut = Window.partitionBy(*keys, "pos").orderBy(value)
    return (
        _same_keys(table.drop("_at"), located, [*keys, "_p"])
        .withColumn("_last", F.col("_before") + F.sum("_n").over(cut))
        .filter((F.col("_last") > F.col("pos")) & (F.col("_last") - F.col("_n") <= F.col("pos")))
        .select(*keys, "pos", value)
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles, one row per key and probability.

    Needs no task that sees all distinct values, unlike ``percentile``.
    """
    sizes = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_rows"))
    targets = sizes.select(
        *keys, "_rows", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    ).withColumn("_place", F.col("prob") * (F.col("_rows") - 1))
    targets = targets.withColumns(
        {"_lo": F.floor("_place"), "_hi": F.ceil("_place"), "_f": F.expr("_place - floor(_place)")}
    )
    positions = targets.select(*keys, F.explode(F.array("_lo", "_hi")).alias("pos"))
    found = materialise(order_statistics(df, value, positions, keys), "quantiles")
    low = found.select(*keys, F.col("pos").alias("_lo"), F.col(value).alias("_vlo"))
    high = found.select(*keys, F.col("pos").alias("_hi"), F.col(value).alias("_vhi"))
    return (
        _same_keys(_same_keys(targets, low, [*keys, "_lo"]), high, [*keys, "_hi"])
        .select(
            *keys,
            "prob",
            (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_f")).alias("quantile"),
        )
    )


def values_at_rank_shares(df: DataFrame, order: str, shares: Sequence[float]) -> list:
    """Per share, the largest ``order`` value whose percent rank is at most the share.

    Nulls rank first, as in a window; the value is null where only they qualify, and
    also for a table without rows.
    """
    rows, filled = df.agg(F.count("*"), F.count(order)).first()
    nulls = rows - filled
    places = []
    for share in shares:
        place = int(share * (rows - 1)) if rows > 1 else 0
        while rows > 1 and (place + 1) / (rows - 1) <= share:
            place += 1
        while place > 0 and place / (rows - 1) > share:
            place -= 1
        places.append(place - nulls)
    wanted = df.sparkSession.createDataFrame([(p,) for p in places if p >= 0], "pos long")
    found = {r["pos"]: r[order] for r in order_statistics(df.select(order), order, wanted).collect()}
    return [found.get(p) for p in places]


def chronological_split(
    df: DataFrame, order: str, shares: Sequence[float] = (0.7, 0.9), into: str = "split"
) -> DataFrame:
    """Label rows train / validation / test by percent rank of ``order``.

    Percent rank grows with ``order``, so the two cut values found by
    :func:`values_at_rank_shares` decide every row: the data itself is not shuffled
    and rows with equal order values always share a label.  Nulls rank first, so they
    are training rows.
    """
    first, second = values_at_rank_shares(df, order, shares)

    def upto(value):
        return F.col(order).isNull() if value is None else F.col(order).isNull() | (F.col(order) <= F.lit(value))

    return df.withColumn(
        into, F.when(upto(first), "train").when(upto(second), "validation").otherwise("test")
    )


def percent_ranks(df: DataFrame, order: str, into: str = "rank") -> DataFrame:
    """Percent rank over ``order`` as a column, without a single-task window; nulls rank first."""
    rows = df.count()
    per_value = index_rows(df.groupBy(order).agg(F.count("*").alias("_n")), [order])
    ranked = running_sums(per_value, {"_upto": "_n"}).select(
        order, ((F.col("_upto") - F.col("_n")) / F.lit(max(rows - 1, 1))).alias(into)
    )
    return lookup_join(df, ranked, [order])


def positional_split(
    df: DataFrame, rows: int, shares: Sequence[float] = (0.7, 0.9), rn: str = "rn",
    into: str = "split",
) -> DataFrame:
    """Label rows by position; cut points are truncated to whole rows."""
    first, second = [int(rows * s) for s in shares]
    return df.withColumn(
        into,
        F.when(F.col(rn) < first, "train").when(F.col(rn) < second, "validation").otherwise("test"),
    )
