"""Spans of regular expressions in whole texts, with built-in functions only.

Spark finds all matches of a pattern and splits a text by it; the lengths of the pieces
and matches, added up, are the places of the matches.  Offsets count characters (code
points), ends are exclusive, matches are leftmost and do not overlap.

The patterns of the operators are written so that Java's matcher does not recurse (no
repeated group that could be taken back) and does not start again within a run of
characters that cannot match; both give the same matches as the plain form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CHUNK = 256
SPANS = "array<struct<start:long,end:long,value:string>>"


def running_starts(lengths: Column) -> Column:
    """Sum of the elements before each element of an array of longs.

    Works in chunks, so that the cost stays near the number of elements also for a
    text with very many matches.
    """
    zero = F.lit(0).cast("long")

    def bound(value: Column, body: Callable[[Column], Column]) -> Column:
        """``body`` of a value that is computed once, not again in every function of ``body``."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def total(values: Column) -> Column:
        return F.aggregate(values, zero, lambda s, x: s + x)

    def cut(values: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")),
            lambda k: F.slice(values, k * _CHUNK + 1, _CHUNK),
        )

    def summed(chunks: Column, sums: Column) -> Column:
        return F.flatten(F.zip_with(
            chunks, F.transform(sums, lambda _, k: total(F.slice(sums, 1, k))),
            lambda part, base: F.transform(part, lambda _, i: base + total(F.slice(part, 1, i))),
        ))

    return bound(lengths, lambda values: bound(cut(values), lambda chunks: bound(
        F.transform(chunks, total), lambda sums: summed(chunks, sums)
    )))


def located(
    df: DataFrame, text: str, patterns: Mapping[str, str], passing: Mapping[str, Callable[[Column], Column]], around: int = 0
) -> DataFrame:
    """``df`` with one column per pattern: its passing matches as ``start, end, value``.

    With ``around``, each span also has up to so many characters ``before`` and ``after``
    it, up to the neighbouring matches of its pattern.

    ``text`` must not be null.  Matches that fail their test in ``passing`` are dropped
    but still take up their place, so nothing is found inside them.
    """
    found = df.withColumns({f"_m_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    gaps = found.withColumns({
        f"_g_{k}": F.when(
            F.size(f"_m_{k}") > 0,
            F.transform(F.split(text, p, -1), lambda x: F.length(x).cast("long")),
        )
        for k, p in patterns.items()
    })
    starts = gaps.withColumns({
        f"_s_{k}": F.when(
            F.size(f"_m_{k}") > 0,
            running_starts(F.zip_with(
                F.slice(f"_g_{k}", 1, F.size(f"_m_{k}")), f"_m_{k}", lambda gap, m: gap + F.length(m)
            )),
        )
        for k in patterns
    })
    fields = SPANS.replace(">>", ",before:string,after:string>>") if around else SPANS

    def span(x: Column) -> Column:
        start = x["s"] + x["g"]
        sides = [
            F.right(x["b"], F.lit(around)).alias("before"), F.left(x["a"], F.lit(around)).alias("after")
        ] if around else []
        return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("value"), *sides)

    def sides(k: str) -> list[Column]:
        if not around:
            return []
        return [F.slice(F.split(text, patterns[k], -1), 1, F.size(f"_m_{k}")).alias("b"),
                F.slice(F.split(text, patterns[k], -1), 2, F.size(f"_m_{k}")).alias("a")]

    spans = starts.withColumns({
        k: F.when(
            F.size(f"_m_{k}") > 0,
            F.filter(
                F.transform(
                    F.arrays_zip(
                        F.col(f"_m_{k}").alias("m"), F.slice(f"_g_{k}", 1, F.size(f"_m_{k}")).alias("g"),
                        F.col(f"_s_{k}").alias("s"), *sides(k),
                    ),
                    span,
                ),
                lambda x: passing[k](x["value"]),
            ),
        ).otherwise(F.array().cast(fields))
        for k in patterns
    })
    return spans.drop(*[f"_{c}_{k}" for c in "mgs" for k in patterns])


def tagged(kinds: list[str]) -> Column:
    """All spans of the given columns as ``kind, rank, start, end`` (rank: place in ``kinds``)."""
    return F.concat(*[
        F.transform(k, lambda x: F.struct(
            F.lit(k).alias("kind"), F.lit(i).alias("rank"), x["start"].alias("start"), x["end"].alias("end")
        ))
        for i, k in enumerate(kinds)
    ])


def written(spans: Column, *order: str) -> Column:
    """``kind:start:end`` of every span, comma-joined in the order of the named fields."""
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(*[x[o].alias(o) for o in [*order, "end", "kind"]])))
    return F.array_join(
        F.transform(keyed, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
