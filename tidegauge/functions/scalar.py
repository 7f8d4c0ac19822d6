"""Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0

# Code points that Python's argument-less str.split treats as white space.
WHITE_SPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def space_fields(text: Column) -> Column:
    """Fields between single spaces; neighbouring spaces give empty fields."""
    return F.split(text, " ", -1)


def words(text: Column) -> Column:
    """Words between runs of any white space; never empty."""
    spaced = F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE))
    return F.array_remove(F.split(spaced, " ", -1), "")


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines.

    Rounding can push the cosine just outside [-1, 1], where acos gives NaN and NaN
    compares above every number, so it is clamped.
    """
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.cos(a) * F.cos(b) * F.cos(F.radians(lon2) - F.radians(lon1)) + F.sin(a) * F.sin(b)
    return EARTH_RADIUS_KM * F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))


def divider_resistance(volts: Column) -> Column:
    """``(5 - V) / V * 1e6``; null where V is zero."""
    return F.try_divide(F.lit(5.0) - volts, volts) * 1_000_000


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column becomes 0."""
    return F.when(high == low, F.lit(0.0)).otherwise((x - low) / F.nullif(high - low, F.lit(0.0)))


def min_max_inverse(scaled: Column, low: Column, high: Column) -> Column:
    return scaled * (high - low) + low


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean across columns of one row, nulls skipped; null if all are null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in columns])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, present.cast("double"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds from 1970-01-01 of a zone-free timestamp, whatever the session zone."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * 86_400
        + F.hour(ts) * 3_600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def decimal_comma(x: Column, digits: int = 4) -> Column:
    """Number as text with a decimal comma, as European spreadsheets expect."""
    return F.translate(F.round(x, digits).cast("string"), ".", ",")


def skewness_adjusted(x: Column) -> Column:
    """Bias-adjusted sample skewness (Spark's own is the population form)."""
    n = F.count(x).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n > 2, F.skewness(x) * factor)


def hash_unit(*columns: Column) -> Column:
    """Deterministic value in [0, 1) from the text form of ``columns``."""
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def digamma(n: Column) -> Column:
    """Digamma of a positive number: eight steps of the recurrence, then its asymptotic series."""
    x = n.cast("double")
    far = x + 8
    square = 1 / (far * far)
    series = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square * (1 / 132)))))
    return F.log(far) - 1 / (2 * far) - series - reduce(lambda a, b: a + b, [1 / (x + i) for i in range(8)])
