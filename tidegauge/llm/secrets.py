"""Secrets in whole texts: known shapes, and strings that only chance could have written.

Beside assignments, access keys and long hexadecimal numbers, every long run of encoding
characters is tested for randomness: a chi-squared test for equal use of the alphabet of
its inferred encoding, a runs test about the middle of the alphabet, and the serial
correlation of neighbouring symbols.  The three are combined (Cauchy) into one p value.
The parts of a run, cut at slashes and at all of ``/ _ - +``, are tested as well, so that a
random part of a URL or path is neither lost nor diluted.

Random strings have p values spread evenly over 0 to 1, written ones have small values.
Per encoding and length band, the corpus shows how many random strings there are (twice
those with p above one half); the lowest cut is taken at which the others make up at most
``false_share`` of what is reported.  Bands matter because the tests tell more on longer
strings.  Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import patterns as P
from tidegauge.llm.tables import keep

# The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
# Parts of a run, cut at / and at any separator; only what was cut, as whole runs are tested anyway.
_SEGMENT = r"(?<![A-Za-z0-9+_-])(?:(?<=/)[A-Za-z0-9+_-]{20,}+={0,2}|[A-Za-z0-9+_-]{20,}+(?=/))"
_PIECE = r"(?<![A-Za-z0-9])(?:(?<=[+/_-])[A-Za-z0-9]{20,}+={0,2}|[A-Za-z0-9]{20,}+(?=[+/_-]))"

BASE = ["assign", "access", "hex"]
#: Candidates for the tests of randomness, widest first.
LEVELS = {"random": _RUN, "segment": _SEGMENT, "piece": _PIECE}


def _candidate(m: Column) -> Column:
    # Encodings have digits and letters; base kinds need no second finding.
    return m.rlike("[0-9]") & m.rlike("[A-Za-z]") & ~m.rlike("^([0-9a-f]{32,}|AKIA[A-Z0-9]{12,})$")


_PASSING = {
    "assign": lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8,
    "access": lambda m: F.length(m) >= 16,
    "hex": lambda m: F.lit(True),
    "random": _candidate,
    # A segment without other separators is a piece.  64 symbols show both cases within 20
    # characters but for once in 30 000 random strings; words joined by separators do not.
    "segment": lambda m: m.rlike("[+_-]") & m.rlike("[a-z]") & m.rlike("[A-Z]") & _candidate(m),
    "piece": _candidate,
}
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings, narrowest first: name, shape without padding, alphabet in value order.
ENCODINGS = [
    ("hex", "^([0-9a-f]+)$", _DIGITS + "abcdef"),
    ("HEX", "^([0-9A-F]+)$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _DIGITS + _LOWER),
    ("BASE36", "^[A-Z0-9]+$", _DIGITS + _UPPER),
    ("base62", "^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
]
CUTS = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]


def _two_sided(z: Column) -> Column:
    """Two-sided normal tail, to 2e-7 (rational approximation of the error function)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(F.lit(1e-12), poly * F.exp(-x * x)))


def _alphabet(value: Column) -> tuple[Column, Column]:
    name, letters = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, shape, symbols in reversed(ENCODINGS):
        name = F.when(value.rlike(shape), n).otherwise(name)
        letters = F.when(value.rlike(shape), symbols).otherwise(letters)
    return name, letters


def _encoded(x: Column, level: int) -> Column:
    """One candidate with its encoding.  A struct of its own: what reads the symbols of the
    alphabet for every character must find them settled, not match the shapes again."""
    value = F.rtrim(x["value"], F.lit("="))
    name, letters = _alphabet(value)
    return F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(level).alias("level"), name.alias("encoding"),
        letters.alias("letters"), value.alias("value"),
    )


def _measured(x: Column) -> Column:
    """Alphabet size, length and the values of the characters of one candidate."""
    return F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["level"].alias("level"), x["encoding"].alias("encoding"),
        F.length(x["letters"]).cast("double").alias("k"), F.length(x["value"]).cast("double").alias("n"),
        F.transform(F.split(x["value"], ""), lambda c: F.instr(x["letters"], c).cast("double") - 1).alias("v"),
    )


def _sums(x: Column) -> Column:
    zero = F.lit(0.0)
    # Over sorted symbols, 2 * (place in its run) - 1 adds up to the squared counts.
    squares = F.aggregate(
        F.array_sort(x["v"]), F.struct(F.lit(-1.0).alias("last"), zero.alias("place"), zero.alias("sum")),
        lambda s, v: F.struct(
            v.alias("last"), F.when(v == s["last"], s["place"] + 1).otherwise(1.0).alias("place"),
            (s["sum"] + 2 * F.when(v == s["last"], s["place"] + 1).otherwise(1.0) - 1).alias("sum"),
        ),
        lambda s: s["sum"],
    )
    walk = F.aggregate(
        x["v"],
        F.struct(F.lit(None).cast("double").alias("last"), zero.alias("high"), zero.alias("runs"), zero.alias("s1"),
                 zero.alias("s2"), zero.alias("lag")),
        lambda s, v: F.struct(
            v.alias("last"),
            (s["high"] + F.when(v >= x["k"] / 2, 1.0).otherwise(0.0)).alias("high"),
            (s["runs"] + F.when(s["last"].isNull() | ((v >= x["k"] / 2) != (s["last"] >= x["k"] / 2)), 1.0).otherwise(0.0)).alias("runs"),
            (s["s1"] + v).alias("s1"), (s["s2"] + v * v).alias("s2"), (s["lag"] + v * F.coalesce(s["last"], zero)).alias("lag"),
        ),
    )
    return F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["level"].alias("level"), x["encoding"].alias("encoding"), x["k"].alias("k"), x["n"].alias("n"),
        squares.alias("squares"), walk.alias("walk"), F.get(x["v"], F.lit(0)).alias("head"),
        F.element_at(x["v"], -1).alias("tail"),
    )


def _p_value(x: Column) -> Column:
    n, k, w = x["n"], x["k"], x["walk"]
    df = k - 1
    chi = x["squares"] * k / n - n
    z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    high, low = w["high"], n - w["high"]
    mean = 2 * high * low / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(spread > 0, (w["runs"] - mean) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(9.0)
    mu = w["s1"] / n
    var = w["s2"] - n * mu * mu
    lagged = w["lag"] - mu * (2 * w["s1"] - x["head"] - x["tail"]) + (n - 1) * mu * mu
    z_serial = F.when(var > 0, (lagged / F.greatest(var, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(9.0)
    lean = sum((F.tan((0.5 - _two_sided(z)) * math.pi) for z in (z_chi, z_runs, z_serial)), F.lit(0.0)) / 3
    return 0.5 - F.atan(lean) / math.pi


def _tested(x: Column) -> Column:
    return F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["level"].alias("level"),
        F.concat_ws(":", x["encoding"], F.floor(2 * F.log2(x["n"])).cast("string")).alias("band"),
        _p_value(x).alias("p"),
    )


def band_cuts(candidates: DataFrame, false_share: float = 0.1) -> dict[str, float]:
    """The lowest p value to report, per band of ``candidates`` (``band``, ``p``).

    Bands are encodings times half powers of two of the length: at most a few hundred.
    """
    counts = candidates.groupBy("band").agg(*[F.count_if(F.col("p") > c).alias(f"c{i}") for i, c in enumerate(CUTS)])
    cuts = {}
    for row in counts.collect():
        random = 2 * row[f"c{len(CUTS) - 1}"]
        for i, cut in enumerate(CUTS):
            reported = row[f"c{i}"]
            if max(0.0, reported - random * (1 - cut)) <= false_share * reported:
                cuts[row.band] = cut
                break
    return cuts


def find_secrets(docs: DataFrame, text: str = "text", carry: list[str] | None = None, false_share: float = 0.1) -> DataFrame:
    """Spans of secrets in every whole text.

    Columns: ``doc`` (the columns in ``carry``, all if not given, as a struct), ``base``
    and ``added``, arrays of ``kind, rank, start, end``.  Added spans (kind ``random``)
    may lie within an assignment; of a run and its parts the widest random one is a span.  Strings without a digit or without a letter, and
    shorter than 20 characters, are not tested: the tests have no power on them.  A null
    or empty text has no spans, and an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(docs.columns if carry is None else carry)).alias("doc"), body.alias("_text"))
    found = P.located(rows, "_text", {"assign": ASSIGN, "access": ACCESS, "hex": HEX, **LEVELS}, _PASSING).drop("_text")
    encoded = F.concat(*[F.transform(k, lambda x: _encoded(x, i)) for i, k in enumerate(LEVELS)])
    tests = found.select(
        "doc", P.tagged(BASE).alias("base"), F.filter(encoded, lambda x: x["encoding"].isNotNull()).alias("_r")
    ).withColumn("_r", F.transform("_r", _measured)).withColumn("_r", F.transform("_r", _sums)).withColumn("_r", F.transform("_r", _tested))
    tests = keep(tests, "secrets")
    cuts = band_cuts(tests.select(F.explode("_r").alias("r")).select("r.band", "r.p"), false_share)
    limits = F.map_from_arrays(
        F.array(*map(F.lit, cuts)).cast("array<string>"), F.array(*map(F.lit, cuts.values())).cast("array<double>")
    )
    random = F.filter("_r", lambda x: x["p"] > F.coalesce(F.try_element_at(limits, x["band"]), F.lit(1.0)))
    # the widest of nested strings is reported
    widest = F.filter("random", lambda x: (x["level"] == 0) | ~F.exists("random", lambda y: (
        (y["level"] < x["level"]) & (y["start"] <= x["start"]) & (x["end"] <= y["end"])
    )))
    return tests.withColumn("random", random).withColumn("random", widest).select(
        "doc", "base", F.transform("random", lambda x: F.struct(
            F.lit("random").alias("kind"), F.lit(len(BASE)).alias("rank"), x["start"].alias("start"), x["end"].alias("end")
        )).alias("added"),
    )
