"""Personal data in whole texts, and the terms around it that would give it away.

Base kinds are found by their shapes.  Each found value is a protected entity.  How much a
term tells about an entity is their pointwise mutual information over the documents of the
corpus, ``log2(p(t, e) / (p(t) p(e)))``; a term that discloses at least ``share`` of the
entity's own information content ``-log2 p(e)`` (in at least ``support`` different
documents) is a disclosing term.  Wherever it stands, in any document, it is a span of its own: a
capitalised term is generalised to a name, any other is removed.  Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import patterns as P
from tidegauge.llm.tables import keep
from tidegauge.operators.joins import lookup_join

# The patterns of the base kinds, in a form that never backtracks far.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = list(PATTERNS)
ADDED = ["name", "term"]
_ADDED = "array<struct<kind:string,rank:int,start:long,end:long>>"
#: Rows of a lookup table that is broadcast; larger ones are shuffled.
LOOKUP_ROWS = 250_000
#: Least hashes by which near copies are told.
VERSIONS = 3
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_SIGN = r"[\p{L}\p{N}]"
_TERM = _SIGN + "+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, gives a sum ending in 0."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


_PASSING = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda m: F.length(_digits(m)).between(13, 19) & _luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _usable(term: Column) -> Column:
    return (F.length(term) >= 3) & term.rlike(r"\p{L}")


def _blanked(df: DataFrame) -> DataFrame:
    """``df`` with spaces in ``_text`` for the values of the base kinds, every place kept."""
    for kind, pattern in PATTERNS.items():
        gaps, found = F.split("_text", pattern, -1), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        fills = F.transform(found, lambda m: F.when(_PASSING[kind](m), F.repeat(F.lit(" "), F.length(m))).otherwise(m))
        pieces = F.zip_with(gaps, fills, lambda g, m: F.concat(g, F.coalesce(m, F.lit(""))))
        df = df.withColumn("_text", F.when(F.size(kind) > 0, F.array_join(pieces, "")).otherwise(F.col("_text")))
    return df


def _forms(text: Column) -> Column:
    """The distinct terms of a text as they are written."""
    return F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)), _usable))


def _words(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    return F.array_distinct(F.transform(_forms(text), F.lower))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda x: F.concat(F.lit(f"{kind}:"), F.lower(x["value"])))


def _versions(text: Column) -> Column:
    """Least hashes of the pairs of neighbouring words, one per seed.

    Two texts agree in each of them with the probability of the overlap of their pairs, so
    copies with small changes nearly always share one, and texts of their own hardly ever do.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.xxhash64(a, b))
    held = F.when(rest > 0, pairs).otherwise(F.array(F.xxhash64(text)))
    return F.array(*[F.array_min(F.transform(held, lambda h: F.xxhash64(h, F.lit(seed)))) for seed in range(VERSIONS)])


def disclosing_terms(documents: DataFrame, total: int, share: float, support: int) -> DataFrame:
    """Terms that disclose an entity by their co-occurrence over whole documents.

    ``documents`` holds ``total`` different documents: a number ``_rid``, every text outside of
    its entities (``_text``) and its distinct entities (``_entities``).

    Entities of the same documents tell the same, and so do terms: each set of documents is
    one class, known by its size and the exclusive or of its hashed numbers, and pairs are
    counted between classes.  A pair reaches the share only if the term is in at most
    ``n_entity ** share * total ** (1 - share)`` documents; others are not counted.
    """
    member = F.bit_xor(F.xxhash64("_rid"))
    held = documents.filter(F.size("_entities") > 0)
    listed = held.select("_rid", F.explode("_entities").alias("entity"))
    entities = (
        listed.groupBy("entity").agg(F.count("*").alias("n_entity"), member.alias("e_set"))
        .filter((F.col("n_entity") >= support) & (F.col("n_entity") < total))
    )
    by_document = (
        lookup_join(listed, entities, ["entity"], how="inner", rows=LOOKUP_ROWS).groupBy("_rid")
        .agg(F.collect_set(F.struct("e_set", "n_entity")).alias("_e"), F.max("n_entity").alias("_top"))
    )
    terms = keep(
        documents.select("_rid", F.explode(_words(F.col("_text"))).alias("term"))
        .groupBy("term").agg(F.count("*").alias("n_term"), member.alias("t_set")).filter(F.col("n_term") >= support),
        "terms",
    )

    def reach(n: Column) -> Column:
        return F.pow(n, F.lit(share)) * F.pow(F.lit(float(max(total, 1))), F.lit(1 - share)) * (1 + 1e-9)

    naming = keep(held.select("_rid", "_text").join(by_document, "_rid").select(
        "_rid", "_e", "_top", _versions(F.col("_text")).alias("_v"), _words(F.col("_text")).alias("_w")
    ), "naming")
    top = naming.agg(F.max("_top")).first()[0]
    rare = keep(terms.filter(F.col("n_term") <= reach(F.lit(top or 0))), "rare")
    near = (
        lookup_join(naming.select("_rid", "_top", F.explode("_w").alias("term")), rare, ["term"], how="inner", rows=LOOKUP_ROWS, derived=False)
        .filter(F.col("n_term") <= reach(F.col("_top")))
        .groupBy("_rid").agg(F.collect_set(F.struct("t_set", "n_term")).alias("_t"))
    )
    pairs = (
        naming.select("_rid", "_e", "_v").join(near, "_rid")
        .select("_v", "_t", F.inline("_e")).select("_v", "e_set", "n_entity", F.inline("_t"))
        .filter(F.col("n_term") <= reach(F.col("n_entity")))
    )
    several = [F.min(F.get("_v", F.lit(i))) < F.max(F.get("_v", F.lit(i))) for i in range(VERSIONS)]
    both = pairs.groupBy("e_set", "n_entity", "t_set", "n_term").agg(
        F.count("*").alias("n_both"), reduce(lambda a, b: a & b, several).alias("_several")
    ).filter(F.col("_several") & (F.col("n_both") >= support))
    content = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    shared = content + F.log2(F.col("n_both") / F.col("n_term"))
    telling = both.filter(shared >= share * content).select("t_set", "n_term").distinct()
    return lookup_join(rare, telling, ["t_set", "n_term"], how="inner", rows=LOOKUP_ROWS).select("term")


def find_personal(
    docs: DataFrame, text: str = "text", carry: list[str] | None = None, share: float = 0.9, support: int = 2
) -> DataFrame:
    """Spans of personal data and of terms that disclose it.

    Columns: ``doc`` (the columns in ``carry``, all if not given, as a struct), ``base``
    and ``added``, arrays of ``kind, rank, start, end``.  Terms are runs of letters and
    digits outside of the base spans, with a letter and three characters at least,
    compared in lower case over whole documents; every occurrence of a disclosing term
    is a span, also in documents without the entity.

    Documents with equal texts count once (told by a 64-bit hash and the length), and a term
    discloses only if it stands by the entity in texts that are no near copies of each other
    (:func:`_versions`); so copies do not make their words disclosing.  All of them get their spans.
    A null or empty text has no spans.  An entity of every document tells nothing and has no
    disclosing terms.  An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(docs.columns if carry is None else carry)).alias("doc"), body.alias("_text"))
    located = P.located(rows.withColumn("_copy", F.struct(F.xxhash64("_text"), F.length("_text"))), "_text", PATTERNS, _PASSING)
    found = keep(_blanked(located).select(
        F.monotonically_increasing_id().alias("_rid"), "doc", P.tagged(BASE).alias("base"), "_copy",
        F.array_distinct(F.concat(*[_entities(k) for k in BASE])).alias("_entities"), "_text",
    ), "personal")
    firsts = keep(found.groupBy("_copy").agg(F.min("_rid").alias("_first"), F.count("*").alias("_n")), "texts")
    once = lookup_join(
        found.select("_rid", "_copy", "_entities", "_text"), firsts.filter("_n > 1").select("_copy", "_first"), ["_copy"], rows=LOOKUP_ROWS
    ).filter(F.coalesce("_first", "_rid") == F.col("_rid")).select("_rid", "_entities", "_text")
    giving = keep(disclosing_terms(once, firsts.count(), share, support), "disclosing")

    def of_giving(terms: DataFrame) -> DataFrame:
        return lookup_join(terms, giving, ["term"], how="inner", rows=LOOKUP_ROWS, derived=False)

    holding = of_giving(found.select("_rid", F.explode(_words(F.col("_text"))).alias("term"))).select("_rid").distinct()
    texts = lookup_join(found.select("_rid", "_text"), holding, ["_rid"], how="inner", rows=LOOKUP_ROWS)
    # outer: the plain form would look for words in all texts, before the join with those that hold any
    words = P.located(texts, "_text", {"word": _TERM}, {"word": _usable}).select("_rid", F.inline_outer("word")).filter("value is not null")
    name = F.col("value").rlike(r"^\p{Lu}")
    spans = of_giving(words.withColumn("term", F.lower("value"))).select("_rid", F.struct(
        F.when(name, "name").otherwise("term").alias("kind"), F.when(name, len(BASE)).otherwise(len(BASE) + 1).alias("rank"),
        "start", "end",
    ).alias("s")).groupBy("_rid").agg(F.collect_list("s").alias("_added"))
    added = F.array_sort(F.coalesce("_added", F.array().cast(_ADDED)), lambda a, b: (a["start"] - b["start"]).cast("int"))
    return found.select("_rid", "doc", "base").join(spans, "_rid", "left").select("doc", "base", added.alias("added"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced: base kinds and names by their kind, terms by nothing.

    Of overlapping spans the first one counts.
    """
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"])))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(s: Column, x: Column) -> Column:
        label = F.when(x["kind"] == "term", "").otherwise(F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
        gone = x["start"] < s["at"]
        return F.struct(
            F.when(gone, s["at"]).otherwise(x["end"]).alias("at"),
            F.when(gone, s["out"]).otherwise(F.concat(
                s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), label
            )).alias("out"),
        )

    return F.aggregate(ordered, start, add, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
