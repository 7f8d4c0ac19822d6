"""Registered queries of the operators here, with SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.llm import (
    chat, decontaminate, disclosure, exactdup, langid, merkle, mixing, neardup, patterns, resample, secrets, sharding,
    topk, warc,
)
from tidegauge.plans.registry import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


#: Words, shingles and links as in the contract; every pair that shares a shingle is compared.
NEARDUP_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
    SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                          FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
    JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
    WHERE 100 * shared >= 85 * (na.n + nb.n - shared)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN links l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id,
       d.doc_id = min(r.c) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""


@query("op6_minhash_neardup", NEARDUP_SQL)
def op6_minhash_neardup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, shingle=3, percent=85).select(
        F.col("doc.doc_id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


DECONTAMINATION_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
        lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS g FROM bw WHERE len(w) > 0),
ds AS (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i
       FROM dw, (SELECT DISTINCT m FROM bg) WHERE len(w) >= m),
h AS (SELECT ds.doc_id, ds.i, ds.m, bg.item_id FROM ds JOIN bg ON bg.m = ds.m AND bg.g = array_to_string(ds.w[ds.i:ds.i + ds.m - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY 1),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op10_winnowing_decontamination", DECONTAMINATION_SQL)
def op10_winnowing_decontamination(spark, sf_dir):
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    """Predictions for all documents from a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = langid.remainder("doc_id")
    model = langid.train(docs.filter(part != 2), F.col("text"), F.col("lang"))
    return langid.identify(docs, model, carry=["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.coalesce(langid.remainder("doc.doc_id") == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score",
    )


@query("op7_feistel_sharding")
def op7_feistel_sharding(spark, sf_dir):
    """Law ``rows``: shuffled row numbers dealt over 16 shards."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.sharded(docs, ["doc_id", "size", "text_crc32"], shards=16, key=20240229).select(
        "doc.doc_id", "doc.size", "doc.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op4_pfair_mixing")
def op4_pfair_mixing(spark, sf_dir):
    """All documents in a mixture of their sources, one row per placed document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs).select(
        "doc.doc_id", "source", "epoch", "block", "release", "deadline", "slot", "position"
    )


def _of_kind(kind: str):
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(docs, carry=["doc_id"]).select(
        "doc.doc_id", *[_of_kind(k) for k in secrets.BASE],
        F.sha2(patterns.written(F.col("base"), "start", "rank"), 256).alias("base_sha256"),
        patterns.written(F.concat("base", "added"), "start", "rank").alias("spans"),
    )


@query("op8_disclosure_sanitisation")
def op8_disclosure_sanitisation(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return disclosure.find_personal(docs, carry=["doc_id"]).select(
        "doc.doc_id", *[_of_kind(k) for k in disclosure.BASE],
        F.sha2(patterns.written(F.col("base"), "rank", "start"), 256).alias("base_sha256"),
        patterns.written(F.concat("base", "added"), "rank", "start").alias("spans"),
    )


TOP_K_SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT a.vec_id AS query_id, b.vec_id, s.score,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY s.score DESC, b.vec_id) AS rank
    FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id,
         LATERAL (SELECT list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score) s)
WHERE rank <= 5
"""


@query("op9_block_top_k", TOP_K_SQL)
def op9_block_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op5_zstd_warc")
def op5_zstd_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Conversations of up to one page; longer ones have further rows in the query.
CHAT_SQL = """
WITH t AS (SELECT conv_id, turn, role, text, row_number() OVER w - 1 AS pos,
                  string_agg(coalesce(length(role) || ':' || role, '-') || coalesce(length(text) || ':' || text, '-'), '')
                      OVER (w ROWS UNBOUNDED PRECEDING) AS pre,
                  count(*) OVER (PARTITION BY conv_id) AS n_turns
           FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
f AS (SELECT pre, n_turns, min(conv_id) AS conv_id, count(*) AS copies FROM t WHERE pos = n_turns - 1 GROUP BY ALL),
k AS (SELECT * FROM f WHERE pre NOT IN (SELECT pre FROM t WHERE pos < n_turns - 1))
SELECT k.conv_id, t.pos // 256 AS page, k.n_turns, k.copies,
       string_agg('<|im_start|>' || replace(replace(coalesce(t.role, 'unknown'), '<|', '< |'), '|>', '| >') || chr(10)
           || replace(replace(coalesce(t.text, ''), '<|', '< |'), '|>', '| >') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS rendered
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY ALL
"""


@query("op2_snapshot_collapse", CHAT_SQL)
def op2_snapshot_collapse(spark, sf_dir):
    return chat.collapsed(table(spark, sf_dir, "conversations"))


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       h AS text_sha256 FROM n WINDOW w AS (PARTITION BY h)
"""


@query("op13_exact_bloom_dedup", EXACT_SQL)
def op13_exact_bloom_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exactdup.exact_duplicates(docs, carry=["doc_id"]).select(
        "doc.doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


#: CRC-32 bytewise; its table of 256 entries follows from the reversed polynomial 0xEDB88320.
_CRC_TABLE = """tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i)) AS crc)"""


def _crc(code_units: str) -> str:
    """SQL for the unsigned CRC-32 of a list of bytes."""
    return (
        f"xor(list_reduce({code_units}, lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT),"
        " 4294967295)"
    )


MERKLE_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, source, {{leaf_text}} AS leaf, {{leaf_lower}} AS other,
             row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
             {_crc("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)")} % 5 = 0 AS hit
      FROM documents, tab),
nodes AS (SELECT 0 AS lev, source, pos, leaf AS h, n FROM d
          UNION ALL
          SELECT lev + 1, source, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
          FROM nodes WHERE n > 1 GROUP BY lev, source, pos // 16),
sub AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (SELECT 0 AS lev, pos, h, n FROM sub
        UNION ALL
        SELECT lev + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
        FROM top WHERE n > 1 GROUP BY lev, pos // 16),
near AS (SELECT d.doc_id, k.lev, k.h, k.pos, d.pos >> (4 * k.lev) AS own
         FROM d JOIN nodes k ON k.source IS NOT DISTINCT FROM d.source AND k.n > 1 AND k.pos >> 4 = d.pos >> (4 * k.lev + 4)
         UNION ALL
         SELECT d.doc_id, 100 + k.lev, k.h, k.pos, s.pos >> (4 * k.lev)
         FROM d JOIN sub s ON s.source IS NOT DISTINCT FROM d.source
         JOIN top k ON k.n > 1 AND k.pos >> 4 = s.pos >> (4 * k.lev + 4)),
steps AS (SELECT doc_id, lev, coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < own), '') AS l,
                 coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > own), '') AS r FROM near GROUP BY ALL),
path AS (SELECT doc_id, list(l || '|' || r ORDER BY lev) AS p, string_agg(l || r, '' ORDER BY lev) AS sib FROM steps GROUP BY 1),
f AS (SELECT d.doc_id, leaf, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(sib, '')) AS proof_sha256,
             list_reduce(coalesce(p, []), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2)),
                         CASE WHEN hit THEN other ELSE leaf END) AS folded_root
      FROM d JOIN sub ON sub.source IS NOT DISTINCT FROM d.source LEFT JOIN path USING (doc_id))
SELECT *, folded_root = root AS verified FROM f
"""


def _leaf_sql(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MERKLE_SQL = MERKLE_SQL.format(
    leaf_text=_leaf_sql("text"), leaf_lower=_leaf_sql(f"translate(text, '{_CAPITALS}', '{_SMALL}')"))


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark, sf_dir):
    """Proofs of all rows, each folded from the row as it is or, for a fifth, lower-cased."""
    docs = table(spark, sf_dir, "documents")
    kept = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.when(changed, merkle.leaf_hash(*kept, F.translate("text", _CAPITALS, _SMALL)))
    manifest = merkle.build(
        docs.withColumn("tampered", lowered), merkle.leaf_hash(*kept, F.col("text")), carry=["doc_id", "tampered"])
    now = F.coalesce("doc.tampered", "leaf")
    return manifest.proofs().select(
        "doc.doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        merkle.folded(now, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_WORDS_SQL = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
RESAMPLE_SQL = rf"""
WITH {_CRC_TABLE},
dw AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
bw AS (SELECT {_WORDS_SQL} AS w FROM benchmark),
df AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM dw) GROUP BY ALL),
tf AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM bw) GROUP BY ALL),
v AS (SELECT w, {_crc("list_transform(range(0, strlen(w)), lambda i: ('0x' || substr(hex(w), 2 * i + 1, 2))::BIGINT)")} % 10000 AS b
      FROM (SELECT w FROM df UNION SELECT w FROM tf), tab),
s AS (SELECT b, sum(n) AS n FROM df JOIN v USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM tf JOIN v USING (w) GROUP BY b),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE + 10000 AS s, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + 10000 AS t),
gain AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * totals.s / ((coalesce(s.n, 0) + 1)::DOUBLE * totals.t)))::BIGINT AS g
         FROM s FULL JOIN t USING (b), totals),
doc AS (SELECT doc_id, sum(n)::BIGINT AS n, floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
        FROM df JOIN v USING (w) JOIN gain USING (b) GROUP BY 1),
r AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM documents LEFT JOIN doc USING (doc_id)),
p AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (n_features >= 20) OVER () AS n FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM p
"""


@query("op12_bitsliced_resampling", RESAMPLE_SQL)
def op12_bitsliced_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample.resampled(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("doc.doc_id", "n_features", "weight", "score", "rank")
