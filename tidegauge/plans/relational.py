"""Scans, sinks, profiles, grouped reports, key-value and multiset queries."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import scalar as S
from tidegauge.operators import relational as R
from tidegauge.operators import observed, reports, sketches
from tidegauge.operators.folding import UserAggregate, user_aggregate
from tidegauge.operators.joins import lookup_join
from tidegauge.plans.registry import query, table
from tidegauge.session import fresh_path
from tidegauge.sources import inference, readers, sinks

# ---------------------------------------------------------------- sources and sinks


def _event_csv_runs(spark: SparkSession, sf_dir: str) -> str:
    """Events written as CSV files, one folder per event type; returns the glob."""
    path = fresh_path(spark, "runs")
    events = table(spark, sf_dir, "events").withColumn("run", F.col("event_type"))
    events.select("event_id", "ts", "user_id", "value", "run").write.partitionBy("run").options(
        header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return f"{path}/run=*/*.csv"


_EVENT_CSV = "c0 long, c1 timestamp_ntz, c2 long, c3 double"


@query(
    "scan_csv_glob",
    "SELECT event_id, ts, user_id, value AS reading FROM events",
)
def scan_csv_glob(spark, sf_dir):
    scanned = readers.read_csv(
        spark,
        _event_csv_runs(spark, sf_dir),
        _EVENT_CSV,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        enforceSchema="true",
    )
    return readers.rename_by_position(scanned, ["event_id", "ts", "user_id", "reading"])


@query(
    "scan_provenance",
    """SELECT event_type AS run, count(*) AS "rows", round(sum(value), 2) AS total
       FROM events GROUP BY event_type""",
)
def scan_provenance(spark, sf_dir):
    scanned = readers.with_source_file(
        readers.read_csv(
            spark, _event_csv_runs(spark, sf_dir), _EVENT_CSV,
            timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        )
    )
    return (
        scanned.groupBy(F.regexp_extract("source_file", "run=([^/]+)/", 1).alias("run"))
        .agg(F.count("*").alias("rows"), F.round(F.sum("c3"), 2).alias("total"))
    )


#: Columns whose type differs between the lines of an order, as text.
_MIXED = {
    "id": "CAST(l_orderkey AS STRING)",
    "amount": "CASE WHEN l_linenumber = 1 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) ELSE CAST(l_extendedprice AS STRING) END",
    "code": "CASE WHEN l_linenumber = 3 THEN l_returnflag ELSE CAST(l_partkey AS STRING) END",
    "shipped": "CASE WHEN l_linenumber <= 4 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 06:30:00' END",
    "flag": "CASE WHEN l_linenumber < 7 THEN CASE WHEN l_tax > 0.04 THEN 'true' ELSE 'False' END END",
    "large": "CAST(CASE WHEN l_linenumber = 2 THEN l_orderkey * 10000000000 ELSE l_orderkey END AS STRING)",
}

_MIXED_SQL = (
    "WITH t AS (SELECT l_linenumber AS line, " + ", ".join(f"{sql} AS {name}" for name, sql in _MIXED.items())
    + """ FROM lineitem),
  u AS (SELECT line, unnest(['id', 'amount', 'code', 'shipped', 'flag', 'large']) AS "column",
               unnest([id, amount, code, shipped, flag, large]) AS v FROM t),
  c AS (SELECT line, "column", v, CASE WHEN v IS NULL THEN 0
      WHEN regexp_full_match(v, '[0-9]+') THEN CASE WHEN TRY_CAST(v AS INT) IS NOT NULL THEN 2 ELSE 4 END
      WHEN regexp_full_match(v, '[0-9]+[.][0-9]+([eE][0-9]+)?') THEN 8 WHEN lower(v) IN ('true', 'false') THEN 1
      WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 16
      WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} .*') THEN 32 ELSE 64 END AS k FROM u),
  f AS (SELECT line, "column", bit_or(k) AS m, count(*) AS n, count(*) FILTER (k = 0) AS blank FROM c GROUP BY ALL),
  o AS (SELECT *, CASE WHEN m = 0 OR m >= 64 THEN 'string' WHEN m = 1 THEN 'boolean' WHEN m = 2 THEN 'int' WHEN m <= 6 AND m % 2 = 0 THEN 'bigint'
      WHEN m <= 14 AND m % 2 = 0 THEN 'double' WHEN m = 16 THEN 'date' WHEN m IN (32, 48) THEN 'timestamp_ntz' ELSE 'string' END AS own
      FROM (SELECT * FROM f UNION ALL SELECT NULL, "column", bit_or(m), sum(n), sum(blank) FROM f GROUP BY "column"))
SELECT w."column", w.own AS "type", w.n::BIGINT AS n, w.blank::BIGINT AS blank, count(*) FILTER (o.m > 0 AND o.own <> w.own) AS drifting,
       w.own = 'string' AND w.m > 0 AND (w.m <> 64 OR count(*) FILTER (o.m > 0 AND o.own <> 'string') > 0) AS conflict,
       coalesce(string_agg(DISTINCT o.own, ',' ORDER BY o.own) FILTER (o.m > 0), '') AS own_types
FROM o w JOIN o ON o."column" = w."column" AND o.line IS NOT NULL WHERE w.line IS NULL
GROUP BY w."column", w.own, w.n, w.blank, w.m"""
).replace("AS STRING)", "AS VARCHAR)")


@query("infer_types", _MIXED_SQL)
def infer_types(spark, sf_dir):
    """Types of CSV columns over all values, with the lines of an order as kinds of files."""
    path = fresh_path(spark, "mixed")
    lines = table(spark, sf_dir, "lineitem")
    lines.select(F.col("l_linenumber").alias("line"), *[F.expr(sql).alias(name) for name, sql in _MIXED.items()]).write.partitionBy(
        "line").option("header", True).csv(path)
    texts = inference.read_texts(spark, f"{path}/line=*/*.csv")
    profile = inference.file_profile(texts, F.regexp_extract("_file", "line=([^/]+)/", 1))
    return inference.type_report(profile).select(
        "column", "type", "n", "blank", "drifting", "conflict", F.array_join("own_types", ",").alias("own_types"))


@query("scan_tsv_pairs", "SELECT p_brand AS source, p_type AS target, p_name AS name FROM part")
def scan_tsv_pairs(spark, sf_dir):
    path = fresh_path(spark, "pairs")
    table(spark, sf_dir, "part").select("p_brand", "p_type", "p_name").write.option(
        "sep", "\t"
    ).csv(path)
    return readers.read_pairs(spark, path, ["source", "target", "name"])


@query(
    "sink_roundtrip",
    """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "balances")
    per_nation = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )
    named = per_nation.join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("n_name", "customers", "balance")
    sinks.write_single_csv(named, path)
    return readers.read_csv(spark, path, "n_name string, customers long, balance double")


@query(
    "sink_locale_csv",
    """SELECT l_returnflag, l_linestatus,
              replace(CAST(CAST(round(avg(l_discount), 4) AS DOUBLE) AS VARCHAR), '.', ',') AS avg_discount,
              replace(CAST(CAST(round(avg(l_quantity), 4) AS DOUBLE) AS VARCHAR), '.', ',') AS avg_quantity
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def sink_locale_csv(spark, sf_dir):
    path = fresh_path(spark, "locale")
    means = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.avg("l_discount").alias("avg_discount"), F.avg("l_quantity").alias("avg_quantity"))
    )
    sinks.write_locale_csv(means, path)
    return readers.read_csv(
        spark, path,
        "l_returnflag string, l_linestatus string, avg_discount string, avg_quantity string",
        sep=";",
    )


@query(
    "catalog_tables",
    """SELECT 'orders' AS name, count(*) AS "rows" FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'events', count(*) FROM events""",
)
def catalog_tables(spark, sf_dir):
    """Rows per registered view, read through the catalog."""
    names = ["orders", "lineitem", "events"]
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(f"tg_{name}")
    listed = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    parts = [
        spark.table(f"tg_{n}").agg(F.lit(n).alias("name"), F.count("*").alias("rows"))
        for n in names
        if f"tg_{n}" in listed
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# ---------------------------------------------------------------- grouped reports

_VENDOR_SQL = """SELECT o_orderpriority, sum(o_totalprice_cents) AS total_cents FROM
    (SELECT o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice_cents FROM orders)
    GROUP BY o_orderpriority"""
_VENDOR_SQL = _VENDOR_SQL.replace("sum(o_totalprice_cents)", "CAST(sum(o_totalprice_cents) AS BIGINT)")


def _priced(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    )


@query("vendor_totals_dsl", _VENDOR_SQL)
def vendor_totals_dsl(spark, sf_dir):
    return reports.group_totals(_priced(spark, sf_dir), "o_orderpriority", "cents", "total_cents")


@query("vendor_totals_sql", _VENDOR_SQL)
def vendor_totals_sql(spark, sf_dir):
    return reports.group_totals_sql(
        _priced(spark, sf_dir), "o_orderpriority", "cents", "total_cents", "tg_priced"
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as rides; some lack a start time or lie off the map."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    start = F.col("o_orderdate") + F.make_dt_interval(secs=(k * 37 % 86_400).cast("int"))
    seconds = (c % 3_000 + 60).cast("int")
    return table(spark, sf_dir, "orders").select(
        k.alias("ride"),
        (c % 2 + 1).cast("int").alias("company"),
        (k % 6 + 1).cast("int").alias("riders"),
        F.when(k % 97 != 0, start).alias("started"),
        (start + F.make_dt_interval(secs=seconds)).alias("ended"),
        F.when(k % 89 == 0, 200.0).otherwise((c % 3_500) / 10.0 - 175.0).alias("lon_a"),
        ((k % 1_400) / 10.0 - 70.0).alias("lat_a"),
        ((c % 3_500) / 10.0 - 175.0 + (k % 7 - 3) * 0.03).alias("lon_b"),
        ((k % 1_400) / 10.0 - 70.0 + (c % 5 - 2) * 0.04).alias("lat_b"),
        seconds.alias("seconds"),
    )


_RIDES_SQL = """rides AS (
    SELECT o_orderkey AS ride, CAST(o_custkey % 2 + 1 AS INTEGER) AS company, CAST(o_orderkey % 6 + 1 AS INTEGER) AS riders,
           CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_seconds(o_orderkey * 37 % 86400) END AS started,
           o_orderdate + to_seconds(o_orderkey * 37 % 86400) + to_seconds(o_custkey % 3000 + 60) AS ended,
           CASE WHEN o_orderkey % 89 = 0 THEN 200.0::DOUBLE
                ELSE (o_custkey % 3500) / 10.0::DOUBLE - 175.0::DOUBLE END AS lon_a,
           (o_orderkey % 1400) / 10.0::DOUBLE - 70.0::DOUBLE AS lat_a,
           (o_custkey % 3500) / 10.0::DOUBLE - 175.0::DOUBLE + (o_orderkey % 7 - 3) * 0.03::DOUBLE AS lon_b,
           (o_orderkey % 1400) / 10.0::DOUBLE - 70.0::DOUBLE + (o_custkey % 5 - 2) * 0.04::DOUBLE AS lat_b,
           CAST(o_custkey % 3000 + 60 AS INTEGER) AS seconds
    FROM orders),
measured AS (
    SELECT *, 6371.0::DOUBLE * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
               sin(radians(lat_a)) * sin(radians(lat_b))
               + cos(radians(lat_a)) * cos(radians(lat_b)) * cos(radians(lon_b - lon_a))))) AS km
    FROM rides WHERE started IS NOT NULL AND ended IS NOT NULL AND abs(lon_a) <= 180 AND abs(lon_b) <= 180
      AND abs(lat_a) <= 90 AND abs(lat_b) <= 90)"""
_REPORT_SQL = f"""WITH {_RIDES_SQL}
    SELECT company, CAST(hour(started) AS INTEGER) AS start_hour, strftime(started, '%a') AS start_day, CAST(km > 10 AS INTEGER) AS far,
           count(*) AS rides, round(avg(seconds), 4) AS mean_seconds, quantile_disc(seconds, 0.5) AS median_seconds,
           round(avg(km), 2) AS mean_km, round(quantile_disc(km, 0.5), 2) AS median_km,
           min(riders) AS fewest_riders, max(riders) AS most_riders, round(avg(riders), 4) AS mean_riders
    FROM measured GROUP BY 1, 2, 3, 4"""


def _rounded_report(report: DataFrame) -> DataFrame:
    digits = {"mean_seconds": 4, "mean_km": 2, "median_km": 2, "mean_riders": 4}
    return report.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("trip_report_dsl", _REPORT_SQL)
def trip_report_dsl(spark, sf_dir):
    return _rounded_report(reports.RIDES.frame(rides(spark, sf_dir)))


@query("trip_report_sql", _REPORT_SQL)
def trip_report_sql(spark, sf_dir):
    return _rounded_report(reports.RIDES.from_text(rides(spark, sf_dir), "tg_rides"))


@query("great_circle", f"WITH {_RIDES_SQL} SELECT ride, round(km, 2) AS km FROM measured")
def great_circle(spark, sf_dir):
    km = S.great_circle_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    return reports.RIDES.kept(rides(spark, sf_dir)).select("ride", F.round(km, 2).alias("km"))


@query(
    "median_by_group",
    """SELECT c_mktsegment, quantile_disc(c_acctbal, 0.5) AS median_balance, count(*) AS customers
       FROM customer GROUP BY c_mktsegment""",
)
def median_by_group(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment")
        .agg(
            F.percentile_approx("c_acctbal", 0.5).alias("median_balance"),
            F.count("*").alias("customers"),
        )
    )


# ---------------------------------------------------------------- profiles and filters


@query(
    "median_rollup",
    """SELECT l_returnflag, count(*) AS n, true AS within FROM lineitem GROUP BY 1""",
)
def median_rollup(spark, sf_dir):
    """Medians per flag from stored sketches per flag, supplier and month, with their exact
    rank checked against the stated error (``within``)."""
    lines = table(spark, sf_dir, "lineitem")
    daily = lines.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = fresh_path(spark, "sketches")
    sketches.sketch_groups(daily, ["l_returnflag", "l_linestatus", "month"], "l_extendedprice").write.parquet(path)
    medians = sketches.merge_groups(spark.read.parquet(path), ["l_returnflag"]).select(
        "l_returnflag", "n", sketches.quantile("sketch", 0.5).alias("median"))
    ranked = lookup_join(lines.select("l_returnflag", "l_extendedprice"), medians, ["l_returnflag"]).groupBy("l_returnflag", "n").agg(
        F.avg((F.col("l_extendedprice") < F.col("median")).cast("int")).alias("below"),
        F.avg((F.col("l_extendedprice") <= F.col("median")).cast("int")).alias("up_to"))
    slack = 1.5 * sketches.rank_error()
    return ranked.select("l_returnflag", "n", ((F.col("below") - slack <= 0.5) & (F.col("up_to") + slack >= 0.5)).alias("within"))


@query(
    "sum_above_fraction_of_max",
    """SELECT round(sum(o_totalprice), 2) AS total, count(*) AS "rows" FROM orders
       WHERE o_totalprice > (SELECT max(o_totalprice) FROM orders) * 0.6""",
)
def sum_above_fraction_of_max(spark, sf_dir):
    return R.above_share_of_max(table(spark, sf_dir, "orders"), "o_totalprice", 0.6).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("rows")
    )


@query(
    "count_if_two_predicates",
    """SELECT count(*) FILTER (WHERE l_quantity > 10 AND l_discount < 0.03) AS matching
       FROM lineitem""",
)
def count_if_two_predicates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        F.count_if((F.col("l_quantity") > 10) & (F.col("l_discount") < 0.03)).alias("matching")
    )


@query(
    "mean_variance_table",
    """SELECT 'Mean' AS "Statistic", round(avg(l_quantity), 2) AS l_quantity,
              round(avg(l_extendedprice), 2) AS l_extendedprice, round(avg(l_tax), 2) AS l_tax FROM lineitem
       UNION ALL
       SELECT 'Variance', round(var_samp(l_quantity), 2), round(var_samp(l_extendedprice), 2),
              round(var_samp(l_tax), 2) FROM lineitem""",
)
def mean_variance_table(spark, sf_dir):
    return R.statistic_table(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"]
    )


@query(
    "derived_ratio_max",
    """SELECT voltage, format('{:,.2f}', max(r)) AS max_r FROM (
         SELECT round(v, 2) AS voltage, (5 - v) / nullif(v, 0) * 1000000 AS r
         FROM (SELECT l_discount * 10 AS v FROM lineitem)) GROUP BY voltage""",
)
def derived_ratio_max(spark, sf_dir):
    """Largest divider resistance per voltage; a zero voltage has none."""
    volts = table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10).alias("v"))
    return (
        volts.select(F.round("v", 2).alias("voltage"), S.divider_resistance(F.col("v")).alias("r"))
        .groupBy("voltage")
        .agg(F.format_number(F.max("r"), 2).alias("max_r"))
        .orderBy("voltage")
    )


_NULLED_SQL = """nulled AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS o_totalprice,
    nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)"""


def _nulled(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(price > 100_000, price).alias("o_totalprice"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"),
    )


@query(
    "null_profile",
    f"""WITH {_NULLED_SQL} SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
        count(*) FILTER (WHERE o_orderstatus IS NULL) AS o_orderstatus,
        count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice,
        count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority FROM nulled""",
)
def null_profile(spark, sf_dir):
    return R.null_profile(_nulled(spark, sf_dir))


@query(
    "fill_missing",
    f"""WITH {_NULLED_SQL} SELECT o_orderkey, coalesce(o_orderstatus, 'unknown') AS o_orderstatus,
        coalesce(o_totalprice, 0.0) AS o_totalprice, o_orderpriority FROM nulled""",
)
def fill_missing(spark, sf_dir):
    return _nulled(spark, sf_dir).na.fill({"o_orderstatus": "unknown", "o_totalprice": 0.0})


@query(
    "titanic_style_features",
    """SELECT doc_id, family, CASE WHEN family = 1 THEN 1 ELSE 0 END AS alone,
              CASE WHEN cabin IS NULL THEN 'U' ELSE substr(cabin, 1, 1) END AS deck,
              CASE WHEN regexp_matches(ticket, '^[0-9]+$') THEN 'NUM'
                   WHEN regexp_extract(ticket, '([A-Za-z./]+)', 1) = '' THEN 'NONE'
                   ELSE regexp_extract(ticket, '([A-Za-z./]+)', 1) END AS prefix
       FROM (SELECT d.doc_id, CAST(quality + toxic + 1 AS INTEGER) AS family,
                    coalesce(nullif(lang, 'fr'), 'NoCabin') AS cabin,
                    CASE WHEN n_chars % 3 = 0 THEN CAST(n_chars AS VARCHAR)
                         WHEN n_chars % 3 = 1 THEN source || ' ' || n_chars
                         ELSE '#' || n_chars END AS ticket
             FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
)
def titanic_style_features(spark, sf_dir):
    n = F.col("n_chars")
    passengers = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "lang", "source", "n_chars")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            "doc_id", "quality", "toxic", "source", "n_chars",
            F.nullif(F.col("lang"), F.lit("fr")).alias("cabin"),
            F.when(n % 3 == 0, n.cast("string"))
            .when(n % 3 == 1, F.concat_ws(" ", "source", n.cast("string")))
            .otherwise(F.concat(F.lit("#"), n.cast("string")))
            .alias("ticket"),
        )
        .na.fill({"cabin": "NoCabin"})
        .drop("source", "n_chars")
    )
    letters = F.regexp_extract("ticket", r"([A-Za-z./]+)", 1)
    return passengers.withColumns(
        {
            "family": (F.col("quality") + F.col("toxic") + 1).cast("int"),
            "alone": F.when(F.col("family") == 1, 1).otherwise(0),
            "deck": F.when(F.col("cabin").isNull(), "U").otherwise(F.substring("cabin", 1, 1)),
            "prefix": F.when(F.col("ticket").rlike("^[0-9]+$"), "NUM")
            .when(letters == "", "NONE")
            .otherwise(letters),
        }
    ).select("doc_id", "family", "alone", "deck", "prefix")


@query(
    "corr_matrix",
    """WITH c AS (SELECT corr(l_extendedprice, l_quantity) AS a, corr(l_discount, l_quantity) AS b,
                         corr(l_discount, l_extendedprice) AS c, corr(l_tax, l_quantity) AS d,
                         corr(l_tax, l_extendedprice) AS e, corr(l_tax, l_discount) AS f FROM lineitem)
       SELECT 'l_extendedprice' AS x, 'l_quantity' AS y, round(a, 2) AS r FROM c
       UNION ALL SELECT 'l_discount', 'l_quantity', round(b, 2) FROM c
       UNION ALL SELECT 'l_discount', 'l_extendedprice', round(c, 2) FROM c
       UNION ALL SELECT 'l_tax', 'l_quantity', round(d, 2) FROM c
       UNION ALL SELECT 'l_tax', 'l_extendedprice', round(e, 2) FROM c
       UNION ALL SELECT 'l_tax', 'l_discount', round(f, 2) FROM c""",
)
def corr_matrix(spark, sf_dir):
    return R.correlation_pairs(
        table(spark, sf_dir, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )


_BOX_SQL = """WITH long AS (SELECT 'value' AS name, value AS x FROM events
                            UNION ALL SELECT 'user_id', CAST(user_id AS DOUBLE) FROM events),
    q AS (SELECT name, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                 quantile_cont(x, 0.75) AS q3 FROM long GROUP BY name)
    SELECT q.name, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(avg(x), 6) AS mean,
           min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (WHERE NOT (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))) AS outliers
    FROM long JOIN q ON long.name = q.name GROUP BY q.name, q1, median, q3"""


@query("box_stats", _BOX_SQL)
def box_stats(spark, sf_dir):
    stats = R.box_statistics(table(spark, sf_dir, "events"), ["value", "user_id"])
    return stats.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "mean")})


@query(
    "histogram_50",
    """WITH b AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM events),
       c AS (SELECT least(floor((value - lo) / w), 49)::INTEGER AS bin, count(*) AS n
             FROM events, b GROUP BY 1)
       SELECT g.bin::INTEGER AS bin, round(lo + g.bin * w, 6) AS left_edge, coalesce(n, 0) AS "rows"
       FROM range(50) AS g(bin) CROSS JOIN b LEFT JOIN c ON c.bin = g.bin""",
)
def histogram_50(spark, sf_dir):
    bins = R.histogram(table(spark, sf_dir, "events"), "value", 50)
    return bins.withColumn("left_edge", F.round("left_edge", 6))


@query(
    "kde_curve",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
                         stddev_samp(value) * pow(count(value), -0.2) AS h FROM events),
       c AS (SELECT least(floor((value - lo) / ((hi - lo) / 1024)), 1023) AS bin, count(*) AS k
             FROM events, b GROUP BY 1),
       m AS (SELECT lo + (bin + 0.5) * (hi - lo) / 1024 AS centre, k, lo, hi, n, h FROM c, b)
       SELECT g.p::INTEGER AS point, round(max(lo + g.p * (hi - lo) / 199), 6) AS x,
              round(sum(k * exp(-0.5 * pow((lo + g.p * (hi - lo) / 199 - centre) / h, 2)))
                    / max(n * h * sqrt(2 * pi())), 9) AS density
       FROM m, range(200) AS g(p) GROUP BY g.p""",
)
def kde_curve(spark, sf_dir):
    curve = R.density_curve(table(spark, sf_dir, "events"), "value")
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query(
    "skewness_adjusted",
    """SELECT round(skewness(value), 6) AS value, round(skewness(user_id), 6) AS user_id FROM events""",
)
def skewness_adjusted(spark, sf_dir):
    skew = R.skewness_of(table(spark, sf_dir, "events"), ["value", "user_id"])
    return skew.select(F.round("value", 6).alias("value"), F.round("user_id", 6).alias("user_id"))


_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)


@query(
    "pivot_year_month",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, "
    + ", ".join(
        f'round(avg(o_totalprice) FILTER (WHERE month(o_orderdate) = {i}), 4) AS "{m}"'
        for i, m in enumerate(_MONTHS, 1)
    )
    + " FROM orders GROUP BY 1",
)
def pivot_year_month(spark, sf_dir):
    pivot = R.pivot_months(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
    return pivot.select("year", *[F.round(m, 4).alias(m) for m in _MONTHS])


@query(
    "estimate_spread",
    """WITH e AS (SELECT l_returnflag, l_suppkey, avg(l_extendedprice) AS e FROM lineitem GROUP BY ALL),
            t AS (SELECT l_returnflag, avg(l_extendedprice) AS t FROM lineitem GROUP BY ALL)
       SELECT l_returnflag, round(var_samp(e), 4) AS estimate_variance, round(avg(abs(e - t)), 4) AS mean_error
       FROM e JOIN t USING (l_returnflag) GROUP BY l_returnflag""",
)
def estimate_spread(spark, sf_dir):
    """Mean prices by supplier as estimates of the mean price per return flag: spread and error."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_suppkey", "l_extendedprice")
    estimates = lines.groupBy("l_returnflag", "l_suppkey").agg(F.avg("l_extendedprice").alias("estimate"))
    truth = lines.groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("truth"))
    spread = R.estimate_spread(lookup_join(estimates, truth, ["l_returnflag"]), "l_returnflag", "estimate", "truth")
    return spread.select(
        "l_returnflag", F.round("estimate_variance", 4).alias("estimate_variance"), F.round("mean_error", 4).alias("mean_error")
    )


# ---------------------------------------------------------------- joins and key-value


@query(
    "join_inner",
    """SELECT o_orderkey, c_name, c_mktsegment, o_totalprice
       FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "key")
    return R.key_join(orders, customers, ["key"]).select(
        "o_orderkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query(
    "join_left",
    """SELECT c_custkey AS key, c_name, o_orderkey FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey""",
)
def join_left(spark, sf_dir):
    placed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return R.key_join(customers, placed, ["key"], "left")


@query(
    "cogroup_lists",
    """WITH a AS (SELECT CAST(floor(c_acctbal / 50) AS BIGINT) AS key, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS l
                  FROM customer GROUP BY 1),
            b AS (SELECT CAST(floor(s_acctbal / 50) AS BIGINT) AS key, string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey) AS r
                  FROM supplier GROUP BY 1)
       SELECT coalesce(a.key, b.key) AS key, coalesce(l, '') AS customers, coalesce(r, '') AS suppliers
       FROM a FULL JOIN b ON a.key = b.key""",
)
def cogroup_lists(spark, sf_dir):
    """Customers and suppliers per band of account balance; some bands lack one side."""
    customers = table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_acctbal") / 50).alias("key"), F.col("c_custkey").alias("customer")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.floor(F.col("s_acctbal") / 50).alias("key"), F.col("s_suppkey").alias("supplier")
    )
    both = R.cogroup_lists(customers, suppliers, "key", "customer", "supplier")
    return both.select(
        "key",
        F.array_join(F.col("left_values").cast("array<string>"), ",").alias("customers"),
        F.array_join(F.col("right_values").cast("array<string>"), ",").alias("suppliers"),
    )


@query(
    "reduce_fold_sum",
    """SELECT CAST(sum(l_linenumber) AS BIGINT) AS reduced,
              CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS folded FROM lineitem""",
)
def reduce_fold_sum(spark, sf_dir):
    total = F.sum("l_linenumber")
    return table(spark, sf_dir, "lineitem").agg(
        total.alias("reduced"), F.coalesce(total, F.lit(0)).alias("folded")
    )


@query(
    "aggregate_sum_count",
    'SELECT CAST(sum(l_partkey) AS BIGINT) AS total, count(l_partkey) AS n FROM lineitem',
)
def aggregate_sum_count(spark, sf_dir):
    return R.sum_and_count(table(spark, sf_dir, "lineitem"), F.col("l_partkey"))


def _range_of(state, batch):
    """(n, sum, least, greatest) of the state and a batch's first column."""
    column = batch.column(0).drop_null()
    if not len(column):
        return state
    bounds = pc.min_max(column).as_py()
    return _ranges_together(state, (len(column), pc.sum(column).as_py(), bounds["min"], bounds["max"]))


def _ranges_together(a, b):
    if not a[0] or not b[0]:
        return a if a[0] else b
    return a[0] + b[0], a[1] + b[1], min(a[2], b[2]), max(a[3], b[3])


@query(
    "user_aggregate_range",
    """SELECT count(l_partkey) AS n, sum(l_partkey)::BIGINT AS total, min(l_partkey) AS least, max(l_partkey) AS greatest
       FROM lineitem""",
)
def user_aggregate_range(spark, sf_dir):
    """A step over Arrow batches, one state per task."""
    how = UserAggregate(lambda: (0, 0, None, None), _range_of, _ranges_together,
                        "struct<n: bigint, total: bigint, least: bigint, greatest: bigint>",
                        result=lambda s: dict(zip(("n", "total", "least", "greatest"), s)), by_batch=True)
    return user_aggregate(table(spark, sf_dir, "lineitem"), ["l_partkey"], how).select("value.*")


@query(
    "user_aggregate_months",
    "SELECT l_suppkey, bit_or(1::BIGINT << month(l_shipdate)) AS months FROM lineitem GROUP BY 1",
)
def user_aggregate_months(spark, sf_dir):
    """A set of months per supplier, held in the bits of a number."""
    how = UserAggregate(lambda: 0, lambda bits, day: bits | 1 << day.month, lambda a, b: a | b, "bigint")
    return user_aggregate(table(spark, sf_dir, "lineitem"), ["l_shipdate"], how, keys=["l_suppkey"], into="months")


def _three(values):
    return sorted(set(values), reverse=True)[:3]


@query(
    "user_aggregate_top",
    """SELECT l_returnflag, string_agg(l_orderkey::VARCHAR, ',' ORDER BY l_orderkey DESC) AS orders
       FROM (SELECT DISTINCT l_returnflag, l_orderkey, dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey DESC) AS r
             FROM lineitem) WHERE r <= 3 GROUP BY 1""",
)
def user_aggregate_top(spark, sf_dir):
    """The three greatest different orders of each flag: few keys, each of very many rows."""
    how = UserAggregate(list, lambda best, order: best if order in best else _three([*best, order]),
                        lambda a, b: _three(a + b), "array<bigint>")
    found = user_aggregate(table(spark, sf_dir, "lineitem"), ["l_orderkey"], how, keys=["l_returnflag"], into="orders")
    return found.withColumn("orders", F.array_join(F.col("orders").cast("array<string>"), ","))


@query(
    "observed_counts",
    """SELECT count(*) AS "rows", count(*) FILTER (WHERE l_quantity > 10 AND l_discount < 0.03) AS matching,
              count(*) FILTER (WHERE l_shipdate IS NULL) AS null_shipdate,
              count(*) FILTER (WHERE NOT l_tax < l_discount) AS failed_taxed_less, count(*) AS written FROM lineitem""",
)
def observed_counts(spark, sf_dir):
    """Counts that the one pass delivers which writes the rows."""
    lines = table(spark, sf_dir, "lineitem")
    counters = observed.quality_counters(lines.select("l_shipdate"), {"taxed_less": F.col("l_tax") < F.col("l_discount")})
    counters["matching"] = F.count_if((F.col("l_quantity") > 10) & (F.col("l_discount") < 0.03))
    path = fresh_path(spark, "counted")
    counts = observed.write_counted(lines, path, counters)
    return spark.read.parquet(path).agg(F.count("*").alias("written")).select(
        *[F.lit(counts[n]).alias(a) for n, a in (
            ("rows", "rows"), ("matching", "matching"), ("null_l_shipdate", "null_shipdate"),
            ("failed_taxed_less", "failed_taxed_less"))], "written")


@query(
    "map_values_tax",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS price,
              CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)) * 1.1, 2) AS DOUBLE) AS taxed FROM lineitem""",
)
def map_values_tax(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        F.round(price * F.lit("1.1").cast("decimal(2,1)"), 2).cast("double").alias("taxed"),
    )


@query(
    "reduce_by_key",
    "SELECT user_id, round(sum(value), 2) AS total FROM events GROUP BY user_id",
)
def reduce_by_key(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.round(F.sum("value"), 2).alias("total"))
    )


@query(
    "group_values_list",
    """SELECT o_custkey, (rn - 1) // 10000 AS page,
              string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS orders
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
       GROUP BY 1, 2""",
)
def group_values_list(spark, sf_dir):
    lists = R.grouped_values(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")
    return lists.select(
        "o_custkey",
        "page",
        F.array_join(F.col("values").cast("array<string>"), ",").alias("orders"),
    )


# ---------------------------------------------------------------- multisets of lines


def _two_logs(spark, sf_dir):
    """The lines of all documents and the lines of the labelled documents."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(S.text_lines(F.col("text"))).alias("line")
    )
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    return lines.select("line"), lines.join(labelled, "doc_id", "left_semi").select("line")


_LINES_SQL = """WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    a AS (SELECT line FROM lines),
    b AS (SELECT line FROM lines WHERE doc_id IN (SELECT doc_id FROM labels))"""


@query(
    "set_union_all",
    _LINES_SQL
    + ' SELECT line, count(*) AS "rows" FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY line',
)
def set_union_all(spark, sf_dir):
    a, b = _two_logs(spark, sf_dir)
    return R.bag_union(a, b).groupBy("line").agg(F.count("*").alias("rows"))


@query("set_intersect", _LINES_SQL + " SELECT * FROM a INTERSECT SELECT * FROM b")
def set_intersect(spark, sf_dir):
    return R.intersection(*_two_logs(spark, sf_dir))


@query(
    "set_subtract_bag",
    _LINES_SQL + " SELECT line FROM a WHERE line NOT IN (SELECT line FROM b)",
)
def set_subtract_bag(spark, sf_dir):
    return R.bag_subtract(*_two_logs(spark, sf_dir))


# ---------------------------------------------------------------- wide sensor frame

SENSOR_COUNT = 64


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per row and embedding dimension."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        *[
            F.element_at("embedding", i).cast("double").alias(f"R{i}")
            for i in range(1, SENSOR_COUNT + 1)
        ],
    )


R_COLUMNS = [f"R{i}" for i in range(1, SENSOR_COUNT + 1)]
LOWER, UPPER = R_COLUMNS[: SENSOR_COUNT // 2], R_COLUMNS[SENSOR_COUNT // 2 :]
SENSORS_SQL = (
    "sensors AS (SELECT vec_id, label, "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS R{i}" for i in range(1, SENSOR_COUNT + 1))
    + " FROM embeddings)"
)


@query(
    "melt_sensors",
    f"""WITH {SENSORS_SQL} SELECT vec_id, substr(name, 2) AS "Sensor_ID", round(v, 6) AS "R",
        round(t, 6) AS "Target_R"
        FROM (SELECT vec_id, unnest([{", ".join(f"'R{i}'" for i in range(1, SENSOR_COUNT + 1))}]) AS name,
                     unnest([{", ".join(R_COLUMNS)}]) AS v,
                     unnest([{", ".join(f"{c} + label" for c in R_COLUMNS)}]) AS t FROM sensors)""",
)
def melt_sensors(spark, sf_dir):
    wide = sensors(spark, sf_dir).withColumns(
        {f"Target_{c}": F.col(c) + F.col("label") for c in R_COLUMNS}
    )
    groups = {str(i): (f"Target_R{i}", f"R{i}") for i in range(1, SENSOR_COUNT + 1)}
    long = R.melt_pairs(wide, ["vec_id"], groups, "Sensor_ID", ["Target_R", "R"])
    return long.select(
        "vec_id", "Sensor_ID", F.round("R", 6).alias("R"), F.round("Target_R", 6).alias("Target_R")
    )


@query(
    "log1p_expm1",
    f"WITH {SENSORS_SQL} SELECT vec_id, "
    + ", ".join(f"round(ln(1 + {c}), 6) AS log_{c}, round({c}, 6) AS {c}" for c in R_COLUMNS)
    + " FROM sensors",
)
def log1p_expm1(spark, sf_dir):
    wide = sensors(spark, sf_dir)
    logged = wide.select("vec_id", *[F.log1p(c).alias(f"l_{c}") for c in R_COLUMNS])
    columns = []
    for c in R_COLUMNS:
        columns += [F.round(f"l_{c}", 6).alias(f"log_{c}"), F.round(F.expm1(f"l_{c}"), 6).alias(c)]
    return logged.select("vec_id", *columns)


@query(
    "minmax_columns",
    f"WITH {SENSORS_SQL} SELECT vec_id, "
    + ", ".join(
        f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}"
        for c in R_COLUMNS
    )
    + " FROM sensors",
)
def minmax_columns(spark, sf_dir):
    wide = sensors(spark, sf_dir)
    bounds = wide.agg(*[x for c in R_COLUMNS for x in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))])
    placed = lookup_join(wide, bounds, [])
    return placed.select(
        "vec_id", *[F.round(S.min_max(F.col(c), F.col(f"lo_{c}"), F.col(f"hi_{c}")), 6).alias(c) for c in R_COLUMNS]
    )


@query(
    "midrange_state",
    """SELECT count(*) FILTER (WHERE o_totalprice > (SELECT (min(o_totalprice) + max(o_totalprice)) / 2 FROM orders)) AS high,
              count(*) AS "rows" FROM orders""",
)
def midrange_state(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    middle = orders.agg((F.min("o_totalprice") + F.max("o_totalprice")) / 2).scalar()
    state = F.when(F.col("o_totalprice") > middle, 1).otherwise(0)
    return orders.select(state.alias("state")).agg(
        F.count_if(F.col("state") == 1).alias("high"), F.count("*").alias("rows")
    )


@query(
    "row_mean",
    f"""WITH {SENSORS_SQL}, n AS (SELECT vec_id, {", ".join(f"CASE WHEN {c} > 0 THEN {c} END AS {c}" for c in R_COLUMNS)} FROM sensors)
    SELECT vec_id, round(list_avg([{", ".join(R_COLUMNS)}]), 6) AS all_mean,
           round(list_avg([{", ".join(LOWER)}]), 6) AS first_mean,
           round(list_avg([{", ".join(UPPER)}]), 6) AS second_mean FROM n""",
)
def row_mean(spark, sf_dir):
    positive = sensors(spark, sf_dir).select(
        "vec_id", *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in R_COLUMNS]
    )

    def mean(columns):
        return F.round(S.row_mean([F.col(c) for c in columns]), 6)

    return positive.select(
        "vec_id",
        mean(R_COLUMNS).alias("all_mean"),
        mean(LOWER).alias("first_mean"),
        mean(UPPER).alias("second_mean"),
    )
