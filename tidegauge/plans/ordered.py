"""Row order, rolling frames, splits and time-series diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import scalar as S
from tidegauge.operators import features, neighbours, ordered, relational, series, stationarity, stl
from tidegauge.plans.registry import query, table
from tidegauge.plans.relational import R_COLUMNS, SENSORS_SQL, sensors
from tidegauge.session import materialise

# ---------------------------------------------------------------- five-minute means


def five_minute_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "ts", "value")
    return series.downsample(events, "event_type", S.epoch_seconds(F.col("ts")))


_BUCKETS_SQL = """buckets AS (SELECT event_type, CAST(floor(epoch(ts) / 300) AS BIGINT) AS bucket,
    avg(value) AS value FROM events GROUP BY 1, 2),
    numbered AS (SELECT *, row_number() OVER (ORDER BY event_type, bucket) - 1 AS rn FROM buckets)"""


@query(
    "downsample_bucket_mean",
    f"WITH {_BUCKETS_SQL} SELECT event_type, bucket, round(value, 6) AS value FROM buckets",
)
def downsample_bucket_mean(spark, sf_dir):
    means = five_minute_means(spark, sf_dir)
    return means.select("event_type", "bucket", F.round("value", 6).alias("value"))


@query(
    "synthetic_timestamps",
    f"""WITH {_BUCKETS_SQL} SELECT TIMESTAMP '2025-09-01 00:00:00' + to_minutes(rn * 5) AS "Timestamp",
        event_type, bucket FROM numbered""",
)
def synthetic_timestamps(spark, sf_dir):
    stamped = series.synthetic_timestamps(
        five_minute_means(spark, sf_dir), ["event_type", "bucket"]
    )
    return stamped.select("Timestamp", "event_type", "bucket")


@query(
    "tumbling_25m",
    """SELECT time_bucket(INTERVAL 25 MINUTES, ts, TIMESTAMP '1970-01-01') AS ts,
              round(avg(value), 6) AS value FROM events GROUP BY 1""",
)
def tumbling_25m(spark, sf_dir):
    means = series.tumbling_mean(table(spark, sf_dir, "events"), "ts", ["value"], "25 minutes")
    return means.select("ts", F.round("value", 6).alias("value"))


@query(
    "rolling_zscore",
    f"""WITH {_BUCKETS_SQL}, w AS (SELECT *,
          CASE WHEN rn >= 2 THEN avg(value) OVER (ORDER BY rn ROWS 2 PRECEDING) END AS s,
          CASE WHEN rn >= 11 THEN avg(value) OVER (ORDER BY rn ROWS 11 PRECEDING) END AS m,
          CASE WHEN rn >= 11 THEN stddev_samp(value) OVER (ORDER BY rn ROWS 11 PRECEDING) END AS d FROM numbered)
        SELECT event_type, bucket, round(value, 6) AS value,
               round(greatest(least(coalesce((s - m) / (d + 1e-6), 0), 5), -5), 6) AS zscore FROM w""",
)
def rolling_zscore(spark, sf_dir):
    means = ordered.index_rows(five_minute_means(spark, sf_dir), ["event_type", "bucket"])
    scored = series.rolling_zscore(means, "value", 3, 12, "zscore")
    return scored.select(
        "event_type", "bucket", F.round("value", 6).alias("value"),
        F.round("zscore", 6).alias("zscore"),
    )


# ---------------------------------------------------------------- positions and splits


def events_in_order(spark: SparkSession, sf_dir: str, keys=()) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ordered.index_rows(events, ["ts", "event_id"], keys)


_EVENTS_SQL = """ev AS (SELECT event_id, ts, event_type, value,
    row_number() OVER (ORDER BY ts, event_id) - 1 AS rn, count(*) OVER () AS n FROM events)"""
_TYPED_SQL = """ev AS (SELECT event_id, ts, event_type, value,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS rn FROM events)"""


@query(
    "positional_slice",
    f"WITH {_EVENTS_SQL} SELECT event_id, rn, value FROM ev WHERE rn < n // 6",
)
def positional_slice(spark, sf_dir):
    rows = events_in_order(spark, sf_dir)
    return rows.filter(F.col("rn") < rows.count() // 6).select("event_id", "rn", "value")


@query(
    "positional_split",
    f"""WITH {_EVENTS_SQL} SELECT event_id, CASE WHEN rn < floor(n * 0.7::DOUBLE) THEN 'train'
        WHEN rn < floor(n * 0.9::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ev""",
)
def positional_split(spark, sf_dir):
    rows = events_in_order(spark, sf_dir)
    return ordered.positional_split(rows, rows.count()).select("event_id", "split")


@query(
    "chronological_split",
    """SELECT o_orderkey, CASE WHEN r <= 0.7 THEN 'train' WHEN r <= 0.9 THEN 'validation' ELSE 'test' END AS split
       FROM (SELECT o_orderkey, percent_rank() OVER (ORDER BY o_orderdate) AS r FROM orders)""",
)
def chronological_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return ordered.chronological_split(orders, "o_orderdate").select("o_orderkey", "split")


@query(
    "percent_rank",
    """SELECT o_orderkey, round(percent_rank() OVER (ORDER BY o_orderdate), 9) AS "rank" FROM orders""",
)
def percent_rank(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    ranked = ordered.percent_ranks(orders, "o_orderdate")
    return ranked.select("o_orderkey", F.round("rank", 9).alias("rank"))


@query(
    "prev_minus_current",
    f"""WITH {_EVENTS_SQL} SELECT event_id, round(lag(value) OVER (ORDER BY rn) - value, 6) AS diff FROM ev""",
)
def prev_minus_current(spark, sf_dir):
    rows = series.shift_difference(events_in_order(spark, sf_dir), "value", "diff")
    return rows.select("event_id", F.round("diff", 6).alias("diff"))


@query(
    "lead_targets",
    f"""WITH {SENSORS_SQL}, led AS (SELECT vec_id, {", ".join(f'lead({c}) OVER (ORDER BY vec_id) AS "Target_{c}"' for c in R_COLUMNS)},
          row_number() OVER (ORDER BY vec_id DESC) AS back FROM sensors)
        SELECT vec_id, {", ".join(f'round("Target_{c}", 6) AS "Target_{c}"' for c in R_COLUMNS)} FROM led WHERE back > 1""",
)
def lead_targets(spark, sf_dir):
    rows = ordered.index_rows(sensors(spark, sf_dir), ["vec_id"])
    led = series.lead_targets(rows, R_COLUMNS)
    return led.select("vec_id", *[F.round(f"Target_{c}", 6).alias(f"Target_{c}") for c in R_COLUMNS])


@query(
    "lag_features",
    f"""WITH {_TYPED_SQL} SELECT event_id, CAST(quarter(ts) AS INTEGER) AS quarter, value,
        {", ".join(f"lag(value, {k}) OVER (PARTITION BY event_type ORDER BY rn) AS lag_{k}" for k in range(1, 13))} FROM ev""",
)
def lag_features(spark, sf_dir):
    rows = events_in_order(spark, sf_dir, ["event_type"])
    lagged = series.lag_columns(rows, "value", range(1, 13), ["event_type"])
    return lagged.select(
        "event_id", F.quarter("ts").alias("quarter"), "value", *[f"lag_{k}" for k in range(1, 13)]
    )


@query(
    "lag_plot",
    f"""WITH {_TYPED_SQL}, l AS (SELECT event_id, ts, value,
        {", ".join(f"lag(value, {k}) OVER (PARTITION BY event_type ORDER BY rn) AS lag_{k}" for k in range(1, 13))} FROM ev)
        SELECT event_id, CAST(quarter(ts) AS INTEGER) AS quarter, value,
               unnest([{", ".join(f"'lag_{k}'" for k in range(1, 13))}]) AS lag,
               unnest([{", ".join(f"lag_{k}" for k in range(1, 13))}]) AS earlier FROM l""",
)
def lag_plot(spark, sf_dir):
    """Value against each earlier value in long form, with the quarter for colour."""
    rows = events_in_order(spark, sf_dir, ["event_type"])
    lagged = series.lag_columns(rows, "value", range(1, 13), ["event_type"])
    return relational.unpivot_columns(
        lagged.withColumn("quarter", F.quarter("ts")), ["event_id", "quarter", "value"],
        [f"lag_{k}" for k in range(1, 13)], "lag", "earlier",
    )


@query(
    "lag_limits",
    f"""WITH {_TYPED_SQL}, l AS (SELECT value,
        {", ".join(f"lag(value, {k}) OVER (PARTITION BY event_type ORDER BY rn) AS lag_{k}" for k in range(1, 13))} FROM ev)
        SELECT least(min(value), {", ".join(f"min(lag_{k})" for k in range(1, 13))}) AS low,
               greatest(max(value), {", ".join(f"max(lag_{k})" for k in range(1, 13))}) AS high FROM l""",
)
def lag_limits(spark, sf_dir):
    rows = events_in_order(spark, sf_dir, ["event_type"])
    lagged = series.lag_columns(rows, "value", range(1, 13), ["event_type"])
    return relational.extremes(lagged, ["value", *[f"lag_{k}" for k in range(1, 13)]])


@query(
    "rolling_mean",
    f"""WITH {_TYPED_SQL} SELECT event_id, round(CASE WHEN rn >= 4 THEN
        avg(value) OVER (PARTITION BY event_type ORDER BY rn ROWS 4 PRECEDING) END, 6) AS mean_5 FROM ev""",
)
def rolling_mean(spark, sf_dir):
    rows = events_in_order(spark, sf_dir, ["event_type"])
    rolled = series.rolling_statistics(rows, "value", {"mean_5": 5}, keys=["event_type"])
    return rolled.select("event_id", F.round("mean_5", 6).alias("mean_5"))


@query(
    "rolling_std",
    f"""WITH {_EVENTS_SQL} SELECT event_id, round(CASE WHEN rn >= 49 THEN
        stddev_samp(value) OVER (ORDER BY rn ROWS 49 PRECEDING) END, 6) AS std_50 FROM ev""",
)
def rolling_std(spark, sf_dir):
    rolled = series.rolling_statistics(
        events_in_order(spark, sf_dir), "value", deviations={"std_50": 50}
    )
    return rolled.select("event_id", F.round("std_50", 6).alias("std_50"))


@query(
    "lookback_windows",
    f"""WITH {SENSORS_SQL}, r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS rn, R1, R14,
          array_to_string([{", ".join(f"CAST(round({c} * 1000000) AS BIGINT)" for c in R_COLUMNS)}], ',') AS cells FROM sensors)
        SELECT vec_id, round(R1, 6) AS target_first, round(R14, 6) AS target_last,
               md5(string_agg(cells, ',') OVER (ORDER BY rn ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)) AS digest
        FROM r QUALIFY rn >= 30""",
)
def lookback_windows(spark, sf_dir):
    """Thirty rows of fourteen readings before each row, as a digest for comparison."""
    rows = ordered.index_rows(sensors(spark, sf_dir), ["vec_id"])
    windows = series.lookback_windows(rows, R_COLUMNS, 30)
    whole = F.transform(F.flatten("window"), lambda x: F.round(x * 1_000_000).cast("long").cast("string"))
    return windows.select(
        "vec_id", F.round("R1", 6).alias("target_first"), F.round("R14", 6).alias("target_last"),
        F.md5(F.array_join(whole, ",")).alias("digest"),
    )


# ---------------------------------------------------------------- daily order series

PERIOD = 7


def daily_orders(spark: SparkSession, sf_dir: str, keys=()) -> DataFrame:
    """Order value per calendar day, in thousands."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    orders = table(spark, sf_dir, "orders").select(
        *keys, F.col("o_orderdate").cast("date").alias("day"), cents.alias("cents")
    )
    daily = series.calendar_series(orders, "day", "cents", keys)
    # a few rows per day stand for all orders: write them once, read them often
    return materialise(daily.withColumn("x", F.col("x") / 100_000), "daily")


_DAILY_SQL = """d AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100000 AS x
       FROM orders GROUP BY 1),
    c AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
    s AS (SELECT c.day, row_number() OVER (ORDER BY c.day) - 1 AS rn, CAST(coalesce(x, 0) AS DOUBLE) AS x
          FROM c LEFT JOIN d ON c.day = d.day)"""
_DECOMPOSED_SQL = f"""{_DAILY_SQL},
    t AS (SELECT *, CASE WHEN count(*) OVER f = 7 THEN avg(x) OVER f END AS trend
          FROM s WINDOW f AS (ORDER BY rn ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    p AS (SELECT rn % 7 AS phase, avg(x - trend) AS m FROM t GROUP BY 1),
    q AS (SELECT day, rn, x, trend, m - (SELECT avg(m) FROM p) AS seasonal FROM t JOIN p ON rn % 7 = phase),
    z AS (SELECT *, x - trend - seasonal AS resid FROM q)"""


@query(
    "seasonal_profile",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
              round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1, 2""",
)
def seasonal_profile(spark, sf_dir):
    profile = series.seasonal_profile(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
    return profile.withColumn("mean", F.round("mean", 4))


@query(
    "seasonal_decompose",
    f"""WITH {_DECOMPOSED_SQL} SELECT day, round(x, 6) AS x, round(trend, 6) AS trend,
        round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM z""",
)
def seasonal_decompose(spark, sf_dir):
    parts = series.seasonal_decompose(daily_orders(spark, sf_dir), "x", PERIOD)
    return parts.select("day", *[F.round(c, 6).alias(c) for c in ("x", "trend", "seasonal", "resid")])


@query(
    "seasonal_decompose_even",
    f"""WITH {_DAILY_SQL},
    t AS (SELECT *, CASE WHEN rn >= 150 AND rn < (SELECT count(*) FROM s) - 150 THEN
            (sum(x) OVER (ORDER BY rn ROWS BETWEEN 149 PRECEDING AND 149 FOLLOWING)
             + (lag(x, 150) OVER (ORDER BY rn) + lead(x, 150) OVER (ORDER BY rn)) / 2) / 300 END AS trend FROM s),
    p AS (SELECT rn % 300 AS phase, avg(x - trend) AS m FROM t GROUP BY 1)
    SELECT day, round(trend, 8) AS trend, round(m - (SELECT avg(m) FROM p), 8) AS seasonal
    FROM t JOIN p ON rn % 300 = phase""",
)
def seasonal_decompose_even(spark, sf_dir):
    parts = series.seasonal_decompose(daily_orders(spark, sf_dir), "x", 300)
    return parts.select("day", F.round("trend", 8).alias("trend"), F.round("seasonal", 8).alias("seasonal"))


@query(
    "decomp_strength",
    f"""WITH {_DECOMPOSED_SQL} SELECT round(1 - var_pop(resid) / var_pop(trend + resid), 6) AS trend_strength,
        round(1 - var_pop(resid) / var_pop(seasonal + resid), 6) AS seasonal_strength FROM z""",
)
def decomp_strength(spark, sf_dir):
    parts = series.seasonal_decompose(daily_orders(spark, sf_dir), "x", PERIOD)
    strength = series.component_strength(parts)
    return strength.select(*[F.round(c, 6).alias(c) for c in strength.columns])


@query(
    "acf",
    f"""WITH {_DECOMPOSED_SQL}, e AS (SELECT rn, resid - (SELECT avg(resid) FROM z) AS e FROM z WHERE resid IS NOT NULL)
        SELECT k.lag::INTEGER AS lag, round(sum(a.e * b.e) / (SELECT sum(e * e) FROM e), 6) AS acf,
               round(1.96 / sqrt((SELECT count(*) FROM e)), 6) AS band
        FROM range(37) AS k(lag) JOIN e a ON true JOIN e b ON b.rn = a.rn - k.lag GROUP BY 1""",
)
def acf(spark, sf_dir):
    parts = series.seasonal_decompose(daily_orders(spark, sf_dir), "x", PERIOD)
    values = series.autocorrelation(parts, "resid", 36)
    return values.select("lag", F.round("acf", 6).alias("acf"), F.round("band", 6).alias("band"))


@query(
    "pacf",
    f"""WITH RECURSIVE {_DECOMPOSED_SQL}, e AS (SELECT rn, resid - (SELECT avg(resid) FROM z) AS e FROM z WHERE resid IS NOT NULL),
        a AS (SELECT k.lag AS lag, sum(a.e * b.e) / (SELECT sum(e * e) FROM e) AS r
              FROM range(1, 37) AS k(lag) JOIN e a ON true JOIN e b ON b.rn = a.rn - k.lag GROUP BY 1),
        v AS (SELECT list(r ORDER BY lag) AS r FROM a),
        dl AS (SELECT 1 AS k, [r[1]] AS phi, r[1] AS last, r FROM v
               UNION ALL
               SELECT k + 1, list_concat([phi[i] - nxt * phi[k + 1 - i] for i in range(1, k + 1)], [nxt]), nxt, r
               FROM (SELECT *, (r[k + 1] - list_sum([phi[i] * r[k + 1 - i] for i in range(1, k + 1)]))
                               / (1 - list_sum([phi[i] * r[i] for i in range(1, k + 1)])) AS nxt FROM dl WHERE k < 36))
        SELECT 0 AS lag, 1.0::DOUBLE AS pacf, round(1.96 / sqrt((SELECT count(*) FROM e)), 6) AS band
        UNION ALL SELECT k, round(last, 6), round(1.96 / sqrt((SELECT count(*) FROM e)), 6) FROM dl""",
)
def pacf(spark, sf_dir):
    parts = series.seasonal_decompose(daily_orders(spark, sf_dir), "x", PERIOD)
    values = series.partial_autocorrelation(parts, "resid", 36)
    return values.select("lag", F.round("pacf", 6).alias("pacf"), F.round("band", 6).alias("band"))


@query("adf_test")
def adf_test(spark, sf_dir):
    """Unit-root test per order priority."""
    keys = ["o_orderpriority"]
    return stationarity.adf_test(daily_orders(spark, sf_dir, keys), "x", keys)


@query(
    "kpss_test",
    f"""WITH {_DAILY_SQL}, e AS (SELECT rn, x - (SELECT avg(x) FROM s) AS e, (SELECT count(*) FROM s) AS n FROM s),
        u AS (SELECT rn, e, n, sum(e) OVER (ORDER BY rn) AS cum, {", ".join(f"lag(e, {k}) OVER (ORDER BY rn) AS l{k}" for k in range(1, 11))} FROM e)
        SELECT max(n) AS n, 10 AS lags, round(sum(cum * cum) / max(n) /
          (sum(e * e) + 2 * ({" + ".join(f"{1 - k / 11} * sum(e * l{k})" for k in range(1, 11))})), 6) AS statistic FROM u""",
)
def kpss_test(spark, sf_dir):
    result = stationarity.kpss_test(daily_orders(spark, sf_dir), "x", lags=10)
    return result.select("n", "lags", F.round("statistic", 6).alias("statistic"))


_KEYED_DAILY_SQL = """d AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100000 AS x FROM orders GROUP BY 1, 2),
    c AS (SELECT p, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY p),
    s AS (SELECT c.p, row_number() OVER (PARTITION BY c.p ORDER BY c.day) - 1 AS rn, CAST(coalesce(x, 0) AS DOUBLE) AS x
          FROM c LEFT JOIN d ON c.p = d.p AND c.day = d.day)"""


@query(
    "kpss_auto",
    f"""WITH {_KEYED_DAILY_SQL},
        e AS (SELECT p, rn, x - avg(x) OVER (PARTITION BY p) AS e, count(*) OVER (PARTITION BY p) AS n FROM s),
        g AS (SELECT a.p, a.n, k.lag, sum(a.e * b.e) AS s FROM range(0, 80) AS k(lag)
              JOIN e a ON true JOIN e b ON a.p = b.p AND b.rn = a.rn - k.lag GROUP BY ALL),
        h AS (SELECT p, n, sum(CASE WHEN lag = 0 THEN s / n ELSE s / (n / 2) END) AS s0, sum(lag * s / (n / 2)) AS s1
              FROM g WHERE lag <= floor(pow(n, 2.0::DOUBLE / 9)) GROUP BY p, n),
        l AS (SELECT p, floor(1.1447 * pow(pow(s1 / s0, 2), 1.0::DOUBLE / 3) * pow(n, 1.0::DOUBLE / 3)) AS lags FROM h),
        v AS (SELECT g.p, n, lags, sum(s * CASE WHEN lag = 0 THEN 1 ELSE 2 * (1 - lag / (lags + 1)) END) AS lrv
              FROM g JOIN l ON g.p = l.p WHERE lag <= lags GROUP BY ALL),
        q AS (SELECT p, sum(cum * cum) AS ss FROM
              (SELECT p, sum(e) OVER (PARTITION BY p ORDER BY rn) AS cum FROM e) GROUP BY p),
        t AS (SELECT v.p, n, lags, ss / n / lrv AS st FROM v JOIN q ON v.p = q.p),
        w AS (SELECT *, CASE WHEN st <= 0.347 THEN 0.10 WHEN st <= 0.463 THEN 0.10 - (st - 0.347) / 0.116 * 0.05
                             WHEN st <= 0.574 THEN 0.05 - (st - 0.463) / 0.111 * 0.025
                             WHEN st <= 0.739 THEN 0.025 - (st - 0.574) / 0.165 * 0.015 ELSE 0.01 END AS pv FROM t)
        SELECT p AS o_orderpriority, n, CAST(lags AS INTEGER) AS lags, round(st, 6) AS statistic,
               round(CAST(pv AS DOUBLE), 6) AS p_value,
               CASE WHEN pv < 0.05 THEN 'non-stationary' ELSE 'stationary' END AS verdict FROM w""",
)
def kpss_auto(spark, sf_dir):
    """Stationarity test per order priority with the automatic bandwidth."""
    keys = ["o_orderpriority"]
    result = stationarity.kpss_test(daily_orders(spark, sf_dir, keys), "x", None, keys)
    return result.withColumns(
        {"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)}
    )


@query("stl_per_series")
def stl_per_series(spark, sf_dir):
    keys = ["o_orderpriority"]
    parts = stl.stl_decompose(daily_orders(spark, sf_dir, keys), "x", PERIOD, keys)
    return parts.select("o_orderpriority", "day", "x", "trend", "seasonal", "resid", "weight")


@query("stl_strength")
def stl_strength(spark, sf_dir):
    keys = ["o_orderpriority"]
    parts = stl.stl_decompose(daily_orders(spark, sf_dir, keys), "x", PERIOD, keys)
    return series.component_strength(parts, keys)


# ---------------------------------------------------------------- feature search

_Z_SQL = """zy AS (SELECT p.s, p.g, greatest(least(floor((round(z, 9) + 5) * 2.1), 20), 0) AS zb, yb FROM ({parts}) p
    WHERE z IS NOT NULL)"""


def _pair_sql(shorts, longs) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {s} AS s, {g} AS g, (m{s} - m{g}) / nullif(CASE WHEN d{g} > 1e-6 * (hi - lo) THEN d{g} END, 0) AS z, yb "
        f"FROM w WHERE rn >= {g - 1} AND yb IS NOT NULL"
        for g in longs for s in shorts if s < g
    )
    sizes = sorted({*shorts, *longs})
    means = ", ".join(f"avg(x) OVER (ORDER BY rn ROWS {k - 1} PRECEDING) AS m{k}" for k in sizes)
    devs = ", ".join(f"stddev_samp(x) OVER (ORDER BY rn ROWS {g - 1} PRECEDING) AS d{g}" for g in longs)
    return f"""WITH {_BUCKETS_SQL},
      cut AS (SELECT rn, value AS x FROM numbered WHERE rn <= floor(((SELECT count(*) FROM numbered) - 2) * 0.9::DOUBLE)),
      b AS (SELECT min(x) AS lo, max(x) AS hi FROM cut),
      e AS (SELECT [l[1 + i * len(l) // 16] for i in range(1, 16)] AS edges FROM (SELECT list(x ORDER BY x) AS l FROM cut)),
      n AS (SELECT rn, x, lo, hi, edges, lead(x) OVER (ORDER BY rn) AS nx FROM cut, b, e),
      y AS (SELECT rn, x, lo, hi, nx, len([v for v in edges if nx >= v]) AS yb0 FROM n),
      w AS (SELECT rn, lo, hi, CASE WHEN nx IS NOT NULL THEN yb0 END AS yb, {means}, {devs} FROM y),
      {_Z_SQL.format(parts=parts)},
      j AS (SELECT s, g, zb, yb, count(*) AS n FROM zy GROUP BY ALL),
      jx AS (SELECT s, g, zb, sum(n) AS nx FROM j GROUP BY ALL),
      jy AS (SELECT s, g, yb, sum(n) AS ny FROM j GROUP BY ALL),
      t AS (SELECT s, g, sum(n) AS nn FROM j GROUP BY ALL),
      mi AS (SELECT j.s, j.g, sum(n / nn * ln(n * nn / (nx * ny))) AS mi FROM j
             JOIN jx ON j.s = jx.s AND j.g = jx.g AND j.zb = jx.zb
             JOIN jy ON j.s = jy.s AND j.g = jy.g AND j.yb = jy.yb
             JOIN t ON j.s = t.s AND j.g = t.g GROUP BY j.s, j.g)"""


_MI_SHORTS, _MI_LONGS = range(1, 13), range(2, 13)


@query(
    "zscore_mutual_info",
    _pair_sql(_MI_SHORTS, _MI_LONGS)
    + " SELECT s AS short_window, g AS long_window, round(mi, 6) AS mutual_information FROM mi",
)
def zscore_mutual_info(spark, sf_dir):
    """Score of every window pair of the short horizon."""
    means = ordered.index_rows(five_minute_means(spark, sf_dir), ["event_type", "bucket"])
    train = means.filter(F.col("rn") <= int((means.count() - 2) * 0.9))
    scores = features.window_pair_scores(train, "value", _MI_SHORTS, _MI_LONGS)
    return scores.withColumn("mutual_information", F.round("mutual_information", 6))


@query(
    "best_window_pair",
    _pair_sql(_MI_SHORTS, _MI_LONGS)
    + """ SELECT s AS short_window, g AS long_window, round(mi, 6) AS mutual_information FROM mi
          ORDER BY round(mi, 9) DESC, s, g LIMIT 1""",
)
def best_window_pair(spark, sf_dir):
    means = ordered.index_rows(five_minute_means(spark, sf_dir), ["event_type", "bucket"])
    best = features.best_window_pair(means, "value", _MI_SHORTS, _MI_LONGS)
    return best.withColumn("mutual_information", F.round("mutual_information", 6))


@query("horizon_zscores")
def horizon_zscores(spark, sf_dir):
    """Best short, medium and long window pair of the full grid, each as a feature."""
    means = ordered.index_rows(five_minute_means(spark, sf_dir), ["event_type", "bucket"])
    return features.horizon_zscores(means, "value").drop("rn")


_KNN_SQL = f"""WITH {_BUCKETS_SQL},
  w AS (SELECT rn, value, lead(value) OVER (ORDER BY rn) AS nxt, count(*) OVER a AS n3, avg(value) OVER a AS m3,
               count(*) OVER b AS n12, avg(value) OVER b AS m12, stddev_samp(value) OVER b AS d12
        FROM numbered WINDOW a AS (ORDER BY rn ROWS 2 PRECEDING), b AS (ORDER BY rn ROWS 11 PRECEDING)),
  p AS (SELECT rn, round((m3 - m12) / d12, 6) AS x, round(nxt, 6) AS y FROM w WHERE n12 = 12 AND d12 > 0 AND nxt IS NOT NULL),
  t AS (SELECT count(*) AS n FROM p),
  d AS (SELECT a.rn, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy FROM p a JOIN p b ON a.rn <> b.rn),
  r AS (SELECT rn, min(greatest(dx, dy), 3)[3] AS r FROM d GROUP BY rn),
  c AS (SELECT rn, 1 + count(*) FILTER (dx < r OR dx = 0) AS nx, 1 + count(*) FILTER (dy < r OR dy = 0) AS ny FROM d JOIN r USING (rn) GROUP BY rn),
  h AS (SELECT i + 1 AS n, -0.57721566490153286 + coalesce(sum(CASE WHEN i > 0 THEN 1.0::DOUBLE / i END) OVER (ORDER BY i), 0) AS psi
        FROM range(0, (SELECT n FROM t) + 1) g(i))
  SELECT any_value(t.n) AS n, round(greatest(0, any_value(a.psi) + any_value(k.psi) - avg(hx.psi) - avg(hy.psi)), 6) AS mutual_information
  FROM c JOIN h hx ON hx.n = nx JOIN h hy ON hy.n = ny, t, h a, h k WHERE a.n = t.n AND k.n = 3"""


@query("knn_mutual_information", _KNN_SQL)
def knn_mutual_information(spark, sf_dir):
    """How much the z-score (3 rows against 12) tells about the next value, by nearest neighbours."""
    means = ordered.index_rows(five_minute_means(spark, sf_dir), ["event_type", "bucket"])
    rolled = series.rolling_statistics(means, "value", {"m3": 3, "m12": 12}, {"d12": 12})
    rows = series.lead_targets(rolled, ["value"], prefix="next_").filter("d12 > 0")
    pairs = rows.select(F.round((F.col("m3") - F.col("m12")) / F.col("d12"), 6).alias("x"), F.round("next_value", 6).alias("y"))
    found = neighbours.knn_mutual_information(pairs, "x", "y", k=3, scaled=False)
    return found.select("n", F.round("mutual_information", 6).alias("mutual_information"))
