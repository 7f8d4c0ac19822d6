"""Feature preparation, training and evaluation queries."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, MinMaxScaler, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidegauge.functions import scalar as S
from tidegauge.operators import boosting, features, forest, ml, ordered, relational, series
from tidegauge.plans.registry import query, table
from tidegauge.plans.relational import LOWER, R_COLUMNS, SENSOR_COUNT, SENSORS_SQL, UPPER, sensors
from tidegauge.session import materialise, spread

# ---------------------------------------------------------------- encoders and scalers

_INDEX_SQL = """idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS idx,
    count(*) OVER () AS labels FROM part GROUP BY p_brand)"""


@query(
    "string_index",
    f"WITH {_INDEX_SQL} SELECT p_partkey, part.p_brand, idx FROM part JOIN idx ON part.p_brand = idx.p_brand",
)
def string_index(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return ml.string_index(parts, "p_brand", "idx", handle_invalid="keep")


@query(
    "one_hot",
    f"""WITH {_INDEX_SQL} SELECT p_partkey, array_to_string([CAST(i = idx AS INTEGER) for i in range(labels - 1)], ',') AS encoded
        FROM part JOIN idx ON part.p_brand = idx.p_brand""",
)
def one_hot(spark, sf_dir):
    parts = ml.string_index(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "idx")
    encoder = OneHotEncoder(inputCol="idx", outputCol="vec", dropLast=True)
    flags = vector_to_array("vec").cast("array<int>").cast("array<string>")
    return encoder.fit(parts).transform(parts).select(
        "p_partkey", F.array_join(flags, ",").alias("encoded")
    )


@query(
    "impute_mean",
    """SELECT c_custkey, round(coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END,
         (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal >= 0)), 6) AS c_acctbal FROM customer""",
)
def impute_mean(spark, sf_dir):
    """Negative balances read as missing and filled with the mean."""
    balance = F.col("c_acctbal")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(balance >= 0, balance).alias("c_acctbal")
    )
    filled = Imputer(inputCols=["c_acctbal"], outputCols=["c_acctbal"]).fit(customers)
    return filled.transform(customers).select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


_LINE = ["l_quantity", "l_extendedprice", "l_discount"]


def _assembled(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_LINE)
    return VectorAssembler(inputCols=_LINE, outputCol="raw").transform(lines)


def _scaled_columns(df):
    values = vector_to_array("scaled")
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[F.round(values[i], 6).alias(c) for i, c in enumerate(_LINE)],
    )


@query(
    "minmax_features",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in _LINE)
    + " FROM lineitem",
)
def minmax_features(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    return _scaled_columns(MinMaxScaler(inputCol="raw", outputCol="scaled").fit(rows).transform(rows))


@query(
    "standard_scale",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(f"round({c} / (SELECT stddev_samp({c}) FROM lineitem), 6) AS {c}" for c in _LINE)
    + " FROM lineitem",
)
def standard_scale(spark, sf_dir):
    rows = _assembled(spark, sf_dir)
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withStd=True, withMean=False)
    return _scaled_columns(scaler.fit(rows).transform(rows))


@query(
    "minmax_inverse",
    f"""WITH {SENSORS_SQL}, p AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS rn, count(*) OVER () AS n FROM sensors),
        b AS (SELECT min(R1) AS lo, max(R1) AS hi FROM p WHERE rn < floor(n * 0.7::DOUBLE))
        SELECT vec_id, round((R1 - lo) / (hi - lo), 6) AS scaled, round(R1, 6) AS restored FROM p, b""",
)
def minmax_inverse(spark, sf_dir):
    """Scale by the extremes of the training rows only, then undo it."""
    rows = ordered.index_rows(sensors(spark, sf_dir).select("vec_id", "R1"), ["vec_id"])
    split = ordered.positional_split(rows, rows.count())
    bounds = split.filter("split = 'train'").agg(
        F.struct(F.min("R1").alias("lo"), F.max("R1").alias("hi"))
    ).scalar()
    low, high = bounds.getField("lo"), bounds.getField("hi")
    scaled = S.min_max(F.col("R1"), low, high)
    return split.select(
        "vec_id", F.round(scaled, 6).alias("scaled"),
        F.round(S.min_max_inverse(scaled, low, high), 6).alias("restored"),
    )


@query(
    "hash_split",
    """SELECT o_orderkey, CAST('0x' || substr(md5(o_orderkey || '|42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.7 AS is_train
       FROM orders""",
)
def hash_split(spark, sf_dir):
    return ml.hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"]).select("o_orderkey", "is_train")


@query("random_split")
def random_split(spark, sf_dir):
    train, test = ml.random_split(table(spark, sf_dir, "orders").select("o_orderkey"))
    return train.withColumn("part", F.lit("train")).unionAll(test.withColumn("part", F.lit("test")))


# ---------------------------------------------------------------- regression


@query(
    "linear_regression",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT round(b, 4) AS slope, round(a, 4) AS intercept,
              round((SELECT sqrt(avg(pow(l_extendedprice - a - b * l_quantity, 2))) FROM lineitem), 4) AS rmse FROM f""",
)
def linear_regression(spark, sf_dir):
    lines = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    )
    model = LinearRegression(labelCol="l_extendedprice", solver="normal").fit(lines)
    evaluator = ml.RegressionEvaluator(labelCol="l_extendedprice", metricName="rmse")
    rmse = evaluator.evaluate(model.transform(lines))
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(model.intercept, 4), round(rmse, 4))],
        "slope double, intercept double, rmse double",
    )


_MEANS = ["lower_mean", "upper_mean"]
# Files of wide rows are small beside the long rows they become.
MELTED_ROWS_PER_TASK = 250_000


def long_sensors(spark, sf_dir, count=SENSOR_COUNT):
    """Melted log-scale sensors with their next reading and derived context columns.

    Context: the label, its change and its high or low state, the mean of all sensors and
    of both halves, and the z-scores of both halves over the best window pair of each
    horizon.  ``count`` sensors are melted; the context always comes from all of them.
    """
    logged = sensors(spark, sf_dir).select("vec_id", "label", *[F.log1p(c).alias(c) for c in R_COLUMNS])
    means = {"all_mean": R_COLUMNS, "lower_mean": LOWER, "upper_mean": UPPER}
    rows = materialise(
        ordered.index_rows(logged.withColumns({n: S.row_mean([F.col(c) for c in cs]) for n, cs in means.items()}), ["vec_id"]),
        "sensors",
    )
    middle = rows.agg((F.min("label") + F.max("label")) / 2).first()[0]
    stepped = series.shift_difference(rows, "label", "label_step").withColumns(
        {"label_step": F.coalesce("label_step", F.lit(0)), "label_state": F.when(F.col("label") > F.lit(middle), 1).otherwise(0)}
    )
    scored = features.horizon_zscores(materialise(stepped, "context"), _MEANS)
    led = materialise(series.lead_targets(scored, R_COLUMNS[:count]), "features")
    led = spread(led, count * led.count(), MELTED_ROWS_PER_TASK, "rn")
    groups = {str(i): (f"Target_R{i}", f"R{i}") for i in range(1, count + 1)}
    melted = relational.melt_pairs(led, ["vec_id", *_CONTEXT], groups, "Sensor_ID", ["Target_R", "R"])
    indexed = ml.string_index(melted, "Sensor_ID", "sensor_code")
    return ordered.chronological_split(indexed, "vec_id")


_CONTEXT = ["label", "label_step", "label_state", "all_mean", *_MEANS, *[f"{c}_{h}_zscore" for c in _MEANS for h in features.HORIZONS]]
_FEATURES = ["R", "sensor_code", *_CONTEXT]


@query(
    "error_metrics_per_group",
    f"""WITH {SENSORS_SQL}, l AS (SELECT vec_id, unnest([{", ".join(f"'{i}'" for i in range(1, SENSOR_COUNT + 1))}]) AS sid,
          unnest([{", ".join(R_COLUMNS)}]) AS p,
          unnest([{", ".join(f"lead({c}) OVER (ORDER BY vec_id)" for c in R_COLUMNS)}]) AS y FROM sensors),
        e AS (SELECT sid, y, y - p AS e FROM l WHERE y IS NOT NULL)
        SELECT 'Sensor_R' || sid AS "Sensor_ID", round(avg(abs(e / nullif(y, 0))) * 100, 4) AS "MAPE",
               round(avg(abs(e)), 4) AS "MAE", round(sqrt(avg(e * e)), 4) AS "RMSE",
               round(1 - avg(e * e) / var_pop(y), 4) AS "R2", round(avg(e), 4) AS "Mean_Error",
               round(stddev_pop(e), 4) AS "Std_Error" FROM e GROUP BY sid""",
)
def error_metrics_per_group(spark, sf_dir):
    """Errors of the forecast "next reading equals this one", computed in log scale and undone."""
    logged = sensors(spark, sf_dir).select("vec_id", *[F.log1p(c).alias(c) for c in R_COLUMNS])
    led = series.lead_targets(ordered.index_rows(logged, ["vec_id"]), R_COLUMNS)
    groups = {str(i): (f"Target_R{i}", f"R{i}") for i in range(1, SENSOR_COUNT + 1)}
    melted = relational.melt_pairs(led, ["vec_id"], groups, "Sensor_ID", ["Target_R", "R"])
    return ml.sensor_errors(melted, "Sensor_ID", "Target_R", "R")


@query("holdout_search")
def holdout_search(spark, sf_dir):
    """Linear regression: best of the penalty grid, error metrics per sensor."""
    model = LinearRegression(featuresCol="features", labelCol="Target_R")
    return ml.train_sensor_model(
        long_sensors(spark, sf_dir), model, ml.linear_grid(model), _FEATURES, "Target_R", "Sensor_ID"
    )


def sensor_forest(spark, sf_dir, trees=forest.TREES, depth=forest.DEPTH):
    """Error metrics per sensor, for all sensors, of a forest grown on the training rows."""
    split = long_sensors(spark, sf_dir)
    grown = forest.grow_forest(split.filter("split = 'train'"), _FEATURES, "Target_R", trees, depth)
    predicted = forest.predict(grown, split.filter("split = 'test'").select("Sensor_ID", "Target_R", *_FEATURES))
    return ml.sensor_errors(predicted, "Sensor_ID", "Target_R")


@query("rf_regression")
def rf_regression(spark, sf_dir):
    """Random forest of 200 trees of depth 20 over all sensors; its one setting needs no search."""
    return sensor_forest(spark, sf_dir)


def lookback_frame(spark, sf_dir):
    """Thirty-row windows of all sensors with their next readings, split by position."""
    logged = sensors(spark, sf_dir).select("vec_id", *[F.log1p(c).alias(c) for c in R_COLUMNS])
    led = series.lead_targets(ordered.index_rows(logged, ["vec_id"]), R_COLUMNS)
    windows = series.lookback_windows(led, R_COLUMNS, 30)
    renumbered = windows.withColumn("rn", F.col("rn") - 30)
    # as many windows as there are of a single column, which are counted without the others
    return ordered.positional_split(renumbered, series.lookback_windows(led.select("rn"), ["rn"], 30).count())


@query("lookback_forecast")
def lookback_forecast(spark, sf_dir):
    """Ridge regression on thirty-row windows, error metrics per sensor."""
    long = ml.lookback_forecast(lookback_frame(spark, sf_dir), [f"Target_{c}" for c in R_COLUMNS])
    return ml.sensor_errors(long, "Sensor_ID", "truth")


@query("boosted_forecast")
def boosted_forecast(spark, sf_dir):
    """Gradient-boosted trees on thirty-row windows, error metrics per sensor."""
    long = boosting.boosted_forecast(lookback_frame(spark, sf_dir), [f"Target_{c}" for c in R_COLUMNS])
    return ml.sensor_errors(long, "Sensor_ID", "truth")


# ---------------------------------------------------------------- classification

_NUMERIC, _CATEGORICAL = ["n_chars", "toxic"], ["lang", "source"]


def labelled_documents(spark, sf_dir):
    n = F.col("n_chars").cast("double")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.when(n > 10, n).alias("n_chars")
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"), "toxic")
    return ml.hash_split(documents.join(labels, "doc_id"), ["doc_id"])


def _stages():
    return ml.feature_stages(_NUMERIC, _CATEGORICAL, ["n_chars"])


def _classified(spark, sf_dir, model):
    rows = labelled_documents(spark, sf_dir)
    train, test = rows.filter("is_train").persist(), rows.filter("not is_train")
    fitted = ml.Pipeline(stages=[*_stages(), model]).fit(train)
    scored = fitted.transform(test)
    auc = ml.auc_evaluator("quality").evaluate(scored)
    train.unpersist()
    return scored.groupBy("prediction", "quality").agg(F.count("*").alias("rows")).withColumn(
        "auc", F.lit(round(auc, 6))
    )


@query("logistic_quality")
def logistic_quality(spark, sf_dir):
    return _classified(spark, sf_dir, ml.logistic_regression("quality"))


@query("tree_quality")
def tree_quality(spark, sf_dir):
    return _classified(spark, sf_dir, ml.decision_tree("quality"))


@query("cv_grid")
def cv_grid(spark, sf_dir):
    """Five-fold search of both learners over 27 settings each."""
    rows = labelled_documents(spark, sf_dir)
    train, test = rows.filter("is_train").persist(), rows.filter("not is_train").persist()
    evaluator = ml.auc_evaluator("quality")
    lr = LogisticRegression(featuresCol="features", labelCol="quality", family="binomial")
    dt = DecisionTreeClassifier(
        featuresCol="features", labelCol="quality", maxBins=32, impurity="gini", seed=42
    )
    results = []
    for model, grid in ((lr, ml.logistic_grid(lr)), (dt, ml.tree_grid(dt))):
        fitted, chosen, _ = ml.cross_validate(_stages(), model, grid, train, evaluator, ["doc_id"])
        settings = ", ".join(f"{p.name}={v:g}" for p, v in sorted(chosen.items(), key=lambda x: x[0].name))
        results.append((type(model).__name__, settings, evaluator.evaluate(fitted.transform(test))))
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame(results, "model string, settings string, auc double")


@query(
    "auc_rank",
    """WITH r AS (SELECT l_returnflag = 'R' AS pos, rank() OVER (ORDER BY l_extendedprice)
                   + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS mean_rank FROM lineitem),
       n AS (SELECT count(*) FILTER (WHERE pos) AS p, count(*) FILTER (WHERE NOT pos) AS q FROM r)
       SELECT round((sum(mean_rank) FILTER (WHERE pos) - max(p) * (max(p) + 1) / 2.0::DOUBLE) / (max(p) * max(q)), 6) AS auc FROM r, n""",
)
def auc_rank(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return ml.area_under_roc(lines, "l_extendedprice", "label").select(F.round("auc", 6).alias("auc"))


# ---------------------------------------------------------------- clustering


def _clustered(spark, sf_dir):
    return ml.scaled_clusters(sensors(spark, sf_dir), R_COLUMNS)


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    return _clustered(spark, sf_dir).groupBy("cluster", "label").agg(F.count("*").alias("rows"))


@query("silhouette")
def silhouette(spark, sf_dir):
    score = ml.silhouette(_clustered(spark, sf_dir))
    return spark.createDataFrame([(score,)], "silhouette double")


@query(
    "silhouette_by_label",
    """WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
       q AS (SELECT *, list_inner_product(x, x) AS sq FROM p),
       m AS (SELECT label, list(y ORDER BY i) AS y FROM (
                 SELECT label, i, sum(v) AS y FROM (SELECT label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM p) GROUP BY ALL)
             GROUP BY label),
       c AS (SELECT label, count(*) AS n, sum(sq) AS psi FROM q GROUP BY label),
       d AS (SELECT vec_id, q.label = c.label AS own, n, sq + psi / n - 2 * list_inner_product(x, y) / n AS d
             FROM q, c JOIN m USING (label)),
       s AS (SELECT vec_id, max(n) FILTER (own) AS n, max(d * n / nullif(n - 1, 0)) FILTER (own) AS a, min(d) FILTER (NOT own) AS b
             FROM d GROUP BY vec_id)
       SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""",
)
def silhouette_by_label(spark, sf_dir):
    """Silhouette of the given labels as clusters, on all components."""
    points = table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").alias("cluster")
    )
    return spark.createDataFrame([(round(ml.silhouette(points), 6),)], "silhouette double")


@query("pca_2d")
def pca_2d(spark, sf_dir):
    points = ml.principal_components(_clustered(spark, sf_dir), 2)
    values = vector_to_array("components")
    return points.select("vec_id", "cluster", values[0].alias("pc1"), values[1].alias("pc2"))
