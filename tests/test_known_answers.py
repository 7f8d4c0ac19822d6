"""Small inputs with results worked out by hand."""

from pyspark.sql import functions as F

from tidegauge.functions import scalar as S
from tidegauge.operators import relational as R
from tidegauge.operators import joins, reports, text
from tidegauge.sources import readers, sinks


def purchases(spark):
    return spark.createDataFrame([("u1", 100), ("u2", 150), ("u1", 200), ("u3", 50)], "k string, v int")


def users(spark):
    return spark.createDataFrame([("u1", "Alice"), ("u2", "Bob"), ("u4", "Eve")], "k string, n string")


def test_joins_and_cogroup(spark):
    assert R.key_join(users(spark), purchases(spark), ["k"]).count() == 3
    left = R.key_join(users(spark), purchases(spark), ["k"], "left")
    assert left.count() == 4 and left.filter("v is null").first()["k"] == "u4"
    both = {r["k"]: (r["left_values"], r["right_values"])
            for r in R.cogroup_lists(users(spark), purchases(spark), "k", "n", "v").collect()}
    assert both == {"u1": (["Alice"], [100, 200]), "u2": (["Bob"], [150]), "u3": ([], [50]), "u4": (["Eve"], [])}


def test_grouped_values_are_paged(spark):
    many = spark.range(25).select(F.lit("hot").alias("k"), F.col("id").alias("v")).unionAll(
        spark.createDataFrame([("cold", 7)], "k string, v long"))
    rows = R.grouped_values(many, "k", "v", page=10).collect()
    hot = sorted((r["page"], r["values"]) for r in rows if r["k"] == "hot")
    assert [p for p, _ in hot] == [0, 1, 2]
    assert sum((v for _, v in hot), []) == list(range(25))


def test_multisets(spark):
    def bag(*values):
        return spark.createDataFrame([(v,) for v in values], "line string")

    def listed(df):
        return sorted(r[0] for r in df.collect())

    assert listed(R.intersection(bag("1", "1", "2", "3", "3"), bag("1", "1", "3"))) == ["1", "3"]
    assert listed(R.bag_subtract(bag("1", "1", "2", "2", "3"), bag("1", "3"))) == ["2", "2"]
    assert R.bag_union(bag("1", "1"), bag("1")).count() == 3
    with_null = spark.createDataFrame([(None,), ("a",)], "line string")
    assert listed(R.bag_subtract(with_null, spark.createDataFrame([(None,)], "line string"))) == ["a"]


def test_sums(spark):
    numbers = spark.createDataFrame([(i,) for i in (3, 1, 4, 1, 5, 9, 2, 6, 5)], "v int")
    assert tuple(R.sum_and_count(numbers, F.col("v")).first()) == (36, 9)
    assert tuple(R.sum_and_count(numbers.filter("v > 99"), F.col("v")).first()) == (0, 0)


def test_scalars(spark):
    row = spark.range(1).select(
        S.great_circle_km(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0)).alias("same"),
        S.great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        S.divider_resistance(F.lit(0.0)).alias("zero"),
        S.divider_resistance(F.lit(2.5)).alias("middle"),
        S.min_max(F.lit(3.0), F.lit(3.0), F.lit(3.0)).alias("flat"),
        S.row_mean([F.lit(1.0), F.lit(None).cast("double"), F.lit(3.0)]).alias("mean"),
        S.row_mean([F.lit(None).cast("double")]).alias("none"),
        S.decimal_comma(F.lit(1.23456)).alias("comma"),
        F.size(S.space_fields(F.lit("a  b "))).alias("fields"),
        S.words(F.lit("\ta  b c\n")).alias("words"),
    ).first()
    assert row["same"] < 1e-3 and abs(row["half"] - 6371 * 3.141592653589793) < 1e-6
    assert row["zero"] is None and row["middle"] == 1_000_000
    assert row["flat"] == 0.0 and row["mean"] == 2.0 and row["none"] is None
    assert row["comma"] == "1,2346" and row["fields"] == 4 and row["words"] == ["a", "b", "c"]


def test_malformed_lines_need_three_fields(spark):
    lines = spark.createDataFrame([("a b c",), ("a b",), ("",), ("a b c d",)], "value string")
    assert tuple(text.malformed_lines(lines, "value").first()) == (2, 4)


def test_report_sql_equals_dsl(spark, sf_dir):
    from tidegauge.plans.relational import rides

    rows = rides(spark, sf_dir)
    assert reports.RIDES.frame(rows).exceptAll(reports.RIDES.from_text(rows, "twin")).isEmpty()
    totals = reports.group_totals(rows, "company", "riders", "total")
    assert totals.collect() == reports.group_totals_sql(rows, "company", "riders", "total", "twin").collect()


def test_sensor_csv_and_locale_sink(spark, tmp_path):
    header = ",".join(readers.SENSOR_SCHEMA.names)
    for run in ("a", "b"):
        (tmp_path / f"{run}.csv").write_text(header + "\n" + ",".join(["1.5"] * 20) + "\n")
    runs = readers.read_sensor_runs(spark, f"{tmp_path}/*.csv")
    assert runs.count() == 2 and runs.select("source_file").distinct().count() == 2
    assert len(readers.rename_by_position(runs, [f"c{i}" for i in range(21)]).columns) == 21
    out = str(tmp_path / "out")
    metrics = spark.createDataFrame([("Sensor_R1", 8.20241)], "Sensor_ID string, MAPE double")
    sinks.write_locale_csv(metrics.coalesce(1), out)
    assert [r[0] for r in spark.read.text(out).collect()] == ["Sensor_ID;MAPE", "Sensor_R1;8,2024"]
    (tmp_path / "words.txt").write_text("the \nand\nthe\n")
    assert readers.read_word_list(spark, str(tmp_path / "words.txt")).count() == 2
    assert readers.read_whole_texts(spark, str(tmp_path / "words.txt")).first()[0] == "the \nand\nthe\n"
    (tmp_path / "pairs.tsv").write_text("Go.\tVa !\n")
    assert tuple(readers.read_pairs(spark, str(tmp_path / "pairs.tsv"), ["en", "fr"]).first()) == ("Go.", "Va !")


def test_error_metrics(spark):
    rows = [("2", 1.0, 2.0), ("2", 3.0, 3.0), ("10", 0.0, 1.0), ("10", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "id string, y double, p double")
    got = R.error_metrics(df, "id", "y", "p").collect()
    assert [r["Sensor_ID"] for r in got] == ["Sensor_R2", "Sensor_R10"]
    first = got[0]
    assert (first["MAE"], first["MAPE"], first["R2"], first["Mean_Error"], first["Std_Error"]) == (0.5, 50.0, 0.5, -0.5, 0.5)


def test_subtract_moves_rows_once_and_writes_none(spark, monkeypatch):
    rows = [(i % 7 or None, f"x{i % 5}" if i % 3 else None) for i in range(200)] + [(9, "hot")] * 50 + [(8, "hot too")] * 40
    left = spark.createDataFrame(rows, "a int, b string")
    gone = {(9, "hot"), (1, None), (None, None), (2, "x1")}
    right = spark.createDataFrame([*gone, *gone, (77, "other")], "a int, b string")
    want = sorted((r for r in rows if r not in gone), key=str)
    for per_salt, per_task in ((30, 500_000), (10**6, 10), (10**6, 500_000)):
        monkeypatch.setattr(joins, "ROWS_PER_TASK", per_task)
        written = []
        monkeypatch.setattr(joins, "materialise", lambda df, label="table": (written.append(label), df.localCheckpoint())[1])
        got = R.bag_subtract(left, right, per_salt)
        assert got.columns == ["a", "b"] and sorted((tuple(r) for r in got.collect()), key=str) == want
        assert set(written) <= {"hot", "hot-keys"}
