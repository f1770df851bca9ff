import pytest
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators import validate
from foresight.operators.split import sample_rows, scale_columns_in_window, split_by_time
from foresight.plans.features import build_features
from tests.fixtures import plant_pandas, frame


@pytest.fixture(scope="module")
def clean(spark):
    t = plant_pandas(nulls=0.0, repeats=0, gaps=0.0, hours=200, on_the_hour=True)
    for s, (lo, hi) in S.HARD_BOUNDS.items():
        t["telemetry"][s] = t["telemetry"][s].clip(lo, hi)
    return {k: frame(spark, k, v) for k, v in t.items()}


def issues(tables):
    found = validate.validate_tables(tables, S.raw_contract(machine_ids=S.MACHINE_ID_RANGE))
    return {(r["table"], r["column"], r["check"]): (r["count"], list(r["examples"])) for r in found.collect()}


def first(n):
    return F.col("seq") < n


CASES = {
    "wrong_type": (lambda t: t.withColumn("volt", F.when(first(10), "sensor_error").otherwise(F.col("volt").cast("string"))),
                   {("telemetry", "volt", "dtype('double')"): 10}),
    "negative_vibration": (lambda t: t.withColumn("vibration", F.when(first(25), -5.0).otherwise(F.col("vibration"))),
                           {("telemetry", "vibration", "in_range(0, 150)"): 25}),
    "out_of_range_rotate": (lambda t: t.withColumn("rotate", F.when(first(10), 5000.0).otherwise(F.col("rotate"))),
                            {("telemetry", "rotate", "in_range(0, 1000)"): 10}),
    "too_many_nulls": (lambda t: t.withColumn("pressure", F.when(F.col("seq") % 10 != 0, F.col("pressure"))),
                       {("telemetry", "pressure", "sensor null fraction > 5%"): 1}),
    "duplicate_rows": (lambda t: t.unionByName(t.where(first(50))),
                       {("telemetry", "machineID", "multiple_fields_uniqueness"): 100,
                        ("telemetry", "datetime", "multiple_fields_uniqueness"): 100}),
    "unknown_machine": (lambda t: t.withColumn("machineID", F.when(first(5), F.lit(999)).otherwise(F.col("machineID"))),
                        {("telemetry", "machineID", "in_range(1, 100)"): 5,
                         ("telemetry", "machineID", "unknown machine (not in machines table)"): 1}),
    "missing_column": (lambda t: t.drop("vibration"), {("telemetry", "vibration", "column missing"): 1}),
}


def test_clean_tables_pass(clean):
    assert issues(clean) == {}
    validate.validate_or_raise(clean)


@pytest.mark.parametrize("case", CASES)
def test_corruptions_are_found(clean, case):
    change, want = CASES[case]
    found = issues({**clean, "telemetry": change(clean["telemetry"])})
    assert {k: v[0] for k, v in found.items()} == want
    assert all(len(v[1]) <= 5 for v in found.values())


def test_missing_table_and_stop_the_line(clean, tmp_path):
    rest = {k: v for k, v in clean.items() if k != "errors"}
    assert ("errors", None, "table missing") in issues(rest)
    with pytest.raises(validate.DataValidationError):
        validate.validate_or_raise(rest, report_dir=str(tmp_path / "report"))
    assert (tmp_path / "report").exists()


def test_feature_contract(spark, small_plant):
    numeric, _ = S.feature_columns()
    df = build_features(small_plant)
    assert validate.validate_features(df, numeric).count() == 0
    bad = df.withColumn("age", F.lit(float("nan"))).withColumn("model", F.lit("model9"))
    assert {r["column"] for r in validate.validate_features(bad, numeric).collect()} == {"age", "model"}


def test_split_and_sample(clean):
    tel = clean["telemetry"]
    ranges = {"train": ("2015-01-01", "2015-01-03"), "val": ("2015-01-03", "2015-01-05"), "test": ("2015-01-05", "2015-01-09")}
    parts = split_by_time(tel, ranges)
    assert [p.count() for p in parts.values()] == [4 * 48, 4 * 48, 4 * 96]
    with pytest.raises(ValueError, match="empty"):
        split_by_time(tel, {**ranges, "val": ("2030-01-01", "2030-02-01")})
    with pytest.raises(ValueError, match="overlap"):
        split_by_time(tel, {**ranges, "val": ("2015-01-02", "2015-01-05")})
    one = sample_rows(tel, 100).collect()
    two = sample_rows(tel.repartition(5, "volt"), 100).collect()
    assert len(one) == 100 and sorted(r["seq"] for r in one) == sorted(r["seq"] for r in two)
    assert sample_rows(tel, 10 ** 6).count() == tel.count()
    up = scale_columns_in_window(tel, {"volt": 1.1}, "2015-01-03", "2015-01-04")
    changed = up.join(tel.select("seq", F.col("volt").alias("v")), "seq").where("abs(volt - v * 1.1) < 1e-9")
    assert changed.count() == 4 * 48


def test_violations_are_made_once_for_counts_and_examples(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return None if x % 4 == 0 else f"v{x % 4}"

    found = spark.range(0, 40, 1, 2).select(
        F.lit("t").alias("table"), F.concat(F.lit("c"), F.col("id") % 2).alias("column"), F.lit("k").alias("check"), counted("id").alias("value"))
    long = found.groupBy("table", "column", "check", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["column"]: (r["count"], r["examples"]) for r in validate.issue_summary(long).collect()}
    assert rows == {"c0": (20, ["v2"]), "c1": (20, ["v1", "v3"])} and seen.value == 40
