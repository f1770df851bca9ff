import datetime as dt

import pytest
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators import validate
from foresight.schema import PlantTables
from foresight.sources import stages
from tests.fixtures import SCHEMAS, frame, plant_pandas

CONTRACT = S.raw_contract(machine_ids=S.MACHINE_ID_RANGE)


@pytest.fixture(scope="module")
def broken(spark):
    t = {k: frame(spark, k, v) for k, v in plant_pandas(hours=100, on_the_hour=True).items()}
    early = lambda n: F.col("seq") < n
    tel = t["telemetry"].select(
        F.when(F.col("seq") == 3, F.lit(None)).otherwise(F.col("datetime")).alias("datetime"),
        F.when(early(5), 999).otherwise(F.col("machineID")).alias("machineID"), "seq",
        F.when(early(10), "sensor_error").otherwise(F.col("volt").cast("string")).alias("volt"), "rotate", "pressure",
        F.when(early(25), -5.0).otherwise(F.col("vibration")).alias("vibration"))
    machines = t["machines"].withColumns({"age": F.lit(31), "model": F.when(F.col("machineID") != 2, F.col("model"))})
    return {"telemetry": tel, "errors": t["errors"].withColumn("errorID", F.lit("error7")), "maint": t["maint"].drop("comp"),
            "machines": machines.unionByName(machines)}


def rows(df):
    return sorted((r["table"], r["column"] or "", r["check"], r["count"], list(r["examples"])) for r in df.collect())


def test_issues_of_the_write_are_those_of_the_tables(broken, tmp_path):
    want = rows(validate.validate_tables(broken, CONTRACT))
    stored, issues = stages.stage_plant(broken, str(tmp_path), CONTRACT)
    assert rows(issues) == want
    checks = {r[2].split("(")[0] for r in want}
    assert checks >= {"dtype", "not_nullable", "in_range", "isin", "multiple_fields_uniqueness", "field_uniqueness", "column missing",
                      "table missing", "unknown machine ", "sensor null fraction > 5%"}
    for name, df in broken.items():
        assert stored[name].select(df.columns).exceptAll(df).isEmpty() and df.exceptAll(stored[name].select(df.columns)).isEmpty()


def test_the_source_is_read_once_even_with_issues(spark, broken, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    source = broken["telemetry"].drop("datetime").withColumn("datetime", F.lit(dt.datetime(2015, 1, 1)).cast("timestamp_ntz"))
    n = source.count()
    df = source.mapInPandas(counted, source.schema)
    _, issues = stages.stage_table(df, str(tmp_path / "t"), "telemetry", CONTRACT["telemetry"])
    assert len(issues.collect()) >= 4 and seen.value == n


def test_clean_and_empty_tables_have_no_issues(spark, tmp_path):
    empty = {k: spark.createDataFrame([], s) for k, s in SCHEMAS.items()}
    stored, issues = stages.stage_plant(empty, str(tmp_path / "empty"), CONTRACT)
    assert issues.collect() == [] and all(df.isEmpty() for df in stored.values())
    # columns named like counts, and a table of nulls in what may be null
    one = spark.createDataFrame([(dt.datetime(2015, 1, 1), 1, None, None, None, None, 7, "x")],
                                "datetime timestamp_ntz, machineID bigint, volt double, rotate double, pressure double, vibration double, r0 int, rows string")
    stored, issues = stages.stage_table(one, str(tmp_path / "one"), "telemetry", CONTRACT["telemetry"])
    assert {r["check"] for r in issues.collect()} == {"sensor null fraction > 5%"}
    assert stored.select("r0", "rows").first()[:] == (7, "x")


def test_the_line_stops_after_the_report(spark, broken, tmp_path):
    with pytest.raises(validate.DataValidationError) as error:
        stages.stage_or_raise(broken, str(tmp_path), CONTRACT)
    written = spark.read.parquet(str(tmp_path / "issues"))
    assert len(error.value.issues) == written.count() > 8
    pdf = plant_pandas(nulls=0.0, repeats=0, gaps=0.0, hours=60, on_the_hour=True)
    for s, (lo, hi) in S.HARD_BOUNDS.items():
        pdf["telemetry"][s] = pdf["telemetry"][s].clip(lo, hi)
    good = PlantTables(**{k: frame(spark, k, v) for k, v in pdf.items()})
    stored = stages.stage_or_raise(good, str(tmp_path / "good"), CONTRACT)
    assert set(stored) == set(SCHEMAS) and spark.read.parquet(str(tmp_path / "good" / "issues")).isEmpty()
    assert "date" in stored["telemetry"].columns
