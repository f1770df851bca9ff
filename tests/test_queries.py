from pyspark.sql import functions as F

from checks import queries
from foresight.schema import LABEL

SMALL = "/root/testdata/sf0.001"


def test_log_without_feedback_holds_every_prediction(spark, monkeypatch):
    """40 scored machines: none is left out of the log."""
    scores = spark.range(40).selectExpr(
        "id AS machineID", "timestamp_ntz '2024-01-30 23:00:00' AS datetime", "id / 40 AS failure_probability",
        f"CAST(id >= 20 AS INT) AS {LABEL}", "0.5D AS threshold", "'7' AS model_version",
        *[f"0D AS {c}" for c in queries.NUMERIC], "'model1' AS model")
    monkeypatch.setattr(queries, "latest_scores", lambda *_: scores)
    got = queries.log_without_feedback(spark, SMALL).collect()
    assert sorted(r["machine_id"] for r in got) == list(range(40)) and all(r[LABEL] is None for r in got)


def test_rule_scored_builds_the_features_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    made = spark.range(50).select(
        F.col("id").alias("machineID"), F.lit("2024-01-01").cast("timestamp_ntz").alias("datetime"), F.lit("model1").alias("model"),
        F.lit(0).alias(LABEL), counted("id").alias(queries.RULE_FEATURE))
    monkeypatch.setattr(queries.feat, "build_training_table", lambda *_: made)
    p = [r["p"] for r in queries.rule_scored(spark, SMALL).orderBy("machineID").collect()]
    assert p == [round(i / 49, 6) for i in range(50)] and seen.value == 50
