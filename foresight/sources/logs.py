"""Append-only prediction and feedback logs as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.schema import LABEL

_FEATURES = ", ".join([f"{c}: double" for c in S.feature_columns()[0]] + ["model: string"])
SCHEMAS = {
    "predictions": (
        "logged_at string, request_id string, machine_id bigint, as_of timestamp_ntz, failure_probability double, "
        f"will_fail_24h boolean, threshold double, model_version string, latency_ms double, features struct<{_FEATURES}>"
    ),
    "feedback": "logged_at string, request_id string, actual_failure boolean",
}


def read_log(spark: SparkSession, folder: str, kind: str, schema: str | None = None) -> DataFrame:
    """Union of all `kind*` files or folders; cut-off lines are skipped."""
    reader = spark.read.schema(schema or SCHEMAS[kind]).option("mode", "DROPMALFORMED")
    return reader.json(f"{folder}/{kind}*")


def count_corrupt(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """One row: lines read and lines that are no valid record."""
    schema = f"{SCHEMAS[kind]}, _corrupt_record string"
    df = spark.read.schema(schema).json(f"{folder}/{kind}*")
    return df.agg(F.count("request_id").alias("n_good"), F.count("_corrupt_record").alias("n_corrupt"))


def stream_log(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS[kind]).option("mode", "DROPMALFORMED")
    return reader.json(f"{folder}/{kind}*")


def append_log(df: DataFrame, folder: str, kind: str) -> None:
    """Add rows to a log; every task writes its own file, so writers never interleave."""
    df.write.mode("append").json(f"{folder}/{kind}")


def prediction_records(scored: DataFrame, latency_ms: float | None = None) -> DataFrame:
    """Log rows of scored feature rows (needs failure_probability, will_fail_24h, threshold, model_version).

    The request's own id is logged, so that feedback finds it. Without one it is a hash of machine, time and model version, so a repeated run logs the same ids.
    """
    numeric, categorical = S.feature_columns()
    request_id = F.md5(F.concat_ws("|", F.col(S.KEY).cast("string"), F.col(S.TS).cast("string"), "model_version"))
    if "request_id" in scored.columns:
        request_id = F.col("request_id")
    return scored.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("logged_at"),
        request_id.alias("request_id"), F.col(S.KEY).alias("machine_id"), F.col(S.TS).alias("as_of"),
        F.round("failure_probability", 4).alias("failure_probability"),
        F.col(LABEL).cast("boolean").alias("will_fail_24h"), "threshold", "model_version",
        F.lit(latency_ms).cast("double").alias("latency_ms"), F.struct(*numeric, *categorical).alias("features"))


def last_feedback(feedback: DataFrame) -> DataFrame:
    """Newest outcome per request, by logging time."""
    return feedback.groupBy("request_id").agg(F.max_by("actual_failure", "logged_at").alias("actual_failure"))


def attach_feedback(predictions: DataFrame, feedback: DataFrame, label: str = LABEL) -> DataFrame:
    """Add the known outcome as label 1/0; null where none has arrived."""
    joined = predictions.join(last_feedback(feedback), "request_id", "left")
    return joined.withColumn(label, F.col("actual_failure").cast("int"))


def newest(df: DataFrame, n: int | None, order: str = "logged_at", tie: str = "request_id") -> DataFrame:
    """The n newest rows; none or 0 keeps all."""
    return df.orderBy(F.desc(order), F.desc(tie)).limit(n) if n else df


def as_window(predictions: DataFrame) -> DataFrame:
    """Prediction log rows as a monitoring window: flat features, `prediction`, `probability`.

    The logged flag has the label's name but is what the model said, so it becomes `prediction`.
    """
    flat = predictions.select(*[c for c in predictions.columns if c != "features"], "features.*")
    return (
        flat.withColumn("prediction", F.col("will_fail_24h").cast("int")).drop("will_fail_24h")
        .withColumn("probability", F.col("failure_probability"))
    )


def load_prediction_log(spark: SparkSession, folder: str, last: int | None = None, feedback: bool = True) -> DataFrame:
    """Newest `last` predictions with flat features and, where known, the outcome."""
    window = as_window(newest(read_log(spark, folder, "predictions"), last))
    if not feedback:
        return window
    try:
        answers = read_log(spark, folder, "feedback")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        answers = spark.createDataFrame([], SCHEMAS["feedback"])  # none has arrived yet
    return attach_feedback(window, answers)
