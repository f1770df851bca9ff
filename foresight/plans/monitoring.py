"""Monitoring a window of scored rows, and the drift-to-retrain loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators.asof import before_first
from foresight.operators.drift import drift_summary, drift_table, live_performance, retrain_decision
from foresight.operators.metrics import gate_checks, gate_passed
from foresight.operators.split import drop_columns, sample_rows, split_by_time
from foresight.operators.validate import validate_features, validate_or_raise
from foresight.operators.windows import time_cuts
from foresight.plans.features import build_training_table
from foresight.plans.models import Scorer, compare_on_test, train_experiments
from foresight.schema import TS, PlantTables
from foresight.session import materialize
from foresight.sources.stages import stage_or_raise


def reference_sample(train: DataFrame, n: int | None = None) -> DataFrame:
    """Training rows that later windows are compared with: all, or a reproducible sample of `n`."""
    return sample_rows(train, n) if n else train


def monitoring_report(cur: DataFrame, table: DataFrame, name: str, cfg: dict | None = None) -> DataFrame:
    """One row: volume, drift share and names, live performance, verdicts and the retraining decision."""
    cfg = {**S.MONITORING, **(cfg or {})}
    perf = live_performance(cur)
    one = perf.agg(F.first(F.struct(*perf.columns))).scalar()
    rate = F.round(F.avg(F.col("prediction").cast("double")), 4) if "prediction" in cur.columns else F.lit(None).cast("double")
    volume = cur.agg(F.struct(F.count(F.lit(1)).alias("rows"), rate.alias("rate"))).scalar()
    summary = drift_summary(table, cfg["drift_share_threshold"]).withColumn("_p", one).withColumn("_v", volume)
    concept = F.coalesce(F.col("_p.recall") < cfg["min_recall"], F.lit(False))
    row = summary.select(
        F.lit(name).alias("name"), F.col("_v.rows").alias("rows"), F.col("_v.rate").alias("predicted_positive_rate"),
        "drift_share", "data_drift", "drifted_features",
        *[F.col(f"_p.{c}").alias(c) for c in ("n_labelled", "positives", "recall", "precision", "pr_auc")],
        concept.alias("concept_drift"))
    return retrain_decision(row)


def run_monitoring(cur: DataFrame, ref: DataFrame, name: str = "window", cfg: dict | None = None,
                   with_ks: bool = True) -> tuple[DataFrame, DataFrame]:
    """(report row, per-feature drift table) of a scored window against the reference sample."""
    cfg = {**S.MONITORING, **(cfg or {})}
    numeric, categorical = S.feature_columns()
    table = drift_table(ref, cur, numeric, categorical, cfg["psi_threshold"], with_ks)
    return monitoring_report(cur, table, name, cfg), table


def alerts(report: DataFrame) -> DataFrame:
    """Alert rows: reports whose status is not quiet."""
    share = F.concat(F.round(F.col("drift_share") * 100).cast("int").cast("string"), F.lit("%"))
    message = F.concat(F.lit("["), "name", F.lit("] "), "status", F.lit(": drift share "), share, F.lit(" ("),
                       F.array_join("drifted_features", ", "), F.lit(")"),
                       F.when(F.col("recall").isNotNull(), F.format_string("; live recall %.2f", "recall")).otherwise(""),
                       F.lit(" -> "), "reason")
    return report.where(F.col("status") != "no_drift").select("name", "status", message.alias("message"))


def retrain_splits(old: DataFrame, cur: DataFrame, recent_weight: float = S.RECENT_WEIGHT, ts: str = TS) -> dict[str, DataFrame]:
    """Old rows (weight 1) with the first half of the window (higher weight); its third and last quarters to judge."""
    cur = drop_columns(cur)
    cuts = time_cuts(cur, ts, [0.5, 0.75])
    cut = [cuts.select(f"cut{i}").scalar() for i in range(2)]
    past = before_first(old, cur, ts).withColumn("sample_weight", F.lit(1.0))
    recent = cur.where(F.col(ts) < cut[0]).withColumn("sample_weight", F.lit(float(recent_weight)))
    return {
        "train": past.unionByName(recent, allowMissingColumns=True),
        "val": cur.where((F.col(ts) >= cut[0]) & (F.col(ts) < cut[1])),
        "test": cur.where(F.col(ts) >= cut[1]),
    }


def judge(candidate: Scorer, champion: Scorer | None, test: DataFrame, gate: dict | None = None) -> tuple[bool, DataFrame]:
    """(passed, checks) of the candidate against the minima and the champion on the same rows."""
    metrics = materialize(compare_on_test(candidate, champion, test), "test-metrics")
    best = None
    if champion:
        best = metrics.where(F.col("model_version") == champion.version).agg(F.max("pr_auc")).first()[0]
    checks = gate_checks(metrics.where(F.col("model_version") == candidate.version), best, gate)
    return gate_passed(checks).first()["passed"], checks


def train_and_judge(
    spark: SparkSession, t: PlantTables, ranges: dict | None = None, specs=S.EXPERIMENTS, champion: Scorer | None = None,
    contract: dict | None = None, version: str = "candidate", stage_dir: str | None = None,
) -> dict:
    """Validate, build features, split by time, keep a reference sample, train and judge the candidate.

    With `stage_dir` the tables are checked while they are written there, and the job goes on from what is stored."""
    from dataclasses import replace

    if stage_dir:
        t = PlantTables(**stage_or_raise(t, stage_dir, contract))
    else:
        validate_or_raise(t.as_dict(), contract)
    features = materialize(build_training_table(t), "features")
    numeric, _ = S.feature_columns()
    broken = validate_features(features, numeric).collect()  # at most a row per column and rule
    if broken:
        raise ValueError(f"feature table breaks its contract: {broken}")
    parts = split_by_time(features, ranges)
    reference = materialize(reference_sample(parts["train"]), "reference")
    runs = train_experiments(parts["train"], parts["val"], specs)
    candidate = replace(runs.scorers[runs.best], version=version)
    passed, checks = judge(candidate, champion, parts["test"])
    return {"candidate": candidate, "passed": passed, "checks": checks, "comparison": runs.comparison,
            "reference": reference, "splits": parts}


def retrain_on_drift(
    old: DataFrame, cur: DataFrame, ref: DataFrame, champion: Scorer | None, name: str = "window", specs=S.EXPERIMENTS,
    version: str = "retrained", cfg: dict | None = None,
) -> dict:
    """Monitor a scored window; on drift retrain with it and judge the new model on its newest quarter."""
    from dataclasses import replace

    report, table = run_monitoring(cur, ref, name, cfg)
    decision = report.first()
    if not decision["retrain"]:
        return {"retrained": False, "report": decision}
    parts = retrain_splits(old, cur)
    runs = train_experiments(parts["train"], parts["val"], specs)
    candidate = replace(runs.scorers[runs.best], version=version)
    passed, checks = judge(candidate, champion, parts["test"])
    return {"retrained": True, "report": decision, "candidate": candidate, "promoted": passed, "checks": checks}
