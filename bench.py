"""Headline timings over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from checks import queries as q
from checks.plant import plant_tables
from foresight import schema as S
from foresight.operators import drift, metrics, validate
from foresight.plans import features as feat
from foresight.plans import models, monitoring, scoring
from foresight.schema import LABEL, TS
from foresight.session import get_session, materialize


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("foresight-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rates: dict[str, float] = {}

    def timed(name, run, rows=None):
        t0 = time.perf_counter()
        out = run()
        seconds[name] = round(time.perf_counter() - t0, 3)
        if rows:
            rates[f"{name}_rows_per_s"] = round((rows(out) if callable(rows) else rows) / seconds[name], 1)
        return out

    def drain(df):
        df.write.mode("overwrite").format("noop").save()

    plant = plant_tables(spark, sf_dir)
    # the raw tables are written once, as a plant's tables would already be
    t = S.PlantTables(**{k: materialize(v, k) for k, v in plant.as_dict().items()})
    readings = t.telemetry.count()
    drain(feat.build_features(t))  # first run compiles the generated code
    timed("feature_build", lambda: drain(feat.build_features(t)), readings)
    table = timed("training_table", lambda: materialize(feat.build_training_table(t), "training"), readings)
    timed("validate_tables", lambda: validate.validate_tables(t.as_dict()).collect(), readings)
    rule = models.fit_minmax_rule(table, q.RULE_FEATURE).with_threshold(0.5)
    timed("score_all", lambda: scoring.score_all(t, rule).collect(), lambda out: len(out))
    scored = materialize(rule.score_window(table), "scored")
    timed("metrics", lambda: metrics.classification_metrics(scored, LABEL, "probability", 0.5).collect())
    timed("metric_sweep", lambda: metrics.choose_threshold(scored, LABEL, "probability", min_recall=0.8).collect())
    numeric, categorical = S.feature_columns()
    half = scored.where(f"{TS} < timestamp_ntz '2024-01-16'"), scored.where(f"{TS} >= timestamp_ntz '2024-01-16'")
    ref = materialize(monitoring.reference_sample(half[0]), "reference")
    timed("drift_27_features", lambda: drift.drift_table(ref, half[1], numeric, categorical, with_ks=False).collect())
    timed("drift_27_features_ks", lambda: drift.drift_table(ref, half[1], numeric, categorical).collect())
    timed("logreg_fit", lambda: models.fit(table, S.EXPERIMENTS[1]))
    for name in ("rolling_stats", "label_forward", "last_event_asof", "exact_quantile_table", "psi_numeric", "error_share",
                 "slo_summary", "seeded_sample", "validate_plant", "request_features"):
        timed(name, lambda name=name: q.REGISTRY[name](spark, sf_dir).collect())
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "rates": rates, "sf": float(sf.group(1)) if sf else sf_dir}))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
