from types import SimpleNamespace

import pytest

from checks import queries
from checks.compare import compare, connect
from checks.oracles import oracle_sql
from checks.queries import REGISTRY
from foresight import schema as S
from foresight.operators.asof import label_forward
from foresight.plans.features import build_training_table

SF = "/root/testdata/sf0.001"
QUICK = [
    "maint_with_failures", "rolling_stats", "ffill_limited", "ffill_unlimited", "dedup_keep_last", "latest_per_key", "full_history",
    "gap_check", "time_cuts", "label_forward", "last_event_asof", "pivot_counts", "attach_hourly_counts", "unknown_keys", "before_first",
    "split_summary", "seeded_sample", "relabelled_lines", "normalized_values", "validate_plant", "exact_quantile_table", "slo_summary",
    "psi_numeric", "psi_categorical", "ks_distance", "drift_per_day", "table_version", "request_rate", "held_breaches", "late_feedback",
    "stream_request_rate", "training_table", "validate_feature_values", "latency_quantiles", "score_distribution",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan(spark, small_plant):
    text = plan(build_training_table(small_plant))
    for bad in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert "WindowGroupLimit" in text
    assert "hashpartitioning(machineID" in text and "_blk" in text


def test_label_plan_reads_only_what_it_needs(spark):
    e = REGISTRY["label_forward"](spark, SF)
    text = plan(e)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in text
    assert "NestedLoop" not in text and "Window" not in text


def test_censored_rows_can_go(spark):
    df = spark.sql("SELECT 1 AS k, timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, id) AS ts FROM (SELECT CAST(id AS INT) FROM range(49))")
    last = df.where("ts = timestamp_ntz '2024-01-03 00:00:00'")
    assert label_forward(df, last, "k", "ts", 24).count() == 49
    kept = label_forward(df, last, "k", "ts", 24, drop_censored=True).collect()
    assert len(kept) == 25 and [r["will_fail_24h"] for r in sorted(kept, key=lambda r: r["ts"])] == [0] * 24 + [1]


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, SF, oracle_sql()[name])
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(REGISTRY)


def test_model_queries_train_the_full_list(monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "plant_tables", lambda *a: None)
    monkeypatch.setattr(queries, "materialize", lambda *a: None)
    monkeypatch.setattr(queries.feat, "build_training_table", lambda *a: None)
    monkeypatch.setattr(queries.split, "split_by_time", lambda *a: {"train": None, "val": None})
    monkeypatch.setattr(queries.models, "train_experiments", lambda train, val, specs: seen.extend(specs) or SimpleNamespace(comparison=None))
    monkeypatch.setattr(queries.models, "fit", lambda df, spec: seen.append(spec))
    monkeypatch.setattr(queries.models, "importance_table", lambda *a: None)
    REGISTRY["experiment_comparison"](None, SF)
    assert seen == list(S.EXPERIMENTS)
    REGISTRY["forest_importance"](None, SF)
    assert seen[-1] == {"name": "random_forest", "model": "random_forest",
                        "params": {"n_estimators": 200, "max_depth": 12, "min_samples_leaf": 5}}
