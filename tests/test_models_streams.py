import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators.split import split_by_time
from foresight.plans import models, monitoring
from foresight.plans.features import build_training_table
from foresight.plans.scoring import score_requests
from foresight.schema import KEY, LABEL, TS
from foresight.session import materialize
from foresight.streaming import jobs, windows
from tests.fixtures import plant

SPECS = (
    {"name": "rule_baseline", "model": "rule", "params": {"feature": "vibration_mean_24h"}},
    {"name": "logreg", "model": "logreg", "params": {"C": 1.0, "max_iter": 50}},
    {"name": "random_forest", "model": "random_forest", "params": {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 2}},
    {"name": "boosted_trees", "model": "boosted_trees",
     "params": {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8}},
)
RANGES = {"train": ("2015-01-01", "2015-01-10"), "val": ("2015-01-10", "2015-01-13"), "test": ("2015-01-13", "2015-02-01")}


@pytest.fixture(scope="module")
def table(spark):
    return materialize(build_training_table(plant(spark, nulls=0.01, gaps=0, repeats=0)), "test-table")


def test_every_kind_fits_saves_and_scores(spark, table, tmp_path):
    for spec in SPECS:
        scorer = models.fit(table, spec).with_threshold(0.4)
        scored = scorer.score(table)
        row = scored.agg(F.min("failure_probability"), F.max("failure_probability"), F.count(F.lit(1))).first()
        assert 0 <= row[0] <= row[1] <= 1 and row[2] == table.count()
        scorer.save(spark, str(tmp_path / spec["name"]))
        again = models.Scorer.load(spark, str(tmp_path / spec["name"])).score(table)
        both = scored.select(KEY, TS, F.col("failure_probability").alias("a"), LABEL).join(
            again.select(KEY, TS, F.col("failure_probability").alias("b")), [KEY, TS])
        assert both.where("abs(a - b) > 1e-12").count() == 0
        importance = models.feature_importance(scorer)
        assert (importance is None) == (spec["model"] == "rule")
        if importance:
            assert len(importance) == 30 and importance[0][1] >= importance[-1][1]


def test_forest_grown_in_groups_is_one_forest(spark, table, tmp_path, monkeypatch):
    spec = {"name": "forest", "model": "random_forest", "params": {"n_estimators": 7, "max_depth": 3, "min_samples_leaf": 2}}
    monkeypatch.setattr(models, "FOREST_CELLS", 3 * table.count())
    scorer = models.fit(table, spec)
    groups = models.forests_of(scorer.model)
    assert [g.getNumTrees for g in groups] == [3, 2, 2] and {g.getOrDefault("cacheNodeIds") for g in groups} == {True}
    trees = [t for g in groups for t in g.trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) > 1
    want = sum(t.featureImportances.toArray() for t in trees)
    got = dict(models.feature_importance(scorer))
    assert sum(got.values()) == pytest.approx(1.0)
    assert list(got.values()) == pytest.approx(sorted(want / want.sum(), reverse=True))
    # the probability is the mean of the trees' leaf shares
    vectors = scorer.model.transform(table.limit(40)).select("features", "probability_0").collect()
    scores = [r[0] for r in scorer.probability(table.limit(40)).select("failure_probability").collect()]
    for row, p in zip(vectors, scores):
        assert p == pytest.approx(sum(t.predictProbability(row[0])[1] for t in trees) / 7)
    scorer.save(spark, str(tmp_path / "forest"))
    again = models.Scorer.load(spark, str(tmp_path / "forest"))
    assert [r[0] for r in again.probability(table.limit(40)).select("failure_probability").collect()] == pytest.approx(scores)


def test_group_sizes():
    assert models.grown_together(200, models.FOREST_CELLS // 200) == [200]
    assert models.grown_together(200, 22_000_000) == [25] * 8
    assert models.grown_together(5, 10**12) == [3, 2] and models.grown_together(1, 10**12) == [1] and models.grown_together(3, 0) == [3]


def test_fits_share_preprocessing_and_equal_single_ones(table, monkeypatch):
    calls, real = [], models.preprocessing
    monkeypatch.setattr(models, "preprocessing", lambda numeric: calls.append(1) or real(numeric))
    together = models.fit_all(table, SPECS)
    assert len(calls) == 1 and [s.name for s in together] == [s["name"] for s in SPECS]
    for scorer, spec in zip(together, SPECS):
        alone = models.fit(table, spec)
        if scorer.model is None:
            assert scorer == alone
        else:
            assert dict(models.feature_importance(scorer)) == pytest.approx(dict(models.feature_importance(alone)), abs=1e-6)


def test_unknown_model_is_all_zero(spark, table):
    fitted = models.fit(table, SPECS[1]).model
    row = fitted.transform(table.limit(1).withColumn("model", F.lit("model9"))).select("_onehot").first()[0]
    assert row.size == 4 and row.numNonzeros() == 0


def test_training_and_retraining_loop(spark):
    t = plant(spark, nulls=0.01, gaps=0, repeats=0)
    for sensor, (lo, hi) in S.HARD_BOUNDS.items():
        t = type(t)(t.telemetry.withColumn(sensor, F.least(F.greatest(sensor, F.lit(lo)), F.lit(hi))), t.errors.where("errorID != 'error9'"),
                    t.maint, t.failures, t.machines)
    out = monitoring.train_and_judge(spark, t, RANGES, SPECS[:2])
    assert out["comparison"].count() == 2 and out["passed"] in (True, False)
    assert [r["pr_auc"] for r in out["comparison"].collect()] == sorted([r["pr_auc"] for r in out["comparison"].collect()], reverse=True)
    assert {r["name"] for r in out["checks"].collect()} == {"recall", "precision"}
    champion = out["candidate"]
    parts = out["splits"]
    window = champion.score_window(parts["val"].unionByName(parts["test"]))
    shifted = window.withColumns({c: F.col(c) * 3 + 50 for c in S.feature_columns()[0][:16]})
    again = monitoring.retrain_on_drift(parts["train"], shifted, out["reference"], champion, "shifted", SPECS[:2])
    assert again["retrained"] and again["report"]["data_drift"]
    assert "pr_auc_vs_champion" in {r["name"] for r in again["checks"].collect()}
    report, drifted = monitoring.run_monitoring(window, parts["train"].unionByName(parts["val"]).unionByName(parts["test"]))
    row = report.first()
    assert row["rows"] == window.count() and drifted.count() == 27
    assert monitoring.alerts(report).count() == (0 if row["status"] == "no_drift" else 1)
    weights = monitoring.retrain_splits(parts["train"], window)["train"].groupBy("sample_weight").count().collect()
    assert {r["sample_weight"] for r in weights} == {1.0, 5.0}


LOG = "ts timestamp_ntz, status int, latency double, flag int, score double"


def log_rows(n=400):
    start = dt.datetime(2015, 1, 1)
    return [(start + dt.timedelta(seconds=17 * i), 500 if 100 < i < 180 else 200, (i % 50) / 200, int(i % 3 == 0), (i % 97) / 97) for i in range(n)]


@pytest.fixture(scope="module")
def log_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "rows"
    spark.createDataFrame(log_rows(), LOG).repartition(3).write.parquet(str(path))
    return str(path)


def run(df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    q = (df.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


@pytest.mark.parametrize("make", [
    lambda d: windows.request_rate(d, "ts", ["status"]),
    lambda d: windows.latency_quantiles(d, "ts", "latency", "5 minutes", "1 minute"),
    lambda d: windows.error_share(d, "ts", "status", "5 minutes", "1 minute"),
    lambda d: windows.flag_share(d, "ts", "flag", "1 hour", "5 minutes"),
    lambda d: windows.score_distribution(d, "ts", "score"),
])
def test_stream_equals_batch(spark, log_dir, tmp_path, make):
    batch = make(spark.read.parquet(log_dir))
    stream = run(make(spark.readStream.schema(LOG).parquet(log_dir)), tmp_path)
    last = log_rows()[-1][0] - dt.timedelta(minutes=10)
    want = batch.where(F.col("window_end") <= F.lit(last))
    assert sorted(map(str, stream.collect())) == sorted(map(str, want.select(stream.columns).collect())) and stream.count() > 5


def test_table_quantiles_are_exact(spark):
    start = dt.datetime(2015, 1, 1)
    rows = [(start + dt.timedelta(seconds=7 * i), None if i % 11 == 0 else ((i * 37) % 101) / 500) for i in range(500)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, latency double")
    got = {r["window_start"]: r for r in windows.latency_quantiles(df, "ts", "latency", "5 minutes", "1 minute").collect()}
    assert min(got) == start - dt.timedelta(minutes=4)
    for w, r in got.items():
        inside = [x for t, x in rows if w <= t < w + dt.timedelta(minutes=5)]
        known = sorted(x for x in inside if x is not None)
        assert r["requests"] == len(inside)
        for name, share in (("p50", 0.5), ("p95", 0.95)):
            assert r[name] == next(x for i, x in enumerate(known) if i + 1 >= share * len(known))
    assert windows.latency_quantiles(df.limit(0), "ts", "latency").count() == 0


def test_held_breach_needs_the_whole_hold(spark):
    start = dt.datetime(2015, 1, 1)
    pattern = [True] * 7 + [False] + [True] * 6 + [None] + [True] * 6
    rows = [(start + dt.timedelta(minutes=i), b) for i, b in enumerate(pattern) if b is not None]
    df = spark.createDataFrame(rows, "window_end timestamp_ntz, breach boolean")
    out = windows.held_breaches(df, "5 minutes", "1 minute").orderBy("window_end").collect()
    assert [int((r["window_end"] - start).total_seconds() // 60) for r in out if r["firing"]] == [5, 6, 13, 20]


def test_alert_job_equals_batch(spark, log_dir, tmp_path):
    short = windows.error_share(spark.readStream.schema(LOG).parquet(log_dir), "ts", "status", "5 minutes", "1 minute")
    jobs.start_alerts(short, "5 minutes", "1 minute", str(tmp_path / "b"), str(tmp_path / "cp2")).awaitTermination()
    got = {r["window_end"] for r in spark.read.parquet(str(tmp_path / "b" / "firing")).collect()}
    all_windows = spark.read.parquet(str(tmp_path / "b" / "windows"))
    want = {r["window_end"] for r in windows.held_breaches(all_windows, "5 minutes", "1 minute").where("firing").collect()}
    assert got == want and len(want) > 5


def test_late_feedback_stream(spark, tmp_path):
    start = dt.datetime(2015, 1, 1)
    preds = [(f"r{i}", start + dt.timedelta(hours=i)) for i in range(200)]
    fb = [(f"r{i}", start + dt.timedelta(hours=i + (60 if i % 10 == 0 else 20)), i % 2 == 0) for i in range(0, 200, 2)]
    p = spark.createDataFrame(preds, "request_id string, ts timestamp_ntz")
    f = spark.createDataFrame(fb, "request_id string, feedback_ts timestamp_ntz, actual_failure boolean")
    p.write.parquet(str(tmp_path / "p"))
    f.write.parquet(str(tmp_path / "f"))
    batch = windows.join_late_feedback(p, f)
    assert batch.count() == 200 and batch.where("label = 1").count() == 80
    stream = windows.join_late_feedback(spark.readStream.schema(p.schema).parquet(str(tmp_path / "p")),
                                        spark.readStream.schema(f.schema).parquet(str(tmp_path / "f")))
    got = {r["request_id"]: r["label"] for r in run(stream, tmp_path).collect()}
    want = {r["request_id"]: r["label"] for r in batch.collect()}
    assert len(got) > 140 and all(want[k] == v for k, v in got.items())
    assert sum(v is None for v in got.values()) > 50


def test_dedup_stream_keeps_one(spark, tmp_path):
    rows = [(i % 20, dt.datetime(2015, 1, 1, 0, i % 20), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v int")
    df.write.parquet(str(tmp_path / "in"))
    out = run(windows.dedup_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["k"], "ts"), tmp_path)
    assert out.count() == 20 == windows.dedup_stream(df, ["k"], "ts").count()


def test_scoring_stream_with_quarantine(spark, tmp_path):
    from tests.test_requests_logs import RULE, body
    bodies = [body(machine_id=1), body(machine_id=2), body(machine_id=0)]
    (tmp_path / "in").mkdir()
    for i, b in enumerate(bodies):
        (tmp_path / "in" / f"{i}.txt").write_text(json.dumps(b) + "\n")
    stream = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "body")
    jobs.start_scoring(stream, RULE, str(tmp_path / "out"), str(tmp_path / "cp"), limits=S.SERVICE_REQUESTS).awaitTermination()
    good = spark.read.json(str(tmp_path / "out" / "predictions"))
    bad = spark.read.json(str(tmp_path / "out" / "quarantine"))
    assert sorted(r["machine_id"] for r in good.collect()) == [1, 2]
    assert [r["reasons"] for r in bad.collect()] == [["machine_id"]]


def test_requests_of_one_machine_stay_apart(spark):
    from tests.test_requests_logs import RULE, body
    rows = [body(machine_id=1), body(machine_id=1, telemetry=[{**r, "volt": 200.0} for r in body()["telemetry"]])]
    df = spark.createDataFrame([(f"r{i}", json.dumps(b)) for i, b in enumerate(rows)], "request_id string, body string")
    scored, refused = score_requests(df, RULE)
    got = {r["request_id"]: r["volt_mean_24h"] for r in scored.collect()}
    assert refused.count() == 0 and set(got) == {"r0", "r1"} and got["r1"] == 200.0 and got["r0"] != 200.0
    short = spark.createDataFrame([("s", json.dumps(body(telemetry=body()["telemetry"][:5])))], "request_id string, body string")
    scored, refused = score_requests(short, RULE)
    assert scored.count() == 0 and [r["reasons"] for r in refused.collect()] == [["no_complete_history"]]


def test_one_id_for_two_bodies_is_refused(spark):
    from foresight.plans.scoring import request_features
    from foresight.sources.requests import check_requests
    from tests.test_requests_logs import RULE, body
    other = body(machine_id=3, telemetry=[{**r, "vibration": 55.0} for r in body()["telemetry"]])
    rows = [("x", body(machine_id=1)), ("x", other), ("y", other), ("y", other), (None, body(machine_id=4)), (None, other), ("z", body(machine_id=0)), ("z", other)]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in rows], "request_id string, body string")
    scored, refused = score_requests(df, RULE, limits=S.SERVICE_REQUESTS)
    got = sorted((r["machineID"], r["failure_probability"]) for r in scored.collect())
    assert [m for m, _ in got] == [3, 3, 3, 4] and got[0][1] == got[2][1] != got[3][1]
    reasons = sorted((r["request_id"], tuple(r["reasons"])) for r in refused.collect())
    assert reasons == [("x", ("ambiguous_id",)), ("x", ("ambiguous_id",)), ("z", ("ambiguous_id",)), ("z", ("machine_id",))]
    # even without refusing, each request has features of its own body
    valid, _ = check_requests(df)
    own = {(r["request_id"], r["machineID"]): r["vibration_mean_24h"] for r in request_features(valid).collect()}
    assert own[("x", 1)] == 40.0 and own[("x", 3)] == 55.0


def test_drift_of_constant_and_missing_references(spark):
    rows = [(dt.datetime(2015, 1, d), 0.0 if d < 3 else 5.0, None) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double, y double")
    ref = df.where("x = 0")
    got = {(r["window_start"].day, r["feature"]): r["psi"] for r in jobs.drift_per_window(df, ref, ["x", "y"], ts="ts").collect()}
    assert got[(1, "x")] == 0 and got[(3, "x")] == pytest.approx(9.2103, abs=1e-4)
    from foresight.operators.drift import drift_table
    table = {r["feature"]: (r["psi"], r["drifted"]) for r in drift_table(ref, df.where("x = 5"), ["x", "y"], with_ks=False).collect()}
    assert table == {"x": (9.2103, True), "y": (None, False)}


def test_drift_per_window(spark, tmp_path):
    start = dt.datetime(2015, 1, 1)
    rows = [(start + dt.timedelta(minutes=7 * i), float(i % 40) + (100 if i > 1000 else 0), "ab"[i % 2] if i <= 1000 else "c") for i in range(1400)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double, c string")
    ref = df.where(F.col("ts") < F.lit(start + dt.timedelta(days=2)))
    got = jobs.drift_per_window(df, ref, ["x"], ["c"], "ts")
    from foresight.operators.drift import psi
    for day in (1, 6):
        lo, hi = start + dt.timedelta(days=day), start + dt.timedelta(days=day + 1)
        part = df.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)))
        want = {r["feature"]: r["psi"] for r in psi(ref, part, ["x"], ["c"]).collect()}
        have = {r["feature"]: r["psi"] for r in got.where(F.col("window_start") == F.lit(lo)).collect()}
        assert have == pytest.approx(want)
    df.write.parquet(str(tmp_path / "in"))
    edges = jobs.edge_literals(ref, ["x"])
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    jobs.start_drift_counts(stream, edges, str(tmp_path / "out"), str(tmp_path / "cp"), ["c"], "ts").awaitTermination()
    streamed = jobs.psi_per_window(spark.read.parquet(str(tmp_path / "out")), jobs.bin_counts(ref, edges, ["c"]))
    a = {(r["window_start"], r["feature"]): r["psi"] for r in streamed.collect()}
    b = {(r["window_start"], r["feature"]): r["psi"] for r in got.collect()}
    assert len(a) >= 10 and all(b[k] == pytest.approx(v) for k, v in a.items())


def test_forest_keeps_the_node_of_each_row(spark):
    """Passes go on from the node a row reached, and give the forest that walks from the root."""
    numeric, _ = S.feature_columns()
    rows = spark.range(300).select(
        *[F.expr(f"(id * {7 + i}) % 31 / 31D").alias(c) for i, c in enumerate(numeric)], F.lit("model1").alias("model"),
        F.expr("CAST(id % 5 = 0 AS INT)").alias(LABEL)).withColumn(models.WEIGHT, F.lit(1.0))
    pipeline = models.make_pipeline("random_forest", {"n_estimators": 5, "max_depth": 6, "min_samples_leaf": 2}, numeric, 300.0)
    forest = pipeline.getStages()[-1]
    assert forest.getCacheNodeIds()
    trees = lambda: [t.toDebugString.split("\n", 1)[1] for t in pipeline.fit(rows).stages[-1].trees]
    kept = trees()
    forest.setCacheNodeIds(False)
    assert kept == trees() and any("If" in t for t in kept)
