"""Registered queries: one per operator or job, each over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.plant import plant_tables
from foresight import schema as S
from foresight.functions import columns as fx
from foresight.operators import asof, drift, metrics, split, validate, windows
from foresight.operators.blocks import exact_quantiles
from foresight.plans import features as feat
from foresight.plans import models, monitoring, refresh, scoring
from foresight.schema import KEY, LABEL, TS
from foresight.session import materialize, work_dir
from foresight.sources import logs, requests, stages, tables
from foresight.streaming import holds
from foresight.streaming import jobs as stream_jobs
from foresight.streaming import windows as stream_windows

NUMERIC, CATEGORICAL = S.feature_columns()
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RULE_FEATURE = "vibration_mean_24h"
# Parameters of the registered runs.
PLANT_SPLITS = {"train": ("2024-01-01", "2024-01-16"), "val": ("2024-01-16", "2024-01-23"),
                "test": ("2024-01-23", "2024-02-01")}
ORDER_SPLITS = {"train": ("1995-01-01", "1998-01-01"), "val": ("1998-01-01", "1999-06-01"),
                "test": ("1999-06-01", "2003-01-01")}
SHIP_CUT = "1998-06-01"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(names, digits: int = 6) -> list:
    return [F.round(c, digits).alias(c) for c in names]


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    return read(spark, sf_dir, "events")


def request_log(spark, sf_dir):
    """Events as a request log: errors are 500s, clicks without luck 404s, the value is the latency in ms."""
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "click", 404).otherwise(200)
    return events(spark, sf_dir).select(
        "event_id", "ts", status.alias("status"), F.col("value").alias("latency_ms"),
        (F.col("value") / 1000).alias("latency_s"), (F.col("event_type") == "purchase").cast("int").alias("flag"),
        (F.col("event_id") % 997 / F.lit(997.0)).alias("score"))


# ---- features -------------------------------------------------------------------------------------------------


@query
def machine_risk_ranking(spark, sf_dir):
    """Ten most endangered machines at the latest hour, by the rule fitted on the training table."""
    t = plant_tables(spark, sf_dir)
    limits = feat.build_training_table(t).agg(
        F.struct(F.min(RULE_FEATURE).alias("lo"), F.max(RULE_FEATURE).alias("hi"))).scalar()
    now = scoring.features_at(t)
    p = F.round(fx.minmax_score(RULE_FEATURE, limits["lo"], limits["hi"]), 6)
    scored = now.withColumn(models.PROBABILITY, p).withColumn(LABEL, fx.decide(models.PROBABILITY, 0.5))
    top = scoring.top_risks(scored)
    return top.select(KEY, TS, models.PROBABILITY, LABEL, "model", "age")


@query
def training_table(spark, sf_dir):
    df = feat.build_training_table(plant_tables(spark, sf_dir))
    return df.select(KEY, TS, *rounded(NUMERIC), *CATEGORICAL, LABEL)


@query
def serving_features(spark, sf_dir):
    """Every hour, without label: the serving form of the feature job."""
    t = plant_tables(spark, sf_dir)
    return feat.build_features(t).select(KEY, TS, *rounded(NUMERIC), *CATEGORICAL)


@query
def refreshed_features(spark, sf_dir):
    """The training table from a stored feature table that late rows have refreshed: the repeated readings, errors, services
    and failures of the last two days of readings come after the table was built."""
    t = plant_tables(spark, sf_dir)
    since = t.telemetry.agg((F.max(TS) - F.expr("INTERVAL 2 DAYS")).alias("since")).first()[0]
    is_late = {"telemetry": (F.col(TS) >= F.lit(since)) & (F.col("seq") > 0), "machines": F.lit(False)}

    def side(late: bool) -> S.PlantTables:
        rows = {k: is_late.get(k, F.col(TS) >= F.lit(since)) for k in t.as_dict()}
        return S.PlantTables(**{k: df.where(rows[k] if late else ~rows[k]) for k, df in t.as_dict().items()})

    path = f"{work_dir(spark)}/features-{uuid.uuid4().hex}"
    refresh.write_features(side(False), path, parts=8)
    refresh.refresh_features(path, side(False), side(True), parts=8)
    df = refresh.read_features(spark, path).where(F.hour(TS) % S.SAMPLE_EVERY_HOURS == 0)
    return df.select(KEY, TS, *rounded(NUMERIC), *CATEGORICAL, LABEL)


@query
def clean_telemetry(spark, sf_dir):
    return feat.clean_telemetry(plant_tables(spark, sf_dir).telemetry).select(KEY, TS, *S.SENSORS)


@query
def maint_with_failures(spark, sf_dir):
    t = plant_tables(spark, sf_dir)
    return feat.maint_with_failures(t.maint, t.failures)


# ---- windows and as-of lookups --------------------------------------------------------------------------------


@query
def rolling_stats(spark, sf_dir):
    df = windows.rolling(events(spark, sf_dir), "user_id", "ts", ["value"], [3, 24], ("mean", "std", "sum", "count"))
    made = [f"value_{a}_{h}h" for h in (3, 24) for a in ("mean", "std", "sum")]
    return df.select("event_id", *rounded(made), "value_count_3h", "value_count_24h")


def sparse_events(spark, sf_dir):
    known = F.when(F.col("event_id") % 5 < 2, F.col("value"))
    return events(spark, sf_dir).select("event_id", "user_id", "ts", known.alias("value"))


@query
def ffill_limited(spark, sf_dir):
    df = windows.ffill(sparse_events(spark, sf_dir), "user_id", "ts", ["value"], limit=3, block_hours=24)
    return df.select("event_id", "value")


@query
def ffill_unlimited(spark, sf_dir):
    df = windows.ffill(sparse_events(spark, sf_dir), "user_id", "ts", ["value"], block_hours=24)
    return df.select("event_id", "value")


@query
def dedup_keep_last(spark, sf_dir):
    return windows.dedup_last(plant_tables(spark, sf_dir).telemetry, [KEY, TS], "seq")


@query
def latest_per_key(spark, sf_dir):
    return windows.latest_per_key(events(spark, sf_dir), "user_id", "ts", "event_id").select(
        "user_id", "event_id", "ts", "event_type", "value")


@query
def first_seen(spark, sf_dir):
    return windows.first_seen(events(spark, sf_dir), "user_id", "ts")


@query
def full_history(spark, sf_dir):
    return windows.full_history(events(spark, sf_dir), "user_id", "ts", 24).select("event_id", "user_id", "ts")


@query
def gap_check(spark, sf_dir):
    t = windows.dedup_last(plant_tables(spark, sf_dir).telemetry, [KEY, TS], "seq")
    return windows.gap_check(t, KEY, TS).select(KEY, TS, F.col("gap").cast("int").alias("gap"))


@query
def time_cuts(spark, sf_dir):
    return windows.time_cuts(events(spark, sf_dir), "ts", [0.5, 0.75])


@query
def label_forward(spark, sf_dir):
    e = events(spark, sf_dir)
    out = asof.label_forward(e, e.where("event_type = 'purchase'"), "user_id", "ts", 24, "label")
    return out.select("event_id", "label")


@query
def last_event_asof(spark, sf_dir):
    e = events(spark, sf_dir)
    codes = ["signup", "purchase", "refund"]
    out = asof.last_event_asof(e.select("event_id", "user_id", "ts"), e, "user_id", "ts", "event_type", codes, 7.0)
    return out.select("event_id", *rounded([f"days_since_{c}" for c in codes]))


@query
def pivot_counts(spark, sf_dir):
    return asof.pivot_counts(plant_tables(spark, sf_dir).errors, KEY, TS, "errorID", S.ERROR_IDS)


@query
def attach_hourly_counts(spark, sf_dir):
    t = plant_tables(spark, sf_dir)
    rows = t.telemetry.select(KEY, TS).distinct()
    counts = asof.pivot_counts(t.errors, KEY, TS, "errorID", S.ERROR_IDS)
    return asof.attach_hourly_counts(rows, counts, KEY, TS, S.ERROR_IDS)


@query
def attach_dimension(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    c = read(spark, sf_dir, "customer")
    return asof.attach_dimension(o.select("o_orderkey", "c_custkey"), c, "c_custkey", ["c_mktsegment", "c_nationkey"])


@query
def unknown_keys(spark, sf_dir):
    keys = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"))
    known = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"))
    return asof.unknown_keys(keys.unionByName(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))), known, "k")


@query
def before_first(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("ts"))
    recent = read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    return asof.before_first(line, recent, "ts")


# ---- splits, slices, samples ----------------------------------------------------------------------------------


@query
def split_summary(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return split.split_summary(o, ORDER_SPLITS, "o_orderdate").withColumn("overlap", F.col("overlap").cast("int"))


@query
def split_parts(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = split.split_by_time(o, ORDER_SPLITS, "o_orderdate")
    return metrics.union_all([df.withColumn("split", F.lit(n)) for n, df in parts.items()])


@query
def history_slice(spark, sf_dir):
    t = split.history_slice(plant_tables(spark, sf_dir), "2024-01-20 06:00:00")
    kinds = {"telemetry": t.telemetry, "errors": t.errors, "maint": t.maint, "failures": t.failures}
    return metrics.union_all([df.select(F.lit(n).alias("kind"), KEY, TS) for n, df in kinds.items()])


@query
def latest_readings(spark, sf_dir):
    t = plant_tables(spark, sf_dir).telemetry
    return split.at_timestamp(t, split.latest_time(t)).select(KEY, TS, "seq", *S.SENSORS)


@query
def hour_grid(spark, sf_dir):
    return split.hour_grid(events(spark, sf_dir), 3, "ts").select("event_id", "ts")


@query
def seeded_sample(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return split.sample_rows(line, 5000, ["l_orderkey", "l_linenumber"])


@query
def scaled_sensors(spark, sf_dir):
    t = plant_tables(spark, sf_dir).telemetry
    out = split.scale_columns_in_window(t, {"vibration": 1.2, "pressure": 1.15, "volt": 1.1}, "2024-01-16", "2024-01-20")
    return out.select(KEY, TS, "seq", *rounded(S.SENSORS))


@query
def relabelled_lines(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_discount") > 0.09).cast("int"))
    out = split.relabel_above_quantile(line, "l_extendedprice", 0.93, F.col("l_returnflag").isin("A", "R"), "label")
    return out.select("l_orderkey", "l_linenumber", "label")


@query
def normalized_values(spark, sf_dir):
    """Coerced, filled, clipped and finite numbers of the JSON property of each event."""
    raw = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_id") % 10 == 0, F.lit("fast")).when(F.col("event_id") % 10 == 1, F.lit("NaN")).otherwise(raw)
    e = events(spark, sf_dir).select("event_id", text.alias("text"), "value")
    number = fx.coerce("text")
    share = F.when(F.col("event_id") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return e.select(
        "event_id", number.alias("number"), fx.clip(fx.fill_midrange(number, 20, 80), 20.0, 80.0).alias("clipped"),
        fx.finite_or_zero(share).alias("finite"), fx.decide("value", 50.0).alias("flag"))


# ---- validation -----------------------------------------------------------------------------------------------


def flat_issues(df):
    return df.select("table", "column", "check", "count", F.array_join("examples", ",").alias("examples"))


@query
def validate_plant(spark, sf_dir):
    contract = S.raw_contract(machine_ids=S.MACHINE_ID_RANGE)
    return flat_issues(validate.validate_tables(plant_tables(spark, sf_dir).as_dict(), contract))


def corrupted_plant(spark, sf_dir) -> dict[str, DataFrame]:
    """The plant's tables with every kind of fault: the rows are told by their machine and hour."""
    t = plant_tables(spark, sf_dir)
    k = F.col(KEY) * 7 + F.hour(TS) + F.dayofmonth(TS) * 24
    bad = lambda n, value, other: F.when(k % n == 0, value).otherwise(other)
    telemetry = t.telemetry.select(
        bad(233, F.lit(None), F.col(TS)).alias(TS), bad(229, F.lit(999), F.col(KEY)).alias(KEY), "seq",
        bad(211, F.lit("sensor_error"), F.col("volt").cast("string")).alias("volt"), bad(227, F.lit(5000.0), F.col("rotate")).alias("rotate"),
        bad(9, F.lit(None), F.col("pressure")).alias("pressure"), bad(223, F.lit(-5.0), F.col("vibration")).alias("vibration"))
    machines = t.machines.withColumns({"age": F.when(F.col(KEY) % 13 == 0, 31).otherwise(F.col("age")),
                                       "model": F.when(F.col(KEY) % 17 == 0, F.lit(None)).otherwise(F.col("model"))})
    return {"telemetry": telemetry, "errors": t.errors, "maint": t.maint.drop("comp"),
            "machines": machines.unionByName(machines.where(f"{KEY} % 10 = 0"))}


@query
def validate_corrupted(spark, sf_dir):
    """Every rule kind broken: types, nulls, ranges, lists, keys, null shares, unknown machines, a lost column and a lost table."""
    contract = S.raw_contract(machine_ids=S.MACHINE_ID_RANGE)
    return flat_issues(validate.validate_tables(corrupted_plant(spark, sf_dir), contract))


@query
def staged_validation(spark, sf_dir):
    """The same issues from the write of the stage tables, which are then in the shared folder."""
    folder = f"{work_dir(spark)}/stages-{uuid.uuid4().hex}"
    return flat_issues(stages.stage_plant(corrupted_plant(spark, sf_dir), folder, S.raw_contract(machine_ids=S.MACHINE_ID_RANGE))[1])


@query
def validation_report(spark, sf_dir):
    """The stop of the line: the issue table as written before the job is ended."""
    folder = f"{work_dir(spark)}/issues-{uuid.uuid4().hex}"
    try:
        validate.validate_or_raise(corrupted_plant(spark, sf_dir), S.raw_contract(machine_ids=S.MACHINE_ID_RANGE), folder)
    except validate.DataValidationError:
        return spark.read.parquet(folder).select("table", "column", "check", "count")
    raise AssertionError("corrupted tables passed")


@query
def null_fractions(spark, sf_dir):
    df = validate.null_fractions(plant_tables(spark, sf_dir).telemetry, S.SENSORS)
    return df.select("column", F.round("fraction", 6).alias("fraction"))


@query
def duplicate_groups(spark, sf_dir):
    return validate.duplicate_groups(plant_tables(spark, sf_dir).telemetry, [KEY, TS])


@query
def validate_feature_values(spark, sf_dir):
    """Models by the customer of the machine's number: one in five is not in the list, machines without a customer have none."""
    t = plant_tables(spark, sf_dir)
    model = F.concat(F.lit("model"), F.col("c_nationkey") % 5 + 1).alias("model")
    owners = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias(KEY), model)
    df = asof.attach_dimension(t.telemetry, owners, KEY, ["model"])
    return flat_issues(validate.validate_features(df, S.SENSORS))


# ---- metrics --------------------------------------------------------------------------------------------------


def rule_scored(spark, sf_dir):
    """Training table with the rule's score. The features are built and written once; the rule's limits are read from there."""
    df = feat.build_training_table(plant_tables(spark, sf_dir)).select(KEY, TS, "model", LABEL, RULE_FEATURE)
    df = materialize(df, "rule-scored")
    limits = df.agg(F.struct(F.min(RULE_FEATURE).alias("lo"), F.max(RULE_FEATURE).alias("hi"))).scalar()
    p = F.round(fx.minmax_score(RULE_FEATURE, limits["lo"], limits["hi"]), 6).alias("p")
    return df.select(KEY, TS, "model", LABEL, p)


METRIC_COLUMNS = ["pr_auc", "roc_auc", "recall", "precision", "f1", "cost", "saving_vs_no_model"]


@query
def classification_metrics(spark, sf_dir):
    df = metrics.classification_metrics(rule_scored(spark, sf_dir), LABEL, "p", 0.5)
    return df.select("tn", "fp", "fn", "tp", *rounded(METRIC_COLUMNS))


@query
def metrics_by_model(spark, sf_dir):
    df = metrics.classification_metrics(rule_scored(spark, sf_dir), LABEL, "p", 0.5, by=["model"])
    return df.select("model", "tn", "fp", "fn", "tp", *rounded(METRIC_COLUMNS))


@query
def threshold_sweep(spark, sf_dir):
    df = metrics.threshold_sweep(rule_scored(spark, sf_dir), LABEL, "p")
    return df.select("threshold", "tn", "fp", "fn", "tp", *rounded(["recall", "precision", "cost"]))


@query
def choose_threshold(spark, sf_dir):
    df = metrics.choose_threshold(rule_scored(spark, sf_dir), LABEL, "p", min_recall=0.6, min_precision=0.01, by=["model"])
    return df.select("model", "threshold", *rounded(["cost", "recall", "precision"]),
                     F.col("meets_minimum").cast("int").alias("meets_minimum"))


@query
def gate_checks(spark, sf_dir):
    """Each machine model's rows judged as a candidate against the whole plant's average precision."""
    scored = rule_scored(spark, sf_dir)
    champion = metrics.average_precision(scored, LABEL, "p").select("pr_auc").scalar()
    by_model = metrics.classification_metrics(scored, LABEL, "p", 0.5, by=["model"]).withColumnRenamed("model", "model_version")
    checks = metrics.gate_checks(by_model, champion, {"min_recall": 0.3, "min_precision": 0.05}, 12.0, 60.0)
    return checks.select("model_version", "name", F.round("value", 6).alias("value"), F.col("passed").cast("int").alias("passed"))


@query
def positive_rate(spark, sf_dir):
    df = metrics.positive_rate(rule_scored(spark, sf_dir), LABEL, ["model"])
    return df.select("model", "n", *rounded(["positive_rate", "class_ratio"]))


@query
def value_range(spark, sf_dir):
    return metrics.value_range(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query
def exact_quantile_table(spark, sf_dir):
    df = exact_quantiles(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], [0.05, 0.5, 0.93], ["l_returnflag"])
    q = F.col("quantiles")
    return df.select("l_returnflag", "feature", *[F.round(q[i], 6).alias(f"q{i}") for i in range(3)])


@query
def slo_summary(spark, sf_dir):
    df = metrics.slo_summary(request_log(spark, sf_dir), "latency_ms", "status", "ts")
    flags = [F.col(c).cast("int").alias(c) for c in ("latency_met", "errors_met", "slo_met")]
    return df.select(*[c for c in df.columns if not c.endswith("_met")], *flags)


# ---- drift and monitoring -------------------------------------------------------------------------------------


def ship_halves(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").withColumn("late", (F.col("l_tax") > 0.05).cast("double"))
    early = F.col("l_shipdate") < F.lit(SHIP_CUT).cast("timestamp_ntz")
    shifted = F.when(F.col("l_quantity") > 30, F.col("l_extendedprice") * 1.5).otherwise(F.col("l_extendedprice"))
    return line.where(early), line.where(~early).withColumn("l_extendedprice", shifted)


DRIFT_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late"]
DRIFT_CATEGORICAL = ["l_returnflag", "l_linestatus"]


@query
def psi_numeric(spark, sf_dir):
    ref, cur = ship_halves(spark, sf_dir)
    return drift.psi_numeric(ref, cur, DRIFT_NUMERIC).select("feature", F.round("psi", 6).alias("psi"))


@query
def psi_categorical(spark, sf_dir):
    ref, cur = ship_halves(spark, sf_dir)
    return drift.psi_categorical(ref, cur, DRIFT_CATEGORICAL).select("feature", F.round("psi", 6).alias("psi"))


@query
def ks_distance(spark, sf_dir):
    ref, cur = ship_halves(spark, sf_dir)
    return drift.ks(ref, cur, DRIFT_NUMERIC).select("feature", *rounded(["ks"]))


@query
def value_shares(spark, sf_dir):
    df = drift.value_shares(read(spark, sf_dir, "lineitem"), DRIFT_CATEGORICAL)
    return df.select("feature", "value", F.round("share", 6).alias("share"))


@query
def drift_summary(spark, sf_dir):
    ref, cur = ship_halves(spark, sf_dir)
    table = drift.drift_table(ref, cur, DRIFT_NUMERIC, DRIFT_CATEGORICAL, 0.02, with_ks=False)
    df = drift.drift_summary(table, 0.1)
    return df.select("drift_share", F.col("data_drift").cast("int").alias("data_drift"),
                     F.array_join("drifted_features", ",").alias("drifted_features"))


@query
def live_performance(spark, sf_dir):
    scored = rule_scored(spark, sf_dir).select(
        LABEL, fx.decide("p", 0.5).alias("prediction"), F.col("p").alias("probability"))
    df = drift.live_performance(scored)
    return df.select("n_labelled", "positives", *rounded(["recall", "precision", "pr_auc"]))


def monitored_halves(spark, sf_dir):
    """Reference = first half of the plant's training rows, window = second half with the rule's predictions."""
    df = feat.build_training_table(plant_tables(spark, sf_dir))
    df = materialize(df.select(KEY, TS, LABEL, *rounded(NUMERIC), *CATEGORICAL), "monitored")
    rule = models.fit_minmax_rule(df, RULE_FEATURE)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    cur = df.where(F.col(TS) >= cut)
    p = F.round(fx.minmax_score(RULE_FEATURE, rule.lo, rule.hi), 6)
    return df.where(F.col(TS) < cut), cur.withColumn("probability", p).withColumn("prediction", fx.decide("probability", 0.5))


@query
def feature_drift(spark, sf_dir):
    ref, cur = monitored_halves(spark, sf_dir)
    table = drift.drift_table(ref, cur, NUMERIC, CATEGORICAL)
    return table.select("feature", "psi", F.round("ks_pvalue", 4).alias("ks_pvalue"), F.col("drifted").cast("int").alias("drifted"))


@query
def monitoring_report(spark, sf_dir):
    ref, cur = monitored_halves(spark, sf_dir)
    report, _ = monitoring.run_monitoring(cur, ref, "plant", with_ks=False)
    names = ["drift_share", "predicted_positive_rate", "recall", "precision", "pr_auc"]
    flags = [F.col(c).cast("int").alias(c) for c in ("data_drift", "concept_drift", "retrain")]
    return report.select("name", "rows", "n_labelled", "positives", "status", *rounded(names), *flags)


@query
def retrain_splits(spark, sf_dir):
    ref, cur = monitored_halves(spark, sf_dir)
    parts = monitoring.retrain_splits(ref, cur)
    every = metrics.union_all([df.withColumn("split", F.lit(n)) for n, df in parts.items()])
    return every.groupBy("split", "sample_weight").agg(
        F.count(F.lit(1)).alias("n"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"), F.sum(LABEL).alias("positives"))


@query
def drift_per_day(spark, sf_dir):
    e = events(spark, sf_dir)
    ref = e.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    df = stream_jobs.drift_per_window(e, ref, ["value"], ["event_type"], "ts")
    return df.select("window_start", "feature", F.round("psi", 6).alias("psi"))


# ---- requests, logs, versions ---------------------------------------------------------------------------------

REQUEST_TIME = "2024-01-20 06:00:00"
EARLY_TIME = "2024-01-20 00:00:00"
REQUEST_LIMITS = S.RequestContract(history=(S.MIN_HISTORY, S.MAX_HISTORY))


def plant_requests(spark, sf_dir):
    """Requests of the whole plant, written once: they are the stored input of the request jobs."""
    return materialize(requests.make_requests(plant_tables(spark, sf_dir), REQUEST_TIME), "requests")


@query
def request_readings(spark, sf_dir):
    """Readings after a round trip through JSON requests."""
    parsed = requests.read_requests(plant_requests(spark, sf_dir))
    return requests.parse_requests(parsed).telemetry.select(KEY, TS, *S.SENSORS)


@query
def request_services(spark, sf_dir):
    parsed = requests.read_requests(plant_requests(spark, sf_dir))
    return requests.parse_requests(parsed).maint


@query
def request_errors(spark, sf_dir):
    parsed = requests.read_requests(plant_requests(spark, sf_dir))
    return requests.parse_requests(parsed).errors


@query
def rejected_requests(spark, sf_dir):
    _, rejected = requests.check_requests(plant_requests(spark, sf_dir), limits=REQUEST_LIMITS)
    return rejected.select(KEY, F.array_join("reasons", ",").alias("reasons"))


@query
def request_features(spark, sf_dir):
    valid, _ = requests.check_requests(plant_requests(spark, sf_dir), limits=REQUEST_LIMITS)
    return scoring.request_features(valid).select(KEY, TS, *rounded(NUMERIC), *CATEGORICAL)


def latest_scores(spark, sf_dir):
    t = plant_tables(spark, sf_dir)
    rule = models.Scorer("rule", None, RULE_FEATURE, 30.0, 51.0, 0.5, "7")
    return rule.score(scoring.features_at(t))


@query
def score_all(spark, sf_dir):
    rule = models.Scorer("rule", None, RULE_FEATURE, 30.0, 51.0, 0.5, "7")
    df = scoring.score_all(plant_tables(spark, sf_dir), rule)
    return df.select(KEY, TS, F.round(models.PROBABILITY, 6).alias(models.PROBABILITY), LABEL, "model_version", "model", "age")


@query
def prediction_log_window(spark, sf_dir):
    """Scores written to a log, read back with flat features and joined with feedback."""
    folder = f"{work_dir(spark)}/log-{uuid.uuid4().hex}"
    logs.append_log(logs.prediction_records(latest_scores(spark, sf_dir)), folder, "predictions")
    saved = logs.read_log(spark, folder, "predictions")
    answers = saved.where("machine_id % 3 != 0").select(
        "logged_at", "request_id", (F.col("machine_id") % 2 == 0).alias("actual_failure"))
    logs.append_log(answers, folder, "feedback")
    df = logs.load_prediction_log(spark, folder)
    return df.select("machine_id", "as_of", "prediction", "probability", LABEL, *rounded(NUMERIC), "model", "model_version")


@query
def table_summary(spark, sf_dir):
    names = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
             "conversations").split()
    return tables.table_summary({n: read(spark, sf_dir, n) for n in names})


@query
def table_version(spark, sf_dir):
    return tables.table_version(read(spark, sf_dir, "customer"))


@query
def score_requests(spark, sf_dir):
    """Two requests of every machine, six hours apart: each is scored or refused under its own id."""
    t = plant_tables(spark, sf_dir)
    late = requests.make_requests(t, REQUEST_TIME).withColumn("request_id", F.concat(F.lit("late-"), KEY))
    early = requests.make_requests(t, EARLY_TIME).withColumn("request_id", F.concat(F.lit("early-"), KEY))
    rule = models.Scorer("rule", None, RULE_FEATURE, 30.0, 51.0, 0.5, "7")
    both = materialize(late.unionByName(early), "requests")
    scored, refused = scoring.score_requests(both, rule, limits=REQUEST_LIMITS)
    answer = scored.select("request_id", KEY, F.round(models.PROBABILITY, 6).alias("probability"), F.lit("scored").alias("state"))
    return answer.unionByName(refused.select("request_id", KEY, F.lit(None).cast("double").alias("probability"), F.lit("refused").alias("state")))


@query
def repeated_request_ids(spark, sf_dir):
    """Requests that share ids: of different machines, which are refused, and sent twice, which are answered twice."""
    made = requests.make_requests(plant_tables(spark, sf_dir), REQUEST_TIME)
    own, shared = F.concat(F.lit("own-"), KEY), F.concat(F.lit("shared-"), F.expr(f"{KEY} div 10"))
    made = materialize(made.withColumn("request_id", F.when(F.col(KEY) % 5 == 0, shared).otherwise(own)), "shared-requests")
    rule = models.Scorer("rule", None, RULE_FEATURE, 30.0, 51.0, 0.5, "7")
    scored, refused = scoring.score_requests(made.unionByName(made.where(f"{KEY} % 3 = 0")), rule, limits=REQUEST_LIMITS)
    answer = scored.select("request_id", KEY, F.round(models.PROBABILITY, 6).alias("probability"), F.lit(0).alias("ambiguous"))
    return answer.unionByName(refused.select("request_id", KEY, F.lit(None).cast("double").alias("probability"),
                                             F.array_contains("reasons", "ambiguous_id").cast("int").alias("ambiguous")))


@query
def log_without_feedback(spark, sf_dir):
    """All predictions of a log before any feedback: every outcome is unknown."""
    folder = f"{work_dir(spark)}/log-{uuid.uuid4().hex}"
    logs.append_log(logs.prediction_records(latest_scores(spark, sf_dir)), folder, "predictions")
    df = logs.load_prediction_log(spark, folder)
    return df.select("machine_id", "prediction", "probability", LABEL)


@query
def grouped_areas(spark, sf_dir):
    """Curve areas by two nullable columns: null is a group of its own in either."""
    o = read(spark, sf_dir, "orders")
    df = o.select((F.col("o_totalprice") / 600000).alias("p"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("y"),
                  F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("a"),
                  F.when(F.col("o_orderkey") % 2 == 0, F.lit("x")).alias("b"))
    out = metrics.classification_metrics(df, "y", "p", 0.5, by=["a", "b"])
    return out.select("a", "b", F.round("pr_auc", 6).alias("pr_auc"), F.round("roc_auc", 6).alias("roc_auc"), "tp", "fp")


# ---- windowed service statistics (table form and streams) -----------------------------------------------------


@query
def request_rate(spark, sf_dir):
    return stream_windows.request_rate(request_log(spark, sf_dir), "ts", ["status"])


@query
def latency_quantiles(spark, sf_dir):
    df = stream_windows.latency_quantiles(request_log(spark, sf_dir), "ts", "latency_s")
    return df.withColumn("breach", F.col("breach").cast("int"))


@query
def error_share(spark, sf_dir):
    df = stream_windows.error_share(request_log(spark, sf_dir), "ts", "status")
    return df.select("window_start", "window_end", "requests", "errors", F.round("share", 6).alias("share"),
                     F.col("breach").cast("int").alias("breach"))


@query
def flag_share(spark, sf_dir):
    df = stream_windows.flag_share(request_log(spark, sf_dir), "ts", "flag")
    return df.select("window_start", "window_end", "predictions", "flagged", F.round("share", 6).alias("share"),
                     F.col("breach").cast("int").alias("breach"))


@query
def score_distribution(spark, sf_dir):
    df = stream_windows.score_distribution(request_log(spark, sf_dir), "ts", "score", "1 hour")
    n = len(stream_windows.PROBABILITY_BUCKETS)
    return df.select("window_start", "n", *rounded(["median", "p90"]), *[F.col("at_most")[i].alias(f"b{i}") for i in range(n)])


@query
def held_breaches(spark, sf_dir):
    df = stream_windows.flag_share(request_log(spark, sf_dir), "ts", "flag")
    held = stream_windows.held_breaches(df, "10 minutes", "1 minute")
    return held.where("firing").select("window_end", F.round("share", 6).alias("share"))


def late_pair(spark, sf_dir):
    log = request_log(spark, sf_dir)
    preds = log.select(F.col("event_id").alias("request_id"), "ts", "flag")
    late = F.expr("make_dt_interval(0, CAST(event_id % 60 AS INT))")
    fb = log.where("event_id % 4 != 0").select(
        F.col("event_id").alias("request_id"), (F.col("ts") + late).alias("feedback_ts"),
        (F.col("event_id") % 2 == 0).alias("actual_failure"))
    return preds, fb


@query
def late_feedback(spark, sf_dir):
    return stream_windows.join_late_feedback(*late_pair(spark, sf_dir)).select("request_id", "flag", "label")


def stream_events(spark, sf_dir):
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def run_stream(df, name, mode="append", out=None):
    """Run a stream over what is there now, into a table of the shared folder; with `out` an earlier run goes on."""
    out = out or f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    q =(df.writeStream.outputMode(mode).format("parquet").option("path", f"{out}/table")
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/table")


@query
def stream_request_rate(spark, sf_dir):
    """All windows of a stream: a last row a day later lets a second run close those that the first one left open."""
    folder = f"{work_dir(spark)}/rate-{uuid.uuid4().hex}"
    log = events(spark, sf_dir).select("ts", F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))
    log.write.parquet(f"{folder}/in")

    def rates():
        source = spark.readStream.schema(log.schema).parquet(f"{folder}/in")
        return run_stream(stream_windows.request_rate(source, "ts", ["status"], "1 hour"), "rate", out=folder)

    rates()
    last = log.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), F.lit(200).alias("status"))
    last.write.mode("append").parquet(f"{folder}/in")
    return rates()


def all_windows(spark, log, make, name):
    """The windows of a stream over `log`, all of them: a last row a day later lets a second run close those that the first one left open."""
    folder = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    log.write.parquet(f"{folder}/in")

    def run():
        return run_stream(make(spark.readStream.schema(log.schema).parquet(f"{folder}/in")), name, out=folder)

    run()
    last = [(F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), *[F.max(c).alias(c) for c in log.columns if c != "ts"]]
    log.agg(*last).write.mode("append").parquet(f"{folder}/in")
    return run()


@query
def stream_error_share(spark, sf_dir):
    """Sliding shares of a stream: chained aggregations of panes."""
    log = request_log(spark, sf_dir).select("ts", "status")
    df = all_windows(spark, log, lambda s: stream_windows.error_share(s, "ts", "status"), "error-share")
    return df.select("window_start", "window_end", "requests", "errors", F.round("share", 6).alias("share"),
                     F.col("breach").cast("int").alias("breach"))


@query
def stream_latency_quantiles(spark, sf_dir):
    """Sliding quantiles of a stream from sketches of panes; exact while a window has at most `SKETCH_K` rows."""
    log = request_log(spark, sf_dir).select("ts", "latency_s")
    df = all_windows(spark, log, lambda s: stream_windows.latency_quantiles(s, "ts", "latency_s"), "latency")
    return df.withColumn("breach", F.col("breach").cast("int"))


@query
def stream_held_alerts(spark, sf_dir):
    """Windows of a stream that hold a breach: the hold is streaming state with event-time timers."""
    log = request_log(spark, sf_dir).select("ts", "flag")
    held = all_windows(spark, log, lambda s: holds.held_stream(stream_windows.flag_share(s, "ts", "flag"), "10 minutes", "1 minute"), "alerts")
    return held.where("firing").select("window_end", F.round("share", 6).alias("share"))


@query
def stream_dedup(spark, sf_dir):
    return run_stream(stream_windows.dedup_stream(stream_events(spark, sf_dir), ["event_id"], "ts"), "dedup").select(
        "event_id", "user_id", "event_type")


@query
def stream_dedup_repeats(spark, sf_dir):
    """Users and hours with events: a key comes many times and passes once."""
    hours = stream_events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return run_stream(stream_windows.dedup_stream(hours, ["user_id", "hour"], "ts", "1 hour"), "dedup").select("user_id", "hour")


# ---- models ---------------------------------------------------------------------------------------------------


@query
def experiment_comparison(spark, sf_dir):
    """Rule, regression, forest and boosted trees on the plant's time splits."""
    df = materialize(feat.build_training_table(plant_tables(spark, sf_dir)), "features")
    parts = split.split_by_time(df, PLANT_SPLITS)
    return models.train_experiments(parts["train"], parts["val"], S.EXPERIMENTS).comparison


@query
def forest_importance(spark, sf_dir):
    df = materialize(feat.build_training_table(plant_tables(spark, sf_dir)), "features")
    return models.importance_table(spark, models.fit(df, S.EXPERIMENTS[2]))
