import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators.split import at_timestamp
from foresight.plans.features import build_features
from foresight.plans.models import Scorer
from foresight.plans.scoring import features_at, request_features, score_all, score_requests, top_risks
from foresight.schema import KEY, LABEL, TS, PlantTables
from foresight.sources import logs, requests, tables
from tests.fixtures import frame, plant_pandas

AS_OF = "2015-01-12 07:00:00"
RULE = Scorer("rule", None, "vibration_mean_24h", 20.0, 60.0, 0.5, "3")
NUMERIC, _ = S.feature_columns()


@pytest.fixture(scope="module")
def steady(spark):
    """No gaps, no nulls, errors on the hour: requests and history see the same data."""
    t = plant_pandas(nulls=0, gaps=0, repeats=0, on_the_hour=True)
    for s, (lo, hi) in S.HARD_BOUNDS.items():  # a reading outside would be rejected as a request
        t["telemetry"][s] = t["telemetry"][s].clip(lo, hi)
    return PlantTables(**{k: frame(spark, k, v) for k, v in t.items()})


def body(**change):
    start = dt.datetime(2015, 1, 1)
    b = {"machine_id": 5, "model": "model3", "age": 7,
         "telemetry": [{"datetime": (start + dt.timedelta(hours=h)).isoformat(), "volt": 170.0, "rotate": 450, "pressure": 100.0,
                        "vibration": 40.0} for h in range(24)],
         "errors": [{"datetime": "2015-01-01T05:00:00", "errorID": "error2"}], "last_maint": {"comp1": "2014-12-31T06:00:00"}}
    b.update(change)
    return b


def with_reading(i, **change):
    t = body()["telemetry"]
    t[i] = {**t[i], **change}
    return {"telemetry": t}


BAD = {
    "negative vibration": (with_reading(3, vibration=-1), "reading_value"),
    "text for a number": (with_reading(3, rotate="fast"), "reading_value"),
    "short history": ({"telemetry": body()["telemetry"][:10]}, "history_length"),
    "gap": ({"telemetry": body()["telemetry"][:11] + [{**r, "datetime": r["datetime"].replace("01-01", "01-02")} for r in body()["telemetry"][11:]]}, "hourly_order"),
    "unknown model": ({"model": "model9"}, "model"),
    "machine zero": ({"machine_id": 0}, "machine_id"),
    "age": ({"age": 31}, "age"),
    "no telemetry": ({"telemetry": None}, "body"),
    "half the volts missing": ({"telemetry": [{**r, "volt": None if i % 2 else 170.0} for i, r in enumerate(body()["telemetry"])]}, "missing_readings"),
    "error code": ({"errors": [{"datetime": "2015-01-01T05:00:00", "errorID": "error7"}]}, "error_code"),
    "component": ({"last_maint": {"comp7": "2014-12-31T06:00:00"}}, "component"),
    "service after the readings": ({"last_maint": {"comp1": "2015-01-03T06:00:00"}}, "service_in_future"),
}


def as_table(spark, bodies):
    return spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "id int, body string")


def test_bad_requests_are_rejected_with_a_reason(spark):
    df = as_table(spark, [body(**c) for c, _ in BAD.values()] + ["{broken"])
    valid, rejected = requests.check_requests(df, limits=S.SERVICE_REQUESTS)
    assert valid.count() == 0
    got = {r["id"]: r["reasons"] for r in rejected.collect()}
    for i, (name, (_, reason)) in enumerate(BAD.items()):
        assert reason in got[i], (name, got[i])
    assert got[len(BAD)] == ["body"]


def test_good_requests_pass(spark):
    two_missing = body()["telemetry"]
    two_missing[4]["volt"] = two_missing[5]["volt"] = None
    offset = [{**r, "datetime": r["datetime"] + "+07:00"} for r in body()["telemetry"]]
    df = as_table(spark, [body(), body(telemetry=two_missing), body(telemetry=offset), body(last_maint={}, errors=[])])
    valid, rejected = requests.check_requests(df)
    assert rejected.count() == 0 and valid.count() == 4
    third = requests.parse_requests(valid.where("id = 2")).telemetry
    assert third.agg(F.min(TS)).first()[0] == dt.datetime(2015, 1, 1)  # wall clock stays
    row = request_features(valid.where("id = 3")).first()
    assert [row[f"days_since_{c}"] for c in S.COMPONENTS] == [365.0] * 4


def test_no_limits_by_default(spark):
    df = as_table(spark, [body(machine_id=1400, age=99)])
    assert requests.check_requests(df)[1].count() == 0
    batch = df.withColumn("batch", F.lit("a"))
    assert requests.check_requests(batch, batch="batch", limits=S.RequestContract(batch=0))[1].count() == 0
    assert requests.check_requests(batch, batch="batch", limits=S.RequestContract(machine_ids=(1, 9)))[1].count() == 1


def test_log_without_feedback(spark, steady, tmp_path):
    logs.append_log(logs.prediction_records(score_requests(requests.make_requests(steady, AS_OF), RULE)[0]), str(tmp_path), "predictions")
    window = logs.load_prediction_log(spark, str(tmp_path))
    assert window.count() == 4 and window.where("will_fail_24h is not null").count() == 0


def test_batch_rules(spark):
    rows = [("a", body(machine_id=1)), ("a", body(machine_id=1)), ("b", body(machine_id=2)), ("b", body(machine_id=3, age=99)),
            ("c", body(machine_id=4)), ("c", body(machine_id=5))]
    df = spark.createDataFrame([(b, json.dumps(r)) for b, r in rows], "batch string, body string")
    valid, rejected = requests.check_requests(df, batch="batch", limits=S.SERVICE_REQUESTS)
    assert {r["batch"] for r in valid.collect()} == {"c"}
    reasons = {(r["batch"], tuple(r["reasons"])) for r in rejected.collect()}
    assert reasons == {("a", ("repeated_machine",)), ("b", ("batch_has_invalid_request",)), ("b", ("age",))}


def test_request_path_equals_training_path(spark, steady):
    made = requests.make_requests(steady, AS_OF)
    valid, rejected = requests.check_requests(made)
    assert rejected.count() == 0
    got = request_features(valid).orderBy(KEY).toPandas()
    t = PlantTables(steady.telemetry, steady.errors.where(F.col(TS) <= F.lit(AS_OF).cast("timestamp_ntz")), steady.maint,
                    steady.failures, steady.machines)
    want = at_timestamp(build_features(t), AS_OF).orderBy(KEY).toPandas()
    assert len(got) == len(want) == 4
    for c in NUMERIC:
        assert np.allclose(got[c], want[c], rtol=1e-9, atol=1e-9), c


def test_scoring_and_logs(spark, steady, tmp_path):
    scores = score_all(steady, RULE)
    assert scores.count() == 4
    p = [r["failure_probability"] for r in scores.collect()]
    assert p == sorted(p, reverse=True) and top_risks(scores, 2).count() == 2
    by_request, _ = score_requests(requests.make_requests(steady, AS_OF), RULE)
    folder = str(tmp_path)
    logs.append_log(logs.prediction_records(by_request, 1.5), folder, "predictions")
    logs.append_log(logs.prediction_records(RULE.score(features_at(steady))), folder, "predictions")
    (tmp_path / "predictions-9.jsonl").write_text('{broken line\n')
    saved = logs.read_log(spark, folder, "predictions")
    assert saved.count() == 8
    bad = logs.count_corrupt(spark, folder, "predictions").first()
    assert (bad["n_good"], bad["n_corrupt"]) == (8, 1)
    ids = [r["request_id"] for r in saved.orderBy("request_id").collect()]
    feedback = [("2015-01-01", ids[0], False), ("2015-01-02", ids[0], True), ("2015-01-01", ids[1], False)]
    logs.append_log(spark.createDataFrame(feedback, logs.SCHEMAS["feedback"]), folder, "feedback")
    window = logs.load_prediction_log(spark, folder)
    got = {r["request_id"]: r[LABEL] for r in window.collect()}
    assert (got[ids[0]], got[ids[1]], got[ids[2]]) == (1, 0, None) and len(got) == 8
    assert {"prediction", "probability", *NUMERIC}.issubset(window.columns)
    assert logs.load_prediction_log(spark, folder, 3).count() == 3


def test_csv_versions_and_stages(spark, tmp_path):
    files = {
        "telemetry": "datetime,machineID,volt,rotate,pressure,vibration\n2015-01-01 06:00:00,1,170,450,100,40\n1/2/2015 7:00:00 AM,1,NaN,x,100,40\n1/2/2015 07:00,1,1,2,3,4\n",
        "errors": "datetime,machineID,errorID\n2015-01-01T06:00,1,error1\nnever,1,error2\n",
        "maint": "datetime,machineID,comp\n2015-01-01 06:00:00,1,comp1\n", "failures": "datetime,machineID,failure\n2015-01-01 06:00:00,1,comp2\n",
        "machines": "machineID,model,age\n1,model1,3\n"}
    for name, text in files.items():
        (tmp_path / tables.CSV_FILES[name]).write_text(text)
    t = tables.load_plant_csv(spark, str(tmp_path), with_seq=True)
    rows = t.telemetry.orderBy("seq").collect()
    assert rows[0][TS] == dt.datetime(2015, 1, 1, 6) and rows[2][TS] == dt.datetime(2015, 1, 2, 7)
    assert rows[1]["volt"] is None and rows[1]["rotate"] is None and rows[1]["pressure"] == 100.0
    assert [r[TS] for r in t.errors.collect()].count(None) == 1
    summary = {r["table"]: r["n_rows"] for r in tables.table_summary(t.as_dict()).collect()}
    assert summary == {"telemetry": 3, "errors": 2, "maint": 1, "failures": 1, "machines": 1}
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("x\n1\n"), b.write_text("y\n1\n")
    one = tables.file_version(spark, [str(a), str(b)])
    assert len(one) == 12 and one == tables.file_version(spark, [str(b), str(a)])
    import hashlib
    want = hashlib.md5(b"".join(n + hashlib.md5(c).hexdigest().encode() for n, c in ((b"a.csv", b"x\n1\n"), (b"b.csv", b"y\n1\n")))).hexdigest()[:12]
    assert one == want
    a.write_text("x\n2\n")
    assert one != tables.file_version(spark, [str(a), str(b)])
    v = tables.table_version(t.machines).first()["version"]
    assert v == tables.table_version(t.machines.repartition(3)).first()["version"]
    assert v != tables.table_version(t.machines.withColumn("age", F.lit(4))).first()["version"]
    back = tables.write_stage(t.telemetry, str(tmp_path / "stage"), TS)
    plan = back.where("date = '2015-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and back.count() == 3


def test_scores_csv_is_in_rank_order(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "machineID bigint, failure_probability double")
    path = tables.write_scores_csv(df, str(tmp_path), dt.datetime(2015, 12, 1, 6))
    assert path.endswith("scores_20151201_0600")
    import pathlib
    lines = [x for f in sorted(pathlib.Path(path).glob("part-*.csv")) for x in f.read_text().splitlines()[1:]]
    values = [float(x.split(",")[1]) for x in lines]
    assert len(values) == 50 and values == sorted(values, reverse=True)
    tables.write_report(df, str(tmp_path / "report"))
    tables.write_experiment_tables(df, df, str(tmp_path / "experiments"))
    assert spark.read.json(str(tmp_path / "report")).count() == 50


def test_requests_are_read_and_parsed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    rows = [body(machine_id=i) for i in (1, 2, 3)] + [body(machine_id=4, telemetry=body()["telemetry"][:5])]
    df = as_table(spark, rows)
    valid, _ = requests.check_requests(df, limits=S.SERVICE_REQUESTS)
    assert valid.select("request_id")._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    scored, refused = score_requests(df.withColumn("body", counted("body")), RULE)
    assert scored.count() == 3 and [r["reasons"] for r in refused.collect()] == [["no_complete_history"]] and seen.value == 4
