import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import plant
from foresight import schema as S
from foresight.operators import asof, windows
from foresight.plans.features import build_features, build_training_table, clean_telemetry, maint_with_failures
from foresight.schema import LABEL, PlantTables
from tests.fixtures import expected_features, frame, plant_pandas

D = dt.datetime


def by_key(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_label_boundaries(spark):
    rows = spark.createDataFrame(
        [(D(2015, 1, 1, 0), 1), (D(2015, 1, 1, 6), 1), (D(2015, 1, 1, 7), 1), (D(2015, 1, 2, 6), 1), (D(2015, 1, 2, 7), 1)],
        "datetime timestamp_ntz, machineID bigint")
    fails = spark.createDataFrame([(D(2015, 1, 2, 6), 1)], rows.schema)
    out = asof.label_forward(rows, fails, "machineID", "datetime", 24).orderBy("datetime")
    assert [r[LABEL] for r in out.collect()] == [0, 1, 1, 0, 0]


def test_label_stays_with_its_machine(spark):
    rows = spark.createDataFrame([(D(2015, 1, 1, 6), 1), (D(2015, 1, 1, 6), 2)], "datetime timestamp_ntz, machineID bigint")
    fails = spark.createDataFrame([(D(2015, 1, 1, 12), 2)], rows.schema)
    out = asof.label_forward(rows, fails, "machineID", "datetime", 24).orderBy("machineID")
    assert [r[LABEL] for r in out.collect()] == [0, 1]


def test_cleaning_fills_and_clips(spark):
    volts = [170.0, None, None, 999.0, 170.0, 170.0]
    rows = [(D(2015, 1, 1, h), 1, h, v, 450.0, 100.0, 40.0) for h, v in enumerate(volts)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, machineID bigint, seq bigint, volt double, rotate double, pressure double, vibration double")
    got = [r["volt"] for r in clean_telemetry(df).orderBy("datetime").collect()]
    assert got == [170.0, 170.0, 170.0, 256.0, 170.0, 170.0]


@pytest.mark.parametrize("block_hours", [1, 24, 168])
def test_ffill_counts_rows_across_blocks_and_gaps(spark, block_hours):
    hours, values = [0, 1, 2, 30, 90, 91], [5.0, None, None, None, None, 7.0]
    rows = [(D(2015, 1, 1) + dt.timedelta(hours=h), 1, v) for h, v in zip(hours, values)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k bigint, v double")
    got = [r["v"] for r in windows.ffill(df, "k", "ts", ["v"], 3, block_hours).orderBy("ts").collect()]
    assert got == [5.0, 5.0, 5.0, 5.0, None, 7.0]
    every = [r["v"] for r in windows.ffill(df, "k", "ts", ["v"], None, block_hours).orderBy("ts").collect()]
    assert every == [5.0] * 5 + [7.0]


def test_rolling_frame_is_open_on_the_left(spark):
    rows = [(D(2015, 1, 1, h), 1, float(h + 1)) for h in range(4)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k bigint, v double")
    out = windows.rolling(df, "k", "ts", ["v"], [3], ("mean", "std", "sum", "count")).orderBy("ts").collect()
    assert [r["v_mean_3h"] for r in out] == pytest.approx([1, 1.5, 2, 3])
    assert [r["v_sum_3h"] for r in out] == pytest.approx([1, 3, 6, 9])
    assert [r["v_count_3h"] for r in out] == [1, 2, 3, 3]
    assert out[0]["v_std_3h"] == 0.0 and out[3]["v_std_3h"] == pytest.approx(1.0)


@pytest.mark.parametrize("block_hours", [24, 50, 168])
def test_rolling_matches_pandas(spark, block_hours):
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame({"k": rng.integers(0, 3, n), "ts": pd.Timestamp("2015-01-01") + pd.to_timedelta(rng.integers(0, 400 * 3600, n), unit="s")})
    pdf["v"] = np.where(rng.random(n) < 0.3, np.nan, np.where(rng.random(n) < 0.4, 12.5, rng.normal(1000, 3, n)))
    pdf = pdf.drop_duplicates(["k", "ts"]).sort_values(["k", "ts"]).reset_index(drop=True)
    rows = [(int(a), b.to_pydatetime(), None if np.isnan(c) else float(c)) for a, b, c in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double")
    got = windows.rolling(df, "k", "ts", ["v"], [24], ("mean", "std", "count"), block_hours).orderBy("k", "ts").toPandas()
    roll = pdf.set_index("ts").groupby("k")["v"].rolling("24h", min_periods=1)
    assert np.allclose(got["v_mean_24h"].astype(float), roll.mean().to_numpy(), rtol=1e-9, equal_nan=True)
    exact = [pdf[(pdf.k == k) & (pdf.ts > t - pd.Timedelta(hours=24)) & (pdf.ts <= t)]["v"].std() for k, t in zip(pdf.k, pdf.ts)]
    assert np.allclose(got["v_std_24h"], np.nan_to_num(exact), rtol=1e-9, atol=1e-9)
    same = [len(set(pdf[(pdf.k == k) & (pdf.ts > t - pd.Timedelta(hours=24)) & (pdf.ts <= t)]["v"].dropna())) <= 1 for k, t in zip(pdf.k, pdf.ts)]
    assert (got["v_std_24h"][same] == 0).all()


def test_asof_includes_the_exact_time_and_caps(spark):
    rows = spark.createDataFrame([(D(2015, 1, 1, 6), 1), (D(2015, 2, 1, 6), 1), (D(2014, 12, 31), 1)], "datetime timestamp_ntz, machineID bigint")
    ev = spark.createDataFrame([(D(2015, 1, 1, 6), 1, "comp1"), (D(2013, 1, 1), 1, "comp2"), (D(2015, 1, 1), 1, "comp9")],
                               "datetime timestamp_ntz, machineID bigint, comp string")
    out = asof.last_event_asof(rows, ev, "machineID", "datetime", "comp", ["comp1", "comp2", "comp3"], 365.0, 24)
    got = {r["datetime"]: (r["days_since_comp1"], r["days_since_comp2"], r["days_since_comp3"]) for r in out.collect()}
    assert got[D(2015, 1, 1, 6)] == (0.0, 365.0, 365.0)
    assert got[D(2015, 2, 1, 6)] == (31.0, 365.0, 365.0)
    assert got[D(2014, 12, 31)] == (365.0, 365.0, 365.0)


@pytest.mark.parametrize("block_hours", [24, 100, 1000])
def test_training_table_matches_the_definition(spark, small_plant, block_hours):
    want = expected_features(plant_pandas()).sort_values(["machineID", "datetime"]).reset_index(drop=True)
    got = build_training_table(small_plant, sample_every=None, block_hours=block_hours).toPandas()
    got = got.sort_values(["machineID", "datetime"]).reset_index(drop=True)
    numeric, _ = S.feature_columns()
    assert list(got.columns) == ["machineID", "datetime", *numeric, "model", LABEL]
    assert len(got) == len(want) > 1000
    assert (got["datetime"] == want["datetime"]).all() and (got["model"] == want["model"]).all()
    for c in [*numeric, LABEL]:
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9), c
    assert got[LABEL].sum() > 20


def test_sampled_grid_and_no_maintenance(spark, small_plant):
    sampled = build_training_table(small_plant)
    assert {r[0] for r in sampled.select(F.hour("datetime") % 3).distinct().collect()} == {0}
    none = PlantTables(small_plant.telemetry, small_plant.errors, small_plant.maint.limit(0), None, small_plant.machines)
    row = build_features(none).select(*[F.min(f"days_since_{c}") for c in S.COMPONENTS]).first()
    assert list(row) == [365.0] * 4


def test_services_include_failures_once(spark):
    m = spark.createDataFrame([(D(2015, 1, 1), 1, "comp1")], "datetime timestamp_ntz, machineID bigint, comp string")
    f = spark.createDataFrame([(D(2015, 1, 1), 1, "comp1"), (D(2015, 1, 2), 1, "comp2")], "datetime timestamp_ntz, machineID bigint, failure string")
    assert maint_with_failures(m, f).count() == 2


def test_dedup_keeps_the_last_and_other_windows(spark):
    df = frame(spark, "telemetry", plant_pandas()["telemetry"])
    kept = windows.dedup_last(df, ["machineID", "datetime"], "seq")
    pdf = plant_pandas()["telemetry"].drop_duplicates(["machineID", "datetime"], keep="last")
    assert sorted(r["seq"] for r in kept.collect()) == sorted(pdf["seq"])
    gaps = windows.gap_check(kept, "machineID", "datetime", block_hours=24)
    pdf = pdf.sort_values(["machineID", "datetime"])
    want = (pdf.groupby("machineID")["datetime"].diff() > pd.Timedelta(hours=1)).sum()
    assert gaps.where("gap").count() == want
    assert windows.latest_per_key(kept, "machineID", "datetime").count() == 4
    cut = windows.time_cuts(kept, "datetime", [0.5, 0.75]).first()
    times = sorted(pdf["datetime"].unique())
    assert cut["cut0"] == times[int(len(times) * 0.5)] and cut["cut1"] == times[int(len(times) * 0.75)]


def test_the_grid_of_readings_is_made_by_many_tasks(spark, monkeypatch):
    """The machines' ids fit one small partition, which must not unfold the hours of all of them."""
    monkeypatch.setattr(plant, "GRID_ROWS", 1000, raising=False)
    readings = plant.plant_tables(spark, "/root/testdata/sf0.001").telemetry.where("seq = 0")
    per_task = [r["count"] for r in readings.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) > 8000 and max(per_task) < sum(per_task) / 3


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_shuffles_of_the_plant_have_partitions_by_its_rows(spark, monkeypatch, adaptive):
    """A session that asks for few partitions must not give each task a share that grows with the input."""
    monkeypatch.setattr(plant, "GRID_ROWS", 250)
    name, initial = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = spark.conf.get(name)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set(name, "2")
        spark.conf.unset(initial)
        df = build_features(plant.plant_tables(spark, "/root/testdata/sf0.001"))
        found = re.findall(r"hashpartitioning\(machineID#\d+L, (?:datetime|_blk)#\d+L?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())
        assert found and min(int(n) for n in found) > 30
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set(name, own)
        spark.conf.unset(initial)


@pytest.mark.parametrize("place", [None, "machineID % 3"])
def test_readings_are_exchanged_once(spark, small_plant, place):
    """The aggregation and all windows work where one exchange has put the readings; only a few small rows travel besides."""
    plan = build_features(small_plant, None, 24, place=place)._jdf.queryExecution().executedPlan().toString()
    inside = plan[plan.rindex("Window [", 0, plan.index("Union")):plan.index("HashAggregate", plan.index("Union"))]
    assert "Exchange" not in plan[:plan.index("Union")] and "Exchange" not in inside
    by = "_place" if place else "machineID"
    aggregated = plan[plan.index("HashAggregate", plan.index("Union")):]
    assert re.search(r"Exchange (\w+)\(", aggregated).group(0) == "Exchange hashpartitioning("
    assert re.search(r"hashpartitioning\((\w+)#\d+L?, (\w+)#", aggregated).groups() == (by, "_blk")


def test_readings_of_machines_without_number_and_long_gaps(spark):
    """Rows of a null machine are a machine's like any other; its gaps are filled from far back."""
    t = plant_pandas(machines=2, hours=500, nulls=0.6, repeats=20)
    tel = t["telemetry"]
    t["telemetry"] = tel[~((tel.machineID == 2) & tel.datetime.between(pd.Timestamp("2015-01-04"), pd.Timestamp("2015-01-14 20:00")))].reset_index(drop=True)
    plain = PlantTables(**{k: frame(spark, k, v) for k, v in t.items()})
    nobody = PlantTables(**{k: df.withColumn("machineID", F.when(F.col("machineID") != 2, F.col("machineID"))) for k, df in plain.as_dict().items()})
    numeric = S.feature_columns()[0]
    for place in (None, "pmod(xxhash64(machineID), 4L)"):
        want = build_features(plain, None, 24, block_hours=48, place=place).where("machineID = 2").orderBy("datetime").toPandas()
        got = build_features(nobody, None, 24, block_hours=48, place=place).where("machineID IS NULL").orderBy("datetime").toPandas()
        assert len(got) == len(want) > 100 and (got["datetime"] == want["datetime"]).all()
        known = [c for c in numeric if c != "age"]   # attributes are joined, which null does not
        assert np.allclose(got[known], want[known], rtol=1e-9, atol=1e-9) and (got[LABEL] == want[LABEL]).all()


def test_features_run_compiled_on_a_plain_session(spark, small_plant):
    """A session that `get_session` did not make still gets methods that the JIT compiler takes."""
    own = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        build_features(small_plant)
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", own)
