import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from foresight.streaming import jobs, windows
from foresight.streaming.holds import Hold, held_stream

START = dt.datetime(2015, 1, 1)
WINDOWS = "series string, window_end timestamp, share double, breach boolean"


def series_rows(seed=3, n=200):
    """Closed windows of three series, one of them null, with gaps and breaches in runs."""
    rng = random.Random(seed)
    rows = []
    for name in ("a", "b", None):
        breach = False
        for i in range(n):
            breach = not breach if rng.random() < .15 else breach
            if rng.random() > .05:
                rows.append((name, START + dt.timedelta(minutes=i), round(rng.random(), 6), breach if rng.random() > .02 else None))
    return rows


def table_form(spark, rows, hold="5 minutes"):
    df = spark.createDataFrame(rows, WINDOWS).withColumn("breach", F.coalesce("breach", F.lit(False)))
    out = windows.held_breaches(df.withColumn("window_end", F.col("window_end").cast("timestamp_ntz")), hold, "1 minute", by=["series"])
    return {(r["series"], r["window_end"]): (r["firing"], r["share"]) for r in out.collect()}


def test_hold_in_any_order():
    rng = random.Random(5)
    for _ in range(200):
        hold_us, slide_us = rng.choice([(0, 1), (4, 1), (6, 2), (10, 5)])
        ends = [e for e in range(0, 60 * slide_us, slide_us) if rng.random() < .9]
        breach = {e: rng.random() < .8 for e in ends}
        want = {e: all(breach.get(x, False) for x in range(e - hold_us, e + 1, slide_us)) for e in ends}
        left, hold, got, place = list(ends), Hold(hold_us, slide_us), {}, 0
        while left or hold.waiting:
            width = rng.randint(1, 10)
            part, left = left[:width], left[width:]
            rng.shuffle(part)
            for e in part:
                hold.add(e, breach[e], str(e))
            until = (left[0] if left else 10 ** 9) - 1
            for end, firing, row in hold.judge(until):
                assert row == str(end)
                got[end] = firing
            hold = Hold(hold_us, slide_us, hold.state())   # as after a restart
            assert len(hold.breaches) <= hold_us // slide_us + 1
        assert got == want
    hold.add(ends[0], True, "late")
    assert not hold.waiting


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, WINDOWS).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, files=1):
    source = spark.readStream.schema(WINDOWS).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(folder)
    return source.withWatermark("window_end", "20 minutes")


def test_stream_equals_table_out_of_order_and_after_a_restart(spark, tmp_path):
    rows = series_rows()
    want = table_form(spark, rows)
    rng = random.Random(9)
    late = sorted(rows, key=lambda r: (r[1] + dt.timedelta(minutes=rng.randint(0, 15))))   # within the watermark's delay
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [late[i:i + 90] for i in range(0, len(late), 90)]

    def run():
        q = (held_stream(stream(spark, folder), "5 minutes", "1 minute", by=["series"]).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
        return q.recentProgress

    for i, part in enumerate(parts[:3]):
        write(spark, folder, f"p{i}", part)
    run()
    for i, part in enumerate(parts[3:]):
        write(spark, folder, f"q{i}", part)
    write(spark, folder, "r", [("z", START + dt.timedelta(days=1), 0.0, False)])   # lets the watermark pass all others
    progress = run()
    rows_out = spark.read.parquet(out).collect()
    got = {(r["series"], r["window_end"]): (r["firing"], r["share"]) for r in rows_out}
    assert len(rows_out) == len(got) == len(want) and got == want and 5 < sum(f for f, _ in got.values()) < len(got)
    state = [o for p in progress for o in p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in state) <= 4 * 4     # per series its hold and its timer, not its windows


LOG = "ts timestamp_ntz, status int, latency double"


def test_alerts_from_rows_out_of_order(spark, tmp_path):
    rng = random.Random(2)
    rows = [(START + dt.timedelta(seconds=13 * i), 500 if 150 < i < 260 else 200, (i % 50) / 200) for i in range(700)]
    late = sorted(rows, key=lambda r: r[0] + dt.timedelta(seconds=rng.randint(0, 500)))
    folder = str(tmp_path / "in")
    for i in range(0, 700, 100):
        spark.createDataFrame(late[i:i + 100], LOG).coalesce(1).write.parquet(f"{folder}/p{i}")
    last = START + dt.timedelta(days=1)
    spark.createDataFrame([(last, 200, 0.0)], LOG).coalesce(1).write.parquet(f"{folder}/z")
    source = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    shares = windows.error_share(source, "ts", "status", "5 minutes", "1 minute")
    q = jobs.start_alerts(shares, "5 minutes", "1 minute", str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    table = windows.held_breaches(windows.error_share(spark.createDataFrame(rows, LOG), "ts", "status", "5 minutes", "1 minute"), "5 minutes", "1 minute")
    want = {r["window_end"]: (r["firing"], round(r["share"], 9), r["requests"]) for r in table.collect()}
    stored = spark.read.parquet(str(tmp_path / "out" / "windows"))
    got = {r["window_end"]: (r["firing"], round(r["share"], 9), r["requests"]) for r in stored.collect()}
    assert got == want
    firing = {r["window_end"] for r in spark.read.parquet(str(tmp_path / "out" / "firing")).collect()}
    assert firing == {e for e, (f, _, _) in want.items() if f} and len(firing) > 5
    panes = [o for p in q.recentProgress for o in p["stateOperators"] if o["operatorName"] == "stateStoreSave"]
    assert len(panes) == 2 * len(q.recentProgress)    # panes, then windows of panes


def test_rows_are_not_copied_to_every_window(spark, tmp_path):
    spark.createDataFrame([(START, 200, 0.1)], LOG).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    for df in (windows.error_share(source, "ts", "status"), windows.latency_quantiles(source, "ts", "latency"),
               windows.flag_share(source.withColumn("flag", F.col("status")), "ts", "flag")):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert plan.count("Aggregate") == 2 and "Expand" not in plan[plan.rindex("Aggregate"):]


def test_sketch_ranks_are_within_the_stated_error(spark, tmp_path):
    """A stream's quantiles over merged panes against ranks counted from all values of a window."""
    n = 120_000
    value = F.when(F.col("id") % 13 == 0, None).otherwise(F.pmod(F.hash("id"), F.lit(1_000_003)) / 1000.0 + F.floor(F.col("id") / 40_000) * 300)
    df = spark.range(n).select((F.lit(START).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id / 100)")).alias("ts"), value.alias("latency"))
    df.write.parquet(str(tmp_path / "in" / "a"))
    spark.createDataFrame([(START + dt.timedelta(days=1), None)], df.schema).write.parquet(str(tmp_path / "in" / "b"))
    source = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = (windows.latency_quantiles(source, "ts", "latency", "10 minutes", "2 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = [(r["ts"], r["latency"]) for r in df.collect()]
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 14
    for w in got:
        inside = sorted(v for t, v in rows if w["window_start"] <= t < w["window_end"] and v is not None)
        for name, share in (("p50", 0.5), ("p95", 0.95)):
            below, upto = sum(v < w[name] for v in inside), sum(v <= w[name] for v in inside)
            off = max(0, below - share * len(inside), share * len(inside) - upto)
            assert off <= windows.RANK_ERROR * len(inside), (w, name)
    assert len(inside) > windows.SKETCH_K


def test_windows_without_known_latency(spark, tmp_path):
    rows = [(START, 200, None), (START + dt.timedelta(hours=1), 200, 0.5), (START + dt.timedelta(days=1), 200, 0.5)]
    spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(LOG).parquet(str(tmp_path / "in"))
    q = (windows.latency_quantiles(source, "ts", "latency", "1 minute", "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["window_start"], r["requests"], r["p50"], r["breach"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert [g[1:] for g in got] == [(1, None, None), (1, 0.5, True)]
