"""Long-running jobs: checked scoring of request streams, alert holds, and drift per window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foresight import schema as S
from foresight.operators.drift import SHARE_FLOOR, quantile_edges
from foresight.plans.models import Scorer
from foresight.plans.scoring import score_requests
from foresight.sources.logs import prediction_records
from foresight.streaming.holds import held_stream
from foresight.streaming.windows import WATERMARK, event_time


def _start(df: DataFrame, each, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_scoring(requests: DataFrame, scorer: Scorer, out: str, checkpoint: str, body: str = "body",
                  trigger: dict | None = None, limits: S.RequestContract = S.RequestContract()) -> StreamingQuery:
    """Score valid requests to `out`/predictions and set refused ones aside in `out`/quarantine.

    Each micro-batch owns its folder, so a retried batch replaces its own output. Its requests are written to
    `out`/requests first; scoring and refusing read that, and keep their steps in `out`/judged and `out`/scored.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        def store(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
            return df.sparkSession.read.parquet(f"{out}/{name}/batch={batch_id}")

        scored, rejected = score_requests(store(batch, "requests"), scorer, body, limits=limits, store=store)
        prediction_records(scored).write.mode("overwrite").json(f"{out}/predictions/batch={batch_id}")
        rejected.write.mode("overwrite").json(f"{out}/quarantine/batch={batch_id}")

    return _start(requests, each, checkpoint, trigger)


def start_alerts(windows: DataFrame, hold: str, slide: str, out: str, checkpoint: str,
                 trigger: dict | None = None, by: Sequence[str] = ()) -> StreamingQuery:
    """Append closed windows, with `firing`, to `out`/windows and those that hold a breach to `out`/firing.

    The hold is streaming state (`held_stream`): a micro-batch reads nothing that was stored before. Its part of either
    table lies in a folder of its own, so a retried batch replaces it."""

    def each(batch: DataFrame, batch_id: int) -> None:
        part = f"{out}/windows/batch={batch_id}"
        batch.write.mode("overwrite").parquet(part)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(part)
        stored.where("firing").write.mode("overwrite").parquet(f"{out}/firing/batch={batch_id}")

    return _start(held_stream(windows, hold, slide, by=by), each, checkpoint, trigger)


def edge_literals(ref: DataFrame, numeric: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Bin limits of the reference as plain numbers: at most bins + 1 per feature."""
    return {r["feature"]: list(r["edges"]) for r in quantile_edges(ref, numeric, bins).collect()}


CONSTANT = ("constant:equal", "constant:close", "constant:other")


def _bins(edges: dict[str, list[float]], categorical: Sequence[str]) -> Column:
    """Array of (feature, bin) of one row; missing values fall out."""

    def number(c: str, e: list[float]) -> Column:
        inner = F.array(*[F.lit(float(v)) for v in e[1:-1]]).cast("array<double>")
        x = F.col(c).cast("double")
        known = x.isNotNull() & ~F.isnan(x)
        if len(e) == 1:  # a constant reference: equal, close or different
            v = F.lit(float(e[0]))
            place = F.when(x == v, CONSTANT[0]).when(F.abs(x - v) <= 1e-8 + 1e-5 * F.abs(v), CONSTANT[1]).otherwise(CONSTANT[2])
            return F.when(known, F.struct(F.lit(c).alias("feature"), place.alias("bin")))
        return F.when(known, F.struct(F.lit(c).alias("feature"),
                                      F.size(F.filter(inner, lambda v: x >= v)).cast("string").alias("bin")))

    parts = [number(c, e) for c, e in edges.items() if e]
    parts += [F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("bin")))
              for c in categorical]
    return F.filter(F.array(*parts), lambda p: p.isNotNull())


def bin_counts(df: DataFrame, edges: dict[str, list[float]], categorical: Sequence[str] = (), ts: str | None = None,
               length: str = "1 day", watermark: str = WATERMARK) -> DataFrame:
    """Rows per (window, feature, bin): the only state a drift stream keeps. Without `ts` there is no window."""
    if ts is None:
        return df.select(F.explode(_bins(edges, categorical)).alias("b")).groupBy("b.feature", "b.bin").agg(
            F.count(F.lit(1)).alias("n"))
    timed = event_time(df, ts, watermark).select(ts, F.explode(_bins(edges, categorical)).alias("b"))
    out = timed.groupBy(F.window(ts, length).alias("w"), "b.feature", "b.bin").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "feature", "bin", "n")


def psi_per_window(counts: DataFrame, ref_counts: DataFrame) -> DataFrame:
    """(window_start, feature, psi) from window counts and reference counts.

    Reference bins without rows in a window add a fixed amount each: their total less that of the bins that occur.
    A constant reference has the index of `psi_numeric`: the share that moved, times the log of the share floor.
    A feature without known reference values has no index.
    """
    fixed = counts.where(F.col("bin").isin(*CONSTANT)).groupBy("window_start", "feature").agg(
        F.sum(F.when(F.col("bin") == CONSTANT[2], F.col("n"))).alias("far"),
        F.sum(F.when(F.col("bin") != CONSTANT[0], F.col("n"))).alias("other"), F.sum("n").alias("nc"))
    fixed = fixed.select("window_start", "feature", F.when(F.col("far").isNull(), 0.0).otherwise(
        F.col("other") / F.col("nc") * F.ln(F.lit(1 / SHARE_FLOOR))).alias("psi"))
    counts, ref_counts = (d.where(~F.col("bin").isin(*CONSTANT)) for d in (counts, ref_counts))
    floor = F.lit(SHARE_FLOOR)
    ref_all = ref_counts.groupBy("feature").agg(F.sum("n").alias("nr"))
    shares = ref_counts.join(ref_all, "feature").select(
        "feature", "bin", F.greatest(F.col("n") / F.col("nr"), floor).alias("r"))
    absent = (floor - F.col("r")) * F.ln(floor / F.col("r"))
    all_absent = shares.groupBy("feature").agg(F.sum(absent).alias("all_absent"))
    totals = counts.groupBy("window_start", "feature").agg(F.sum("n").alias("nc"))
    present = counts.join(totals, ["window_start", "feature"]).join(shares, ["feature", "bin"], "left")
    c = F.greatest(F.col("n") / F.col("nc"), floor)
    r = F.coalesce("r", floor)
    known = F.when(F.col("r").isNotNull(), absent).otherwise(0.0)
    sums = present.groupBy("window_start", "feature").agg(F.sum((c - r) * F.ln(c / r) - known).alias("s"))
    binned = sums.join(all_absent, "feature").select("window_start", "feature", (F.col("s") + F.col("all_absent")).alias("psi"))
    return binned.unionByName(fixed)


def drift_per_window(df: DataFrame, ref: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                     ts: str = S.TS, length: str = "1 day", bins: int = 10) -> DataFrame:
    """Drift of each time window of a table against the reference."""
    edges = edge_literals(ref, numeric, bins)
    return psi_per_window(bin_counts(df, edges, categorical, ts, length), bin_counts(ref, edges, categorical))


def start_drift_counts(df: DataFrame, edges: dict[str, list[float]], out: str, checkpoint: str,
                       categorical: Sequence[str] = (), ts: str = S.TS, length: str = "1 day",
                       trigger: dict | None = None) -> StreamingQuery:
    """Append the counts of closed windows to a table that `psi_per_window` reads."""
    counts = bin_counts(df, edges, categorical, ts, length)
    return (counts.writeStream.outputMode("append").format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
