"""Windowed service and prediction statistics. Each function takes a stream or a table and means the same on both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foresight.functions.columns import HOUR_US, micros, ratio
from foresight.operators.blocks import BLOCK, OWN, US, block_size, block_window, spread

WATERMARK = "10 minutes"
SKETCH_K, RANK_ERROR = 4096, 0.002
# Upper limits of the probability and latency (seconds) buckets.
PROBABILITY_BUCKETS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.25, 0.5, 1.0, 2.5)


def event_time(df: DataFrame, ts: str, watermark: str = WATERMARK) -> DataFrame:
    """`ts` as event time; late rows are bounded by the watermark on a stream, and all count in a table."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, watermark) if df.isStreaming else timed


def _windowed(df: DataFrame, ts: str, length: str, slide: str | None, by: Sequence[str], aggs: Sequence[Column],
              watermark: str, merged: dict[str, Column] | None = None) -> DataFrame:
    """Aggregates per window. Sliding windows merge panes of one slide, in a table as on a stream: a row enters the state
    (or the shuffle) once, in its pane, and only panes are copied to the windows that hold them.

    Aggregates are summed up over panes, or merged as `merged` says. A stream chains two stateful aggregations; the second one closes
    a window when the watermark has passed its end."""
    timed = event_time(df, ts, watermark)
    if slide and interval_us(length) % interval_us(slide) == 0:
        panes = timed.groupBy(F.window(ts, slide).alias("pane"), *by).agg(*aggs)
        merges = [(merged or {}).get(c, F.sum(c)).alias(c) for c in panes.columns if c not in ("pane", *by)]
        out = panes.groupBy(F.window("pane", length, slide).alias("w"), *by).agg(*merges)
    else:
        out = timed.groupBy(F.window(ts, length, slide or length).alias("w"), *by).agg(*aggs)
    names = [c for c in out.columns if c != "w"]
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), *names)


def _sketch(value: str | Column, shares: Sequence[float]) -> tuple[Column, Column, list[Column]]:
    """(sketch of a pane, its merge over panes, quantiles read from it) for streams: mergeable KLL sketches of fixed size.

    The rank of a quantile is off by less than RANK_ERROR of the known rows (99 % confidence), by nothing up to SKETCH_K rows."""
    k = F.lit(SKETCH_K)
    known = F.kll_sketch_get_n_double("q") > 0
    reads = [F.when(known, F.kll_sketch_get_quantile_double("q", F.lit(float(s)))) for s in shares]
    return F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("q"), F.kll_merge_agg_double("q", k), reads


def _ranked(df: DataFrame, ts: str, value: str, length: str, slide: str | None, watermark: str) -> DataFrame:
    """Per window and distinct value `_v` of a table: rows `_n`, known ones `_k`, their running and overall number.

    The distinct values of one window are sorted in one task, which spills."""
    counts = _windowed(df.select(ts, F.col(value).alias("_v")), ts, length, slide, ["_v"], [F.count(F.lit(1)).alias("_n")], watermark)
    whole = Window.partitionBy("window_start", "window_end")
    upto = whole.orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_k", F.when(F.col("_v").isNull(), 0).otherwise(F.col("_n"))).withColumns(
        {"_run": F.sum("_k").over(upto), "_all": F.sum("_k").over(whole)})


def _at(share: float) -> Column:
    """Exact quantile of the ranked values: the least one that the share of the known rows does not exceed."""
    return F.min(F.when((F.col("_k") > 0) & (F.col("_run") >= F.col("_all") * share), F.col("_v")))


def request_rate(df: DataFrame, ts: str, by: Sequence[str] = (), length: str = "1 minute", watermark: str = WATERMARK) -> DataFrame:
    """Requests per window, in total or by status."""
    return _windowed(df, ts, length, None, by, [F.count(F.lit(1)).alias("requests")], watermark)


def latency_quantiles(df: DataFrame, ts: str, latency: str, length: str = "5 minutes", slide: str = "15 seconds",
                      limit: float = 0.1, watermark: str = WATERMARK) -> DataFrame:
    """p50 and p95 latency (seconds) per sliding window; breach above the limit.

    Exact in a table; a stream merges a sketch per pane, see `_sketch`. Windows without a known latency have null quantiles."""
    if df.isStreaming:
        sketch, merge, reads = _sketch(latency, (0.5, 0.95))
        out = _windowed(df, ts, length, slide, (), [F.count(F.lit(1)).alias("requests"), sketch], watermark, {"q": merge})
        out = out.select("window_start", "window_end", "requests", reads[0].alias("p50"), reads[1].alias("p95"))
    else:
        out = _ranked(df, ts, latency, length, slide, watermark).groupBy("window_start", "window_end").agg(
            F.sum("_n").alias("requests"), _at(0.5).alias("p50"), _at(0.95).alias("p95"))
    return out.withColumn("breach", F.col("p95") > limit)


def error_share(df: DataFrame, ts: str, status: str, length: str = "5 minutes", slide: str = "15 seconds",
                limit: float = 0.01, watermark: str = WATERMARK) -> DataFrame:
    """Share of 5xx answers per sliding window; breach above the limit."""
    aggs = [F.count(F.lit(1)).alias("requests"), F.count_if(F.col(status) >= 500).alias("errors")]
    out = _windowed(df, ts, length, slide, (), aggs, watermark)
    return out.withColumn("share", ratio("errors", "requests")).withColumn("breach", F.col("share") > limit)


def flag_share(df: DataFrame, ts: str, flag: str, length: str = "1 hour", slide: str = "1 minute", limit: float = 0.3,
               watermark: str = WATERMARK) -> DataFrame:
    """Share of predicted failures per sliding window; breach above the limit."""
    aggs = [F.count(F.lit(1)).alias("predictions"), F.count_if(F.col(flag).cast("int") == 1).alias("flagged")]
    out = _windowed(df, ts, length, slide, (), aggs, watermark)
    return out.withColumn("share", ratio("flagged", "predictions")).withColumn("breach", F.col("share") > limit)


def score_distribution(df: DataFrame, ts: str, score: str, length: str = "5 minutes",
                       buckets: Sequence[float] = PROBABILITY_BUCKETS, watermark: str = WATERMARK) -> DataFrame:
    """Median, p90 and cumulative bucket counts of a score per window; quantiles as in `latency_quantiles`."""
    if not df.isStreaming:
        most = F.array(*[F.sum(F.when(F.col("_v") <= b, F.col("_k")).otherwise(0)) for b in buckets])
        return _ranked(df, ts, score, length, None, watermark).groupBy("window_start", "window_end").agg(
            F.sum("_k").alias("n"), _at(0.5).alias("median"), _at(0.9).alias("p90"), most.alias("at_most"))
    sketch, _, reads = _sketch(score, (0.5, 0.9))
    counts = F.array(*[F.count_if(F.col(score) <= b) for b in buckets])
    out = _windowed(df, ts, length, None, (), [sketch, counts.alias("at_most"), F.count(score).alias("n")], watermark)
    return out.select("window_start", "window_end", "n", reads[0].alias("median"), reads[1].alias("p90"), "at_most")


def held_breaches(windows: DataFrame, hold: str, slide: str, ts: str = "window_end", breach: str = "breach",
                  by: Sequence[str] = (), block_hours: int = 24) -> DataFrame:
    """Add `firing`: every window of the trailing hold exists and is in breach (a quiet window resets the hold)."""
    hold_us, slide_us = interval_us(hold), interval_us(slide)
    size = block_size(block_hours, hold_us)
    blocks = spread(windows.withColumn(US, micros(ts)), size, back=F.lit(hold_us))
    trailing = block_window(by).rangeBetween(-hold_us, 0)
    held = F.count_if(F.col(breach)).over(trailing) == F.lit(hold_us // slide_us + 1)
    return blocks.withColumn("firing", held).where(F.col(OWN)).drop(US, BLOCK, OWN)


def interval_us(text: str) -> int:
    """'5 minutes' -> microseconds."""
    number, unit = text.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * HOUR_US // 3600


def join_late_feedback(predictions: DataFrame, feedback: DataFrame, max_delay: str = "48 hours", ts: str = "ts",
                       feedback_ts: str = "feedback_ts", watermark: str = WATERMARK) -> DataFrame:
    """Predictions with the outcome that arrives within `max_delay`; without one, the outcome is null.

    On streams the unmatched row appears once the watermark has passed the delay.
    """
    p, f = event_time(predictions, ts, watermark), event_time(feedback, feedback_ts, watermark)
    f = f.withColumnRenamed("request_id", "_request_id")
    match = (F.col("request_id") == F.col("_request_id")) & (F.col(feedback_ts) >= F.col(ts)) & (
        F.col(feedback_ts) <= F.col(ts) + F.expr(f"INTERVAL {max_delay}"))
    return p.join(f, match, "left").drop("_request_id").withColumn("label", F.col("actual_failure").cast("int"))


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, watermark: str = WATERMARK) -> DataFrame:
    """First arrival of each key within the watermark (a batch job that must keep the last uses dedup_last)."""
    timed = event_time(df, ts, watermark)
    return timed.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else timed.dropDuplicates(list(keys))
