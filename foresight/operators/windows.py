"""Time-window operators over irregular series per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foresight.functions.columns import HOUR_US, block_of, micros
from foresight.operators.blocks import (
    BLOCK, BLOCK_HOURS, OWN, US, as_list, block_size, block_window, carried_last, previous_rows, running_totals, spread,
)

def over(keys, frame: str, order: str = US) -> str:
    """SQL window over the rows of one key and block."""
    return f"OVER (PARTITION BY {', '.join([*as_list(keys), BLOCK])} ORDER BY {order} {frame})"


ALL_ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
ROWS_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
ROWS_UP_TO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
UP_TO = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def behind(hours: int) -> str:
    """Frame of the rows at or before t - hours: what a left-open window of that length leaves out."""
    return f"RANGE BETWEEN UNBOUNDED PRECEDING AND {hours * HOUR_US}L PRECEDING"


def rolling_columns(
    df: DataFrame, keys, stats: Sequence[str], hours: Sequence[int], aggs: Sequence[str] = ("mean", "std"),
    sums: Sequence[tuple[str, int]] = (), complete: bool = False, extra: dict[str, str] | None = None,
) -> DataFrame:
    """Add `{value}_{agg}_{h}h` over (t - h, t] to rows that carry block columns.

    Each frame is a difference of two running totals, so the cost per row does not depend on how many readings
    a frame holds. Totals run over values centred on the block mean; a frame whose values are all equal has a
    deviation of exactly 0, as has a single value. `sums` lists (value, hours) pairs that only need totals.
    `complete` states that all values are missing on the same rows, which then share one count. `extra` are
    further SQL window columns to compute in the same pass.
    """
    count_of = {v: f"_n_{stats[0] if complete else v}" for v in stats}
    counted = {n: v for v, n in reversed(count_of.items())}
    with_std = "std" in aggs
    first = {f"_c_{v}": f"avg({v}) {over(keys, ALL_ROWS)}" for v in stats}
    if with_std:
        first |= {f"_p_{v}": f"last({v}, true) {over(keys, ROWS_BEFORE)}" for v in stats}
        first |= {f"_i{n}": f"count({v}) {over(keys, ROWS_UP_TO)}" for n, v in counted.items()}
    run = {n: f"count({v}) {over(keys, UP_TO)}" for n, v in counted.items()}
    for v in stats:
        run[f"_s_{v}"] = f"sum({v} - _c_{v}) {over(keys, UP_TO)}"
        if with_std:
            run[f"_q_{v}"] = f"sum(({v} - _c_{v}) * ({v} - _c_{v})) {over(keys, UP_TO)}"
            changed = f"{v} IS NOT NULL AND NOT ({v} <=> _p_{v})"
            run[f"_r_{v}"] = f"max(CASE WHEN {changed} THEN _i{count_of[v]} END) {over(keys, UP_TO)}"
    run |= {f"_t_{v}": f"sum({v}) {over(keys, UP_TO)}" for v, _ in sums}
    # all totals at the frame's lower end travel as one struct per window length
    lower = {}
    for h in sorted({*hours, *(h for _, h in sums)}):
        fields = [c for c in run if not c.startswith(("_r_", "_t_"))] if h in hours else []
        fields += [f"_t_{v}" for v, hv in sums if hv == h]
        lower[f"_b_{h}"] = f"last(struct({', '.join(fields)})) {over(keys, behind(h))}"

    def within(c: str, h: int) -> str:
        return f"(coalesce({c}, 0) - coalesce(_b_{h}.{c}, 0))"

    out = {}
    for h in hours:
        for v in stats:
            n, s = within(count_of[v], h), within(f"_s_{v}", h)
            if "mean" in aggs:
                out[f"{v}_mean_{h}h"] = f"try_divide({s}, {n}) + _c_{v}"
            if "count" in aggs:
                out[f"{v}_count_{h}h"] = n
            if "sum" in aggs:
                out[f"{v}_sum_{h}h"] = f"CASE WHEN {n} > 0 THEN {s} + {n} * _c_{v} END"
            if with_std:
                squares = f"greatest({within(f'_q_{v}', h)} - try_divide({s} * {s}, {n}), 0D)"
                varied = f"_r_{v} > coalesce(_b_{h}.{count_of[v]}, 0) + 1"
                out[f"{v}_std_{h}h"] = f"coalesce(CASE WHEN {varied} THEN sqrt(try_divide({squares}, {n} - 1)) END, 0D)"
    for v, h in sums:
        out[f"{v}_sum_{h}h"] = within(f"_t_{v}", h)
    for columns in (first, run, {**lower, **(extra or {})}):
        df = with_expressions(df, columns)
    kept = [c for c in df.columns if c not in {*first, *run, *lower}]
    return df.selectExpr(*kept, *[f"{e} AS {c}" for c, e in out.items()])


def with_expressions(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns given as SQL text in one projection."""
    return df.selectExpr("*", *[f"{e} AS {c}" for c, e in columns.items()])


def rolling(
    df: DataFrame, key, ts: str, values: Sequence[str], hours: Sequence[int],
    aggs: Sequence[str] = ("mean", "std"), block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Add `{value}_{agg}_{h}h` columns (mean, std, sum, count) over the left-open time frame (t - h, t]."""
    back = max(hours) * HOUR_US
    size = block_size(block_hours, back)
    blocks = spread(df.where(F.col(ts).isNotNull()).withColumn(US, micros(ts)), size, back=F.lit(back))
    rolled = rolling_columns(blocks, key, list(values), list(hours), aggs)
    return rolled.where(F.col(OWN)).drop(US, BLOCK, OWN)


def ffill(
    df: DataFrame, key, ts: str, cols: Sequence[str], limit: int | None = None, block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Carry the last known value forward, over at most `limit` consecutive rows (None: without limit)."""
    size = block_size(block_hours)
    base = df.withColumn(US, micros(ts))
    own = base.withColumn(BLOCK, block_of(F.col(US), size)).withColumn(OWN, F.lit(True))
    w = block_window(key)
    if limit is not None:
        rows = own.unionByName(previous_rows(base, key, size, limit))
        filled = {c: F.last(c, ignorenulls=True).over(w.rowsBetween(-limit, 0)) for c in cols}
    else:
        known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(US))).alias(c) for c in cols]
        carry = carried_last(own.groupBy(*as_list(key), BLOCK).agg(*known), key, cols)
        carry = carry.withColumn(US, F.col(BLOCK) * size - 1).withColumn(OWN, F.lit(False))
        rows = own.unionByName(carry, allowMissingColumns=True)
        filled = {c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in cols}
    return rows.withColumns(filled).where(F.col(OWN)).drop(US, BLOCK, OWN)


def dedup_last(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key: the one with the highest `seq` (unique per key). Copies are combined before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, seq)]
    best = df.groupBy(*keys).agg(*[F.max_by(c, seq).alias(c) for c in rest], F.max(seq).alias(seq))
    return best.select(*df.columns)


def latest_per_key(df: DataFrame, key, ts: str, tie: str | None = None) -> DataFrame:
    """Newest row of each key; older rows are pruned before the shuffle."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    rank = F.row_number().over(Window.partitionBy(*as_list(key)).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")


def first_seen(df: DataFrame, key, ts: str) -> DataFrame:
    """First time of each key."""
    return df.groupBy(*as_list(key)).agg(F.min(ts).alias("first_seen"))


def full_history(df: DataFrame, key, ts: str, hours: int) -> DataFrame:
    """Rows whose look-back of `hours` hourly readings is complete: ts >= first seen + (hours - 1) h."""
    keys = as_list(key)
    begin = first_seen(df, keys, ts)
    full = F.col(ts) >= F.col("first_seen") + F.expr(f"INTERVAL '{hours - 1}' HOUR")
    return df.join(begin, keys).where(full).drop("first_seen")


def gap_check(df: DataFrame, key, ts: str, hours: int = 1, block_hours: int = BLOCK_HOURS) -> DataFrame:
    """Add `gap`: true where the previous reading of the key is not exactly `hours` before (null for the first)."""
    size = block_size(block_hours)
    base = df.withColumn(US, micros(ts))
    own = base.withColumn(BLOCK, block_of(F.col(US), size)).withColumn(OWN, F.lit(True))
    rows = own.unionByName(previous_rows(base, key, size, 1))
    gap = (F.col(US) - F.lag(US).over(block_window(key))) != F.lit(hours * HOUR_US)
    return rows.withColumn("gap", gap).where(F.col(OWN)).drop(US, BLOCK, OWN)


def time_cuts(df: DataFrame, ts: str, fractions: Sequence[float]) -> DataFrame:
    """One row (cut0, cut1, ...): the elements at floor(f * n) of the sorted distinct times."""
    times = df.select(micros(ts).alias(US)).where(F.col(US).isNotNull()).groupBy(US).agg(F.lit(1).alias("one"))
    ranked = running_totals(times, US, ["one"])
    picks = [
        F.max(F.when(F.col("one_run") - 1 == F.floor(F.lit(float(f)) * F.col("one_all")), F.col(US))) for f in fractions
    ]
    return ranked.agg(*[F.timestamp_micros(p).cast("timestamp_ntz").alias(f"cut{i}") for i, p in enumerate(picks)])
