"""As-of lookups between rows and events of the same key, as equi-joins and block windows (no range join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foresight.functions.columns import HOUR_US, block_of, clip, micros
from foresight.operators.blocks import BLOCK, BLOCK_HOURS, OWN, US, as_list, block_size, block_window, carried_last

DAY_US = 24 * HOUR_US


def label_forward(
    rows: DataFrame, events: DataFrame, key, ts: str, hours: int, label: str = "will_fail_24h", drop_censored: bool = False
) -> DataFrame:
    """Add 1 where an event of the key lies in (t, t + hours], else 0.

    With `drop_censored` rows whose horizon ends after the last time of `rows` go, as their outcome is not fully known.

    Time is cut into buckets of the horizon's length. A row's horizon touches its own bucket and the next,
    so two numbers per (key, bucket) decide: the last event in it and the first event of the next one.
    """
    keys, reach = as_list(key), hours * HOUR_US
    us = F.col(US)
    at = events.where(F.col(ts).isNotNull()).select(*keys, micros(ts).alias(US))
    sides = F.array(
        F.struct(block_of(us, reach).alias("b"), us.alias("last_in"), F.lit(None).cast("bigint").alias("first_next")),
        F.struct((block_of(us, reach) - 1).alias("b"), F.lit(None).cast("bigint").alias("last_in"),
                 us.alias("first_next")),
    )
    summary = (
        at.select(*keys, F.explode(sides).alias("_s"))
        .groupBy(*keys, F.col("_s.b").alias(BLOCK))
        .agg(F.max("_s.last_in").alias("_last_in"), F.min("_s.first_next").alias("_first_next"))
    )
    timed = rows.withColumn(US, micros(ts)).withColumn(BLOCK, block_of(F.col(US), reach))
    if drop_censored:
        timed = timed.where(us + F.lit(reach) <= rows.agg(F.max(micros(ts))).scalar())
    hit = (F.col("_last_in") > us) | (F.col("_first_next") <= us + F.lit(reach))
    return (
        timed.join(summary, [*keys, BLOCK], "left")
        .withColumn(label, F.when(hit, 1).otherwise(0))
        .select(*[c for c in rows.columns if c != label], label)
    )


def last_event_asof(
    rows: DataFrame, events: DataFrame, key, ts: str, code: str, codes: Sequence[str], cap_days: float | None = 365.0,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Add `days_since_{code}`: days since the latest event of each code with event time <= t.

    Never seen, or longer ago than the cap: the cap. Codes outside `codes` are ignored.
    """
    keys, size = as_list(key), block_size(block_hours)
    marks = [f"_last_{c}" for c in codes]
    timed = rows.withColumn(US, micros(ts)).withColumn(BLOCK, block_of(F.col(US), size)).withColumn(OWN, F.lit(True))
    at = (
        events.where(F.col(code).isin(list(codes)) & F.col(ts).isNotNull())
        .withColumn(US, micros(ts))
        .groupBy(*keys, US)
        .agg(*[F.max(F.when(F.col(code) == c, F.col(US))).alias(m) for c, m in zip(codes, marks)])
        .withColumn(BLOCK, block_of(F.col(US), size))
    )
    blocks = timed.select(*keys, BLOCK).distinct().unionByName(at.select(*keys, BLOCK, *marks), True)
    summary = blocks.groupBy(*keys, BLOCK).agg(*[F.max(m).alias(m) for m in marks])
    carry = carried_last(summary, keys, marks).withColumn(US, F.col(BLOCK) * size - 1)
    everything = timed.unionByName(at.unionByName(carry).withColumn(OWN, F.lit(False)), allowMissingColumns=True)
    upto = block_window(keys).rangeBetween(Window.unboundedPreceding, 0)
    days = {
        f"days_since_{c}": (F.col(US) - F.max(m).over(upto)).cast("double") / F.lit(float(DAY_US))
        for c, m in zip(codes, marks)
    }
    out = everything.withColumns(days).where(F.col(OWN))
    if cap_days is not None:
        out = out.withColumns({d: F.coalesce(clip(d, hi=cap_days), F.lit(cap_days)) for d in days})
    return out.select(*rows.columns, *days)


def attach_dimension(rows: DataFrame, dimension: DataFrame, key, columns: Sequence[str]) -> DataFrame:
    """Left equi join of attribute columns. Spark broadcasts the dimension only below its size threshold."""
    return rows.join(dimension.select(*as_list(key), *columns), as_list(key), "left")


def pivot_counts(events: DataFrame, key, ts: str, code: str, codes: Sequence[str]) -> DataFrame:
    """Events per (key, full hour) and code, one column per code of the fixed list."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    hits = [F.count_if(F.col(code) == c).alias(c) for c in codes]
    return events.where(F.col(ts).isNotNull()).groupBy(*as_list(key), hour.alias(ts)).agg(*hits)


def attach_hourly_counts(rows: DataFrame, counts: DataFrame, key, ts: str, codes: Sequence[str]) -> DataFrame:
    """Left join of hourly counts on (key, time); hours without a row are lost, rows without counts get 0."""
    keys = [*as_list(key), ts]
    return rows.join(counts, keys, "left").fillna(0, list(codes))


def unknown_keys(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys of `rows` that the dimension lacks."""
    return rows.where(F.col(key).isNotNull()).select(key).distinct().join(dimension.select(key), key, "left_anti")


def before_first(old: DataFrame, current: DataFrame, ts: str) -> DataFrame:
    """Rows of `old` earlier than the first time in `current`."""
    return old.where(F.col(ts) < current.agg(F.min(ts)).scalar())
