"""Time splits, history slices, hour grids and reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.schema import KEY, TS, PlantTables


def ntz(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def splits_of(ranges: dict[str, tuple], ts: str = TS) -> Column:
    """Names of the half-open ranges [start, end) that hold the time: one, none, or several if ranges overlap."""
    hits = [F.when((F.col(ts) >= ntz(a)) & (F.col(ts) < ntz(b)), F.lit(n)) for n, (a, b) in ranges.items()]
    return F.filter(F.array(*hits), lambda n: n.isNotNull())


def split_summary(df: DataFrame, ranges: dict[str, tuple], ts: str = TS) -> DataFrame:
    """Rows, first and last time per split, and whether a split reaches into the next one."""
    tagged = df.select(F.explode(splits_of(ranges, ts)).alias("split"), ts)
    stats = tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    place = F.array_position(F.array(*[F.lit(n) for n in ranges]), F.col("split"))
    in_order = Window.orderBy("place")  # one row per split
    return stats.withColumn("place", place.cast("int")).withColumn(
        "overlap", F.coalesce(F.lag("last_ts").over(in_order) >= F.col("first_ts"), F.lit(False))
    )


def split_by_time(df: DataFrame, ranges: dict[str, tuple] | None = None, ts: str = TS) -> dict[str, DataFrame]:
    """{"train": ..., "val": ..., "test": ...}; raises if a part is empty or parts overlap in time."""
    ranges = ranges or S.SPLITS
    found = {r["split"]: r for r in split_summary(df, ranges, ts).collect()}  # one row per split
    for name, (start, end) in ranges.items():
        if name not in found:
            raise ValueError(f"split '{name}' {start}..{end} is empty")
    if any(r["overlap"] for r in found.values()):
        raise ValueError("consecutive splits overlap in time")
    return {n: df.where((F.col(ts) >= ntz(a)) & (F.col(ts) < ntz(b))) for n, (a, b) in ranges.items()}


def history_slice(t: PlantTables, as_of, hours: int = S.HISTORY_HOURS, ts: str = TS) -> PlantTables:
    """Telemetry and errors of [as_of - (hours - 1) h, as_of]; services and failures up to as_of."""
    end = ntz(as_of)
    start = end - F.expr(f"INTERVAL '{hours - 1}' HOUR")
    near, past = F.col(ts).between(start, end), F.col(ts) <= end
    failures = None if t.failures is None else t.failures.where(past)
    return PlantTables(t.telemetry.where(near), t.errors.where(near), t.maint.where(past), failures, t.machines)


def latest_time(df: DataFrame, ts: str = TS) -> Column:
    """Last time in the table, as a value other queries can use."""
    return df.agg(F.max(ts)).scalar()


def at_timestamp(df: DataFrame, as_of, ts: str = TS) -> DataFrame:
    return df.where(F.col(ts) == ntz(as_of))


def hour_grid(df: DataFrame, n: int, ts: str = TS) -> DataFrame:
    """Rows whose hour of day is a multiple of n."""
    return df.where(F.hour(ts) % n == 0)


def sample_rows(df: DataFrame, n: int, keys=(KEY, TS), seed: int = S.SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on any partitioning: those with the smallest key hash.

    Counting rows per hash prefix finds the prefix range that holds them, so only about n rows are sorted.
    """
    text = F.concat_ws("|", *[F.date_format(k, "yyyy-MM-dd HH:mm:ss") if k == TS else F.col(k).cast("string")
                              for k in keys], F.lit(str(seed)))
    hashed = df.withColumn("_h", F.md5(text)).withColumn("_p", F.substring("_h", 1, 4))
    prefixes = hashed.groupBy("_p").agg(F.count(F.lit(1)).alias("c"))  # at most 65,536 rows
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    last_prefix = (
        prefixes.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
        .where(F.col("before") < n)
        .agg(F.max("_p"))
        .scalar()
    )
    # rows that share their keys are told apart by their other columns
    return hashed.where(F.col("_p") <= last_prefix).orderBy("_h", *df.columns).limit(n).drop("_h", "_p")


def drop_columns(df: DataFrame, names=("probability", "prediction", "model_version")) -> DataFrame:
    return df.drop(*names)


def scale_columns_in_window(
    df: DataFrame, factors: dict[str, float], start, end, ts: str = TS, noise: dict[str, float] | None = None,
    seed: int = S.SEED, lead_hours: int = 24,
) -> DataFrame:
    """What-if shift of sensors in [start - lead, end): multiply, and optionally add normal noise of a deviation."""
    first = ntz(start) - F.expr(f"INTERVAL '{lead_hours}' HOUR")
    inside = (F.col(ts) >= first) & (F.col(ts) < ntz(end))
    noise = noise or {}
    changed = {
        c: F.when(inside, F.col(c) * f + (F.randn(seed) * noise[c] if c in noise else F.lit(0.0))).otherwise(F.col(c))
        for c, f in factors.items()
    }
    return df.withColumns(changed)


def relabel_above_quantile(df: DataFrame, value: str, q: float, where: Column, label: str) -> DataFrame:
    """What-if outcome: label 1 for rows of the subset at or above the subset's q-quantile of `value`."""
    from foresight.operators.blocks import exact_quantiles

    cut = exact_quantiles(df.where(where).select(value), [value], [q]).select(F.col("quantiles")[0]).scalar()
    return df.withColumn(label, F.when(where & (F.col(value) >= cut), F.lit(1)).otherwise(F.col(label)))
