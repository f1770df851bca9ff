"""Cutting long per-key histories into time blocks, and running totals in two levels.

A window partitioned by the key alone puts the whole history of a hot key into one task. Here the
partition is (key, time block): every row also goes to the neighbouring blocks that look back (or ahead)
at it, and what lies further back reaches a block as a small carried row. Results equal the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foresight.functions.columns import HOUR_US, block_of
from foresight.operators.radix import ranked_values

BLOCK_HOURS = 168
US, BLOCK, OWN = "_us", "_blk", "_own"


def null_safe_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal values of `by`, null being equal to null; keeps the left side's columns of that name."""
    right = right.withColumnsRenamed({b: f"_r_{b}" for b in by})
    on = reduce(lambda a, b: a & b, [left[b].eqNullSafe(right[f"_r_{b}"]) for b in by])
    return left.join(right, on, how).drop(*[f"_r_{b}" for b in by])


def as_list(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def block_size(block_hours: int, *reaches_us: int) -> int:
    """Block length in microseconds, at least as long as every look-back or look-ahead."""
    return max(block_hours * HOUR_US, 1, *reaches_us)


def spread(df: DataFrame, size: int, back: Column | int = 0, ahead: Column | int = 0) -> DataFrame:
    """Copy each row to every block that reaches it: `back` behind a block's start, `ahead` past its end."""
    us = F.col(US)
    home = block_of(us, size)
    first, last = block_of(us - ahead, size), block_of(us + back, size)
    return df.withColumn(BLOCK, F.explode(F.sequence(first, last))).withColumn(OWN, F.col(BLOCK) == home)


def block_window(keys, *order) -> Window:
    return Window.partitionBy(*as_list(keys), BLOCK).orderBy(*(order or (US,)))


def previous_rows(df: DataFrame, keys, size: int, rows: int, back: int = 0, order: Sequence[str] = (US,)) -> DataFrame:
    """The last `rows` rows before each block's look-back region, as extra rows of that block.

    Works on the few last rows of each block only; `row_number() <= n` is pruned before the shuffle.
    """
    cut = df.withColumn("_cut", block_of(F.col(US) + F.lit(back), size))
    newest = Window.partitionBy(*as_list(keys), "_cut").orderBy(*[F.col(c).desc() for c in order])
    tails = cut.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= rows).drop("_rn")
    return rows_before(tails, keys, rows, order)


def rows_before(tails: DataFrame, keys, rows: int, order: Sequence[str] = (US,)) -> DataFrame:
    """From the last `rows` rows of each region (`_cut`): the last `rows` rows before it, as extra rows of its block."""
    names = [c for c in tails.columns if c != "_cut"]
    along = Window.partitionBy(*as_list(keys)).orderBy(*order)
    row = F.struct(*names)
    seen = (
        tails.withColumn("_before", F.lag("_cut").over(along))
        .withColumn("_prev", F.collect_list(row).over(along.rowsBetween(-rows, -1)))
        .where(F.col("_before") < F.col("_cut"))
    )
    # a block without rows of its own region still sees the rows before it
    targets = F.when(F.col("_before") == F.col("_cut") - 1, F.array("_cut")).otherwise(
        F.array(F.col("_cut") - 1, F.col("_cut"))
    )
    exploded = seen.withColumn(BLOCK, F.explode(targets)).withColumn("_row", F.explode("_prev"))
    return exploded.select(*[F.col(f"_row.{c}").alias(c) for c in names], BLOCK).withColumn(OWN, F.lit(False))


def carried_last(summary: DataFrame, keys, values: Sequence[str]) -> DataFrame:
    """From one row per (key, block): the last known value of each column in the blocks before."""
    w = Window.partitionBy(*as_list(keys)).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*as_list(keys), BLOCK, *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])


def edges_below(edges: str, value: str, most: int) -> Column:
    """How many of the sorted `edges` (at most `most`) lie below `value`, by binary search."""
    steps = ", ".join(str(1 << i) for i in reversed(range(max(most - 1, 1).bit_length())))
    step = f"CASE WHEN b + s <= size({edges}) AND {edges}[b + s - 1] < {value} THEN b + s ELSE b END"
    return F.expr(f"aggregate(array({steps}), 0, (b, s) -> {step})")


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False,
    buckets: int | None = None, few_groups: bool = False,
) -> DataFrame:
    """Running and overall totals of `sums` along `order`, without one task seeing all rows.

    `df` holds one row per (by, order) value. Values are cut at quantiles into buckets of about equal size;
    bucket totals are accumulated first, then each bucket runs on its own. Adds `{c}_run` and `{c}_all`.
    There are as many buckets as shuffle partitions, at least 256. Null is a group value like any other. With
    `few_groups` (a fixed list of groups, such as features) the limits travel as one map, else they are joined.
    """
    by = list(by)
    buckets = buckets or max(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    base = df.withColumn("_g", group)
    probs = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    edges = F.array_sort(F.array_distinct(F.percentile_approx(order, probs, F.lit(10000))))
    # sums are kept here so that this branch and the main one share one exchange
    cuts = base.groupBy("_g").agg(edges.alias("edges"), *[F.sum(c).alias(f"{c}_all") for c in sums])
    limits = F.struct("edges", *[f"{c}_all" for c in sums])
    if few_groups or not by:
        lookup = cuts.agg(F.map_from_entries(F.collect_list(F.struct("_g", limits)))).scalar()
        cut = base.withColumn("_cut", F.element_at(lookup, F.col("_g")))
    else:
        cut = base.join(cuts.select("_g", limits.alias("_cut")), "_g").select(*base.columns, "_cut")
    # never null, so that no join filter on it moves below the aggregation that made `df`
    bucket = F.coalesce(edges_below("_cut.edges", order, buckets), F.lit(0))
    binned = cut.select(*base.columns, bucket.alias("_b"), *[F.col(f"_cut.{c}_all").alias(f"{c}_all") for c in sums])
    direction = F.col("_b").desc() if descending else F.col("_b").asc()
    before = Window.partitionBy("_g").orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        binned.groupBy("_g", "_b")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select("_g", "_b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums])
    )
    inside = (
        Window.partitionBy("_g", "_b")
        .orderBy(F.col(order).desc() if descending else F.col(order).asc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    out = binned.join(offsets, ["_g", "_b"])
    totals = reduce(
        lambda d, c: d.withColumn(f"{c}_run", F.col(f"{c}_before") + F.sum(c).over(inside)),
        sums,
        out,
    )
    return totals.drop("_g", "_b", *[f"{c}_before" for c in sums])


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), as_type: str = "double") -> DataFrame:
    """(keep..., feature, value) with one row per column of each row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(as_type).alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles, one row per (by, feature) with an array in the order of `probs`.

    Without groups the values at the ranks are selected by histograms (see `radix.py`), which runs at once and moves no
    distinct values. With groups, counts per distinct value and running counts replace a per-group value buffer, so no group has
    to fit a task. A column without known values has no row.
    """
    by = list(by)
    if not by:
        return _selected_quantiles(df, list(columns), [float(p) for p in probs])
    long = unpivot(df, columns, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counts = long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "value", ["n"], [*by, "feature"], few_groups=not by)
    below = F.col("n_run") - F.col("n")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < F.col("n_run")), F.col("value")))

    picks = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n_all") - 1)
        low = F.floor(position)
        picks += [at_rank(low).alias(f"lo{i}"), at_rank(F.least(low + 1, F.col("n_all") - 1)).alias(f"hi{i}"),
                  F.max(position - low).alias(f"f{i}")]
    wide = ranked.groupBy(*by, "feature").agg(*picks)
    values = [F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"f{i}") for i in range(len(probs))]
    return wide.select(*by, "feature", F.array(*values).alias("quantiles"))


def _selected_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    def ranks(n: int) -> list[int]:
        low = [math.floor(p * (n - 1)) for p in probs]
        return [*low, *(min(r + 1, n - 1) for r in low), n - 1]

    rows = []
    for name, found in zip(columns, ranked_values(df, columns, ranks)):
        if found:
            n = max(found) + 1
            at = [p * (n - 1) for p in probs]
            low = [found[math.floor(x)] for x in at]
            high = [found[min(math.floor(x) + 1, n - 1)] for x in at]
            rows.append((name, [a + (b - a) * (x - math.floor(x)) for a, b, x in zip(low, high, at)]))
    return df.sparkSession.createDataFrame(rows, "feature string, quantiles array<double>")
