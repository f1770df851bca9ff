"""Exact order statistics by radix selection: histograms over ever narrower cells instead of a shuffle of distinct values.

A pass maps every value to one of a fixed number of cells between the least and the largest value, by arithmetic that never
reverses an order, and counts cells; partial counts combine before the shuffle, so it carries cells, not values. Cells that
may hold what is asked for (the rank of a quantile, the largest distance of two distribution functions) are cut again
between their own least and largest value. A cell whose least and largest values are equal is known exactly. When
the cells left hold few rows, their values are counted one by one. Results are exact, whatever the distribution; the driver
only sees histograms, at most `MAX_CELLS` cells a pass.

The table is scanned once for the limits and once a pass (two or three in all for sensors): give a stored one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096            # cells of one column in the first pass
MAX_CELLS = 1 << 18     # cells of all columns in one pass
FEW_ROWS = 1 << 18      # rows in open cells that are counted value by value
PASSES = 8


@dataclass
class Cells:
    """Cells of all columns, in order of column and value, with rows of both sides (`r`, `c`) and least and largest value."""
    pos: np.ndarray
    low: np.ndarray
    high: np.ndarray
    r: np.ndarray
    c: np.ndarray

    def take(self, index) -> Cells:
        return Cells(*(getattr(self, k)[index] for k in ("pos", "low", "high", "r", "c")))

    def before(self, name: str) -> np.ndarray:
        """Rows of that side in the cells before, within each column."""
        n = getattr(self, name)
        total = np.cumsum(n) - n
        return total - total[np.searchsorted(self.pos, self.pos)]

    def all(self, name: str, columns: int) -> np.ndarray:
        return np.bincount(self.pos, getattr(self, name), columns).astype(np.int64)


def _long(df: DataFrame, columns: Sequence[str], side: Column) -> DataFrame:
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(side.alias("_side"), F.posexplode(values).alias("pos", "x")).where("x IS NOT NULL AND NOT isnan(x)")


def _limits(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    finite = [F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in columns]
    row = df.agg(*[F.min(v) for v in finite], *[F.max(v) for v in finite]).first()
    both = np.array([np.nan if v is None else v for v in row], float).reshape(2, -1)
    return both[0], both[1]


class _Tree:
    """Where a value lies: one array lookup a pass. A node is a column, then a cell that is cut again."""

    def __init__(self, spark, low: np.ndarray, high: np.ndarray, width: int):
        self.spark, self.levels = spark, []
        self.add(low, high, width)

    def add(self, low: np.ndarray, high: np.ndarray, width: int) -> None:
        with np.errstate(all="ignore"):
            scale = width / (high - low)
        scale = np.where(np.isfinite(scale), scale, 0.0)
        self.levels.append({"low": np.nan_to_num(low), "scale": scale, "width": width, "child": None})

    def open(self, cells: np.ndarray) -> None:
        """Cells (numbers of the last level) that become nodes of the next one."""
        last = self.levels[-1]
        child = np.full(len(last["low"]) * last["width"], -1, np.int64)
        child[cells] = np.arange(len(cells))
        last["child"] = child

    def _columns(self, level: dict) -> tuple[Column, Column, Column | None]:
        """The arrays of a level, from a one-row subquery."""
        kinds = {"low": "array<double>", "scale": "array<double>", "child": "array<int>"}
        lists = {k: None if level[k] is None else level[k].tolist() for k in kinds}
        table = self.spark.createDataFrame([tuple(lists.values())], ", ".join(f"{k} {t}" for k, t in kinds.items()))
        t = table.select(F.struct(*kinds)).scalar()
        return tuple(None if lists[k] is None else t[k] for k in kinds)

    def locate(self, long: DataFrame) -> DataFrame:
        """Adds `cell`, the value's cell of the last level, or `open`, its number among the open cells if these are chosen; values
        in no open cell go."""
        x, node, columns = F.col("x"), F.col("pos"), long.columns
        for level in self.levels:
            low, scale, child = self._columns(level)
            place = (x - F.get(low, node)) * F.get(scale, node)
            inside = F.least(F.greatest(place, F.lit(0.0)), F.lit(level["width"] - 1.0)).cast("int")
            inside = F.when(x == float("-inf"), 0).otherwise(inside)   # a scale of 0 makes it no number
            cell, name = node * level["width"] + inside, "cell"
            if child is not None:
                cell, name = F.get(child, cell), "open"
            # exploding an array of one binds the place, so that it is worked out once a level, in compiled code
            long = long.select(*columns, F.explode(F.array(cell)).alias(name)).where(F.col(name) >= 0)
            node = F.col(name)
        return long


Choice = Callable[[Cells], np.ndarray]


def narrow(df: DataFrame, columns: Sequence[str], choose: Choice, side: Column | None = None) -> tuple[Cells, DataFrame | None]:
    """(cells, values): all cells in order, and for those still open the counts of single values as (pos, x, r, c), with `open`, the
    number of the cell among the open ones, or no table if none is open.

    `choose` marks the cells that may hold what is asked for; cells of one value are never cut. `side` tells rows of the first
    table (true, counted as r) from those of the second (c); without it all rows count as r."""
    side = F.lit(True) if side is None else side
    long = _long(df, columns, side)
    low, high = _limits(df, columns)
    tree = _Tree(df.sparkSession, low, high, max(16, min(CELLS, MAX_CELLS // len(columns))))
    known, nodes = None, np.arange(len(columns))      # nodes: place of each node of the last level in `known`
    for number in range(PASSES):
        counted = tree.locate(long).groupBy("cell").agg(
            F.count_if("_side").alias("r"), F.count_if(~F.col("_side")).alias("c"), F.min("x").alias("low"), F.max("x").alias("high")).toPandas()
        counted = counted.sort_values("cell")
        width, cell = tree.levels[-1]["width"], counted["cell"].to_numpy(np.int64)
        node = cell // width
        new = Cells(node if known is None else known.pos[nodes[node]], *(counted[k].to_numpy() for k in ("low", "high", "r", "c")))
        number_of = cell
        if known is None:
            known, place = new, np.arange(len(cell))
        else:   # cells of a node take its place
            keep = np.ones(len(known.pos), bool)
            keep[nodes] = False
            order = np.concatenate([np.flatnonzero(keep).astype(float), nodes[node] + (np.arange(len(cell)) + 1) / (len(cell) + 2)])
            sorted_ = np.argsort(order, kind="stable")
            old = known.take(keep)
            known = Cells(*(np.concatenate([getattr(old, k), getattr(new, k)])[sorted_] for k in ("pos", "low", "high", "r", "c")))
            place = np.argsort(sorted_, kind="stable")[keep.sum():]
        wanted = choose(known) & (known.low < known.high)
        mine = np.full(len(known.pos), -1, np.int64)
        mine[place] = number_of
        nodes = np.flatnonzero(wanted & (mine >= 0))
        rows = int((known.r + known.c)[nodes].sum())
        if not len(nodes):
            return known, None
        tree.open(mine[nodes])
        if rows <= FEW_ROWS or number == PASSES - 1 or 16 * len(nodes) > MAX_CELLS:
            break
        tree.add(known.low[nodes], known.high[nodes], max(16, min(CELLS, MAX_CELLS // len(nodes))))
    values = tree.locate(long).groupBy("pos", "open", "x").agg(
        F.count_if("_side").alias("r"), F.count_if(~F.col("_side")).alias("c"))
    return known, _running(values, known, nodes)


def _running(values: DataFrame, known: Cells, nodes: np.ndarray) -> DataFrame:
    """Adds r_run and c_run, the rows of the column up to each value; a window covers the values of one open cell."""
    start = values.sparkSession.createDataFrame([(known.before("r")[nodes].tolist(), known.before("c")[nodes].tolist())], "r array<bigint>, c array<bigint>")
    start = start.select(F.struct("r", "c")).scalar()
    upto = Window.partitionBy("pos", "open").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumns({f"{k}_run": F.get(start[k], F.col("open")) + F.sum(k).over(upto) for k in ("r", "c")})


def ranked_values(df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]) -> list[dict[int, float]]:
    """Per column the values at `ranks(n)`, from 0, among its n known values, exactly."""
    asked: dict[str, list[list[int]]] = {}

    def choose(cells: Cells) -> np.ndarray:
        if "ranks" not in asked:
            asked["ranks"] = [sorted(set(ranks(int(n)))) if n else [] for n in cells.all("r", len(columns))]
        below, wanted = cells.before("r"), np.zeros(len(cells.pos), bool)
        for p, own in enumerate(asked["ranks"]):
            a, b = np.searchsorted(cells.pos, [p, p + 1])
            if own:
                wanted[a + np.searchsorted(below[a:b], own, side="right") - 1] = True
        return wanted

    cells, values = narrow(df, columns, choose)
    found: list[dict[int, float]] = [{} for _ in columns]
    below = cells.before("r")
    for p, own in enumerate(asked["ranks"]):
        a, b = np.searchsorted(cells.pos, [p, p + 1])
        for rank in own:
            i = a + int(np.searchsorted(below[a:b], rank, side="right")) - 1
            if cells.low[i] == cells.high[i]:
                found[p][rank] = float(cells.low[i])
    if values is not None:
        left = [(p, int(r)) for p, own in enumerate(asked["ranks"]) for r in own if r not in found[p]]
        table = df.sparkSession.createDataFrame(left, "pos int, rank bigint")
        hits = values.join(table, "pos").where("rank >= r_run - r and rank < r_run")
        for row in hits.select("pos", "x", "rank").collect():   # one row a rank
            found[row["pos"]][row["rank"]] = row["x"]
    return found


def largest_gaps(df: DataFrame, columns: Sequence[str], side: Column) -> list[tuple[float | None, int, int]]:
    """Per column (largest distance of the two sides' distribution functions, rows of either side); null without rows on a side.

    At the end of a cell the distance is known; inside, it is bounded by the shares before and after. Only cells whose bound
    exceeds the largest known distance are cut."""
    n = {}

    def gaps(cells: Cells):
        for k in "rc":
            n[k] = cells.all(k, len(columns))
        share = {k: (cells.before(k) / np.maximum(n[k], 1)[cells.pos], (cells.before(k) + getattr(cells, k)) / np.maximum(n[k], 1)[cells.pos]) for k in "rc"}
        at_end = np.abs(share["r"][1] - share["c"][1])
        best = np.zeros(len(columns))
        np.maximum.at(best, cells.pos, at_end)
        bound = np.maximum(share["r"][1] - share["c"][0], share["c"][1] - share["r"][0])
        return best, bound > best[cells.pos]

    cells, values = narrow(df, columns, lambda cells: gaps(cells)[1], side)
    best, _ = gaps(cells)
    if values is not None:
        sizes = df.sparkSession.createDataFrame([(np.maximum(n["r"], 1).tolist(), np.maximum(n["c"], 1).tolist())], "r array<bigint>, c array<bigint>")
        sizes = sizes.select(F.struct("r", "c")).scalar()
        gap = F.abs(F.col("r_run") / F.get(sizes["r"], F.col("pos")) - F.col("c_run") / F.get(sizes["c"], F.col("pos")))
        for row in values.groupBy("pos").agg(F.max(gap).alias("gap")).collect():
            best[row["pos"]] = max(best[row["pos"]], row["gap"])
    return [(float(b) if r and c else None, int(r), int(c)) for b, r, c in zip(best, n["r"], n["c"])]
