import numpy as np
import pytest
from pyspark.sql import functions as F

from foresight.operators import radix
from foresight.operators.blocks import exact_quantiles
from foresight.operators.drift import ks

PROBS = [0, 0.013, 0.1, 0.5, 0.77, 0.95, 1]


def columns():
    """Distributions that are hard to cut by width: heavy tails, ties, subnormal and huge values, infinities, few values."""
    r = np.random.default_rng(4)
    n = 3000
    out = {
        "normal": r.normal(100, 8, n), "heavy": np.exp(r.normal(0, 30, n)), "signed": r.standard_cauchy(n) ** 3, "ties": r.integers(0, 4, n).astype(float),
        "constant": np.full(n, 2.5), "mostly": np.where(r.random(n) < .9, 0.0, r.random(n)), "tiny": r.random(n) * 5e-324 * 2**20,
        "wide": np.where(r.random(n) < .5, 1.7e308, -1.7e308) * r.random(n), "close": 1 + r.integers(0, 50, n) * 2.0**-52,
        "infinite": np.where(r.random(n) < .1, np.inf, np.where(r.random(n) < .1, -np.inf, r.random(n)))}
    gone = r.random(n) < .2
    out["holes"] = np.where(gone, np.nan, r.random(n))
    out["nothing"] = np.full(n, np.nan)
    return out


@pytest.fixture(scope="module")
def table(spark):
    data = columns()
    rows = [(i % 3 > 0, *[None if i % 7 == 0 and np.isnan(v) else float(v) for v in row]) for i, row in enumerate(zip(*data.values()))]
    df = spark.createDataFrame(rows, "side boolean, " + ", ".join(f"{c} double" for c in data))
    return df.repartition(5), {k: v[~np.isnan(v)] for k, v in data.items()}, data


@pytest.fixture(params=[(64, 40), (4096, 1 << 18)], ids=["many passes", "one pass"])
def sizes(request, monkeypatch):
    monkeypatch.setattr(radix, "CELLS", request.param[0])
    monkeypatch.setattr(radix, "FEW_ROWS", request.param[1])


def test_quantiles_equal_sorting(table, sizes):
    df, known, data = table
    got = {r["feature"]: r["quantiles"] for r in exact_quantiles(df, list(data), PROBS).collect()}
    assert set(got) == set(data) - {"nothing"}
    for c, values in got.items():
        x = np.sort(known[c])
        for p, v in zip(PROBS, values):
            at = p * (len(x) - 1)
            low, high = x[int(at)], x[min(int(at) + 1, len(x) - 1)]
            with np.errstate(all="ignore"):
                want = low + (high - low) * (at - int(at))
            assert v == want or (np.isnan(v) and np.isnan(want)), (c, p)


def test_gaps_equal_all_values(table, sizes):
    df, _, data = table
    side = np.arange(3000) % 3 > 0
    got = {r["feature"]: r for r in ks(df.where("side"), df.where("not side"), list(data)).collect()}
    assert set(got) == set(data) - {"nothing"}
    for c, r in got.items():
        a, b = (np.sort(v[~np.isnan(v)]) for v in (data[c][side], data[c][~side]))
        at = np.concatenate([a, b])
        want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
        assert r["ks"] == pytest.approx(want, abs=1e-15), c


def test_no_distinct_values_are_shuffled(spark):
    """The exchange of a histogram pass is by cell; single values are only counted in open cells."""
    df = spark.range(200_000).select((F.pmod(F.hash("id"), F.lit(1_000_003)) / 7.0).alias("x"))
    seen = []

    def choose(cells):
        seen.append(len(cells.pos))
        below = cells.before("r")
        return (below <= 100_000) & (below + cells.r > 100_000)

    cells, values = radix.narrow(df, ["x"], choose)
    assert seen[0] <= radix.CELLS and values.count() < 200 and cells.r.sum() == 200_000
    assert radix.ranked_values(df.limit(0), ["x"], lambda n: [0]) == [{}]


def test_places_are_found_in_compiled_code(spark):
    """With several levels no lambda, which Spark interprets, and no filter that works the place out again."""
    tree = radix._Tree(spark, np.array([0.0, 0.0]), np.array([1.0, 2.0]), 16)
    tree.open(np.array([3, 20]))
    tree.add(np.array([0.2, 0.5]), np.array([0.25, 0.625]), 16)
    long = spark.createDataFrame([(0, 0.21), (0, 0.9), (1, 0.6), (1, 2.0)], "pos int, x double")
    out = tree.locate(long)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Generate explode") == 2
    assert sorted((r["pos"], r["x"], r["cell"]) for r in out.collect()) == [(0, 0.21, 3), (1, 0.6, 28)]
