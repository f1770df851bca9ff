import datetime as dt

import numpy as np
import pandas as pd
import pytest

from foresight import schema as S
from foresight.plans.features import build_features
from foresight.plans.refresh import merged, read_features, reading_blocks, refresh_features, touched_blocks, write_features
from foresight.schema import PlantTables
from foresight.session import shuffle_parts
from tests.fixtures import SCHEMAS, frame, plant_pandas

PARTS, HOURS = 4, 48


def tables(spark, pdf):
    return PlantTables(**{k: frame(spark, k, v) if len(v) else spark.createDataFrame([], SCHEMAS[k]) for k, v in pdf.items()})


def cut(pdf, late):
    """Splits the fixture: `late` maps a table to the mask of its late rows."""
    masks = {k: late.get(k, pd.Series(False, index=v.index)) for k, v in pdf.items()}
    return {k: v[~masks[k]] for k, v in pdf.items()}, {k: v[masks[k]] for k, v in pdf.items()}


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def rows_of(df):
    return df.toPandas().sort_values(["machineID", "datetime"]).reset_index(drop=True)


def check(got, want):
    assert len(got) == len(want) and (got[["machineID", "datetime", "model"]] == want[["machineID", "datetime", "model"]]).all().all()
    for c in [*S.feature_columns()[0], S.LABEL]:
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9), c


def day(n, h=0):
    return pd.Timestamp("2015-01-01") + pd.Timedelta(days=n, hours=h)


CASES = {
    "one day of readings": lambda p: {"telemetry": (p["telemetry"].machineID == 2) & p["telemetry"].datetime.between(day(5), day(6))},
    "first readings": lambda p: {"telemetry": (p["telemetry"].machineID == 1) & (p["telemetry"].datetime < day(0, 30))},
    "corrected reading": lambda p: {"telemetry": p["telemetry"].duplicated(["machineID", "datetime"])},
    "new machine": lambda p: {"telemetry": p["telemetry"].machineID == 3, "machines": p["machines"].machineID == 3},
    "errors": lambda p: {"errors": p["errors"].datetime > day(7)},
    "services": lambda p: {"maint": p["maint"].datetime.between(day(4), day(6))},
    "failures": lambda p: {"failures": p["failures"].machineID == 2},
    "scattered": lambda p: {k: pd.Series(np.random.default_rng(5).random(len(p[k])) < 0.02, index=p[k].index) for k in ("telemetry", "errors", "maint", "failures")},
    "nothing": lambda p: {},
}


@pytest.mark.parametrize("case", ["one day of readings", "first readings", "new machine", "scattered", "nothing"])
def test_refreshed_table_equals_a_full_build(spark, tmp_path, case):
    pdf = plant_pandas()
    # a gap longer than blocks, with missing values before it, so that filling reaches over blocks
    pdf["telemetry"] = pdf["telemetry"][~((pdf["telemetry"].machineID == 2) & pdf["telemetry"].datetime.between(day(6, 1), day(11, 5)))].reset_index(drop=True)
    old, late = (tables(spark, p) for p in cut(pdf, CASES[case](pdf)))
    path = tmp_path / "features"
    write_features(old, str(path), block_hours=HOURS, parts=PARTS)
    before = files_of(path)
    folders = {f"_blk={r['_blk']}/part={r['part']}" for r in refresh_features(str(path), old, late, block_hours=HOURS, parts=PARTS).collect()}
    after = files_of(path)
    check(rows_of(read_features(spark, str(path))), rows_of(build_features(tables(spark, pdf), None, S.HORIZON_HOURS, block_hours=HOURS)))
    # files outside the touched folders are the very same, those inside are new
    changed = {f.rsplit("/", 1)[0] for f in before.keys() ^ after.keys()} | {f.rsplit("/", 1)[0] for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed <= folders
    assert bool(folders) == (case != "nothing")
    if case == "one day of readings":
        assert len(folders) < len({f.rsplit("/", 1)[0] for f in after})


@pytest.mark.parametrize("case", ["corrected reading", "errors", "services", "failures"])
def test_touched_blocks_hold_every_changed_row(spark, case):
    pdf = plant_pandas(machines=3, hours=300, gaps=0.5, nulls=0.6)
    old, late = (tables(spark, p) for p in cut(pdf, CASES[case](pdf)))
    size = HOURS * 3600 * 10**6
    touched = {(r[0], r[1]) for r in touched_blocks(old, late, reading_blocks(merged(old, late).telemetry, size), block_hours=HOURS).collect()}
    a, b = (rows_of(build_features(t, None, S.HORIZON_HOURS, block_hours=HOURS)).set_index(["machineID", "datetime"]) for t in (old, merged(old, late)))
    a, b = a.align(b)
    columns = [*S.feature_columns()[0], S.LABEL]
    differ = ~np.isclose(a[columns].astype(float), b[columns].astype(float), rtol=1e-9, atol=1e-9).all(1)
    assert differ.any()
    for m, at in a.index[differ]:
        assert (m, (at - pd.Timestamp(dt.datetime(1970, 1, 1))) // pd.Timedelta(hours=HOURS)) in touched


def test_table_is_written_where_it_is_built(spark, tmp_path):
    """No exchange between the build and the folders, whose files still number a few, and no shuffle files are left behind."""
    path = str(tmp_path / "features")
    built = write_features(tables(spark, plant_pandas(machines=12, hours=200)), path, block_hours=HOURS, parts=PARTS)
    folders = [f for f in (tmp_path / "features").glob("_blk=*/part=*")]
    assert len(folders) > PARTS and built.count() == sum(1 for _ in built.toLocalIterator())
    files = [len(list(f.glob("*.parquet"))) for f in folders]
    shares = PARTS * -(-shuffle_parts(spark) // PARTS)
    assert max(files) <= shares // PARTS
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_table_that_starts_empty(spark, tmp_path):
    pdf = plant_pandas(machines=2, hours=60)
    all_late = {k: pd.Series(True, index=v.index) for k, v in pdf.items()}
    old, late = (tables(spark, p) for p in cut(pdf, all_late))
    path = str(tmp_path / "features")
    assert write_features(old, path, block_hours=HOURS, parts=2).isEmpty()
    refresh_features(path, old, late, block_hours=HOURS, parts=2)
    check(rows_of(read_features(spark, path)), rows_of(build_features(late, None, S.HORIZON_HOURS, block_hours=HOURS)))
