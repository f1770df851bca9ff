"""Run registered queries against their SQL in DuckDB:  python -m checks.compare [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

from checks.oracles import oracle_sql
from checks.queries import REGISTRY
from foresight.session import get_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, (list, tuple)) or hasattr(x, "tolist") and not isinstance(x, (int, float)):
        x = x.tolist() if hasattr(x, "tolist") else x
        return "[" + ",".join(_cell(v) for v in x) + "]" if isinstance(x, (list, tuple)) else _cell(x)
    if isinstance(x, bool):
        return str(int(x))
    if isinstance(x, (int, float)):
        return repr(float(x) + 0.0)
    return str(x)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in row) for row in pdf.itertuples(index=False, name=None))


def compare(spark, con, name: str, sf_dir: str, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    got = REGISTRY[name](spark, sf_dir).toPandas()
    t1 = time.time()
    want = con.execute(sql).fetchdf()
    times = f"spark {t1 - t0:.1f}s sql {time.time() - t1:.1f}s"
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = rows_of(got), rows_of(want)
    if a == b:
        return True, f"{len(a)} rows, {times}"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    return False, f"rows {len(a)} vs {len(b)}; differing {len(differing)}; first {differing[:1]}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(REGISTRY)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                 "spark.ui.enabled": "false",
                                                 "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), []
    for name in names:
        t0 = time.time()
        try:
            if name in sqls:
                ok, note = compare(spark, con, name, sf_dir, sqls[name])
            else:
                ok, note = True, f"{len(REGISTRY[name](spark, sf_dir).collect())} rows (rows only)"
        except Exception as e:  # noqa: BLE001 - a report line per query
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - t0:6.1f}s {note}", flush=True)
        bad += [] if ok else [name]
    print(f"{len(names) - len(bad)}/{len(names)} ok", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
