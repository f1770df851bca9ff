"""Small hand-made tables."""

import numpy as np
import pandas as pd

from foresight.schema import SENSORS, PlantTables

SCHEMAS = {
    "telemetry": "datetime timestamp_ntz, machineID bigint, seq bigint, volt double, rotate double, pressure double, vibration double",
    "errors": "datetime timestamp_ntz, machineID bigint, errorID string",
    "maint": "datetime timestamp_ntz, machineID bigint, comp string",
    "failures": "datetime timestamp_ntz, machineID bigint, failure string",
    "machines": "machineID bigint, model string, age int",
}


def frame(spark, name: str, pdf: pd.DataFrame):
    columns = [c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")]
    rows = pdf[columns].astype(object).where(pdf[columns].notna(), None)
    rows = [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in rows.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, SCHEMAS[name])


def plant_pandas(machines=4, hours=400, seed=7, gaps=0.1, nulls=0.3, repeats=40, on_the_hour=False) -> dict[str, pd.DataFrame]:
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2015-01-01")
    tel = pd.DataFrame([(start + pd.Timedelta(hours=h), m) for m in range(1, machines + 1) for h in range(hours)],
                       columns=["datetime", "machineID"])
    centre = {"volt": (170, 40), "rotate": (446, 120), "pressure": (100, 30), "vibration": (40, 15)}
    for s, (mu, sd) in centre.items():
        tel[s] = rng.normal(mu, sd, len(tel))
        tel.loc[rng.random(len(tel)) < nulls, s] = np.nan
    tel = tel[rng.random(len(tel)) >= gaps].reset_index(drop=True)
    if repeats:
        again = tel.sample(repeats, random_state=1).copy()
        again["volt"] = 200.0
        tel = pd.concat([tel, again], ignore_index=True)
    tel["seq"] = np.arange(len(tel))

    def events(n, column, values):
        step = 60 if on_the_hour else 1
        at = start + pd.to_timedelta(rng.integers(0, hours * 60 // step, n) * step, unit="m")
        return pd.DataFrame({"datetime": at, "machineID": rng.integers(1, machines + 1, n), column: rng.choice(values, n)})

    return {
        "telemetry": tel,
        "errors": events(150, "errorID", ["error1", "error2", "error3", "error4", "error5"] + ([] if on_the_hour else ["error9"])),
        "maint": events(30, "comp", ["comp1", "comp2", "comp3"]),
        "failures": events(20, "failure", ["comp1", "comp2", "comp3", "comp4"]),
        "machines": pd.DataFrame({"machineID": range(1, machines + 1), "model": [f"model{i % 4 + 1}" for i in range(machines)],
                                  "age": [i * 3 for i in range(machines)]}),
    }


def plant(spark, **options) -> PlantTables:
    return PlantTables(**{k: frame(spark, k, v) for k, v in plant_pandas(**options).items()})


def expected_features(t: dict[str, pd.DataFrame], horizon=24) -> pd.DataFrame:
    """Row-by-row calculation of the feature table, straight from its definition."""
    soft = {"volt": (97, 256), "rotate": (138, 696), "pressure": (51, 186), "vibration": (14, 77)}
    out = []
    services = pd.concat([t["maint"], t["failures"].rename(columns={"failure": "comp"})])
    for m, g in t["telemetry"].sort_values("seq").groupby("machineID"):
        g = g.drop_duplicates("datetime", keep="last").sort_values("datetime").reset_index(drop=True)
        for s in SENSORS:
            lo, hi = soft[s]
            g[s] = g[s].ffill(limit=3).fillna((lo + hi) / 2).clip(lo, hi)
        err = t["errors"][t["errors"]["machineID"] == m].assign(hour=lambda d: d["datetime"].dt.floor("h"))
        err = err[err["hour"].isin(g["datetime"])]
        serv = services[services["machineID"] == m]
        fails = t["failures"][t["failures"]["machineID"] == m]["datetime"]
        machine = t["machines"].set_index("machineID").loc[m]
        times = g["datetime"].to_numpy()
        for i, now in enumerate(g["datetime"]):
            if now < g["datetime"][0] + pd.Timedelta(hours=23):
                continue
            row = {"machineID": m, "datetime": now, "model": machine["model"], "age": float(machine["age"])}
            for w in (3, 24):
                part = g[(times > np.datetime64(now - pd.Timedelta(hours=w))) & (times <= np.datetime64(now))]
                for s in SENSORS:
                    row[f"{s}_mean_{w}h"] = part[s].mean()
                    row[f"{s}_std_{w}h"] = part[s].std() if len(part) > 1 else 0.0
            recent = err[(err["hour"] > now - pd.Timedelta(hours=24)) & (err["hour"] <= now)]
            for k in range(1, 6):
                row[f"error{k}_count_24h"] = float((recent["errorID"] == f"error{k}").sum())
            for k in range(1, 5):
                past = serv[(serv["comp"] == f"comp{k}") & (serv["datetime"] <= now)]["datetime"]
                row[f"days_since_comp{k}"] = min((now - past.max()) / pd.Timedelta(days=1), 365.0) if len(past) else 365.0
            row["will_fail_24h"] = int(((fails > now) & (fails <= now + pd.Timedelta(hours=horizon))).any())
            out.append(row)
    return pd.DataFrame(out)
