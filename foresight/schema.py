"""Table contracts, fixed value lists and the feature list."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "machineID"
TS = "datetime"
LABEL = "will_fail_24h"

# Sensor names, enumerations, bounds and business parameters of the data contract.
SENSORS = ("volt", "rotate", "pressure", "vibration")
MODELS = ("model1", "model2", "model3", "model4")
ERROR_IDS = ("error1", "error2", "error3", "error4", "error5")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")
HARD_BOUNDS = {"volt": (50.0, 300.0), "rotate": (0.0, 1000.0), "pressure": (0.0, 300.0), "vibration": (0.0, 150.0)}
SOFT_BOUNDS = {"volt": (97.0, 256.0), "rotate": (138.0, 696.0), "pressure": (51.0, 186.0), "vibration": (14.0, 77.0)}
MACHINE_ID_RANGE = (1, 100)
AGE_RANGE = (0, 30)
MAX_NULL_FRACTION = 0.05
FFILL_ROWS = 3
WINDOW_HOURS = (3, 24)
ERROR_WINDOW_HOURS = 24
SAMPLE_EVERY_HOURS = 3
DAYS_SINCE_CAP = 365.0
HORIZON_HOURS = 24
HISTORY_HOURS = 24
COST_FALSE_NEGATIVE = 50000.0
COST_FALSE_POSITIVE = 5000.0
THRESHOLD_GRID = tuple(round(i / 100, 2) for i in range(2, 99))
GATE = {"min_recall": 0.80, "min_precision": 0.50, "max_p95_latency_ms": 100.0, "max_model_size_mb": 50.0,
        "must_beat_champion": True, "threshold_margin": 0.05}
MONITORING = {"reference_sample_rows": 20000, "psi_threshold": 0.2, "drift_share_threshold": 0.3, "min_recall": 0.70}
SLO = {"p95_latency_ms": 100.0, "error_rate": 0.01}
RECENT_WEIGHT = 5.0
MIN_HISTORY, MAX_HISTORY, MAX_BATCH = 24, 168, 500
SPLITS = {"train": ("2015-01-01", "2015-09-01"), "val": ("2015-09-01", "2015-11-01"),
          "test": ("2015-11-01", "2016-01-02")}
EXPERIMENTS = (
    {"name": "rule_baseline", "model": "rule", "params": {"feature": "vibration_mean_24h"}},
    {"name": "logreg", "model": "logreg", "params": {"C": 1.0}},
    {"name": "random_forest", "model": "random_forest",
     "params": {"n_estimators": 200, "max_depth": 12, "min_samples_leaf": 5}},
    {"name": "boosted_trees", "model": "boosted_trees",
     "params": {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.05, "subsample": 0.8,
                "colsample_bytree": 0.8}},
)
SEED = 42


def feature_columns(windows=WINDOW_HOURS) -> tuple[list[str], list[str]]:
    """Names of the model inputs: numbers first in the order models store them, then text columns."""
    rolled = [f"{s}_{stat}_{w}h" for w in windows for s in SENSORS for stat in ("mean", "std")]
    counts = [f"{e}_count_{ERROR_WINDOW_HOURS}h" for e in ERROR_IDS]
    since = [f"days_since_{c}" for c in COMPONENTS]
    return rolled + counts + since + ["age"], ["model"]


@dataclass(frozen=True)
class PlantTables:
    """The five plant tables; `telemetry` may carry a `seq` column that tells later readings from earlier ones."""

    telemetry: DataFrame
    errors: DataFrame
    maint: DataFrame
    failures: DataFrame | None
    machines: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: v for k, v in vars(self).items() if v is not None}


@dataclass(frozen=True)
class ColumnRule:
    name: str
    dtype: str
    nullable: bool = False
    between: tuple | None = None
    isin: tuple | None = None


@dataclass(frozen=True)
class TableRule:
    columns: tuple[ColumnRule, ...]
    unique: tuple[str, ...] = ()
    null_fraction: dict[str, float] = field(default_factory=dict)

    def spark_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.dtype)) for c in self.columns])


@dataclass(frozen=True)
class RequestContract:
    """Limits a request must keep; None sets none. Table jobs set none, a service may pass its own."""

    machine_ids: tuple[int, int] | None = None
    age: tuple[int, int] | None = None
    history: tuple[int, int] | None = None
    batch: int | None = None


SERVICE_REQUESTS = RequestContract(MACHINE_ID_RANGE, AGE_RANGE, (MIN_HISTORY, MAX_HISTORY), MAX_BATCH)


def raw_contract(machine_ids=None, max_null_fraction=MAX_NULL_FRACTION) -> dict[str, TableRule]:
    """Contract of the five raw tables."""
    when, machine = ColumnRule(TS, "timestamp_ntz"), ColumnRule(KEY, "bigint", between=machine_ids)
    sensors = tuple(ColumnRule(s, "double", nullable=True, between=HARD_BOUNDS[s]) for s in SENSORS)
    return {
        "telemetry": TableRule((when, machine, *sensors), (KEY, TS), {s: max_null_fraction for s in SENSORS}),
        "errors": TableRule((when, machine, ColumnRule("errorID", "string", isin=ERROR_IDS))),
        "maint": TableRule((when, machine, ColumnRule("comp", "string", isin=COMPONENTS))),
        "failures": TableRule((when, machine, ColumnRule("failure", "string", isin=COMPONENTS))),
        "machines": TableRule(
            (machine, ColumnRule("model", "string", isin=MODELS), ColumnRule("age", "int", between=AGE_RANGE)), (KEY,)
        ),
    }
