"""Stage tables that are checked while they are written: a table that keeps its contract is read once from its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators import validate
from foresight.schema import KEY, TS, PlantTables, TableRule
from foresight.sources.tables import write_stage


def _missing(df: DataFrame, rule: TableRule) -> list[str]:
    return [c.name for c in rule.columns if c.name not in df.columns]


def write_observed(df: DataFrame, path: str, rule: TableRule, by_date: str | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Writes a stage and counts, in the same job, its rows (`rows`), the rows that break each row rule (`r0`, `r1`, … in the
    order of `row_rules`) and the missing values of columns with a limit on their share (`m0`, …).

    Counts are of the rows written by tasks that succeeded. Columns of these names may exist in the table."""
    seen = Observation()
    rules = validate.row_rules(rule)
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)]
    counts += [F.count_if(validate.missing(c)).alias(f"m{i}") for i, c in enumerate(rule.null_fraction)]
    stage = write_stage(df.observe(seen, *counts), path, by_date)
    return stage, {k: v or 0 for k, v in seen.get.items()}


def stage_table(df: DataFrame, path: str, table: str, rule: TableRule, by_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(stage, issues) of one table. Issues are those of `validate_table`.

    Row rules and shares of missing values come from the write. Only rules that were broken read their columns of the stage
    again, for the values; keys are counted on the stage's key columns. A table that lacks columns is stored unchecked."""
    spark = df.sparkSession
    if _missing(df, rule):
        return write_stage(df, path, by_date), validate.validate_table(df, table, rule)
    stage, n = write_observed(df, path, rule, by_date)
    broken = [r for i, r in enumerate(validate.row_rules(rule)) if n.get(f"r{i}")]
    parts = [validate.violations(stage, table, broken)] if broken else []
    if rule.unique and n.get("rows"):
        parts.append(validate.duplicates(stage, table, rule.unique))
    over = [(table, c, validate.share_check(limit), 1, []) for i, (c, limit) in enumerate(rule.null_fraction.items())
            if n.get("rows") and n[f"m{i}"] / n["rows"] > limit]
    issues = spark.createDataFrame(over, validate.ISSUES)
    return stage, issues if not parts else validate.issue_summary(reduce(DataFrame.union, parts)).unionByName(issues)


def stage_plant(t: PlantTables | dict[str, DataFrame], folder: str, contract: dict[str, TableRule] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Writes all given tables of the contract under `folder` and returns them with the issues of all, as `validate_tables`.

    Telemetry is stored in one folder a date, so jobs over a time range read that range."""
    tables = t.as_dict() if isinstance(t, PlantTables) else t
    spark = next(iter(tables.values())).sparkSession
    stages, parts = {}, []
    for name, rule in (contract or S.raw_contract()).items():
        if name not in tables:
            parts.append(validate.table_missing(spark, name))
            continue
        by_date = TS if name == "telemetry" and TS in tables[name].columns else None
        stages[name], issues = stage_table(tables[name], f"{folder}/{name}", name, rule, by_date)
        parts.append(issues)
    pair = stages.get("telemetry"), stages.get("machines")
    if all(s is not None and KEY in s.columns for s in pair):
        parts.append(validate.unknown_machines(*pair))
    return stages, reduce(DataFrame.unionByName, parts)


def stage_or_raise(t: PlantTables | dict[str, DataFrame], folder: str, contract: dict[str, TableRule] | None = None) -> dict[str, DataFrame]:
    """As `stage_plant`; the issue table goes to `folder`/issues, and any issue ends the job there."""
    stages, issues = stage_plant(t, folder, contract)
    validate.write_or_raise(issues, f"{folder}/issues")
    return stages
