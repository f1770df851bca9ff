"""Data contracts as jobs: rule violations of whole tables, with counts and up to five examples each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.functions.columns import is_finite, parse_timestamp
from foresight.operators.asof import unknown_keys
from foresight.schema import KEY, ColumnRule, TableRule

_LONG = "`table` string, `column` string, `check` string, value string, n bigint"
ISSUES = "`table` string, `column` string, `check` string, `count` bigint, examples array<string>"
EXAMPLES = 5


class DataValidationError(RuntimeError):
    """The data breaks the contract; carries the issue rows."""

    def __init__(self, issues: list):
        self.issues = issues
        super().__init__("; ".join(f"{i['table']}.{i['column']}: {i['check']} (n={i['count']})" for i in issues))


def _number(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def _typed(rule: ColumnRule) -> Column:
    raw = F.col(rule.name)
    typed = parse_timestamp(raw) if rule.dtype.startswith("timestamp") else raw.try_cast(rule.dtype)
    return F.when(~F.isnan(typed), typed) if rule.dtype == "double" else typed


def missing(name: str) -> Column:
    """Null, or a number that is none."""
    return F.col(name).isNull() | F.isnan(F.col(name).try_cast("double"))


def share_check(limit: float) -> str:
    return f"sensor null fraction > {int(limit * 100)}%"


def table_missing(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(name, None, "table missing", 1, [])], ISSUES)


def row_rules(rule: TableRule) -> list[tuple[str, str, Column]]:
    """(column, check, violated) of every rule that one row can break on its own."""
    out = []
    for c in rule.columns:
        raw, typed = F.col(c.name), _typed(c)
        absent = missing(c.name) if c.dtype == "double" else raw.isNull()
        if c.dtype != "string":
            out.append((c.name, f"dtype('{c.dtype}')", ~absent & typed.isNull()))
        if not c.nullable:
            out.append((c.name, "not_nullable", absent))
        if c.between:
            lo, hi = c.between
            out.append((c.name, f"in_range({_number(lo)}, {_number(hi)})", ~typed.between(lo, hi)))
        if c.isin:
            out.append((c.name, f"isin({', '.join(c.isin)})", ~typed.isin(list(c.isin))))
    return out


def violations(df: DataFrame, table: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Violated (column, check, value) with counts, all rules in one pass over the table."""
    hits = F.array(*[
        F.when(bad, F.struct(F.lit(col).alias("column"), F.lit(check).alias("check"),
                             F.col(col).cast("string").alias("value")))
        for col, check, bad in rules
    ])
    found = df.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
    return (
        found.groupBy("h.column", "h.check", "h.value").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(table).alias("table"), "column", "check", "value", "n")
    )


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicates(df: DataFrame, table: str, keys) -> DataFrame:
    """Repeated keys: every row of a repeated group counts, once per key column."""
    per_column = F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).cast("string").alias("value")) for k in keys])
    check = "multiple_fields_uniqueness" if len(keys) > 1 else "field_uniqueness"
    return (
        duplicate_groups(df, keys).select(F.explode(per_column).alias("h"), "n")
        .groupBy("h.column", "h.value").agg(F.sum("n").alias("n"))
        .select(F.lit(table).alias("table"), "column", F.lit(check).alias("check"), "value", "n")
    )


def null_fractions(df: DataFrame, columns) -> DataFrame:
    """(column, fraction) of missing values, one pass."""
    row = df.agg(*[F.avg(missing(c).cast("double")).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("fraction")) for c in columns])
    return row.select(F.inline(pairs))


def issue_summary(long: DataFrame) -> DataFrame:
    """One row per (table, column, check): number of violations and the first examples in text order.

    Counts and examples read the same rows and columns, neither filtered before its aggregation, so Spark makes `long` once."""
    group = ["table", "column", "check"]
    counts = long.groupBy(*group).agg(F.sum("n").alias("count")).withColumn("value", F.lit(None).cast("string"))
    first = Window.partitionBy(*group).orderBy(F.asc_nulls_last("value"), "n")
    top = long.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= EXAMPLES)
    both = counts.unionByName(top.select(*group, F.lit(None).cast("bigint").alias("count"), "value"))
    return both.groupBy(*group).agg(F.max("count").alias("count"), F.array_sort(F.collect_list("value")).alias("examples"))


def validate_table(df: DataFrame, table: str, rule: TableRule) -> DataFrame:
    """Issues of one table; if columns are missing, that is its only issue."""
    spark = df.sparkSession
    lost = [c.name for c in rule.columns if c.name not in df.columns]
    if lost:
        return spark.createDataFrame([(table, ",".join(lost), "column missing", len(lost), lost[:EXAMPLES])],
                                     ISSUES)
    long = violations(df, table, row_rules(rule))
    if rule.unique:
        long = long.unionByName(duplicates(df, table, rule.unique))
    issues = issue_summary(long)
    if rule.null_fraction:
        limits = F.create_map(*[x for c, v in rule.null_fraction.items() for x in (F.lit(c), F.lit(v))])
        over = null_fractions(df, list(rule.null_fraction)).where(F.col("fraction") > limits[F.col("column")])
        names = F.create_map(*[F.lit(x) for c, v in rule.null_fraction.items() for x in (c, share_check(v))])
        check = names[F.col("column")]
        issues = issues.unionByName(over.select(
            F.lit(table).alias("table"), "column", check.alias("check"), F.lit(1).cast("bigint").alias("count"),
            F.array().cast("array<string>").alias("examples")))
    return issues


def unknown_machines(telemetry: DataFrame, machines: DataFrame) -> DataFrame:
    ids = unknown_keys(telemetry, machines, KEY)
    return issue_summary(ids.select(
        F.lit("telemetry").alias("table"), F.lit(KEY).alias("column"),
        F.lit("unknown machine (not in machines table)").alias("check"),
        F.col(KEY).cast("string").alias("value"), F.lit(1).cast("bigint").alias("n")))


def validate_tables(tables: dict[str, DataFrame], contract: dict[str, TableRule] | None = None,
                    spark: SparkSession | None = None) -> DataFrame:
    """All issues of all tables: (table, column, check, count, examples); empty when the data keeps the contract."""
    contract = contract or S.raw_contract()
    spark = spark or next(iter(tables.values())).sparkSession
    parts = []
    for name, rule in contract.items():
        if name in tables:
            parts.append(validate_table(tables[name], name, rule))
        else:
            parts.append(table_missing(spark, name))
    pair = tables.get("telemetry"), tables.get("machines")
    if all(t is not None and KEY in t.columns for t in pair):
        parts.append(unknown_machines(*pair))
    return reduce(DataFrame.unionByName, parts)


def validate_or_raise(tables: dict[str, DataFrame], contract: dict[str, TableRule] | None = None,
                      report_dir: str | None = None) -> DataFrame:
    """Stop the line on any issue; the issue table is written first when a folder is given."""
    return write_or_raise(validate_tables(tables, contract), report_dir)


def write_or_raise(issues: DataFrame, report_dir: str | None = None) -> DataFrame:
    """Writes the issue table where a folder is given, and raises if it has rows."""
    if report_dir:
        issues.write.mode("overwrite").parquet(report_dir)
        issues = issues.sparkSession.read.parquet(report_dir)
    found = issues.collect()  # at most one row per table, column and rule
    if found:
        raise DataValidationError(found)
    return issues


def validate_features(df: DataFrame, numeric, models=S.MODELS) -> DataFrame:
    """Issues of a feature table: values that are not finite, models outside the list."""
    rules = [(c, "finite", ~is_finite(c)) for c in numeric]
    rules.append(("model", f"isin({', '.join(models)})", ~F.col("model").isin(list(models)) | F.col("model").isNull()))
    return issue_summary(violations(df, "features", rules))
