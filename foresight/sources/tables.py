"""Plant tables from CSV, stage tables in Parquet, report and score files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.functions.columns import coerce, parse_timestamp
from foresight.schema import KEY, TS, PlantTables

# Fixed file names of the raw tables.
CSV_FILES = {
    "telemetry": "PdM_telemetry.csv", "errors": "PdM_errors.csv", "maint": "PdM_maint.csv",
    "failures": "PdM_failures.csv", "machines": "PdM_machines.csv",
}


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV with every column as text: types are checked by the contract, not guessed."""
    return spark.read.option("header", True).csv(path)


def typed(df: DataFrame, rule: S.TableRule) -> DataFrame:
    """Contract columns in their declared types; what does not parse becomes null. Other columns stay."""
    out = {}
    for c in rule.columns:
        if c.name not in df.columns:
            continue
        if c.dtype.startswith("timestamp"):
            out[c.name] = parse_timestamp(c.name)
        elif c.dtype == "double":
            out[c.name] = coerce(c.name)
        else:
            out[c.name] = F.col(c.name).try_cast(c.dtype)
    return df.withColumns(out)


def load_plant_csv(spark: SparkSession, folder: str, files: dict[str, str] | None = None, with_seq: bool = False) -> PlantTables:
    """The five plant tables of a folder.

    `with_seq` adds the order of telemetry rows in their file (start of the file block plus a row counter, which
    stays below the block's length), which "keep the last reading" needs when a file repeats (machine, time).
    """
    contract, tables = S.raw_contract(), {}
    for name, file in {**CSV_FILES, **(files or {})}.items():
        raw = read_raw_csv(spark, f"{folder}/{file}")
        if with_seq and name == "telemetry":
            counter = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            raw = raw.withColumn("seq", F.col("_metadata.file_block_start") + counter)
        tables[name] = typed(raw, contract[name])
    return PlantTables(**tables)


def write_stage(df: DataFrame, path: str, by_date: str | None = None) -> DataFrame:
    """Write a stage table as Parquet (optionally one folder per date, for pruning) and read it back."""
    out = df.withColumn("date", F.to_date(by_date)) if by_date else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy("date") if by_date else writer).parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)  # an empty table may have no file to tell its columns


def write_scores_csv(df: DataFrame, folder: str, as_of) -> str:
    """Ranked scores under scores_<YYYYmmdd_HHMM>; files are in rank order."""
    path = f"{folder}/scores_{as_of:%Y%m%d_%H%M}"
    ranked = df.orderBy(F.desc("failure_probability"), KEY)
    ranked.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_experiment_tables(comparison: DataFrame, importance: DataFrame | None, folder: str) -> None:
    comparison.write.mode("overwrite").option("header", True).csv(f"{folder}/comparison")
    if importance is not None:
        importance.write.mode("overwrite").option("header", True).csv(f"{folder}/feature_importance")


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows, columns) of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(",".join(df.columns)).alias("columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def file_version(spark: SparkSession, paths: list[str]) -> str:
    """12-character version of a set of files: md5 over names and content hashes in name order."""
    files = spark.read.format("binaryFile").load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    hashed = files.select(F.struct(name.alias("name"), F.md5("content").alias("md5")).alias("f"))
    joined = F.concat_ws("", F.transform(F.array_sort(F.collect_list("f")), lambda f: F.concat(f["name"], f["md5"])))
    return hashed.agg(F.substring(F.md5(joined.cast("binary")), 1, 12)).first()[0]


def table_version(df: DataFrame) -> DataFrame:
    """Order-independent fingerprint of a table of any size: columns with types, row count, sum and xor of row hashes.

    A row is hashed as its values in column order, each with its length before it, so no two rows read the same."""
    kinds = dict(df.dtypes)
    names = ",".join(f"{c}:{kinds[c]}" for c in sorted(df.columns))
    value = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    text = F.concat(*[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in value])
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    row = df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x"))
    return row.select("n_rows", F.substring(F.md5(F.concat_ws(
        "|", F.lit(names), F.col("n_rows").cast("string"), F.col("s").cast("string"), F.col("x").cast("string"))), 1, 12).alias("version"))
