"""Plant tables derived from the `events` table, in Spark and as SQL text.

Every user is a machine with an hourly grid of readings over the whole time span of the events; "view" events
repeat a reading of their hour with other values, so deduplication has work to do. Readings have runs of nulls
and missing hours. All numbers come from integer arithmetic with one decimal, equal in both engines.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foresight.schema import PlantTables
from foresight.session import enough_partitions

# (sensor, value, condition for a missing value) of machine m in hour i
_GRID = (
    ("volt", "170 + ((m * 7919 + i * 104729) % 1000 - 500) / CAST(10 AS DOUBLE)", "(m * 31 + i * 17) % 97 < 3"),
    ("rotate", "450 + ((m * 6101 + i * 7577) % 1000 - 500) * 7 / CAST(10 AS DOUBLE)", "(m * 13 + i * 7) % 89 < 2"),
    ("pressure", "100 + ((m * 4421 + i * 9973) % 1000 - 500) / CAST(10 AS DOUBLE)", "(m * 5 + hour6) % 41 = 0"),
    ("vibration", "40 + ((m * 3571 + i * 8101) % 500 - 250) / CAST(10 AS DOUBLE)", "(m * 3 + i) % 101 < 2"),
)
_MISSING_HOURS = "(m * 17 + i) % 53 = 0 OR (m % 7 = 3 AND i BETWEEN 200 AND 260) OR (m % 11 = 5 AND i % 168 > 20)"


def _reading_columns() -> str:
    return ", ".join(f"CASE WHEN {miss} THEN NULL ELSE {value} END AS {name}" for name, value, miss in _GRID)


GRID_ROWS = 250_000  # readings of the grid that one task makes, and that a partition of a shuffle starts with


def grid_parts(events: DataFrame) -> int:
    """Tasks of the grid, by the number of its rows: the ids it is made from are too few bytes to keep them apart."""
    hours = F.timestamp_diff("HOUR", F.min("ts"), F.max("ts")) + 24
    rows = events.agg(F.approx_count_distinct("user_id") * F.coalesce(hours, F.lit(0))).first()[0]
    return max(1, math.ceil(rows / GRID_ROWS))


def plant_tables(spark: SparkSession, sf_dir: str) -> PlantTables:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    parts = grid_parts(events)
    enough_partitions(spark, parts)
    start = events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")).scalar()
    last = events.agg(F.max("ts")).scalar()
    ids = events.select(F.col("user_id").alias("machineID")).distinct()
    machines = ids.select("machineID", F.expr("concat('model', machineID % 4 + 1)").alias("model"),
                          F.expr("CAST(machineID % 21 AS INT)").alias("age"))
    hours = F.timestamp_diff("HOUR", start, last).cast("bigint")
    grid = (
        # a fixed number of partitions is not coalesced by their size, which is that before the hours are unfolded; by the key it
        # would be left out where the distinct ids already come in as many partitions, and those are coalesced
        ids.repartition(parts)
        .select(F.col("machineID").alias("m"), start.alias("t0"),
                   F.explode(F.sequence(F.lit(0).cast("bigint"), hours)).alias("i"))
        .where(f"NOT ({_MISSING_HOURS})")
        .withColumn("hour6", F.expr("i div 6"))
        .selectExpr(
            "m AS machineID", "t0 + make_dt_interval(0, CAST(i AS INT)) AS datetime", "CAST(0 AS BIGINT) AS seq",
            *[f"CASE WHEN {miss} THEN NULL ELSE {value} END AS {name}" for name, value, miss in _GRID],
        )
    )
    repeats = events.where("event_type = 'view'").selectExpr(
        "user_id AS machineID", "CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) AS datetime", "event_id + 1 AS seq",
        "170 + CAST(floor(value) AS BIGINT) / CAST(10 AS DOUBLE) AS volt", "CAST(NULL AS DOUBLE) AS rotate",
        "100 + CAST(floor(value) AS BIGINT) / CAST(10 AS DOUBLE) AS pressure", "CAST(45 AS DOUBLE) AS vibration",
    )
    coded = "concat('{0}', event_id % {1} + 1) AS {2}"
    base = events.withColumnsRenamed({"ts": "datetime", "user_id": "machineID"})
    errors = base.where("event_type = 'error'").selectExpr("datetime", "machineID", coded.format("error", 6, "errorID"))
    maint = base.where("event_type = 'signup'").selectExpr("datetime", "machineID", coded.format("comp", 4, "comp"))
    failures = base.where("event_type = 'purchase'").selectExpr(
        "datetime", "machineID", coded.format("comp", 4, "failure"))
    return PlantTables(grid.unionByName(repeats), errors, maint, failures, machines)


# The same tables as common table expressions.
PLANT_SQL = f"""
span AS (SELECT date_trunc('day', min(ts)) AS t0, max(ts) AS t1 FROM events),
machines AS (
  SELECT DISTINCT user_id AS "machineID", 'model' || (user_id % 4 + 1) AS model, CAST(user_id % 21 AS INTEGER) AS age
  FROM events),
grid AS (
  SELECT m AS "machineID", t0 + to_hours(i) AS datetime, CAST(0 AS BIGINT) AS seq, {_reading_columns()}
  FROM (SELECT *, i // 6 AS hour6 FROM (
    SELECT "machineID" AS m, t0, unnest(range(0, date_diff('hour', t0, t1) + 1)) AS i FROM machines, span))
  WHERE NOT ({_MISSING_HOURS})),
telemetry AS (
  SELECT * FROM grid
  UNION ALL
  SELECT user_id, date_trunc('hour', ts), event_id + 1, 170 + CAST(floor(value) AS BIGINT) / CAST(10 AS DOUBLE), NULL,
         100 + CAST(floor(value) AS BIGINT) / CAST(10 AS DOUBLE), CAST(45 AS DOUBLE)
  FROM events WHERE event_type = 'view'),
errors AS (
  SELECT ts AS datetime, user_id AS "machineID", 'error' || (event_id % 6 + 1) AS "errorID"
  FROM events WHERE event_type = 'error'),
maint AS (
  SELECT ts AS datetime, user_id AS "machineID", 'comp' || (event_id % 4 + 1) AS comp
  FROM events WHERE event_type = 'signup'),
failures AS (
  SELECT ts AS datetime, user_id AS "machineID", 'comp' || (event_id % 4 + 1) AS failure
  FROM events WHERE event_type = 'purchase')
"""
