"""Stored feature table that late rows refresh block by block.

The table is a folder of Parquet files by time block and part of the machines (`_blk`, `part`). A refresh works out which
(machine, block) late rows can change, builds the folders that hold these again, and replaces just them. The windows and the
shuffles of a refresh see readings of these blocks and the few blocks before that they look back at, nothing else.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.functions.columns import HOUR_US, block_of, micros
from foresight.operators.asof import DAY_US
from foresight.operators.blocks import BLOCK, BLOCK_HOURS, US, block_size
from foresight.plans.features import build_features, with_seq
from foresight.schema import KEY, TS, PlantTables
from foresight.session import materialize, shuffle_parts, shuffles_removed

PART = "part"
_BACK = max(*S.WINDOW_HOURS, S.ERROR_WINDOW_HOURS) * HOUR_US
_CAP = int(S.DAYS_SINCE_CAP) * DAY_US


def _size(horizon_hours: int | None, block_hours: int) -> int:
    return block_size(block_hours, _BACK, (horizon_hours or 0) * HOUR_US)


def _part(parts: int):
    return F.pmod(F.xxhash64(KEY), F.lit(parts)).cast("int").alias(PART)


def _write(features: DataFrame, path: str, size: int, mode: str, parts: int) -> None:
    placed = features.select("*", block_of(micros(TS), size).alias(BLOCK), _part(parts))
    with shuffles_removed(placed.sparkSession):
        placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BLOCK, PART).parquet(path)


def _place(spark: SparkSession, parts: int) -> str:
    """Shares of the machines, each inside one part and about as many as a shuffle has partitions. The build puts rows of a share and
    block into one task, so that they go from there to few folders, in files of about a task each, without another exchange."""
    shares = parts * math.ceil(shuffle_parts(spark) / parts)
    return f"pmod(xxhash64({KEY}), {shares}L)"


def write_features(t: PlantTables, path: str, horizon_hours: int | None = S.HORIZON_HOURS, block_hours: int = BLOCK_HOURS,
                   parts: int = 64) -> DataFrame:
    """Builds the whole stored table. A refresh must be given the same horizon, block length and parts."""
    spark = t.telemetry.sparkSession
    features = build_features(t, None, horizon_hours, block_hours=block_hours, place=_place(spark, parts))
    _write(features, path, _size(horizon_hours, block_hours), "static", parts)
    return read_features(spark, path, features.schema)


def read_features(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The stored table; a table without rows has no file, so it is read with the `schema` of its features."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path).drop(BLOCK, PART)


def merged(old: PlantTables, late: PlantTables) -> PlantTables:
    """Old and late rows together. A late machine row replaces the old one of its id; a late reading of a time that exists
    counts by its `seq`, as in the feature job."""
    machines = late.machines.unionByName(old.machines.join(late.machines.select(KEY), KEY, "left_anti"))
    failures = [f for f in (old.failures, late.failures) if f is not None]
    return PlantTables(
        with_seq(old.telemetry).unionByName(with_seq(late.telemetry)), old.errors.unionByName(late.errors),
        old.maint.unionByName(late.maint), reduce(DataFrame.unionByName, failures) if failures else None, machines)


def _timed(df: DataFrame, *columns) -> DataFrame:
    return df.where(F.col(TS).isNotNull()).select(KEY, micros(TS).alias(US), *columns)


def reading_blocks(telemetry: DataFrame, size: int) -> DataFrame:
    """(machine, block, readings, first, third and last reading time) of blocks that hold readings: one small row a block.

    Counts are of distinct times; `third` is the last time where a block has fewer."""
    times = _timed(telemetry).distinct().withColumn(BLOCK, block_of(F.col(US), size))
    numbered = times.withColumn("_n", F.row_number().over(Window.partitionBy(KEY, BLOCK).orderBy(US)))
    return numbered.groupBy(KEY, BLOCK).agg(
        F.count("*").alias("n"), F.min(US).alias("first_us"), F.max(US).alias("last_us"),
        F.max(F.when(F.col("_n") <= S.FFILL_ROWS, F.col(US))).alias("third_us"))


def touched_blocks(old: PlantTables, late: PlantTables, blocks: DataFrame, horizon_hours: int | None = S.HORIZON_HOURS,
                   block_hours: int = BLOCK_HOURS) -> DataFrame:
    """(machine, block) whose feature rows may differ once the late rows are in; `blocks` are the merged `reading_blocks`.

    A reading reaches as many readings further as a gap is filled over, and a look-back from there; the first reading of
    a machine also decides where its rows begin. An error reaches a look-back. A service reaches the first block with a
    later one of its component, or the cap. A failure is a service and a label of the rows before it. A machine row
    reaches every block of the machine. Without late rows nothing is touched."""
    size, ahead = _size(horizon_hours, block_hours), (horizon_hours or 0) * HOUR_US
    along = Window.partitionBy(KEY).orderBy(BLOCK)
    # the fill ends at the latest in the third reading of the blocks after; every block has one reading at least
    after = [F.struct(F.lead("n", i).over(along).alias("n"), F.lead("third_us", i).over(along).alias("end")) for i in range(1, S.FFILL_ROWS + 1)]
    enough = F.expr(f"""aggregate(_after, named_struct('n', 0L, 'end', last_us),
        (s, a) -> CASE WHEN s.n >= {S.FFILL_ROWS} OR a.n IS NULL THEN s ELSE named_struct('n', s.n + a.n, 'end', a.end) END).end""")
    reach = blocks.withColumn("_after", F.array(*after)).select(KEY, BLOCK, enough.alias("_end"))

    first = _timed(old.telemetry).groupBy(KEY).agg(F.min(US).alias("_old_first"))
    readings = _timed(late.telemetry).distinct().withColumn(BLOCK, block_of(F.col(US), size)).join(reach, [KEY, BLOCK])
    readings = readings.groupBy(KEY, BLOCK).agg(F.min(US).alias("lo"), F.max("_end").alias("hi")).join(first, KEY, "left")
    begins = F.when(F.col("lo") < F.col("_old_first"), F.col("_old_first"))
    spans = [readings.select(KEY, "lo", (F.greatest("hi", begins) + _BACK).alias("hi"))]

    hour = F.col(US) - F.pmod(US, F.lit(HOUR_US))
    spans.append(_timed(late.errors).select(KEY, hour.alias("lo"), (F.col(US) + _BACK).alias("hi")))

    def services(t: PlantTables) -> DataFrame:
        out = _timed(t.maint, "comp")
        return out if t.failures is None else out.union(_timed(t.failures, "failure"))

    every = services(old).union(services(late)).withColumn(BLOCK, block_of(F.col(US), size)).groupBy(KEY, "comp", BLOCK).agg(F.min(US).alias("_us0"))
    following = every.withColumn("_next", F.lead("_us0").over(Window.partitionBy(KEY, "comp").orderBy(BLOCK)))
    replaced = services(late).withColumn(BLOCK, block_of(F.col(US), size)).join(following, [KEY, "comp", BLOCK])
    spans.append(replaced.select(KEY, F.col(US).alias("lo"), F.least(F.col("_next"), F.col(US) + _CAP).alias("hi")))
    if late.failures is not None and ahead:
        spans.append(_timed(late.failures).select(KEY, (F.col(US) - ahead).alias("lo"), F.col(US).alias("hi")))

    reached = reduce(DataFrame.union, [s.select(KEY, "lo", "hi") for s in spans])
    numbers = F.explode(F.sequence(block_of(F.col("lo"), size), block_of(F.col("hi"), size))).alias(BLOCK)
    touched = reached.select(KEY, numbers).distinct().join(blocks, [KEY, BLOCK], "left_semi")
    return touched.union(blocks.join(late.machines, KEY, "left_semi").select(KEY, BLOCK)).distinct()


def refresh_features(path: str, old: PlantTables, late: PlantTables, horizon_hours: int | None = S.HORIZON_HOURS,
                     block_hours: int = BLOCK_HOURS, parts: int = 64) -> DataFrame:
    """Brings the stored table up to date with late rows and returns the (block, part) folders it replaced.

    Afterwards the table equals a full build from `merged(old, late)`. Late rows add or correct; rows cannot be taken back.
    A run that is repeated or lost halfway is run again with the same tables. No late rows: no folder changes."""
    size = _size(horizon_hours, block_hours)
    now = merged(old, late)
    blocks = materialize(reading_blocks(now.telemetry, size), "reading-blocks")
    touched = touched_blocks(old, late, blocks, horizon_hours, block_hours)
    folders = materialize(touched.select(BLOCK, _part(parts)).distinct(), "touched-folders")
    # a folder is replaced whole: all its machines are built
    own = materialize(blocks.select(KEY, BLOCK, _part(parts)).join(folders, [BLOCK, PART], "left_semi").select(KEY, BLOCK), "own-blocks")
    # looked back at: the block before, the readings that gaps before it are filled from, and the machine's first reading
    along = Window.partitionBy(KEY).orderBy(BLOCK)
    back = F.array_append(F.collect_list(BLOCK).over(along.rowsBetween(-S.FFILL_ROWS - 1, 0)), F.min(BLOCK).over(along))
    seen = blocks.select(KEY, BLOCK, back.alias("_back")).join(own, [KEY, BLOCK], "left_semi")
    needed = seen.select(KEY, F.explode("_back").alias(BLOCK)).distinct()
    machines = own.select(KEY).distinct()
    placed = now.telemetry.withColumn(BLOCK, block_of(micros(TS), size))

    def of_machines(df: DataFrame | None) -> DataFrame | None:
        return None if df is None else df.join(machines, KEY, "left_semi")

    part = PlantTables(placed.join(needed, [KEY, BLOCK], "left_semi").drop(BLOCK), of_machines(now.errors), of_machines(now.maint),
                       of_machines(now.failures), of_machines(now.machines))
    place = _place(own.sparkSession, parts)
    features = build_features(part, None, horizon_hours, block_hours=block_hours, only=own, place=place)
    _write(features, path, size, "dynamic", parts)
    return folders
