"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JIT_LIMIT = "8000"  # bytes of a method
BATCH_MB = 4  # of a record batch on its way to Python
_own_dirs: dict[str, str] = {}


def get_session(app: str = "foresight", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with the settings every job relies on (UTC wall clock, adaptive execution)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # stream state beside the heap, with timers and maps
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # no call-site capture for every column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # keeps generated methods of wide projections small enough for the JIT compiler
        "spark.sql.codegen.hugeMethodLimit": JIT_LIMIT,
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def small_methods(spark: SparkSession) -> None:
    """Keep generated methods small enough for the JIT compiler on a session that `get_session` did not make: wide feature
    projections above it would run interpreted."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > int(JIT_LIMIT):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_LIMIT)


def enough_partitions(spark: SparkSession, parts: int) -> None:
    """Let shuffles start with at least `parts` partitions on a session that asks for fewer, so that a task's share does not grow with
    the input. Adaptive execution joins those that turn out small; without it the number itself is raised."""
    name, now = _shuffle_setting(spark)
    if parts > now:
        spark.conf.set(name, str(parts))


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    return _shuffle_setting(spark)[1]


def _shuffle_setting(spark: SparkSession) -> tuple[str, int]:
    name = "spark.sql.shuffle.partitions"
    now = int(spark.conf.get(name))
    switches = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    if all(spark.conf.get(s) == "true" for s in switches):
        name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        now = int(spark.conf.get(name, None) or now)
    return name, now


def small_batches(spark: SparkSession) -> None:
    """Let record batches of long texts end by their bytes. By rows alone, 10,000 texts are copied several times beside the heap, for
    every task of an executor and its Python worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size, unit = re.fullmatch(r"\s*(-?\d+)\s*([bkmgtp]?)b?\s*", spark.conf.get(name).lower()).groups()
    if int(size) << 10 * "bkmgtp".index(unit or "b") > BATCH_MB << 20:
        spark.conf.set(name, f"{BATCH_MB}m")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`; where it is unset, a local master gets a temporary one
    that goes when Python ends, and any other master an error."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="foresight-")
        atexit.register(shutil.rmtree, _own_dirs[context.applicationId], ignore_errors=True)
        context.setCheckpointDir(_own_dirs[context.applicationId])
    return _own_dirs[context.applicationId]


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run inside give back their shuffle files when they end; otherwise these stay until the driver's memory is collected,
    beside those of the steps that follow. For writes, whose plans do not run again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    target = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(target)
    return spark.read.parquet(target)
