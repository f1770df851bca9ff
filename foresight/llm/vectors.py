"""Shared steps on embedding columns."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def valid(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id bigint, vector array<double>) of the rows that take part.

    Left out: null ids, null, empty or zero vectors, vectors with null or non-finite components, and vectors whose length
    is not that of most vectors (the smaller length on a tie)."""
    v = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where("id is not null and vector is not null")
    v = v.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    length = v.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.where(F.size("vector") == (length[0]["n"] if length else -1))


def matrix(column) -> np.ndarray:
    """(rows, length) doubles of an Arrow list column without nulls whose lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def sample(v: DataFrame, rows: int, bound: int) -> np.ndarray:
    """At most about `bound` vectors, by hash of the id."""
    share = min(1.0, bound / max(rows, 1))
    got = v.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("id").select("vector").toArrow()
    return matrix(got["vector"])


def digest(row: np.ndarray) -> bytes:
    """Digest of one vector's components; zeros of either sign are equal."""
    return hashlib.blake2b((row + 0.0).tobytes(), digest_size=16).digest()
