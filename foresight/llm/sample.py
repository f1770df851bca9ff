"""Bounded samples of labelled rows for fitting a model on the driver."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foresight.session import materialize


def per_class(rows: DataFrame, label: str, key: str, bound: int) -> list:
    """About `bound` rows of every class at most, by hash of the key: the same rows for the same table.

    A class with fewer rows is taken whole. What reaches the driver is bounded by classes * bound rows."""
    return _chosen(rows, label, key, bound).orderBy(key).collect()


def texts_per_class(rows: DataFrame, label: str, key: str, text: str, bound: int, bound_bytes: int) -> Iterator:
    """As `per_class`, and about `bound_bytes` bytes of text of every class at most; the rows come one by one, in order of the key
    and the text, and need not be held together. Every class that has rows has some: its share is of the class, not of the table."""
    return _chosen(rows, label, key, bound, F.octet_length(text), bound_bytes).orderBy(key, text).toLocalIterator()


def texts_of_labels(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, bound: int, bound_bytes: int) -> Iterator:
    """As `texts_per_class` for the join of `docs` and `labels` by the key. Keys and text sizes are joined and sampled; texts
    are read for the sample only, which is stored first, so Spark broadcasts it only as far as its size allows."""
    sized = docs.where(F.col(text).isNotNull()).select(key, F.octet_length(text).alias("_size")).join(labels.select(key, label), key)
    chosen = materialize(_chosen(sized, label, key, bound, F.col("_size"), bound_bytes).select(key, label).distinct(), "label-sample")
    return docs.where(F.col(text).isNotNull()).select(key, text).join(chosen, key).orderBy(key, text).toLocalIterator()


def _chosen(rows: DataFrame, label: str, key: str, bound: int, size: Column | None = None, bound_size: int = 1) -> DataFrame:
    sizes = rows.groupBy(label).agg(F.count("*").alias("n"), (F.lit(0) if size is None else F.sum(size)).alias("size")).collect()
    wanted = F.lit(False)
    for r in sizes:
        share = min(1.0, bound / r["n"], bound_size / max(r["size"] or 0, 1) if size is not None else 1.0)
        wanted = wanted | (F.col(label).eqNullSafe(F.lit(r[label])) & (F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30))))
    return rows.where(wanted)


def release_memory() -> None:
    """Hands freed memory of a finished fit back to the system, where the C library can; the driver runs on for hours."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
