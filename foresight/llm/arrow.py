"""mapInArrow helpers: one record batch per bounded slice of texts."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foresight.llm.sample import release_memory
from foresight.llm.text import slices
from foresight.session import small_batches

_caches: list = []


def worker_cache(fn):
    """`fn` with its two latest results kept in the Python worker for later tasks, until a task that has no use for them drops them."""
    kept = functools.lru_cache(maxsize=2)(fn)
    _caches.append(kept)
    return kept


def drop_caches() -> None:
    """Frees what earlier tasks have left in this Python worker, which may serve any operator next."""
    if any(c.cache_info().currsize for c in _caches):
        for c in _caches:
            c.cache_clear()
        release_memory()


def map_texts(df: DataFrame, text: str, fn, schema, limit: int | None = None, cached: bool = False) -> DataFrame:
    """Run fn(rows, data, offsets) -> list of arrays on slices of the text column; `rows` is the slice's record batch.

    Slices hold at most `limit` bytes of text or one document. Results are sent slice by slice. `cached`: fn uses worker caches."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    small_batches(df.sparkSession)

    def run(batches):
        if not cached:
            drop_caches()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for a, b, data, offsets in slices(column, *([limit] if limit else [])):
                columns = fn(batch.slice(a, b - a), data, offsets)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)
        release_memory()

    return df.mapInArrow(run, schema)


def by_group(batches, order, fn):
    """Calls fn(table) for every run of rows that agree in `order`; the input is sorted by it. Yields fn's batches.

    Only the rows of one group and one batch are held."""
    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        t = (new if held is None else pa.concat_tables([held, new])).combine_chunks()
        if not t.num_rows:
            continue
        keys = np.stack([t[k].to_numpy() for k in order])
        cut = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [t.num_rows]])
        for a, b in zip(cut[:-2], cut[1:-1]):  # the last group may go on
            for out in fn(t.slice(a, b - a)):
                yield from out.to_batches()
        held = t.slice(cut[-2], cut[-1] - cut[-2])
    if held is not None and held.num_rows:
        for out in fn(held):
            yield from out.to_batches()
    release_memory()
