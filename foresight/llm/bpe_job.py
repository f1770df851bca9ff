"""Byte-level BPE of a text column as a Spark job."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from foresight.llm.arrow import map_texts
from foresight.llm.bpe import encode_documents, rank_vocabulary


def encode(df: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every whole text; a null or empty text has no ids. Other columns are not read.

    The rank file is opened on the executors and must lie at the same path there. No shuffle: a document is encoded
    where it is read. Repeated keys give repeated rows."""
    def run(rows, data, offsets):
        import pyarrow as pa
        _, cache = rank_vocabulary(ranks_path)
        ids, first = encode_documents(cache, data, offsets)
        return [rows.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))]

    return map_texts(_narrow(df, key, text), "_text", run, f"{_quoted(key)} {dict(df.dtypes)[key]}, ids array<int>", cached=True)


def decode(df: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, data binary) of every id sequence; null ids give empty bytes. An id outside the vocabulary is an error."""
    def run(batches):
        import pyarrow as pa
        table, _ = rank_vocabulary(ranks_path)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):  # decoded bytes leave in small batches
                part = batch.slice(a, 512)
                column = part.column(1)
                flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in column])])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([table.decode(flat[x:y]) for x, y in zip(at[:-1], at[1:])], pa.binary())], names=[key, "data"])

    return df.select(key, ids).mapInArrow(run, f"{_quoted(key)} {dict(df.dtypes)[key]}, data binary")


def digests(df: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of ids, digest of the ids (little-endian, 32 bits) and of the bytes decoded from those ids."""
    def run(rows, data, offsets):
        table, cache = rank_vocabulary(ranks_path)
        ids, first = encode_documents(cache, data, offsets)
        packed = ids.astype("<u4").tobytes()
        decoded = table.decode(ids)
        at = np.concatenate([[0], np.cumsum(table.token_length[ids])])[first]
        return [rows.column(0), np.diff(first), [hashlib.sha256(packed[4 * a:4 * b]).hexdigest() for a, b in zip(first[:-1], first[1:])],
                [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]]

    return map_texts(_narrow(df, key, text), "_text", run,
                     f"{_quoted(key)} {dict(df.dtypes)[key]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", cached=True)


def _narrow(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(_quoted(key)), F.col(_quoted(text)).alias("_text"))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
