"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact cosine.

Rotations that make the signs of a bounded sample balanced and close to its vectors give binary codes; pieces of the codes
are the keys of hash tables. Rows that share a key meet in a task, in blocks, and are compared by their original vectors.
A pair counts in the first table it shares. Tasks return sums of links per row and links that span what they joined, not
pairs. Copies of a vector are one row with a weight.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foresight.llm import graph
from foresight.llm.vectors import digest, matrix, sample, valid
from foresight.session import materialize

TABLES = 24
RECALL = 0.99
SAMPLE = 20_000
STEPS = 30
BLOCK = 1024


def rotations(x: np.ndarray, bits: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions (length, bits)): several ITQ rotations of the principal axes side by side."""
    rng, d = np.random.default_rng(seed), x.shape[1]
    mean = x.mean(0)
    axes = np.linalg.eigh((x - mean).T @ (x - mean))[1]
    v, out = (x - mean) @ axes, []
    while sum(w.shape[1] for w in out) < bits:
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(STEPS):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        out.append(axes @ r)
    return mean, np.concatenate(out, 1)[:, :bits]


def key_width(rows: int) -> int:
    """Bits of a key: buckets of about eight rows where codes are balanced."""
    return min(30, max(6, math.ceil(math.log2(max(rows, 2))) - 3))


def table_count(width: int, cosine: float) -> int:
    """Tables until a pair at the limit shares a key of independent bits with probability RECALL, TABLES at least."""
    same = (1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi) ** width
    return max(TABLES, math.ceil(math.log(1 - RECALL) / math.log1p(-same))) if 0 < same < 1 else TABLES


def near_duplicates(df: DataFrame, cosine: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Rows that `vectors.valid` leaves out link with nothing. A pair is found if it agrees in all bits of one key.
    Keys get longer with the table and their number grows with them (`table_count`), so that a pair at the limit is found in
    99 of 100 cases at every row count as far as bits are independent: at 0.9 24 tables up to 11 bits, 33 at 13, 62 at 17, 100 at 20.
    Null ids stay alone and are not kept; rows that repeat an id give a row each, with the links of all."""
    every = df.select(F.col(key).cast("bigint").alias("id"))
    v = valid(df, key, vector)

    def prints(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([digest(r) for r in matrix(b.column(1))], pa.binary()), b.column(1)], names=["id", "print", "vector"])

    v = materialize(v.mapInArrow(prints, "id bigint, print binary, vector array<double>"), "vectors")
    classes = materialize(v.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector")), "classes")
    rows = classes.count()
    some = sample(classes.select(F.col("rep").alias("id"), "vector"), rows, SAMPLE)
    width = key_width(rows)
    tables = table_count(width, cosine)
    mean, planes = rotations(some, tables * width) if len(some) else (np.zeros(1), np.zeros((1, tables * width)))

    def codes(batches):
        power = 1 << np.arange(width, dtype=np.int64)
        for b in batches:
            x = matrix(b.column(2))
            c = x - mean
            keys = np.stack([(c @ planes[:, k:k + width] >= 0) @ power for k in range(0, tables * width, width)], 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in keys.astype(np.int32)], pa.binary()),
                                              pa.array([r.tobytes() for r in x.astype(np.float64)], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                                             names=["rep", "n", "code", "raw", "keys"])

    coded = materialize(classes.select("rep", "n", "vector").mapInArrow(codes, "rep bigint, n bigint, code binary, raw binary, keys array<bigint>"), "codes")
    slim = coded.select("rep", F.posexplode("keys").alias("t", "key"))
    buckets = materialize(slim.groupBy("t", "key").agg(F.count("*").alias("m")).where("m > 1").select("t", "key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "buckets")
    member = slim.join(buckets, ["t", "key"]).withColumn("mine", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    member = (member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("t", "key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "rep"))
    order = ["t", "key", "x", "y"]
    rows = member.join(coded.select("rep", "n", "code", "raw"), "rep").select(*order, "mine", "rep", "n", "code", "raw").repartition(*order).sortWithinPartitions(*order)

    def links(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            t = t.combine_chunks()
            if t.num_rows:
                cut, out = _blocks(t, order, cosine, last=False)
                held = t.slice(cut)
                yield from out
        if held is not None and held.num_rows:
            yield from _blocks(held, order, cosine, last=True)[1]

    found = materialize(rows.mapInArrow(links, "a bigint, b bigint, n bigint"), "links")
    labels = materialize(graph.components(found.where("b is not null").select("a", "b")), "labels")
    count = found.where("b is null").groupBy("a").agg(F.sum("n").alias("links"))
    own = (classes.select("print", "rep", "n").join(count.withColumnRenamed("a", "rep"), "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
           .select("print", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    own = materialize(own, "class-links")
    known = v.select("id", "print").join(own, "print").select("id", "n_links", "component_id")
    out = known.union(every.join(v.select("id").distinct(), "id", "left_anti").select("id", F.lit(0).cast("bigint"), F.col("id")))
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _blocks(t: pa.Table, order: list[str], cosine: float, last: bool):
    """(row where the unfinished group begins, result batches) of sorted rows."""
    keys = np.stack([t[k].to_numpy() for k in order])
    cut = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [t.num_rows]])
    stop = len(cut) - (1 if last else 2)
    x = np.frombuffer(b"".join(t["raw"].to_pylist()), np.float64).reshape(t.num_rows, -1)
    x = x / np.sqrt((x * x).sum(1))[:, None]
    code = np.frombuffer(b"".join(t["code"].to_pylist()), np.int32).reshape(t.num_rows, -1)
    rep, n, mine = (t[k].to_numpy() for k in ("rep", "n", "mine"))
    sums: dict[int, int] = {}
    a, b = [], []
    for lo, hi in zip(cut[:stop].tolist(), cut[1:stop + 1].tolist()):
        table, one, two = keys[0, lo], keys[2, lo], keys[3, lo]
        left = lo + np.flatnonzero(mine[lo:hi] == one)
        right = lo + np.flatnonzero(mine[lo:hi] == two)
        near = x[left] @ x[right].T >= cosine
        if one == two:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if len(i) and table:
            fresh = np.ones(len(i), bool)
            step = (TABLES << 16) // max(TABLES, code.shape[1])
            for k in range(0, len(i), step):
                fresh[k:k + step] = ~(code[left[i[k:k + step]], :table] == code[right[j[k:k + step]], :table]).any(1)
            i, j = i[fresh], j[fresh]
        if not len(i):
            continue
        i, j = left[i], right[j]
        gain = np.bincount(i - lo, n[j], hi - lo) + np.bincount(j - lo, n[i], hi - lo)
        for r in np.flatnonzero(gain).tolist():
            sums[int(rep[lo + r])] = sums.get(int(rep[lo + r]), 0) + int(gain[r])
        parent = {}

        def find(k):
            while parent.setdefault(k, k) != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        pending = np.unique(np.stack([i, j]), axis=1)
        while pending.shape[1]:  # one spanning link at a time, then drop what it joined
            p, q = pending[:, 0]
            parent[find(int(p))] = find(int(q))
            a.append(int(rep[p])), b.append(int(rep[q]))
            star = (pending[0] == p)
            for r in pending[1, star].tolist():
                if find(r) != find(int(p)):
                    parent[find(r)] = find(int(p))
                    a.append(int(rep[p])), b.append(int(rep[r]))
            root = np.array([find(int(k)) for k in np.unique(pending)])
            where = np.searchsorted(np.unique(pending), pending)
            pending = pending[:, root[where[0]] != root[where[1]]]
    out = []
    if sums or a:
        ids, totals = list(sums), list(sums.values())
        out.append(pa.RecordBatch.from_arrays([pa.array(ids + a, pa.int64()), pa.array([None] * len(ids) + b, pa.int64()), pa.array(totals + [None] * len(a), pa.int64())], names=["a", "b", "n"]))
    return int(cut[stop]), out
