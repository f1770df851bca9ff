"""Near-duplicate documents on word shingles: SetSketch registers in bands, joint likelihood estimate, exact check.

1. One sketch per document; documents with equal shingle sets are one class with one representative.
2. Representatives that agree in all registers of a band are candidates. Within a band's bucket every member is first
   paired with the smallest member only (no pairs among the others). Pairs that the joint estimate does not rule out are
   checked on the full shingle sets, at most two per member: the best estimate and the smallest partner. Links give
   components.
3. What is left are candidate pairs between different components. Buckets that hold several components are compared
   completely, in blocks inside tasks, first by sketch, then on the full sets of the rows the sketches keep. So a pair
   is left out only if it is already connected, shares no band or is ruled out by its sketch.

Miss probability of a pair at the limit: (1 - 0.8^8)^64 < 8e-6 for the bands, and below 1e-5 for the estimates
(five standard deviations below the limit).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foresight.llm import graph
from foresight.llm.arrow import by_group, map_texts
from foresight.llm.bpe_job import _narrow
from foresight.llm.setsketch import REGISTERS, equal_low_bits, joint_estimate, low_bits, sketch
from foresight.llm.text import shingles, words
from foresight.session import materialize

ROWS, BANDS = 8, 64     # the registers of a band are one 64-bit word; a band's number is six bits
SLACK = 5 * (0.16 / REGISTERS) ** 0.5   # five standard deviations of the estimate near the limit
BLOCK = 1024


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, fingerprint of the shingle set, registers)."""
    def run(rows, data, offsets):
        flat, first = shingles(*words(data, offsets), size)
        registers = sketch(flat, first)
        raw = flat.tobytes()
        prints = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(first[:-1], first[1:])]
        return [rows.column(0), np.diff(first), pa.array(prints, pa.binary()), pa.array([r.tobytes() for r in registers], pa.binary())]

    return map_texts(docs, "_text", run, "id bigint, n bigint, print binary, registers binary")


def _hits(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """`df` with `_hit`, which is false only where no row of `values` has the key; so few other rows reach a shuffle.

    The bitmap of hashed keys has 2^26 bits whatever the data, in at most 2048 rows of 4 KB: 8 MB are broadcast at most.
    With far more keys than bits every row is a hit, which costs time but changes no result."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << 26))
    bits = (values.select(place.alias("h")).groupBy(F.expr("bitmap_bucket_number(h)").alias("_bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("_bits")))
    at = df.withColumn("_h", place).withColumn("_bucket", F.expr("bitmap_bucket_number(_h)")).withColumn("_at", F.expr("bitmap_bit_position(_h)"))
    bit = F.expr("(cast(conv(hex(substring(_bits, cast(_at div 8 + 1 as int), 1)), 16, 10) as int) & shiftleft(1, cast(_at % 8 as int))) <> 0")
    return at.join(F.broadcast(bits), "_bucket", "left").select(*df.columns, F.coalesce(bit, F.lit(False)).alias("_hit"))


def _wanted(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows with these ids."""
    return _hits(df, ids, "id").where("_hit").drop("_hit").join(ids, "id", "left_semi")


def _classes(base: DataFrame) -> DataFrame:
    """One row per shingle set, with the smallest id. Sketches of sets that occur once are not moved."""
    base = base.where("n > 0")
    repeated = materialize(base.groupBy("print").count().where("count > 1").select("print"), "repeated")
    marked = _hits(base, repeated, "print")
    several = marked.where("_hit").groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("registers").alias("registers"))
    return materialize(marked.where("not _hit").select("print", "id", "n", "registers").unionByName(several), "classes")


def _shared(batches):
    """Rows (bucket, id) in that order: those whose bucket a neighbour has too. The first and the last row of a task
    stay in any case, as the bucket may go on in another task."""
    held, keep_held = None, True  # the last row so far; the first one stays
    for batch in batches:
        if not batch.num_rows:
            continue
        t = batch if held is None else pa.concat_batches([held, batch])
        bucket = t.column(0).to_numpy()
        same = bucket[1:] == bucket[:-1]
        keep = np.zeros(len(bucket), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= keep_held
        yield t.slice(0, len(bucket) - 1).filter(pa.array(keep[:-1]))
        held, keep_held = t.slice(len(bucket) - 1), bool(keep[-1])
    if held is not None:
        yield held


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, id, hub) of all buckets with several members; a bucket is 58 bits of a band's hash and the band's number.

    One shuffle by ranges of (bucket, id), which also cuts large buckets; only members of shared buckets go on."""
    names = [F.xxhash64(F.expr(f"substring(registers, {ROWS * b + 1}, {ROWS})")).bitwiseAND(F.lit(-BANDS)).bitwiseOR(F.lit(b)) for b in range(BANDS)]
    rows = reps.select(F.explode(F.array(*names)).alias("bucket"), "id").repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id")
    members = materialize(rows.mapInArrow(_shared, "bucket bigint, id bigint"), "members")
    hubs = members.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    return materialize(members.join(hubs, "bucket"), "buckets")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full shingle sets of the wanted documents only."""
    def run(rows, data, offsets):
        flat, first = shingles(*words(data, offsets), size)
        return [rows.column(0), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat.view(np.int64)))]

    return map_texts(_wanted(docs, wanted), "_text", run, "id bigint, items array<bigint>")


def _confirmed(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = materialize(_sets(docs, ids, size), "shingle-sets").dropDuplicates(["id"])
    both = (pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a"))
    common = F.size(F.array_intersect("x", "y"))
    return (both.select("a", "b", common.alias("i"), (F.size("x") + F.size("y") - common).alias("u"))
            .where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b"))


def _estimated(batches_of_pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, estimate) of the pairs that size and sketch do not rule out; input has na, nb, ra, rb."""
    least = percent / 100 - SLACK

    def run(batches):
        for t in batches:
            c = {f.name: t.column(i) for i, f in enumerate(t.schema)}
            na, nb = c["na"].to_numpy(), c["nb"].to_numpy()
            ra, rb = (np.frombuffer(b"".join(c[k].to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in ("ra", "rb"))
            keep = np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
            j = np.where(keep, joint_estimate(ra, rb, na, nb), -1)
            out = pa.RecordBatch.from_arrays([c["a"], c["b"], pa.array(j)], names=["a", "b", "estimate"])
            yield out.filter(pa.array(j >= least))

    return batches_of_pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a bigint, b bigint, estimate double")


def _rest(buckets: DataFrame, base: DataFrame, docs: DataFrame, labels: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components that share a bucket: sketches choose the rows, full sets decide.

    No pair leaves a task: the first pass returns rows that have a promising partner in their block, the second only
    links that join components not yet joined within its block."""
    least = 0.25 + 0.75 * (percent / 100 - 1.25 * SLACK)  # low bits of unequal registers agree in a quarter of cases
    member = buckets.join(labels, buckets.id == labels.node, "left").select("bucket", "id", F.coalesce("component", "id").alias("c"))
    mixed = materialize(member.groupBy("bucket").agg(F.count("*").alias("m"), F.min("c").alias("low"), F.max("c").alias("high"))
                        .where("low < high").select("bucket", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "mixed")
    rows = materialize(member.join(mixed, "bucket"), "mixed-members")
    rows = rows.join(_wanted(base, rows.select("id").distinct()), "id")
    rows = (rows.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("bucket", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "id", "n", "c", "registers"))
    order = ["bucket", "x", "y"]
    names = [*order, "mine", "id", "n", "c"]

    def sides(t):
        mine = t["mine"].to_numpy()
        x, y = t["x"][0].as_py(), t["y"][0].as_py()
        return np.flatnonzero(mine == x), np.flatnonzero(mine == y), x == y

    def partners(t):
        """(row, promising partners) of a block: other component, fitting sizes, no earlier common band, close sketches."""
        registers = np.frombuffer(b"".join(t["registers"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
        keys = np.ascontiguousarray(registers[:, :ROWS * BANDS]).view(np.uint64)  # one word per band
        bits, band = low_bits(registers), t["bucket"][0].as_py() & (BANDS - 1)
        n, c = t["n"].to_numpy(), t["c"].to_numpy()
        left, right, same = sides(t)
        for i in left.tolist():
            j = right[right > i] if same else right
            j = j[(c[j] != c[i]) & (np.minimum(n[j], n[i]) * 100 >= np.maximum(n[j], n[i]) * percent)]
            j = j[~(keys[j, :band] == keys[i, :band]).any(1)]
            equal = equal_low_bits(bits[j], bits[i])
            near = np.argsort(-equal, kind="stable")[:np.count_nonzero(equal >= least * REGISTERS)]
            if len(near):
                yield i, j[near]

    def promising(t):
        active = np.zeros(t.num_rows, bool)
        for i, j in partners(t):
            active[i] = active[j] = True
        if active.any():
            yield t.select(names).filter(pa.array(active))

    def linked(t):
        items = [v.values.to_numpy().view(np.uint64) for v in t["items"]]  # sorted and distinct
        c, ids, n = (t[k].to_numpy() for k in ("c", "id", "n"))
        parent = {int(k): int(k) for k in c}

        def find(k):
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        out = []
        for i, j in partners(t):
            for k in j.tolist():
                a, b = find(int(c[i])), find(int(c[k]))
                if a == b:
                    continue
                common = len(np.intersect1d(items[i], items[k], assume_unique=True))
                if common * 100 >= (n[i] + n[k] - common) * percent:
                    parent[a] = b
                    out.append((int(ids[i]), int(ids[k])))
        if out:
            yield pa.table({"a": [p[0] for p in out], "b": [p[1] for p in out]})

    first = rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        lambda batches: by_group(batches, order, promising), "bucket bigint, x int, y int, mine int, id bigint, n bigint, c bigint")
    first = materialize(first, "promising")
    ids = materialize(first.select("id").distinct(), "promising-ids")
    sets = materialize(_sets(docs, ids, size), "shingle-sets").dropDuplicates(["id"])
    rows = first.join(_wanted(base.select("id", "registers"), ids), "id").join(sets, "id")
    return (rows.repartition(*order).sortWithinPartitions(*order)
            .mapInArrow(lambda batches: by_group(batches, order, linked), "a bigint, b bigint").distinct())


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every document.

    Words are `[^ \\t-\\r]+` with A-Z in lower case; `percent` is the least similarity. Empty and null texts have no
    shingles and link with nothing; shorter texts than `size` words are one shingle. Keys are integers; null keys stay as
    they are, alone and not kept. Rows that repeat a key give one row per row read; texts under one key count as one
    node of the graph. Shingles are compared by 64-bit hashes."""
    every = _narrow(df, key, text).select(F.col(key).cast("bigint").alias("id"), "_text")
    docs = every.where("id is not null")
    base = materialize(sketches(docs, size), "sketches")
    reps = _classes(base)
    buckets = _buckets(reps)
    stars = buckets.where("id > hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    sizes = [reps.select(F.col("id").alias(k), F.col("n").alias("n" + k)) for k in "ab"]
    # sizes rule out most pairs before any sketch is moved
    stars = stars.join(sizes[0], "a").join(sizes[1], "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    stars = materialize(stars, "pairs")
    used = [_wanted(reps.select("id", "registers"), stars.select(F.col(k).alias("id")).distinct()).select(F.col("id").alias(k), F.col("registers").alias("r" + k)) for k in "ab"]
    kept = materialize(_estimated(stars.join(used[0], "a").join(used[1], "b"), percent), "estimated")
    first = kept.groupBy("a").agg(F.max(F.struct("estimate", (-F.col("b")).alias("b"))).alias("best"), F.min("b").alias("low"))
    first = first.select("a", F.explode(F.array_distinct(F.array(-F.col("best.b"), F.col("low")))).alias("b"))
    classes = base.where("n > 0").join(reps.select("print", F.col("id").alias("rep")), "print").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    links = materialize(_confirmed(docs, first, size, percent), "links")
    labels = materialize(graph.components(links), "labels")
    rest = materialize(_rest(buckets.select("bucket", "id"), reps.select("id", "n", "registers"), docs, labels, size, percent), "links")
    labels = materialize(graph.components(links.union(rest).union(classes)), "labels")
    out = base.join(labels, base.id == labels.node, "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    out = out.withColumn("kept", F.col(key) == F.col("component_id"))
    lost = every.where("id is null").select(F.col("id").alias(key), F.lit(None).cast("bigint").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"), F.lit(False).alias("kept"))
    return out.union(lost)
