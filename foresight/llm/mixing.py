"""Mixing sources to target weights: blocks of equal token counts are allocated by Sainte-Laguë highest quotients.

1. Every source gets a target: its weight's share of the wanted words, at most `most` times what it holds; what a full source
   leaves is shared again by weight (the level at which this ends is found from running sums over the sources in order of
   words per weight).
2. The words of the sources that are not full are cut into blocks; sources get blocks by the highest quotients
   weight / (2 k - 1). Each source deals its blocks to its shards the same way, by quotients of their words.
3. A shard lays its documents end to end in seeded order, `most` times in a row, and cuts that line into blocks. Its quota
   takes the line's earlier passes whole and a seeded, evenly spaced choice of blocks of the pass where it ends. How many
   chosen words precede a place of the line is a closed formula, so no block is ever a row.

A shard is a hash of the document, so a source with a third of all rows is many shards of about `shard_rows` documents. Equal
rows are counted first and cut into bounded lots. Ranks over sources or shards are taken by ranges: no task sees all of them.
Documents move as (id, source, size, count) only; texts stay where they are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from foresight.operators.blocks import null_safe_join
from foresight.session import materialize

COPIES = 1024       # equal rows that stay together as one lot


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in order of their names, null last; `percent` of all words is wanted."""
    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    most: int = 2
    block: int = 16
    shard_rows: int = 4096
    seed: str = "1"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than blank, tab and line or page ends; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def in_order(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds for each name: column pair the sum of that column over all rows that come before, without one task for all.

    Rows are dealt out by ranges of `order`, which must tell them apart; range totals are added up first."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    totals = totals.select(F.col("_range").alias("_r"), *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = ranged.join(totals, F.col("_range") == F.col("_r"))
    return out.select(*df.columns, *[(F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])


def apportion(parts: DataFrame, by: str | None = None) -> DataFrame:
    """(columns of `parts`, quota): `seats` of each group dealt to its parts by the highest quotients votes / (2 k - 1).

    Columns: id (orders ties), votes, cap (most seats of the part), seats (of the whole group). Every part first gets what its
    share leaves no doubt about, at most one seat a part below its share; only the few seats around the last one are ranked,
    about five a part. A group whose caps end first leaves seats undealt."""
    group = by or "_all_parts"
    columns, parts = parts.columns, parts if by else parts.withColumn(group, F.lit(0))
    p = null_safe_join(parts, parts.groupBy(group).agg(F.sum("votes").alias("_all"), F.count("*").alias("_k")), [group])
    share = lambda seats: F.coalesce(F.try_divide(F.col("votes") * seats, F.col("_all")), F.lit(0.0))
    base = F.greatest(F.lit(0), F.least("cap", F.floor(share(F.col("seats") - F.col("_k"))))).cast("bigint")
    most = F.least("cap", F.ceil(share(F.col("seats") + F.col("_k"))) + 1).cast("bigint")
    p = materialize(p.withColumn("_base", base).withColumn("_most", most), "shares")
    near = p.where("_most > _base and votes > 0").select(group, "id", "votes", "seats", F.explode(F.sequence(F.col("_base") + 1, F.col("_most"))).alias("_j"))
    near = near.withColumn("_q", -F.col("votes") / (2 * F.col("_j") - 1)).withColumn("_one", F.lit(1))
    ranked = in_order(near, [F.col(group).asc_nulls_first(), F.col("_q"), F.col("id"), F.col("_j")], {"_rank": "_one"})
    first = null_safe_join(ranked.groupBy(group).agg(F.min("_rank").alias("_first")), p.groupBy(group).agg(F.sum("_base").alias("_dealt")), [group])
    more = null_safe_join(ranked, first, [group]).where("_rank - _first < seats - _dealt").groupBy(group, "id").agg(F.count("*").alias("_more"))
    out = null_safe_join(p, more, [group, "id"], "left")
    return out.select(*columns, (F.col("_base") + F.coalesce("_more", F.lit(0))).alias("quota"))


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, n_rows, target double, full boolean, quota bigint) from (source, source_size, n_rows).

    `quota` counts blocks; a full source needs none, its documents are taken `most` times."""
    nth = in_order(sizes.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], {"rank": "_one"})
    weights = F.array(*[F.lit(w) for w in mix.weights])
    s = nth.drop("_one").withColumn("weight", F.get(weights, F.pmod("rank", F.lit(len(mix.weights))).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * mix.most).withColumn("_per", F.col("cap") / F.col("weight"))
    s = materialize(in_order(s, [F.col("_per"), F.col("rank")], {"_caps": "cap", "_weights": "weight"}), "levels")
    total = s.agg(F.struct(F.sum("source_size").alias("words"), F.sum("weight").alias("weight"))).scalar()
    s = s.withColumn("_total", total).withColumn("wanted", F.col("_total.words") * mix.percent / F.lit(100.0)).withColumn("_weight", F.col("_total.weight"))
    s = s.withColumn("full", F.col("cap") * (F.col("_weight") - F.col("_weights")) <= (F.col("wanted") - F.col("_caps")) * F.col("weight"))
    left = F.max("wanted") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0))
    rest = s.agg(F.struct(left.alias("words"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"))).scalar()
    s = s.select("source", "source_size", "n_rows", "rank", "weight", "cap", "full").withColumn("_rest", rest)
    s = s.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.try_divide("_rest.words", "_rest.weight") * F.col("weight")))
    s = materialize(s.withColumn("seats", F.floor(F.col("_rest.words") / mix.block + 0.5).cast("bigint")), "targets")
    open_ = s.where("not full").select(F.col("rank").alias("id"), F.col("weight").alias("votes"),
                                       F.ceil(F.col("cap") / mix.block).cast("bigint").alias("cap"), "seats")
    quotas = apportion(open_).select(F.col("id").alias("rank"), "quota")
    return s.join(quotas, "rank", "left").select("source", "source_size", "n_rows", "target", "full", F.coalesce("quota", F.lit(0)).alias("quota"))


def _number(digest: Column) -> Column:
    """The first eight hexadecimal digits of a digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _chosen_before(block: str) -> str:
    """How many chosen blocks of its shard come before this one: `_whole` leading ones and `_take` spread over the next `_among`."""
    return f"(least({block}, _whole) + (least(greatest({block} - _whole, 0L), _among) * _take + _shift) div greatest(_among, 1L))"


def plan(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", source: str = "source", text: str = "text", ranges: bool = False) -> DataFrame:
    """One row per document: key, source, size, source_size, target (its source's), taken (words the mix takes, with repeats).

    With `ranges` also the taken words themselves: ranges array<struct<pass, first, words>>, `first` counting from 0 in the
    document and `pass` from 0 to most - 1; ranges are at most a block long and in order.

    A null text has size 0 and nothing is taken of it; a null source is a source of its own, after all others; rows that repeat a key, or all
    columns, count each. Sizes that are all 0 give targets of 0; an empty table gives no rows. Sources miss their targets by
    about a block. Which words are taken depends on the seed and the documents only, not on their order or partitions.
    Other columns are not read."""
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    classes = materialize(rows.groupBy("key", "source", "size").agg(F.count("*").alias("n")), "sizes")
    sources = materialize(targets(classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_rows")), mix), "quotas")
    lot = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("int")))
    lots = null_safe_join(classes.withColumn("lot", lot), sources, ["source"])
    lots = lots.withColumn("n", F.least(F.lit(COPIES), F.col("n") - F.col("lot") * COPIES))
    digest = F.md5(F.concat_ws(":", F.lit(mix.seed), F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("size"), F.col("lot")))
    shards = F.ceil(F.col("n_rows") / mix.shard_rows)
    lots = lots.withColumn("digest", digest).withColumn("shard", F.pmod(_number(F.col("digest")), shards).cast("bigint"))
    parts = lots.where("not full").groupBy("source", F.col("shard").alias("id")).agg(F.sum(F.col("size") * F.col("n")).alias("votes"), F.max("quota").alias("seats"))
    parts = parts.withColumn("cap", F.ceil(F.col("votes") * mix.most / mix.block).cast("bigint"))
    quotas = apportion(parts, "source").select("source", F.col("id").alias("shard"), F.col("votes").alias("_words"), F.col("quota").alias("_quota"))
    # blocks that end in the same pass as the quota, and those before them
    ends = [F.floor(F.col("_words") * p / mix.block).cast("bigint") for p in range(mix.most + 1)]
    whole, among = F.lit(0).cast("bigint"), ends[1]
    for p in range(1, mix.most):
        whole = F.when(F.col("_quota") >= ends[p], ends[p]).otherwise(whole)
        among = F.when(F.col("_quota") >= ends[p], ends[p + 1] - ends[p]).otherwise(among)
    everything = F.col("_quota") > ends[mix.most]   # the last block is shorter than the others
    whole, among = F.when(everything, F.col("_quota")).otherwise(whole), F.when(everything, F.lit(0).cast("bigint")).otherwise(among)
    quotas = quotas.select("source", "shard", "_words", whole.alias("_whole"), among.alias("_among"), (F.col("_quota") - whole).alias("_take"))
    turn = _number(F.md5(F.concat_ws(":", F.lit(mix.seed), F.coalesce("source", F.lit("")), F.col("shard"))))
    quotas = materialize(quotas.withColumn("_shift", F.pmod(turn, F.greatest("_among", F.lit(1))).cast("bigint")), "shard-quotas")
    line = W.partitionBy("source", "shard").orderBy(F.substring("digest", 9, 24), "key", "size", "lot").rowsBetween(W.unboundedPreceding, -1)
    placed = lots.withColumn("_start", F.coalesce(F.sum(F.col("size") * F.col("n")).over(line), F.lit(0)))
    placed = null_safe_join(placed, quotas, ["source", "shard"], "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))))
    placed = placed.withColumn("_start", F.col("_start") + F.col("_copy") * F.col("size"))
    passes = [f"_start + {p} * _words" for p in range(mix.most)]
    taken = " + ".join(f"({_chosen_words(f'{a} + size', mix.block)} - {_chosen_words(a, mix.block)})" for a in passes)
    out = placed.withColumn("taken", F.when(F.col("full"), F.col("size") * mix.most).otherwise(F.expr(taken)).cast("bigint"))
    names = [F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "taken"]
    if ranges:
        own = " , ".join(_ranges(p, a, mix.block) for p, a in enumerate(passes))
        whole_text = ", ".join(f"array(named_struct('pass', {p}, 'first', 0L, 'words', size))" for p in range(mix.most))
        names.append(F.expr(f"filter(if(full, concat({whole_text}), concat({own})), r -> r.words > 0)").alias("ranges"))
    return out.select(*names)


def _chosen_words(place: str, block: int) -> str:
    """Chosen words of the line before a place."""
    k = f"(({place}) div {block}L)"
    return f"({block} * {_chosen_before(k)} + (({place}) % {block}L) * ({_chosen_before(f'({k} + 1)')} - {_chosen_before(k)}))"


def _ranges(number: int, start: str, block: int) -> str:
    """The chosen blocks of one pass over a document, as words of the document."""
    low, high = f"greatest(k * {block}L - ({start}), 0L)", f"least((k + 1) * {block}L - ({start}), size)"
    words = f"if({_chosen_before('(k + 1)')} > {_chosen_before('k')}, {high} - {low}, 0L)"
    return (f"transform(sequence(({start}) div {block}L, greatest(({start}) + size - 1, {start}) div {block}L), "
            f"k -> named_struct('pass', {number}, 'first', {low}, 'words', {words}))")
