"""Distribution drift between a reference and a current table: stability index, KS distance, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foresight import schema as S
from foresight.operators.blocks import exact_quantiles, unpivot
from foresight.operators.radix import largest_gaps

SHARE_FLOOR = 1e-4


def _index(parts: DataFrame) -> DataFrame:
    """(feature, psi) from counts (feature, bin, r, c) of both tables; shares are floored."""
    totals = parts.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    floor = F.lit(SHARE_FLOOR)
    r = F.greatest(F.try_divide(F.col("r").cast("double"), F.col("nr")), floor)
    c = F.greatest(F.try_divide(F.col("c").cast("double"), F.col("nc")), floor)
    return parts.join(totals, "feature").groupBy("feature").agg(F.sum((c - r) * F.ln(c / r)).alias("psi"))


def _both(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    is_ref = F.lit(True).alias("is_ref")
    return ref.select(is_ref, *columns).unionByName(cur.select(F.lit(False).alias("is_ref"), *columns))


def quantile_edges(ref: DataFrame, numeric: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, edges): distinct bin limits at the reference's quantiles."""
    cuts = exact_quantiles(ref, numeric, [i / bins for i in range(bins + 1)])
    return cuts.select("feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))


def psi_numeric(
    ref: DataFrame, cur: DataFrame, numeric: Sequence[str], bins: int = 10, strict_bins: bool = False,
    edges: DataFrame | None = None,
) -> DataFrame:
    """(feature, psi) of numeric columns over quantile bins of the reference; missing values do not count.

    A reference with two distinct limits has a single bin and index 0 (`strict_bins` splits it at the upper one);
    a constant reference compares equality instead. A feature whose reference or current values are all missing has
    a row with a null index.
    """
    limits = quantile_edges(ref, numeric, bins) if edges is None else edges
    by_name = limits.agg(F.map_from_entries(F.collect_list(F.struct("feature", "edges"))).alias("m"))  # one per feature
    lookup = by_name.select(F.array(*[F.col("m")[c] for c in numeric])).scalar()
    names = F.array(*[F.lit(c) for c in numeric])
    cells = _both(ref, cur, numeric).select(
        "is_ref", F.posexplode(F.array(*[F.col(c).cast("double") for c in numeric])).alias("pos", "x")
    ).where("x IS NOT NULL AND NOT isnan(x)").withColumn("e", lookup[F.col("pos")])
    # inner limits at or below the value; bins are [a, b)
    last = "size(e)" if strict_bins else "size(e) - 1"
    last = f"CASE WHEN size(e) = 2 THEN {last} ELSE size(e) - 1 END"
    bin_no = " + ".join(f"CASE WHEN {i} < {last} AND x >= get(e, {i}) THEN 1 ELSE 0 END" for i in range(1, bins + 1))
    placed = cells.selectExpr(
        "is_ref", "pos", f"{bin_no} AS bin", "size(e) < 2 AS constant", "x <> e[0] AS other",
        "abs(x - e[0]) > 1e-8D + 1e-5D * abs(e[0]) AS far")
    counts = placed.groupBy("pos", "bin", "constant").agg(
        F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"),
        F.count_if(~F.col("is_ref") & F.col("far")).alias("far"),
        F.count_if(~F.col("is_ref") & F.col("other")).alias("other"),
    ).withColumn("feature", names[F.col("pos")])
    binned = _index(counts.where(~F.col("constant")))
    moved = F.when(F.sum("far") == 0, 0.0).otherwise(
        F.try_divide(F.sum("other").cast("double"), F.sum("c")) * F.ln(F.lit(1 / SHARE_FLOOR)))
    out = binned.unionByName(counts.where("constant").groupBy("feature").agg(moved.alias("psi")))
    known = out.agg(F.map_from_entries(F.collect_list(F.struct("feature", "psi"))).alias("m"))  # one entry per feature
    return known.select(F.explode(names).alias("feature"), "m").select("feature", F.col("m")[F.col("feature")].alias("psi"))


def psi_categorical(ref: DataFrame, cur: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(feature, psi) of categorical columns over the union of categories; missing values do not count."""
    long = unpivot(_both(ref, cur, categorical), categorical, ["is_ref"], "string").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", F.col("value").alias("bin")).agg(
        F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
    return _index(counts)


def psi(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), bins: int = 10,
        **options) -> DataFrame:
    parts = psi_numeric(ref, cur, numeric, bins, **options)
    return parts.unionByName(psi_categorical(ref, cur, categorical)) if categorical else parts


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, share) of the known values of each column."""
    counts = unpivot(df, columns, as_type="string").where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("n_all"))
    return counts.join(totals, "feature").select("feature", "value", (F.col("n") / F.col("n_all")).alias("share"))


def ks(ref: DataFrame, cur: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(feature, ks, ks_pvalue): largest distance of the two distribution functions, asymptotic p-value.

    The distance is exact and found by histograms (see `radix.py`), which runs at once. A feature without known values on
    either side has no row."""
    gaps = largest_gaps(_both(ref, cur, numeric), list(numeric), F.col("is_ref"))
    rows = [(name, d, n, m) for name, (d, n, m) in zip(numeric, gaps) if d is not None]
    out = ref.sparkSession.createDataFrame(rows, "feature string, ks double, n bigint, m bigint")
    lam2 = F.col("ks") * F.col("ks") * (F.col("n").cast("double") * F.col("m") / (F.col("n") + F.col("m")))
    terms = F.sequence(F.lit(1), F.lit(200))
    series = F.aggregate(terms, F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0)
                         * F.exp(-2.0 * k * k * lam2))
    p = F.when(lam2 < 0.03, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))
    return out.select("feature", "ks", p.alias("ks_pvalue"))


def drift_table(
    ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
    psi_threshold: float = S.MONITORING["psi_threshold"], with_ks: bool = True, **options,
) -> DataFrame:
    """(feature, psi, ks_pvalue, drifted), most drifted first; the flag uses the unrounded index.

    A feature without an index is not called drifted but stays in the share's denominator."""
    table = psi(ref, cur, numeric, categorical, **options)
    if with_ks:
        table = table.join(ks(ref, cur, numeric).select("feature", "ks_pvalue"), "feature", "left")
    else:
        table = table.withColumn("ks_pvalue", F.lit(None).cast("double"))
    return table.select("feature", F.round("psi", 4).alias("psi"), "ks_pvalue",
                        F.coalesce(F.col("psi") > psi_threshold, F.lit(False)).alias("drifted")).orderBy(F.desc("psi"), "feature")


def drift_summary(table: DataFrame, share_threshold: float = S.MONITORING["drift_share_threshold"]) -> DataFrame:
    """One row: share of drifted features, data-drift verdict, names of the drifted features."""
    share = F.avg(F.col("drifted").cast("double"))
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct((-F.col("psi")).alias("o"), "feature"))))
    return table.agg(F.round(share, 3).alias("drift_share"), (share >= share_threshold).alias("data_drift"),
                     names.alias("_n")).select("drift_share", "data_drift", F.col("_n.feature").alias("drifted_features"))


def live_performance(df: DataFrame, label: str = S.LABEL, prediction: str = "prediction",
                     probability: str = "probability") -> DataFrame:
    """One row over labelled rows, or no row: without labels or predictions, or when nothing failed."""
    from foresight.operators.metrics import average_precision, confusion, rates

    empty = "n_labelled bigint, positives bigint, recall double, precision double, pr_auc double"
    if label not in df.columns or prediction not in df.columns:
        return df.sparkSession.createDataFrame([], empty)
    rows = df.where(F.col(label).isNotNull())
    counts = rows.agg(*confusion(F.col(label).cast("int"), F.col(prediction).cast("int"))).withColumns(
        {k: v for k, v in rates(0, 0).items() if k in ("recall", "precision")})
    area = F.lit(None).cast("double")
    if probability in df.columns:
        area = average_precision(rows, label, probability).agg(F.max("pr_auc")).scalar()
    positives = F.col("tp") + F.col("fn")
    return counts.withColumn("pr_auc", area).where(positives > 0).select(
        (positives + F.col("tn") + F.col("fp")).alias("n_labelled"), positives.alias("positives"),
        "recall", "precision", "pr_auc")


def retrain_decision(summary: DataFrame, data_drift: str = "data_drift", concept_drift: str = "concept_drift") -> DataFrame:
    """Add status, retrain and reason to a row with the two drift verdicts."""
    data, concept = F.col(data_drift), F.coalesce(F.col(concept_drift), F.lit(False))
    status = (F.when(data & concept, "data_and_concept_drift").when(concept, "concept_drift")
              .when(data, "data_drift").otherwise("no_drift"))
    reason = (F.when(data & concept, "inputs shifted and live recall dropped")
              .when(concept, "live recall below the limit while inputs look normal")
              .when(data, "input distribution shifted").otherwise("nothing to do"))
    return summary.withColumn("status", status).withColumn("retrain", F.col("status") != "no_drift").withColumn(
        "reason", reason)
