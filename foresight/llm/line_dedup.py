"""Site-relative line frequency: a line on too large a share of a host's pages is boilerplate and goes.

Pages with the same text on one host count once, so a copied page does not turn its own lines into boilerplate. Per host
fewer than (lines per page) / (ratio) lines can exceed the ratio; they travel as one array of hashes per host, joined to
the pages by host. Counting combines on the map side; no line, page or host is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foresight.session import materialize


def boilerplate(pages: DataFrame, percent: int, min_pages: int) -> DataFrame:
    """(host, lines array<bigint>): hashes of lines that more than `percent` of the host's different pages hold.

    Input: host, text. Lines are compared without surrounding blanks; blank lines never count."""
    page = pages.where("text is not null").select("host", "text", F.xxhash64("text").alias("page"))
    totals = page.groupBy("host").agg(F.count_distinct("page").alias("total"))
    lines = (page.select("host", "page", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line"))
             .where("trim(line) <> ''").groupBy("host", F.xxhash64(F.trim("line")).alias("line")).agg(F.count_distinct("page").alias("n")))
    many = lines.where(F.col("n") >= min_pages).join(totals.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")))
    many = many.where(F.col("n") * 100 > F.col("total") * percent)
    return materialize(many.groupBy("host").agg(F.collect_list("line").alias("lines")), "boilerplate")


def drop_lines(df: DataFrame, text: str = "text", host: str = "source", percent: int = 5, min_pages: int = 5) -> DataFrame:
    """The table with boilerplate lines taken out of `text`, plus n_lines (non-blank before) and n_dropped.

    A null text stays null with 0 lines; an empty text stays empty; a page of boilerplate only becomes empty but stays.
    Null hosts are one host. Repeated rows stay. n_lines and n_dropped replace columns of these names."""
    df = df.drop("n_lines", "n_dropped")
    columns = df.columns
    bad = boilerplate(df.select(F.col(host).alias("host"), F.col(text).alias("text")), percent, min_pages).select(F.col("host").alias("_host"), F.col("lines").alias("_bad"))
    out = df.join(bad, F.col(host).eqNullSafe(F.col("_host")), "left")
    lines = F.split(F.col(text), "\n", -1)
    solid = lambda x: F.trim(x) != ""
    kept = F.when(F.col("_bad").isNull(), F.col(text)).otherwise(
        F.array_join(F.filter(lines, lambda x: ~(solid(x) & F.array_contains("_bad", F.xxhash64(F.trim(x))))), "\n"))
    out = out.withColumn("_kept", kept)
    count = lambda c: F.coalesce(F.size(F.filter(F.split(c, "\n", -1), solid)), F.lit(0)).cast("bigint")
    out = out.withColumn("n_lines", F.when(F.col(text).isNull(), F.lit(0).cast("bigint")).otherwise(count(F.col(text))))
    out = out.withColumn("n_dropped", F.when(F.col(text).isNull(), F.lit(0).cast("bigint")).otherwise(F.col("n_lines") - count(F.col("_kept"))))
    return out.withColumn(text, F.col("_kept")).select(*columns, "n_lines", "n_dropped")
