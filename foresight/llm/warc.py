"""WARC archives: written with the text sink, read back in splits, records found by verifying the chain of boundaries.

A reader that starts in the middle of a file can take the magic inside a payload for a record. So tasks only emit
candidates (magic offset, offset where a record there would end); what can be reached from the start of the file by these
links is a record. Runs of candidates that follow each other are contracted first; pointer jumping over the rest doubles
the reach each round, so a file with k breaks takes log2(k) rounds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from foresight.session import materialize, work_dir

MAGIC = "WARC/1.0\r\n"
_END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's bytes."""
    hexed = F.sha1(data.cast("binary"))
    parts = []
    for k in range(4):  # 40 bits are 10 hex digits and 8 base32 digits
        number = F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 10).cast("bigint")
        parts += [F.substring(F.lit(_BASE32), (F.shiftright(number, 35 - 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*parts)


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One record per row of (page_id bigint, url, html): a response, or a revisit of the response with the smallest
    page_id among equal payloads of at least `min_bytes`.

    Null html is an empty payload, a null url an empty one; white space and control characters in urls are
    percent-coded. Rows that repeat a page_id repeat its record. A null page_id is always a response."""
    page = pages.select(F.col("page_id").cast("bigint"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("digest", base32_sha1(F.col("html")))
    groups = (page.where("page_id is not null").where(F.octet_length("html") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first"))
    page = page.join(materialize(groups, "payload-groups"), "digest", "left")
    revisit = F.coalesce(F.col("first") < F.col("page_id"), F.lit(False))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("html")))
    url = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(_END), block)
    page.select(record.alias("value")).write.option("lineSep", _END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Text between magics, written once: file, split, `at` (a number that grows within a split), value, its bytes `n` and
    the bytes `span` that a record starting there takes by its own header.

    Numbers of splits depend on how Spark lays out a scan, so whatever refers to a chunk is worked out from this table."""
    value = F.col("value")
    header = _header(value)
    length = F.try_to_number(_field(header, "Content-Length", "([0-9]{1,15})"), F.lit("9" * 15)).cast("bigint")
    chunks = (spark.read.option("lineSep", MAGIC).text(path)
              .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.octet_length(value).cast("bigint").alias("n"), (F.octet_length(header) + 4 + length + 4).alias("span"))
              .withColumn("at", F.monotonically_increasing_id()))
    target = f"{work_dir(spark)}/chunks-{uuid.uuid4().hex}"
    chunks.write.option("compression", "zstd").parquet(target)   # as large as the archive without it
    return spark.read.parquet(target)


def _header(value: Column) -> Column:
    return F.when(F.instr(value, _END) > 0, F.substring_index(value, _END, 1))


def _field(header: Column, name: str, pattern: str) -> Column:
    return F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*{pattern}", 1)


def boundaries(chunks: DataFrame) -> DataFrame:
    """(file, at, offset, owner, whole) of every chunk: the offset of the record it belongs to (null if none), and whether it is
    that record's only chunk.

    Windows run over the chunks of one split; a file's splits are linked by their sizes and last records, one row a split."""
    slim = chunks.select("file", "block", "at", "n", "span")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)   # splits of a file
    blocks = slim.groupBy("file", "block").agg(F.sum(F.col("n") + len(MAGIC)).alias("size"))
    blocks = blocks.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("file_end", F.sum("size").over(W.partitionBy("file")) - len(MAGIC))
    inside = W.partitionBy("file", "block").orderBy("at")
    start = F.col("base") + F.coalesce(F.sum(F.col("n") + len(MAGIC)).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) - len(MAGIC)
    c = slim.join(materialize(blocks.drop("size"), "splits"), ["file", "block"]).withColumn("offset", start)
    nothing_before = F.col("offset") >= 0   # what lies before a file's first magic links to nothing
    c = c.withColumns({"end": F.col("offset") + len(MAGIC) + F.col("n"), "next": F.when(nothing_before, F.col("offset") + len(MAGIC) + F.col("span"))})
    c = c.withColumn("last", F.col("end") >= F.col("file_end"))
    c = c.withColumn("follows", F.coalesce((F.col("next") == F.col("end")) & ~F.col("last"), F.lit(False)))
    c = materialize(c.select("file", "block", "at", "offset", "end", "next", "last", "follows"), "candidates")
    # runs of chunks that follow each other, cut at splits and where a link from elsewhere arrives
    targets = c.where("not follows and next is not null").select("file", F.col("next").alias("offset")).distinct().withColumn("target", F.lit(True))
    r = c.join(targets, ["file", "offset"], "left")
    head = F.coalesce(~F.lag("follows").over(inside), F.lit(True)) | F.coalesce("target", F.lit(False))
    r = r.withColumn("head", F.when(head, F.col("offset")))
    r = materialize(r.withColumn("head", F.last("head", True).over(inside.rowsBetween(W.unboundedPreceding, 0))).drop("target"), "runs")
    jump = r.groupBy("file", "head").agg(F.max_by("next", "offset").alias("next"))
    reached = jump.where("head = 0").select("file", "head")
    jump = materialize(jump.where("next is not null").join(jump.select("file", F.col("head").alias("next")), ["file", "next"], "left_semi").select("file", "head", "next"), "jumps")
    while not jump.isEmpty():
        reached = materialize(reached.union(reached.join(jump, ["file", "head"]).select("file", F.col("next").alias("head"))).distinct(), "reached")
        jump = materialize(jump.join(jump.select("file", F.col("head").alias("next"), F.col("next").alias("far")), ["file", "next"]).select("file", "head", F.col("far").alias("next")), "jumps")
    r = r.join(reached.withColumn("true", F.lit(True)), ["file", "head"], "left").withColumn("true", F.coalesce("true", F.lit(False)))
    r = r.withColumn("record", F.when(F.col("true"), F.col("offset")))
    carried = r.groupBy("file", "block").agg(F.max("record").alias("latest"))
    carried = carried.select("file", "block", F.max("latest").over(before).alias("carried"))
    owner = F.coalesce(F.last("record", True).over(inside.rowsBetween(W.unboundedPreceding, 0)), F.col("carried"))
    whole = F.col("true") & (F.col("last") | F.coalesce(F.col("next") == F.col("end"), F.lit(False)))
    return r.join(carried, ["file", "block"]).select("file", "at", "offset", owner.alias("owner"), whole.alias("whole"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, url, digest, payload string) of every record; null payload for revisits.

    Bytes that no chain from the start of a file reaches are no records; a file without magic at its start has none."""
    chunks = _chunks(spark, path)
    odd = materialize(boundaries(chunks).where("not whole"), "boundaries")   # the few that are no record of their own
    whole = chunks.select("at", "value").join(odd.select("at"), "at", "left_anti").select("value")
    pieced = (chunks.select("at", "value").join(odd.where("owner is not null"), "at").groupBy("file", "owner")
              .agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("v")).select(F.array_join(F.col("v.value"), MAGIC).alias("value")))
    r = whole.union(pieced)
    header = _header(F.col("value"))
    r = r.withColumn("header", header)
    kind = _field(F.col("header"), "WARC-Type", "([a-z]+)")
    number = lambda name: _field(F.col("header"), name, "<urn:page:([0-9-]+)>")
    block = F.expr(f"substring(value, length(header) + {len(_END) + 1})")
    payload = F.expr("substring(block, instr(block, '\\r\\n\\r\\n') + 4)")
    r = r.withColumn("block", block).withColumn("payload", payload)
    return r.select(
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("bigint").alias("page_id"), kind.alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("bigint").alias("refers_to"),
        _field(F.col("header"), "WARC-Target-URI", "([^\r\n]*)").alias("url"),
        _field(F.col("header"), "WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("digest"),
        F.when(kind == "response", _trimmed()).alias("payload"))


def _trimmed() -> Column:
    """The payload without the two line ends that close its record, where the record is followed by another one."""
    return F.expr("if(endswith(payload, '\\r\\n\\r\\n') and octet_length(value) - octet_length(header) - 4 > cast(regexp_extract(header, '(?i)(?:^|\\\\r\\\\n)Content-Length:[ \\\\t]*([0-9]+)', 1) as bigint), substring(payload, 1, length(payload) - 4), payload)")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as archives into the shared folder, reads them back: one row per record with size and digest of
    the full payload, which a revisit takes from the record it refers to."""
    spark = pages.sparkSession
    path = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path, min_bytes)
    r = read(spark, path)
    r = materialize(r.select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                             F.when(F.col("payload").isNotNull(), base32_sha1(F.col("payload"))).alias("payload_digest"), "digest"), "records")
    first = r.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")).dropDuplicates(["refers_to"])
    first = materialize(first.join(r.where("record_type = 'revisit'").select("refers_to").distinct(), "refers_to", "left_semi"), "revisited")
    out = r.join(first, "refers_to", "left")
    return out.select("page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), F.coalesce("payload_digest", "_digest").alias("payload_digest"),
                      "record_type", "refers_to", (F.coalesce("payload_digest", "_digest") == F.col("digest")).alias("digest_ok"))
