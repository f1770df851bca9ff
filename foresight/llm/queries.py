"""Queries of the operators on the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from pyspark.sql import functions as F

from foresight.llm import align, ann, bpe_job, fim, language_id, line_dedup, mixing, near_dedup, packing, pii, toxicity, vector_dedup, warc

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
PACKING_TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    return pii.report(_table(spark, sf_dir, "documents"))


def op2_bpe(spark, sf_dir):
    return bpe_job.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS))


def op3_minhash_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op4_ann(spark, sf_dir):
    return ann.nearest(_table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


def op6_embedding_dedup(spark, sf_dir):
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def _remainder(k: int):
    return F.crc32(F.col("doc_id").cast("string")) % k


def op5_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_remainder(5) != 0)
    model = toxicity.learn_from(docs, labels)
    return (toxicity.score(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op7_language_id(spark, sf_dir):
    docs, vocabulary = _table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS)
    model = language_id.learn(docs.where(_remainder(3) != 1), vocabulary)
    return language_id.predict(docs, model, vocabulary).select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op8_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER))


def op9_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return line_dedup.drop_lines(docs.select("doc_id", "text", "source"), percent=5, min_pages=5).select("doc_id", "n_lines", "n_dropped", "text")


def op11_alignment(spark, sf_dir):
    return align.scores(_table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER), public_tokenizers.path(PIECES))


def op12_mixing(spark, sf_dir):
    return mixing.plan(_table(spark, sf_dir, "documents")).drop("source")


def op13_fim(spark, sf_dir):
    return fim.digests(_table(spark, sf_dir, "documents"))


REGISTRY = {f.__name__: f for f in (op1_pii, op2_bpe, op3_minhash_dedup, op4_ann, op5_toxicity, op6_embedding_dedup, op7_language_id, op8_packing, op9_warc, op10_line_dedup, op11_alignment, op12_mixing, op13_fim)}


def oracle_sql() -> dict[str, str]:
    return {
        "op10_line_dedup": """
            with pages as (select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
            totals as (select source, count(distinct text) as total from documents group by source),
            frequent as (
              select l.source, l.line from (select source, text, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) as line from pages) l
              join totals t on l.source is not distinct from t.source where l.line <> ''
              group by l.source, l.line, t.total having count(distinct l.text) >= 5 and count(distinct l.text) * 100 > t.total * 5),
            bad as (select source, list(line) as bad from frequent group by source)
            select doc_id,
              coalesce(len(list_filter(lines, lambda x: trim(x) <> '')), 0) as n_lines,
              coalesce(len(list_filter(lines, lambda x: trim(x) <> '' and list_contains(coalesce(bad, []), trim(x)))), 0) as n_dropped,
              case when bad is null then text else array_to_string(list_filter(lines, lambda x: not (trim(x) <> '' and list_contains(bad, trim(x)))), chr(10)) end as text
            from pages left join bad on pages.source is not distinct from bad.source""",
        "op12_mixing": """
            with rows as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size from documents),
            named as (
              select source, sum(size) as source_size, count(*) as n_rows, row_number() over (order by source nulls last) - 1 as rk from rows group by source),
            weighed as (select *, case rk % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 2 * source_size as cap from named),
            levels as (
              select *, cast(sum(source_size) over () * 150 as double) / 100
                  - coalesce(sum(cap) over (order by cap / weight, rk rows between unbounded preceding and 1 preceding), 0) as words_left,
                sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, rk rows between unbounded preceding and 1 preceding), 0) as weight_left
              from weighed),
            flagged as (select *, cap * weight_left <= words_left * weight as is_full, cast(sum(source_size) over () * 150 as double) / 100 as wanted from levels),
            shared as (
              select *, wanted - coalesce(sum(case when is_full then cap end) over (), 0) as rest, sum(case when not is_full then weight end) over () as rest_weight
              from flagged),
            sources as (
              select source, rk, source_size, n_rows, weight, cap, is_full, case when is_full then cast(cap as double) else rest / rest_weight * weight end as target,
                cast(floor(rest / 16 + 0.5) as bigint) as seats from shared),
            seats as (
              select rk, count(*) as quota from (
                select rk, seats, row_number() over (order by weight / cast(2 * k - 1 as double) desc, rk, k) as place
                from (select *, unnest(generate_series(1, cast(least(seats, ceil(cap / 16)) as bigint))) as k from sources where not is_full)) where place <= seats group by rk),
            lots as (
              select doc_id, source, size, lot, least(1024, n - lot * 1024) as n, md5('1:' || coalesce(cast(doc_id as varchar), '') || ':' || size || ':' || lot) as digest
              from (select *, unnest(generate_series(0, (n - 1) // 1024)) as lot from (select doc_id, source, size, count(*) as n from rows group by all))),
            placed as (
              select l.*, s.rk, s.is_full, s.source_size, s.target, coalesce(q.quota, 0) as source_quota,
                cast('0x' || substr(digest, 1, 8) as bigint) % cast(ceil(s.n_rows / 4096.0) as bigint) as shard
              from lots l join sources s on l.source is not distinct from s.source left join seats q on q.rk = s.rk),
            shards as (select rk, any_value(source) as source, shard, cast(sum(size * n) as bigint) as words, any_value(source_quota) as seats from placed where not is_full group by rk, shard),
            shard_seats as (
              select rk, shard, count(*) as quota from (
                select rk, shard, seats, row_number() over (partition by rk order by words / cast(2 * k - 1 as double) desc, shard, k) as place
                from (select *, unnest(generate_series(1, cast(least(seats, ceil(2 * words / 16)) as bigint))) as k from shards)) where place <= seats group by rk, shard),
            shaped as (
              select s.*, coalesce(q.quota, 0) as quota, case when coalesce(q.quota, 0) >= words // 16 then words // 16 else 0 end as whole
              from shards s left join shard_seats q on q.rk = s.rk and q.shard = s.shard),
            turned as (
              select *, case when whole = 0 then words // 16 else 2 * words // 16 - words // 16 end as among,
                cast('0x' || substr(md5('1:' || coalesce(source, '') || ':' || shard), 1, 8) as bigint) as turn from shaped),
            blocks as (
              select rk, shard, block from (select *, unnest(generate_series(0, cast(ceil(2 * words / 16) as bigint) - 1)) as block from turned)
              where quota > 2 * words // 16 or block < whole or (block < whole + among
                and ((block + 1 - whole) * (quota - whole) + turn % among) // among > ((block - whole) * (quota - whole) + turn % among) // among)),
            copies as (
              select p.*, t.words, start + copy * size as begins from (
                select *, unnest(generate_series(0, n - 1)) as copy, coalesce(sum(size * n) over (partition by rk, shard order by substr(digest, 9, 24), doc_id, size, lot
                  rows between unbounded preceding and 1 preceding), 0) as start from placed) p left join shaped t on t.rk = p.rk and t.shard = p.shard),
            numbered as (select *, row_number() over () as row from copies),
            spans as (
              select row, begins + pass * words as a, begins + pass * words + size as b, rk, shard
              from (select *, unnest([0, 1]) as pass from numbered where not is_full and size > 0)),
            taken as (
              select row, sum(least((block + 1) * 16, b) - greatest(block * 16, a)) as taken from (
                select *, unnest(generate_series(cast(a // 16 as bigint), cast((b - 1) // 16 as bigint))) as block from spans) semi_spans
              join blocks using (rk, shard, block) group by row)
            select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
              cast(case when is_full then 2 * size else coalesce(taken, 0) end as bigint) as taken
            from numbered left join taken using (row)""",
        "op13_fim": """
            with hashed as (
              select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
                sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d from documents),
            drawn as (
              select doc_id, text, u, len(u) as n, cast('0x' || substr(d, 1, 8) as bigint) as h1, cast('0x' || substr(d, 9, 8) as bigint) as h2,
                cast('0x' || substr(d, 17, 8) as bigint) as h3, cast('0x' || substr(d, 25, 8) as bigint) as h4 from hashed),
            cut as (
              select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                     when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
            parts as (
              select doc_id, n, form, text, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle,
                array_to_string(u[b + 1:], '') as suffix from cut)
            select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
              case when form <> 'plain' then length(middle) end as middle_chars,
              sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                     else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
              sha256(prefix || middle || suffix) as restored_sha256 from parts""",
    }
