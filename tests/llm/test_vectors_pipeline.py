import math

import numpy as np
import pytest

import corpus_pipeline
from foresight.llm import ann, vector_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int"


def vectors(spark, x, extra=()):
    return spark.createDataFrame([(i, [float(v) for v in row], 0, 1) for i, row in enumerate(x)] + list(extra), SCHEMA)


ODD = [(9001, None, 0, 1), (9002, [], 0, 1), (9003, [0.0] * 16, 0, 1), (9004, [1.0, None] * 8, 0, 1), (9005, [float("nan")] * 16, 0, 1),
       (9006, [float("inf")] * 16, 0, 1), (9007, [1.0], 0, 1), (None, [1.0] * 16, 0, 1)]


def test_chi_square():
    assert float(ann.chi_square(np.array(15.507))) == pytest.approx(0.95, abs=1e-3)


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 200)  # several cells
    x = np.random.default_rng(0).normal(size=(900, 16)).astype(np.float32)
    x[500:600] = x[0]  # equal vectors: ties
    got = ann.nearest(vectors(spark, x, ODD), "id % 100 = 0", k=10).collect()
    hits = 0
    for q in range(0, 900, 100):
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = math.inf
        best = np.lexsort((np.arange(900), d))[:10]
        assert all(abs(r["score"] - d[r["vec_id"]]) < 1e-12 for r in own)
        hits += len({r["vec_id"] for r in own} & set(best.tolist()))
    assert hits >= 81 and not {r["vec_id"] for r in got} & set(range(9001, 9008))
    few = ann.nearest(vectors(spark, x[:4]), "id % 100 = 0").collect()
    assert len(few) == 3 and ann.nearest(vectors(spark, x[:0], ODD[:1]), "id % 100 = 0").count() == 0


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 32)  # hot buckets are cut
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 16))
    x[100:200] = x[5] + 0.15 * rng.normal(size=(100, 16))
    x[210:230] = x[7]
    x = x.astype(np.float32)
    rows = {r["vec_id"]: r for r in vector_dedup.near_duplicates(vectors(spark, x, ODD)).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    found = sum(rows[i]["n_links"] for i in range(300))
    assert 0.97 * near.sum() <= found <= near.sum()
    assert all(rows[i]["component_id"] == 5 for i in [5, *range(100, 200)]) and all(rows[i]["component_id"] == 7 for i in range(210, 230))
    assert rows[7]["n_links"] == 20 and rows[210]["kept"] is False
    assert all(rows[i]["n_links"] == 0 and rows[i]["kept"] for i in range(9001, 9008)) and rows[None]["kept"] is False
    assert vector_dedup.near_duplicates(vectors(spark, x[:0])).count() == 0


def partners(x, cosine, seed=2):
    """For each row of unit vectors one at exactly this cosine, in a random direction."""
    u = np.random.default_rng(seed).normal(size=x.shape)
    u -= (u * x).sum(1)[:, None] * x
    return cosine * x + math.sqrt(1 - cosine * cosine) * u / np.linalg.norm(u, axis=1)[:, None]


def test_near_vectors_recall_with_long_keys(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "key_width", lambda rows: 20)  # as with over four million rows
    x = np.random.default_rng(4).normal(size=(500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = partners(x, 0.9005)
    rows = {r["vec_id"]: r["n_links"] for r in vector_dedup.near_duplicates(vectors(spark, np.concatenate([x, y]))).collect()}
    assert sum(rows[i] > 0 for i in range(500)) >= 0.98 * 500


def test_table_count():
    for width in range(6, 31):
        n = vector_dedup.table_count(width, 0.9)
        assert n >= 24 and 1 - (1 - (1 - math.acos(0.9) / math.pi) ** width) ** n >= 0.99
    assert vector_dedup.table_count(8, 1.0) == 24


def test_pipeline_stages(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} with some words of its own {i * 7} and more {i * i}", "en", "s", 0) for i in range(30)]
                                 + [(50, "a b c d e f g", "en", "s", 0), (51, "a b c d e f g", "en", "s", 0), (52, None, None, None, None),
                                    (53, "", "en", "s", 0), (54, "write to me@here.org now", "en", "s", 0), (None, "no id here", "en", "s", 0)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    df = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == docs.columns, name
        df = spark.createDataFrame(df.collect(), docs.schema)
    rows = {r["doc_id"]: r for r in df.collect()}
    assert set(rows) == {*range(30), 50, 52, 53, 54, None}
    assert rows[54]["text"] == "write to [EMAIL] now" and rows[54]["n_chars"] == 20 and rows[52]["n_chars"] is None
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == set(rows)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_texts_under_one_id_are_kept_apart(spark, tmp_path):
    long = lambda k: " ".join(f"{k}{i}" for i in range(60))
    a, b = long("a"), long("b")
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, long("c")), (4, long("d")), (4, long("d")), (None, a), (None, long("e")), (5, None), (5, None), (6, ""), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path))
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (4, long("c")), (4, long("d")), (None, long("e")), (5, None), (6, ""), (7, "")], key=str)


def test_sample_is_bounded_in_rows_and_bytes(spark):
    from foresight.llm.sample import texts_per_class
    rows = spark.range(4000).selectExpr("id as key", "repeat('x', cast(id % 2 * 1000 as int)) as text", "cast(id % 2 as int) as label")
    got = list(texts_per_class(rows, "label", "key", "text", 500, 100_000))
    sizes = [sum(r["label"] == y for r in got) for y in (0, 1)]
    assert 400 < sizes[0] < 600 and 70 < sizes[1] < 130 and [r["key"] for r in got] == sorted(r["key"] for r in got)


def test_record_batches_of_long_texts_are_bounded(spark):
    from foresight.llm.arrow import map_texts
    held = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
        docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat('word ', 2000) as text")  # 30 MB in one task
        run = lambda rows, data, offsets: [rows.column(0), [sum(b.size for b in rows.column(1).buffers() if b)] * rows.num_rows]
        got = map_texts(docs, "text", run, "doc_id bigint, bytes bigint").collect()
        assert [r["doc_id"] for r in got] == list(range(3000)) and max(r["bytes"] for r in got) < 9 << 20  # buffers double as they grow
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "100k")
        assert map_texts(docs.limit(10), "text", run, "doc_id bigint, bytes bigint").count() == 10
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "100k"  # a lower limit stays
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", held)


def test_workers_drop_the_tokenizer_of_an_earlier_stage(spark, tmp_path):
    from foresight.llm import packing
    from foresight.llm.arrow import map_texts
    docs = spark.range(0, 64, 1, 8).selectExpr("id as doc_id", "concat('text ', id) as text")
    assert dict(corpus_pipeline.STAGES)["packing"](spark, docs, str(tmp_path)).select("doc_id").distinct().count() == 64
    run = lambda rows, data, offsets: [rows.column(0), [packing._tokenizer_cache.cache_info().currsize] * rows.num_rows]
    assert {r["held"] for r in map_texts(docs, "text", run, "doc_id bigint, held int").collect()} == {0}
