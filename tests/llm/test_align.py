import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from foresight.llm import align, queries

A, B = public_tokenizers.path(queries.PACKING_TOKENIZER), public_tokenizers.path(queries.PIECES)
SCHEMA = "doc_id bigint, text string, block string, n_a string, _text int, source string"  # names that the operator also uses


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "b", "x", 1, "s") for i, t in enumerate(texts)], SCHEMA)


def odd_texts():
    rng = random.Random(6)
    alphabet = "aàs t'lrevemd  \n\t\r1٣!?¿' 　中é´日😀_\x1c\x85\0­<>s"
    return [None, "", " ", "  ", "a", "▁x", "a▁", "<s>", "</s>", "<|endoftext|> <unk> <0x41>", "x" * 400, " " * 300 + "x", "日本語のテキスト" * 40, "same words here", "same words here"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 50))) for _ in range(250)] + [" ".join(rng.choice(["alpha", "béta", "7,000", "don't"]) for _ in range(30)) for _ in range(40)]


def bytes_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    piece = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: tokenizer.encode(t, add_special_tokens=False).ids, lambda i: bytes(byte[c] for c in tokenizer.id_to_token(i)), model.encode, piece)


def brute(texts):
    encode_a, spell_a, encode_b, spell_b = bytes_of()
    out, count = [], Counter()
    for t in texts:
        a, b = (encode_a(" " + t), encode_b(t)) if t else ([], [])
        want = (" " + t).encode() if t else b""
        if b"".join(map(spell_a, a)) != want or b"".join(map(spell_b, b)) != want:
            a, b = [], []
        ends = [list(np.cumsum([len(spell(i)) for i in ids])) if ids else [] for spell, ids in ((spell_a, a), (spell_b, b))]
        spans = [list(zip([0, *e[:-1]], e)) for e in ends]
        links = [(i, j, min(y, v) - max(x, u)) for i, (x, y) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if x < v and u < y]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, start = [], 0
        for c in cuts:
            groups.append(tuple([k for k, e in enumerate(es) if start < e <= c] for es in ends))
            start = c
        out.append((a, b, links, groups))
        count.update({(a[i], b[j]) for i, j, _ in links})
    top = Counter()
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    return out, count, top


def expected(one, count, top):
    a, b, links, groups = one
    counts = [(a[i], count[a[i], b[j]]) for i, j, _ in links]
    text = ";".join(",".join(str(a[i]) for i in x) + "|" + ",".join(str(b[j]) for j in y) for x, y in groups)
    return (len(a), len(b), len(groups), len(links), sum(n == top[i] for i, n in counts), sum(n for _, n in counts),
            hashlib.sha256(text.encode()).hexdigest() if text else "")


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_scores_equal_brute_force(spark, monkeypatch):
    texts = odd_texts()
    want, count, top = brute(texts)
    for block in (200, 1 << 20):  # many blocks, and one for each task
        monkeypatch.setattr(align, "BLOCK_BYTES", block)
        rows = {r["doc_id"]: r for r in align.scores(docs(spark, texts).repartition(3), A, B).collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            assert tuple(rows[i][c] for c in COLUMNS) == expected(want[i], count, top), t
    assert sum(bool(w[0]) for w in want) > 250 and not want[5][0]


def test_links_and_groups_equal_brute_force(spark):
    texts = odd_texts()
    want, _, _ = brute(texts)
    for r in align.align(docs(spark, texts), A, B).collect():
        a, b, links, groups = want[r["doc_id"]]
        assert (r["a"], r["b"]) == (a, b) and [tuple(x) for x in r["links"]] == links
        assert [tuple(x) for x in r["groups"]] == [(x[-1] + 1, y[-1] + 1) for x, y in groups]


def test_query_and_defined_cases(spark, tmp_path):
    texts = ["one two", None, "one two", "", "three"]
    docs(spark, texts, [None, 1, None, 7, 7]).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op11_alignment(spark, str(tmp_path))
    assert out.columns == ["doc_id", *COLUMNS] and dict(out.dtypes)["doc_id"] == "bigint"
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want, count, top = brute(texts)
    assert got == sorted(((i, *expected(w, count, top)) for i, w in zip([None, 1, None, 7, 7], want)), key=str)
    assert align.scores(docs(spark, []), A, B).count() == 0 and align.align(docs(spark, []), A, B).count() == 0
    assert [r["n_links"] for r in align.scores(docs(spark, [None, ""]), A, B).collect()] == [0, 0]


def test_products():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x, y = rng.integers(0, 3, (5, 7)) * (rng.random((5, 7)) < .4), rng.integers(0, 3, (7, 4)) * (rng.random((7, 4)) < .4)
        m = [align.Csr(np.concatenate([[0], np.cumsum((d != 0).sum(1))]), np.nonzero(d)[1], d[d != 0], d.shape[1]) for d in (x, y)]
        dense = lambda c: np.array([[c.data[c.indptr[i]:c.indptr[i + 1]][c.indices[c.indptr[i]:c.indptr[i + 1]] == j].sum() for j in range(c.columns)] for i in range(len(c.indptr) - 1)])
        assert (dense(m[0] @ m[1]) == x @ y).all() and (dense(m[0].transpose()) == x.T).all()
        n = int(rng.integers(1, 300))
        ends = [np.unique(np.append(rng.integers(1, n + 1, int(rng.integers(1, 60))), n)) for _ in range(2)]
        whole, pieces = align.overlap_links(*ends), align.overlap_links(*ends, window=9)
        assert all((p == q).all() for p, q in zip(whole, pieces)) and whole[2].sum() == n
        common = align.common_ends(*ends)
        groups = [np.searchsorted(common, e) for e in ends]
        shared = align.group_links(*groups, len(common))
        assert {(i, j) for i, j in zip(shared.rows().tolist(), shared.indices.tolist())} == {(i, j) for i, g in enumerate(groups[0]) for j, h in enumerate(groups[1]) if g == h}
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**34])
    assert (align._numbers(align._varints(values)) == values).all() and len(align._numbers(b"")) == 0
