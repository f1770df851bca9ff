import hashlib
import random
import re

import pytest

from foresight.llm import fim

SCHEMA = "doc_id bigint, text string, form string, _key string, output int"  # names that the operator also uses


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "f", "k", 7) for i, t in enumerate(texts)], SCHEMA)


def odd_texts():
    rng = random.Random(1)
    return [None, "", "a", "é", "abc", "<P>", "x<S>y", "a < P > b", "<M", "<", "S><P", "日本語 text\n\tab😀c" * 50, "word " * 30000] + [
        "".join(rng.choice("abZ é日<PSM>\n 😀") for _ in range(rng.randint(0, 40))) for _ in range(300)]


def brute(key, text):
    text = text or ""
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_transform_equals_brute_force_and_restores(spark):
    texts = odd_texts()
    table = docs(spark, texts)
    out = fim.restore(fim.transform(table))
    assert out.columns == ["doc_id", "text", "_key", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert {r["form"] for r in rows.values()} == {"plain", "psm", "spm"}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(i, t), t
        assert r["restored"] == (t or "") and r["text"] == t and r["_key"] == "k"
    for r in fim.digests(table).collect():
        want, text = brute(r["doc_id"], texts[r["doc_id"]]), texts[r["doc_id"]] or ""
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == want[:4]
        assert r["output_sha256"] == hashlib.sha256(want[4].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_keys_and_empty_tables(spark):
    out = fim.transform(docs(spark, ["some words here", "some words here", "other words"], [None, None, 4])).collect()
    assert len(out) == 3 and sorted(r["output"] for r in out) == sorted(brute(k, t)[4] for k, t in [(None, "some words here")] * 2 + [(4, "other words")])
    empty = docs(spark, [])
    assert fim.digests(empty).count() == 0 and fim.restore(fim.transform(empty)).count() == 0
    rows = fim.transform(docs(spark, ["a b c"] * 50, list(range(50))), plain_from=100, spm_below=100, seed="2").collect()
    assert all(r["form"] == "spm" for r in rows) and len({r["output"] for r in rows}) > 1
    lost = spark.createDataFrame([(None, "psm"), ("x", None), ("x", "plain")], "output string, form string")
    assert [r["restored"] for r in fim.restore(lost).collect()] == [None, None, "x"]


def test_piece_table():
    t = fim.PieceTable(b"abcdef")
    assert (t.cut(2), t.cut(2), t.cut(6), t.cut(0)) == (1, 1, 3, 1)
    assert t.bytes() == b"abcdef" and [n for _, _, n in t.pieces] == [0, 2, 0, 4, 0]
    with pytest.raises(IndexError):
        t.cut(7)
    for form in fim.FORMS:
        for a in range(7):
            for b in range(a, 7):
                out = fim.arranged(b"abcdef", a, b, form)
                assert len(out.pieces) == 6 and out.sha256() == hashlib.sha256(out.bytes()).hexdigest()
                assert fim.restored(out.bytes(), form).bytes() == b"abcdef"
    with pytest.raises(ValueError):
        fim.restored(b"<P>no more", "psm")
