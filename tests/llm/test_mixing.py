import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from foresight.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, taken int"  # two names that the operator also uses


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 0) for i, t, s in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), f"s{min(int(rng.expovariate(.4)), 9)}") for i in range(700)]
    rows += [(i, None, "empty") for i in range(900, 905)] + [(None, "a b c", None)] * 3 + [(7, "same text here", "s0")] * 40
    rows += [(2000, "one", "Z"), (2001, " \t\n", "Z"), (2002, "x y z", "é"), (2003, "x " * 5000, "s1"), (2004, "q " * 7, None)]
    return rows


def seats_of(parts, n):
    """Highest quotients, one seat at a time: parts are (id, votes, cap)."""
    got = Counter()
    for _ in range(n):
        left = [(-Fraction(v, 2 * got[i] + 1), i) for i, v, cap in parts if got[i] < cap and v]
        if not left:
            break
        got[min(left)[1]] += 1
    return got


def digest(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def brute(rows, mix):
    """Taken words by counting single words of the line of each shard."""
    sized = [(i, s, len((t or "").replace("\t", " ").replace("\n", " ").split(" ")) - (t or "").replace("\t", " ").replace("\n", " ").split(" ").count("") if t else 0)
             for i, t, s in rows]
    total = Counter()
    for _, s, n in sized:
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(names)}
    wanted = Fraction(sum(total.values()) * mix.percent, 100)
    full = set()
    while True:  # the excess is shared again until no source is above its cap
        rest = wanted - sum(mix.most * total[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[t] for t in names if t not in full) for s in names if s not in full}
        above = {s for s, x in share.items() if x >= mix.most * total[s]}
        if not above:
            break
        full |= above
    target = {s: mix.most * total[s] if s in full else share[s] for s in names}
    quota = seats_of([(k, weight[s], math.ceil(mix.most * total[s] / mix.block)) for k, s in enumerate(names) if s not in full], math.floor(rest / mix.block + Fraction(1, 2)))
    taken = defaultdict(list)
    for k, s in enumerate(names):
        own = Counter((i, n) for i, t, n in sized if t == s)
        shards = math.ceil(sum(own.values()) / mix.shard_rows)
        lines = defaultdict(list)
        for (i, n), copies in own.items():
            d = digest(mix.seed, "" if i is None else i, n, 0)
            lines[int(d[:8], 16) % shards].append((d[8:], i, n, copies))
        words = {h: sum(n * c for _, _, n, c in v) for h, v in lines.items()}
        dealt = seats_of([(h, w, math.ceil(w * mix.most / mix.block)) for h, w in words.items()], quota[k])
        for h, line in lines.items():
            w, q = words[h], dealt[h]
            last = mix.most * w // mix.block
            ends = [p * w // mix.block for p in range(mix.most + 1)]
            start = max(e for e in ends[:-1] if e <= q)
            among = ends[ends.index(start) + 1] - start if start in ends else 0
            stop = min(e for e in ends if e > start) if any(e > start for e in ends) else start
            among = stop - start
            chosen = set(range(start))
            shift = int(digest(mix.seed, s or "", h)[:8], 16) % max(among, 1)
            for b in range(among):
                if ((b + 1) * (q - start) + shift) // among > (b * (q - start) + shift) // among:
                    chosen.add(start + b)
            if q > last:
                chosen = set(range(q))
            at = 0
            for _, i, n, copies in sorted(line):
                for _ in range(copies):
                    if s in full:
                        spans = [(p, j) for p in range(mix.most) for j in range(n)]
                    else:
                        spans = [(p, j) for p in range(mix.most) for j in range(n) if (p * w + at + j) // mix.block in chosen]
                    taken[i, s].append((n, spans))
                    at += n
    return total, target, taken


@pytest.mark.parametrize("mix", [mixing.Mix(block=4, shard_rows=60), mixing.Mix(weights=(1, 9), percent=40, most=3, block=7, shard_rows=1000, seed="b")])
def test_plan_equals_brute_force(spark, mix):
    rows = odd_rows()
    total, target, taken = brute(rows, mix)
    got = mixing.plan(docs(spark, rows).repartition(3), mix, ranges=True).collect()
    assert len(got) == len(rows)
    words, own = Counter(), defaultdict(list)
    for r in got:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(float(target[r["source"]]), rel=1e-12)
        assert 0 <= r["taken"] <= mix.most * r["size"] and r["taken"] == sum(x["words"] for x in r["ranges"])
        words[r["source"]] += r["taken"]
        own[r["doc_id"], r["source"]].append((r["size"], [(x["pass"], x["first"] + j) for x in r["ranges"] for j in range(x["words"])]))
    assert {k: sorted(v) for k, v in own.items()} == {k: sorted(v) for k, v in taken.items()}
    assert all(abs(words[s] - target[s]) <= 2 * mix.block for s in total)
    assert abs(sum(words.values()) - sum(total.values()) * mix.percent / 100) <= 2 * mix.block * len(total)


def test_apportion_equals_one_seat_at_a_time(spark):
    rng = random.Random(8)
    groups = {g: [(i, rng.choice([0, 1, 5, 5, rng.randint(1, 10 ** 6)]), rng.choice([1, 3, 10 ** 9])) for i in range(rng.randint(1, 40))] for g in [None, *"abcdefgh"]}
    n = {g: rng.randint(0, 300) for g in groups}
    rows = [(g, i, v, cap, n[g]) for g, parts in groups.items() for i, v, cap in parts]
    table = spark.createDataFrame(rows, "g string, id int, votes bigint, cap bigint, seats bigint")
    got = {(r["g"], r["id"]): r["quota"] for r in mixing.apportion(table, "g").collect()}
    for g, parts in groups.items():
        want = seats_of(parts, n[g])
        most = sum(cap for _, v, cap in parts if v)
        if sum(want.values()) == n[g] and all(want[i] < cap for i, v, cap in parts if v):   # no cap binds
            assert {i: got[g, i] for i, _, _ in parts} == {i: want[i] for i, _, _ in parts}, g
        assert sum(got[g, i] for i, _, _ in parts) <= min(n[g], most) and all(got[g, i] <= cap for i, _, cap in parts)
    one = table.where("g = 'a'").drop("g")
    assert {r["id"]: r["quota"] for r in mixing.apportion(one).collect()} == {i: got["a", i] for i, _, _ in groups["a"]}


def test_reruns_partitions_and_empty_tables(spark):
    rows = odd_rows()
    a = sorted(map(tuple, mixing.plan(docs(spark, rows)).collect()), key=str)
    assert a == sorted(map(tuple, mixing.plan(docs(spark, rows[::-1]).repartition(13, "text")).collect()), key=str)
    assert mixing.plan(docs(spark, [])).count() == 0
    nothing = mixing.plan(docs(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in nothing] == [(0, 0, 0.0, 0)] * 2
    assert mixing.plan(docs(spark, rows)).columns == ["doc_id", "source", "size", "source_size", "target", "taken"]


def test_many_equal_rows_are_cut_into_lots(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 8)
    got = mixing.plan(docs(spark, [(1, "a b c", "s")] * 300 + [(2, "a b", "t")] * 3), mixing.Mix(block=4, shard_rows=20)).collect()
    assert len(got) == 303 and abs(sum(r["taken"] for r in got if r["source"] == "s") - got[0]["target"]) < 30
