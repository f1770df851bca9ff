"""Personal data in whole texts: candidate generators, boosted trees on format and context, calibrated thresholds.

Everything runs in Spark's own expressions on the row of a document: no text is shuffled and no Python runs in tasks.
Positions come from the pieces between the matches of a pattern: a match starts where the pieces and matches before it
end. Base spans are those of the contract below. The trees learn which candidates look like a base span or a labelled
secret; candidates above their kind's threshold that touch no base span are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from foresight.llm.bpe_job import _quoted

# Base kinds in order and their patterns. Possessive loops and the run-start condition give the same
# leftmost matches as the plain patterns without quadratic scans.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further generators with high recall: (kind, pattern, text that must occur).
GENERATORS = (
    ("email", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}[\x20]?(?:\[at\]|\(at\)|@)[\x20]?[a-z0-9-]{1,63}(?:[\x20]?(?:\[dot\]|\(dot\)|\.)[\x20]?[a-z0-9-]{1,63}){1,4}", r"(?i)@|\[at\]|\(at\)"),
    ("ip", r"(?i)(?<![0-9a-f:])[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){7}(?![0-9a-f:])", ":"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{0,2}[0-9]{4}){2}[\x20._/-]{0,2}[0-9]{1,7}(?![0-9])", "[0-9]{4}"),
    ("phone", r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "[0-9]{3}"),
    ("secret", r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+", "[A-Za-z0-9_/+-]{16}"),
)
LABELLED_SECRET = r"(?i)(?:password|passwd|secret|token|api_?key)[\x20]*[=:][\x20]*[\x22']?$"
CONTEXT = 24
FEATURES = ("kind", "size", "digits", "letters", "marks", "turns", "before", "after", "word")


def matches(text: Column, pattern: str, needs: str | None = None) -> tuple[Column, Column]:
    """(matches, pieces between them) of a pattern, in order; no matches where `needs` does not occur."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if needs:
        here = text.rlike(needs)
        found, pieces = F.when(here, found), F.when(here, pieces)
    return found, pieces


_SPANS = "array<struct<kind:int,generator:int,start:bigint,stop:bigint,body:string,before:string,after:string>>"


def _placed(kind: int, found: str, pieces: str, generator: int) -> Column:
    """Candidates array<struct> with code-point positions, from the columns of one pattern.

    Positions are running sums in two levels: about sqrt(n) blocks of sqrt(n) matches, so that growing an array by one costs
    its block, not the text."""
    items = f"""zip_with(zip_with(slice({pieces}, 1, size({found})), {found}, (a, m) -> named_struct('gap', a, 'body', m)), slice({pieces}, 2, size({found})),
                 (x, z) -> named_struct('gap', x.gap, 'body', x.body, 'after', left(z, {CONTEXT})))"""
    width = f"greatest(16, cast(ceil(sqrt(size({found}))) as int))"
    blocks = f"transform(sequence(0, (size({found}) - 1) div {width}), k -> slice(its, k * {width} + 1, {width}))"
    ends = "aggregate(transform(bs, b -> aggregate(b, 0L, (n, x) -> n + length(x.gap) + length(x.body))), array(0L), (a, n) -> array_append(a, element_at(a, -1) + n))"
    step = f"""(s, x) -> named_struct(
        'at', s.at + length(x.gap) + length(x.body),
        'out', array_append(s.out, named_struct('kind', {kind}, 'generator', {generator}, 'start', s.at + length(x.gap), 'stop', s.at + length(x.gap) + length(x.body),
                                                'body', x.body, 'before', right(x.gap, {CONTEXT}), 'after', x.after)))"""
    # an array of one binds matches and blocks to a name, so they are made once
    return F.expr(f"""case when size({found}) > 0 then flatten(transform(transform(array({items}), its -> {blocks}), bs ->
        flatten(zip_with(bs, slice({ends}, 1, size(bs)), (b, at) -> aggregate(b, named_struct('at', at, 'out', cast(array() as {_SPANS})), {step}, s -> s.out))))) end""")


def _below(sorted_: str, value: str) -> str:
    """SQL: how many numbers of a sorted array are below a value, by binary search."""
    steps = ", ".join(str(1 << i) for i in reversed(range(26)))
    return f"aggregate(array({steps}), 0, (lo_, by_) -> case when lo_ + by_ <= size({sorted_}) and {sorted_}[lo_ + by_ - 1] < {value} then lo_ + by_ else lo_ end)"


def _touches(kind: int, c: str) -> str:
    """SQL: a candidate overlaps a base span of the kind. These are disjoint and in order, so the last one that starts before
    the candidate's end tells."""
    return f"coalesce(get(_g{kind}, {_below(f'_s{kind}', f'{c}.stop')} - 1).stop > {c}.start, false)"


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '')"


def valid_expr(kind: str, c: str) -> str:
    """SQL condition that a base match of a kind passes."""
    if kind == "email":
        return "true"
    if kind == "ip":
        return f"forall(split({c}, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(p as int), 0) <= 255)"
    if kind == "phone":
        return f"length({_digits(c)}) between 9 and 15"
    d = _digits(c)
    return f"""(case when length({d}) between 13 and 19 then
      aggregate(transform(split(reverse({d}), ''), (ch, i) -> case when i % 2 = 0 then cast(ch as int)
        when cast(ch as int) >= 5 then cast(ch as int) * 2 - 9 else cast(ch as int) * 2 end), 0, (a, b) -> a + coalesce(b, 0)) % 10 = 0 else false end)"""


def _held(df: DataFrame, keep: list[str], names: list[str]) -> DataFrame:
    """Values that lambdas refer to, worked out once a row: an expression that is named once would be put into the lambda and
    evaluated for every element. A generator of one row keeps the optimizer from that."""
    return df.select(*keep, F.explode(F.array(F.struct(*names))).alias("_z")).select(*keep, *[F.col("_z")[n].alias(n) for n in names])


def candidates(df: DataFrame, text: str) -> DataFrame:
    """Adds the valid base spans by kind `_g0`.. with their starts `_s0`.., and `_more` (what the
    generators and the failed base matches propose)."""
    keep = df.columns
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    for i, kind in enumerate(KINDS[:4]):
        found, pieces = matches(F.col("_text"), BASE_PATTERNS[kind], "@" if kind == "email" else "[0-9]" if kind != "phone" else r"\+[0-9]")
        df = df.withColumns({f"_m{i}": found, f"_p{i}": pieces})
    for g, (kind, pattern, needs) in enumerate(GENERATORS):
        found, pieces = matches(F.col("_text"), pattern, needs)
        df = df.withColumns({f"_n{g}": found, f"_q{g}": pieces})
    empty = f"cast(array() as {_SPANS})"
    df = df.withColumns({f"_c{i}": F.coalesce(_placed(i, f"_m{i}", f"_p{i}", -1), F.expr(empty)) for i in range(4)})
    df = df.withColumns({f"_d{g}": F.coalesce(_placed(KINDS.index(kind), f"_n{g}", f"_q{g}", g), F.expr(empty)) for g, (kind, _, _) in enumerate(GENERATORS)})
    df = df.withColumns({f"_g{i}": F.expr(f"filter(_c{i}, c -> {valid_expr(KINDS[i], 'c.body')})") for i in range(4)})
    bad = [F.expr(f"filter(_c{i}, c -> not {valid_expr(KINDS[i], 'c.body')} and length({_digits('c.body')}) >= 7)") for i in (1, 2, 3)]
    df = df.withColumn("_more", F.concat(*bad, *[F.col(f"_d{g}") for g in range(len(GENERATORS))]))
    df = df.withColumns({f"_s{i}": F.expr(f"transform(_g{i}, b -> b.start)") for i in range(4)})
    return _held(df, keep, [*[f"_{c}{i}" for c in "gs" for i in range(4)], "_more"])


def _side(c: str) -> str:
    return f"case when {c} = '' then 0 when {c} rlike '[[:space:]\\\\s]' then 1 when {c} rlike '[A-Za-z0-9]' then 2 when {c} rlike '[=:\\\\x22\\\\x27(<@+]' then 3 else 4 end"


def feature_exprs(c: str) -> dict[str, str]:
    """SQL of the small integer features of a candidate struct; every one takes at most nine values."""
    body, size = f"{c}.body", f"greatest(length({c}.body), 1)"
    count = lambda keep: f"length(regexp_replace({body}, '[^{keep}]', ''))"
    return {
        "kind": f"{c}.kind",
        "size": f"case when {size} < 8 then 0 when {size} < 12 then 1 when {size} < 16 then 2 when {size} < 20 then 3 when {size} < 28 then 4 when {size} < 41 then 5 when {size} < 65 then 6 else 7 end",
        "digits": f"cast(floor(4 * {count('0-9')} / {size}) as int)",
        "letters": f"cast(floor(4 * {count('A-Za-z')} / {size}) as int)",
        "marks": f"cast(least({size} - {count('A-Za-z0-9')}, 5) as int)",
        "turns": f"cast(least(size(regexp_extract_all({body}, '[0-9]+', 0)), 5) as int)",
        "before": _side(f"right({c}.before, 1)"),
        "after": _side(f"left({c}.after, 1)"),
        "word": f"case when {c}.before rlike '{LABELLED_SECRET.replace(chr(39), chr(92) + 'x27').replace(chr(92), chr(92) * 2)}' then 1 "
                f"when {c}.before rlike '(?i)(mail|phone|tel|card|visa|ip|host|key)[^a-z]*$' then 2 else 0 end",
    }


def _label(c: str) -> str:
    """Weak label: overlaps a base span of its kind, or is a secret by its own prefix or by the word before it."""
    f = feature_exprs(c)
    base = " ".join(f"when {k} then {_touches(k, c)}" for k in range(4))
    return f"(case {c}.kind {base} else {f['word']} = 1 or {c}.body rlike '^AKIA[0-9A-Z]{{16}}$' end)"


class Trees:
    """Boosted regression trees on integer features for the logistic loss, fitted to counted feature rows."""

    def __init__(self, rounds: int = 24, depth: int = 3, rate: float = 0.4):
        self.rounds, self.depth, self.rate, self.trees, self.start = rounds, depth, rate, [], 0.0

    def fit(self, rows: list[tuple[tuple[int, ...], float, float]]) -> "Trees":
        """rows: (features, positive count, negative count)."""
        total, hits = sum(p + n for _, p, n in rows), sum(p for _, p, _ in rows)
        share = (hits + 1) / (total + 2)
        self.start = math.log(share / (1 - share))
        margin = [self.start] * len(rows)
        for _ in range(self.rounds):
            grad, hess = [], []
            for (x, p, n), m in zip(rows, margin):
                q = 1 / (1 + math.exp(-m))
                grad.append(p - (p + n) * q)
                hess.append(max((p + n) * q * (1 - q), 1e-9))
            tree = self._grow(rows, grad, hess, range(len(rows)), self.depth)
            self.trees.append(tree)
            margin = [m + self._value(tree, x) for m, (x, _, _) in zip(margin, rows)]
        return self

    def _grow(self, rows, grad, hess, own, depth):
        g, h = sum(grad[i] for i in own), sum(hess[i] for i in own)
        best = (1e-6, None)
        if depth:
            for f in range(len(FEATURES)):
                by: dict[int, list[float]] = {}
                for i in own:
                    e = by.setdefault(rows[i][0][f], [0.0, 0.0])
                    e[0] += grad[i]
                    e[1] += hess[i]
                a = b = 0.0
                for v in sorted(by)[:-1]:
                    a, b = a + by[v][0], b + by[v][1]
                    gain = a * a / (b + 1) + (g - a) ** 2 / (h - b + 1) - g * g / (h + 1)
                    if gain > best[0]:
                        best = (gain, (f, v))
        if best[1] is None:
            return self.rate * g / (h + 1)
        f, v = best[1]
        return (f, v, self._grow(rows, grad, hess, [i for i in own if rows[i][0][f] <= v], depth - 1),
                self._grow(rows, grad, hess, [i for i in own if rows[i][0][f] > v], depth - 1))

    def _value(self, tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    def score(self, x) -> float:
        m = self.start + sum(self._value(t, x) for t in self.trees)
        return 1 / (1 + math.exp(-m))

    def sql(self, c: str) -> str:
        """SQL of the score from a struct of features."""
        def node(t):
            if not isinstance(t, tuple):
                return f"{t:.10e}D"
            return f"if({c}.{FEATURES[t[0]]} <= {t[1]}, {node(t[2])}, {node(t[3])})"
        return f"(1D / (1D + exp(-({self.start:.10e}D + {' + '.join(map(node, self.trees)) or '0D'}))))"


def fit(cands: DataFrame, precision: float = 0.95) -> tuple[Trees, dict[int, float]]:
    """Trees and, by kind, the least score whose held-out precision reaches `precision` (2: adds none).

    Candidates of all documents count. They reach the driver as counts per feature vector: their number is bounded by
    the features' few values, not by the documents."""
    x = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in feature_exprs("c").items()) + ")"
    told = F.expr(f"transform(_more, c -> named_struct('x', {x}, 'y', cast({_label('c')} as int)))")   # before exploding: spans are not copied
    counted = (cands.select("_id", told.alias("told")).select("_id", F.explode("told").alias("t"))
               .select("t.x", "t.y", F.expr("crc32(cast(coalesce(_id, 0) as string)) % 2").alias("held"))
               .groupBy("x", "held").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).collect())
    rows = sorted((int(r.held), tuple(int(r.x[f]) for f in FEATURES), float(r.p), float(r.n)) for r in counted)
    model = Trees().fit([r[1:] for r in rows if r[0] == 0])
    limits = {}
    for kind in range(len(KINDS)):
        own = sorted(((model.score(x), p, n) for held, x, p, n in rows if held and x[0] == kind), reverse=True)
        hits = misses = 0.0
        limits[kind] = 2.0
        for s, p, n in own:
            hits, misses = hits + p, misses + n
            if hits >= precision * (hits + misses) and s >= 0.5:
                limits[kind] = s - 1e-9
    return model, limits


def _joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.stop)), ',')"


FAMILIES = len(GENERATORS) + 3   # generators, and failed base matches of three kinds: spans of one family do not overlap


def _found(df: DataFrame) -> DataFrame:
    """Adds `_base` and `_spans` to a table with `_id` and `_doc`; every step is about linear in the matches of a text."""
    keep = df.columns
    cands = candidates(df, "_doc")
    model, limits = fit(cands)
    limit = "element_at(array(" + ", ".join(f"{limits[k]:.12f}D" for k in range(len(KINDS))) + "), s.kind + 1)"
    x = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in feature_exprs("c").items()) + ")"
    free = " and ".join(f"not {_touches(k, 'c')}" for k in range(4))
    family = f"if(c.generator >= 0, c.generator, {len(GENERATORS)} + c.kind - 1)"
    scored = cands.withColumn("_more", F.expr(f"filter(_more, c -> {free})"))
    scored = scored.withColumn("_more", F.expr(f"transform(_more, c -> named_struct('start', c.start, 'stop', c.stop, 'kind', c.kind, 'family', {family}, 'x', {x}))"))
    scored = scored.withColumn("_more", F.expr(f"transform(_more, s -> named_struct('start', s.start, 'stop', s.stop, 'kind', s.kind, 'family', s.family, 'score', {model.sql('s.x')}))"))
    scored = scored.withColumn("_more", F.expr(f"filter(_more, s -> s.score >= {limit})"))
    # of overlapping accepted candidates the better one stays, then the earlier, longer, first kind: those of one family that
    # overlap a candidate are neighbours, and all such pairs are no more than spans times families
    scored = scored.withColumns({f"_f{f}": F.expr(f"filter(_more, s -> s.family = {f})") for f in range(FAMILIES)})
    scored = scored.withColumns({f"_{n}{f}": F.expr(f"transform(_f{f}, s -> s.{v})") for f in range(FAMILIES) for n, v in (("b", "start"), ("e", "stop"))})
    scored = _held(scored, [*keep, *[f"_g{i}" for i in range(4)]], ["_more", *[f"_{n}{f}" for f in range(FAMILIES) for n in "fbe"]])
    order = "struct(-{0}.score as a, {0}.start as b, -{0}.stop as c, {0}.kind as d)"
    better = " or ".join(
        f"exists(slice(_f{f}, {_below(f'_e{f}', 's.start + 1')} + 1, greatest({_below(f'_b{f}', 's.stop')} - {_below(f'_e{f}', 's.start + 1')}, 0)), "
        f"o -> {order.format('o')} < {order.format('s')})" for f in range(FAMILIES))
    scored = scored.withColumn("_more", F.expr(f"filter(_more, s -> not ({better}))"))
    simple = "named_struct('kind', {0}.kind, 'start', {0}.start, 'stop', {0}.stop)"
    out = scored.withColumn("_base", F.expr(f"transform(concat(_g0, _g1, _g2, _g3), b -> {simple.format('b')})"))
    out = _held(out, keep, ["_base", "_more"])
    out = out.withColumn("_spans", F.expr(f"array_sort(concat(_base, transform(_more, m -> {simple.format('m')})))"))
    out = _held(out, [*keep, "_base"], ["_spans"])
    out = out.withColumn("_spans", F.expr("filter(_spans, (s, i) -> i = 0 or s <> _spans[i - 1])"))
    return out.select(*keep, "_base", "_spans")


def _packed(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows as one column, so that no name of theirs meets one of the operator's."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias("_row"), F.col(_quoted(key)).alias("_id"), F.col(_quoted(text)).alias("_doc"))


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds array columns `base` and `spans` (all) of (kind, start, stop), sorted by kind, then start; they replace columns of
    these names.

    Positions count code points, the end is exclusive; kinds are numbers into KINDS. Null and empty texts have no spans.
    Repeated rows stay. Every row is worked on alone; other columns stay as they are, whatever their names."""
    keep = [c for c in df.columns if c not in ("base", "spans")]
    out = _found(_packed(df, key, text))
    return out.select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of base kinds, digest of the base spans and all spans as text."""
    out = _found(_packed(df.select(key, text), key, text))
    counts = [F.expr(f"cast(size(filter(_base, b -> b.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return out.select(F.col("_id").alias(key), *counts, F.sha2(F.expr(_joined("_base")), 256).alias("base_sha256"), F.expr(_joined("_spans")).alias("spans"))


def redact(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with every found span of its text replaced by [KIND]; a null text stays null, other columns stay, whatever
    their names."""
    out = _found(_packed(df, key, text))
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # cut points in text order; spans that overlap an earlier one are swallowed by it
    ordered = "array_sort(transform(_spans, s -> named_struct('start', s.start, 'stop', s.stop, 'kind', s.kind)))"
    rebuilt = F.expr(f"""aggregate({ordered}, named_struct('at', 0L, 'text', ''), (a, s) -> named_struct(
        'at', greatest(a.at, s.stop),
        'text', if(s.start < a.at, a.text, concat(a.text, substring(_doc, cast(a.at + 1 as int), cast(s.start - a.at as int)), element_at(array({names}), s.kind + 1)))),
        a -> concat(a.text, substring(_doc, cast(a.at + 1 as int))))""")
    clean = F.when(F.size("_spans") > 0, rebuilt).otherwise(F.col("_doc"))
    return out.withColumn("_clean", clean).select(*[(F.col("_clean") if c == text else F.col("_row")[c]).alias(c) for c in df.columns])
