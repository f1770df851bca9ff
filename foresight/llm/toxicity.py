"""Toxicity of texts: bidirectional gated recurrent network with attention pooling over overlapping windows of words.

A word enters as the sum of a hashed word vector and the mean of its hashed character trigram vectors, so parts of unseen
words count. Forward and backward recurrent states of a window are pooled by attention into one logit; a text's score is
that of its worst window. Training is numpy on the driver, on a bounded sample of labelled texts; scoring runs in tasks,
all windows of a slice of texts in step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foresight.llm.arrow import drop_caches, map_texts
from foresight.llm.bpe_job import _narrow, _quoted
from foresight.llm.sample import release_memory, texts_of_labels, texts_per_class
from foresight.llm.text import _BYTE_VALUE, _LOWER, mix, slices, span_hashes
from foresight.session import small_batches

WINDOW, STRIDE = 32, 24
BUCKETS = 1 << 14
INPUT, HIDDEN = 6, 6
TABLE_RATE = 0.3    # the hashed tables learn more slowly than the network: most of their rows are rare
DROP = 0.2          # share of words that a training window loses
SCORED_GRAMS = 1 << 18  # trigrams of the sample that are scored at once
PRIOR = 20          # pseudo-texts that pull the log odds of rare words and trigrams to 0
_EDGE = np.zeros(256, bool)
_EDGE[:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _EDGE[_a:_b] = False


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, start, end, first word of each document): runs of ASCII letters, digits and non-ASCII bytes."""
    low = _LOWER[data]
    inside = ~_EDGE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cut = np.flatnonzero(edge)
    keep = inside[cut[:-1]] if len(data) else np.zeros(0, bool)
    start, end = cut[:-1][keep], cut[1:][keep]
    return low, start, end, np.searchsorted(start, offsets)


def features(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, trigram buckets of all words in a row, trigrams per word); word ends count as characters."""
    bucket = (span_hashes(low, start, end) & np.uint64(BUCKETS - 1)).astype(np.int64)
    n = end - start  # as many trigrams as bytes: centred on each byte
    at = np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)
    v = _BYTE_VALUE[low] if len(low) else np.zeros(0, np.uint64)
    first, last = at == np.repeat(start, n), at == np.repeat(end - 1, n)
    left = np.where(first, np.uint64(7), v[np.maximum(at - 1, 0)]) if len(at) else np.zeros(0, np.uint64)
    right = np.where(last, np.uint64(9), v[np.minimum(at + 1, len(low) - 1)]) if len(at) else np.zeros(0, np.uint64)
    h = mix(left * np.uint64(3) + v[at] * np.uint64(5) + right * np.uint64(11))
    return bucket, (h & np.uint64(BUCKETS - 1)).astype(np.int64), n


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, document) of all overlapping windows; every word lies in one, empty texts have none."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return first[:-1][doc] + k * STRIDE, np.minimum(WINDOW, n[doc] - k * STRIDE), doc


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters of the network; `fit` trains them."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.normal(size=s) * 0.3).astype(np.float32)
        self.word, self.gram = w(BUCKETS, INPUT) * np.float32(0.1), w(BUCKETS, INPUT) * np.float32(0.1)
        self.wx, self.wh, self.b = w(2, INPUT, 3 * HIDDEN), w(2, HIDDEN, 3 * HIDDEN), np.zeros((2, 3 * HIDDEN), np.float32)
        self.att, self.out, self.bias = w(2 * HIDDEN), w(2 * HIDDEN), np.zeros(1, np.float32)
        self.shift = 0.0
        self.scale = 1.0

    names = ("word", "gram", "wx", "wh", "b", "att", "out", "bias")

    def vectors(self, bucket, grams, n) -> np.ndarray:
        """Input vector of every word."""
        total = np.zeros((len(n), INPUT), np.float32)
        if len(grams):
            flat = self.gram[grams]
            at = np.cumsum(n) - n
            total = np.add.reduceat(flat, at, axis=0) / n[:, None].astype(np.float32)
        return total + self.word[bucket]

    def _run(self, gates, mask, d, trace=None):
        """Recurrence over time for input gates (time, windows, 3H): states (time, windows, H)."""
        t, m, _ = gates.shape
        h = np.zeros((m, HIDDEN), np.float32)
        out = np.empty((t, m, HIDDEN), np.float32)
        u, uc = self.wh[d][:, :2 * HIDDEN], self.wh[d][:, 2 * HIDDEN:]
        for i in (range(t) if d == 0 else range(t - 1, -1, -1)):
            g = gates[i]
            zr = _fast_sigmoid(g[:, :2 * HIDDEN] + h @ u)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + (r * h) @ uc)
            new = h + z * (c - h)
            new = np.where(mask[i][:, None], new, h)
            if trace is not None:
                trace.append((i, h, z, r, c))
            h = out[i] = new
        return out

    def logits(self, vectors, index, mask) -> np.ndarray:
        """Logit of each window: index and mask are (time, windows)."""
        states = []
        for d in (0, 1):
            gates = (vectors @ self.wx[d] + self.b[d])[index]
            states.append(self._run(gates, mask, d))
        h = np.concatenate(states, 2)
        e = np.where(mask, h @ self.att, -1e9)
        e = np.exp(e - e.max(0))
        e = np.where(mask, e, 0)
        e /= e.sum(0)
        return ((e[:, :, None] * h).sum(0) @ self.out + self.bias[0]) * np.float32(self.scale) + np.float32(self.shift)

    def _gradient(self, bucket, grams, n, index, mask, label):
        x = self.vectors(bucket, grams, n)
        traces, states = ([], []), []
        for d in (0, 1):
            states.append(self._run((x @ self.wx[d] + self.b[d])[index], mask, d, traces[d]))
        h = np.concatenate(states, 2)
        e = np.where(mask, h @ self.att, -1e9)
        a = np.exp(e - e.max(0))
        a = np.where(mask, a, 0)
        a /= a.sum(0)
        pooled = (a[:, :, None] * h).sum(0)
        p = _sigmoid(pooled @ self.out + self.bias[0])
        g = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        dl = ((p - label) / len(label)).astype(np.float32)
        g["out"], g["bias"][0] = pooled.T @ dl, dl.sum()
        dp = dl[:, None] * self.out
        da = (h * dp).sum(2)
        de = a * (da - (a * da).sum(0))
        g["att"] = np.einsum("tm,tmh->h", de, h)
        dh = a[:, :, None] * dp + de[:, :, None] * self.att
        dx = np.zeros_like(x)
        for d in (0, 1):
            own, carry = dh[:, :, d * HIDDEN:(d + 1) * HIDDEN], np.zeros((h.shape[1], HIDDEN), np.float32)
            u, uc = self.wh[d][:, :2 * HIDDEN], self.wh[d][:, 2 * HIDDEN:]
            dg_all = np.zeros((len(mask), h.shape[1], 3 * HIDDEN), np.float32)
            for i, h0, z, r, c in reversed(traces[d]):
                m = mask[i][:, None]
                total = own[i] + carry
                dn = np.where(m, total, 0)
                dz, dc = dn * (c - h0) * z * (1 - z), dn * z * (1 - c * c)
                drh = dc @ uc.T
                dr = drh * h0 * r * (1 - r)
                dzr = np.concatenate([dz, dr], 1)
                carry = np.where(m, dn * (1 - z) + dzr @ u.T + drh * r, total)
                g["wh"][d][:, :2 * HIDDEN] += h0.T @ dzr
                g["wh"][d][:, 2 * HIDDEN:] += (r * h0).T @ dc
                dg_all[i] = np.concatenate([dzr, dc], 1)
            flat = dg_all.reshape(-1, 3 * HIDDEN)
            g["b"][d] = flat.sum(0)
            xs = x[index.reshape(-1)]
            g["wx"][d] = xs.T @ flat
            np.add.at(dx, index.reshape(-1), flat @ self.wx[d].T)
        np.add.at(g["word"], bucket, dx)
        np.add.at(g["gram"], grams, np.repeat(dx / np.maximum(n, 1)[:, None], n, axis=0).astype(np.float32))
        return g

    def _log_odds(self, docs, label):
        """First input starts as smoothed log odds of the buckets, so that training starts from what labels say."""
        for name, part in (("word", 0), ("gram", 1)):
            n = np.zeros((2, BUCKETS))
            for d, y in zip(docs, label):
                n[int(y)][np.unique(d[part])] += 1
            odds = np.log((n[1] + 0.5) / (max(label.sum(), 1) + 1)) - np.log((n[0] + 0.5) / (max((1 - label).sum(), 1) + 1))
            getattr(self, name)[:, 0] = odds * n.sum(0) / (n.sum(0) + PRIOR) * (n.sum(0) >= 4)

    @classmethod
    def fit(cls, texts: list[str], label: np.ndarray, epochs: int = 12, seed: int = 11) -> "Network":
        """Every epoch takes each text's worst window (and one other window of texts with label 0) as an example."""
        return cls._fitted(cls._inputs(texts), label, epochs, seed)

    @staticmethod
    def _inputs(texts) -> list[tuple]:
        """Word buckets, trigram buckets and trigrams per word of each text: all that training keeps of it."""
        docs = []
        for _, _, data, offsets in slices(pa.array(texts, pa.string())):
            low, start, end, first = words(data, offsets)
            bucket, grams, n = features(low, start, end)
            at = np.concatenate([[0], np.cumsum(n)])
            bucket, grams, n = bucket.astype(np.int16), grams.astype(np.int16), n.astype(np.int32)  # bucket numbers are below 2^14
            docs += [(bucket[a:b], grams[at[a]:at[b]], n[a:b]) for a, b in zip(first[:-1], first[1:])]
        return docs

    @classmethod
    def _fitted(cls, docs: list[tuple], label: np.ndarray, epochs: int = 12, seed: int = 11) -> "Network":
        self, rng = cls(seed), np.random.default_rng(seed)
        label = np.asarray(label, np.float32)
        if not len(docs) or label.min() == label.max():
            self.scale, self.shift = 0.0, (-3.0 if not len(docs) or label.max() == 0 else 3.0)
            return self
        used = [i for i, d in enumerate(docs) if len(d[0])]
        docs, label = [docs[i] for i in used], label[used]
        self._log_odds(docs, label)
        moment = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in self.names}
        step, weight = 0, 3e-2
        for epoch in range(epochs):
            scores = self._score(docs)
            chosen = []
            for i, (s, y) in enumerate(zip(scores, label)):
                chosen.append((i, int(np.argmax(s)), y))
                if y == 0 and len(s) > 1:
                    chosen.append((i, int(rng.integers(len(s))), y))
            rng.shuffle(chosen)
            rate = weight * (1 - epoch / epochs)
            for a in range(0, len(chosen), 256):
                part = chosen[a:a + 256]
                batch = [self._thinned(self._window(docs[int(i)], int(k)), rng) for i, k, _ in part]
                g = self._gradient(*_stacked(batch), np.array([y for *_, y in part], np.float32))
                step += 1
                for k in self.names:
                    m, v = moment[k]
                    m += 0.1 * (g[k] - m)
                    v += 0.01 * (g[k] * g[k] - v)
                    getattr(self, k)[...] -= (rate if k not in ("word", "gram") else rate * TABLE_RATE) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6) + rate * 1e-3 * getattr(self, k)
        self._calibrate(np.array([s.max() for s in self._score(docs)]), label)
        return self

    def _calibrate(self, worst, label):
        """Shift so that 0.5 lies in the gap of the sample with the fewest errors."""
        order = np.argsort(worst)
        s, y = worst[order], label[order]
        wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
        best = np.flatnonzero(wrong == wrong.min())
        i = int(best[len(best) // 2])
        lo, hi = s[max(i - 1, 0)], s[min(i, len(s) - 1)]
        self.shift = float(-(lo + hi) / 2)

    @staticmethod
    def _window(doc, k):
        bucket, grams, n = doc
        a, b = k * STRIDE, min(k * STRIDE + WINDOW, len(n))
        at = np.concatenate([[0], np.cumsum(n)])
        return bucket[a:b], grams[at[a]:at[b]], n[a:b]

    @staticmethod
    def _thinned(window, rng):
        bucket, grams, n = window
        keep = rng.random(len(n)) >= DROP
        if not keep.any():
            return window
        return bucket[keep], grams[np.repeat(keep, n)], n[keep]

    def _score(self, docs):
        """Logits of the windows of each document, on parts of bounded size."""
        out, a = [], 0
        size = np.concatenate([[0], np.cumsum([len(d[1]) for d in docs])])
        while a < len(docs):
            b = max(a + 1, int(np.searchsorted(size, size[a] + SCORED_GRAMS, side="right")) - 1)
            part = docs[a:b]
            first = np.concatenate([[0], np.cumsum([len(d[2]) for d in part])]).astype(np.int64)
            x = self.vectors(*(np.concatenate([d[j] for d in part]) for j in range(3)))
            s, doc = self.window_scores(x, first)
            out += np.split(s, np.searchsorted(doc, np.arange(1, len(part))))
            a = b
        return out

    def window_scores(self, vectors, first) -> tuple[np.ndarray, np.ndarray]:
        """(logit, document) of all windows."""
        start, length, doc = windows(first)
        out = np.empty(len(start), np.float32)
        t = np.arange(WINDOW)[:, None]
        for a in range(0, len(start), 4096):
            s, n = start[a:a + 4096], length[a:a + 4096]
            mask = t < n
            out[a:a + 4096] = self.logits(vectors, np.where(mask, s + t, s), mask)
        return out, doc


def _fast_sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _stacked(batch):
    first = np.concatenate([[0], np.cumsum([len(b[2]) for b in batch])]).astype(np.int64)
    t = np.arange(WINDOW)[:, None]
    mask = t < np.diff(first)
    return (*(np.concatenate([b[j] for b in batch]) for j in range(3)), np.where(mask, first[:-1] + t, first[:-1]), mask)


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = 2000, bound_bytes: int = 8 << 20) -> Network:
    """Fits the network on at most about `bound` labelled texts and `bound_bytes` bytes of text of each class; null labels and
    texts are left out. A text is dropped as soon as its inputs are made."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and text is not null")
    return _trained(texts_per_class(rows, "label", "key", "text", bound, bound_bytes))


def learn_from(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = 2000,
               bound_bytes: int = 8 << 20) -> Network:
    """As `learn` with the labels in a table of their own; texts outside the sample are not moved."""
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    return _trained(texts_of_labels(texts, marks, "label", "key", "text", bound, bound_bytes))


def _trained(sample) -> Network:
    docs, labels, held, size = [], [], [], 0
    for r in sample:
        held.append(r["text"])
        labels.append(r["label"])
        size += len(r["text"])
        if size >= 1 << 19:
            docs += Network._inputs(held)
            held, size = [], 0
    docs += Network._inputs(held)
    del held
    model = Network._fitted(docs, np.array(labels, np.float32))
    del docs
    release_memory()
    return model


def _worst(m: Network, data, offsets) -> np.ndarray:
    """Score of each document of a slice."""
    low, start, end, first = words(data, offsets)
    _, at, back = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
    x = m.vectors(*features(low, start[at], end[at]))[back] if len(start) else np.zeros((0, INPUT), np.float32)
    s, doc = m.window_scores(x, first)
    worst = np.full(len(offsets) - 1, -np.inf)
    np.maximum.at(worst, doc, s)
    return np.where(np.isfinite(worst), _sigmoid(worst.astype(np.float64)), 0.0)


def score(df: DataFrame, model: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every whole text, 0 to 1: that of its worst window. A null text or one without words has score 0.

    Repeated rows stay; memory is bounded by a slice of texts or the longest text."""
    held = df.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(rows, data, offsets):
        return [rows.column(0), _worst(held.value, data, offsets)]

    return map_texts(_narrow(df, key, text), "_text", run, f"{_quoted(key)} {dict(df.dtypes)[key]}, score double")


def reject(df: DataFrame, model: Network, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of the table, all columns, whose text scores below `limit`. Texts are not shuffled."""
    held = df.sparkSession.sparkContext.broadcast(model)
    small_batches(df.sparkSession)

    def run(batches):
        drop_caches()
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(batch.schema.get_field_index(text))):
                s = _worst(held.value, data, offsets)
                yield batch.slice(a, b - a).filter(pa.array(s < limit))
        release_memory()

    return df.mapInArrow(run, df.schema)
