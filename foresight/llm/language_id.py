"""Language of a text by unigram pieces whose segmentation is summed out.

Every language has a probability for each piece of a fixed public vocabulary. The forward algorithm sums over all ways to
cut a word into pieces; a text's score is the sum over its words. Piece probabilities come from expectation maximisation
on a bounded sample of labelled texts. Words are letter runs; each different word of a task is scored once.
"""

from __future__ import annotations

import functools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foresight.llm.arrow import map_texts
from foresight.llm.bpe import load_ranks
from foresight.llm.bpe_job import _narrow, _quoted
from foresight.llm.sample import per_class
from foresight.llm.text import LETTER, char_classes, code_points, slices, span_hashes

PIECE_BYTES = 6     # longer pieces of the vocabulary are not used
WORD_BYTES = 48     # longer letter runs are cut here
CACHE_ENTRIES = 400_000
EM_STEPS = 4
UNKNOWN = "und"


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the letter runs in bytes, cut at WORD_BYTES."""
    cp, at = code_points(data)
    inside = np.zeros(len(cp) + 2, bool)
    inside[1:-1] = char_classes()[cp] == LETTER
    edge = np.zeros(len(cp) + 1, bool)
    edge[np.searchsorted(at, offsets)] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    stop = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    start, end = at[begin], at[stop]
    parts = np.maximum(1, -(-(end - start) // WORD_BYTES))
    k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    doc = np.repeat(np.searchsorted(offsets, start, side="right") - 1, parts)
    start = np.repeat(start, parts) + k * WORD_BYTES
    return start, np.minimum(start + WORD_BYTES, np.repeat(end, parts)), doc


class Pieces:
    """Vocabulary pieces of up to PIECE_BYTES bytes, found by their packed bytes."""

    def __init__(self, path: str):
        tokens = sorted((t, r) for t, r in load_ranks(path).items() if len(t) <= PIECE_BYTES and b" " not in t)
        self.size = len(tokens)
        self.keys, self.index = [], []
        for n in range(1, PIECE_BYTES + 1):
            own = [(int.from_bytes(t, "big"), i) for i, (t, _) in enumerate(tokens) if len(t) == n]
            self.keys.append(np.array([k for k, _ in own] + [2**62], np.int64))
            self.index.append(np.array([i for _, i in own] + [self.size], np.int64))  # size: no such piece

    def grid(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
        """(PIECE_BYTES, words, width) piece that ends after each byte, by its length."""
        col = np.arange(width)
        raw = np.where(col < length[:, None], data[np.minimum(start[:, None] + col, len(data) - 1)], 0).astype(np.int64)
        out = np.full((PIECE_BYTES, len(start), width), self.size, np.int64)
        key = np.zeros_like(raw)
        for n in range(1, PIECE_BYTES + 1):
            # key of the n bytes that end at each column
            key = raw.copy() if n == 1 else np.concatenate([np.zeros((len(start), 1), np.int64), key[:, :-1]], 1) * 256 + raw
            i = np.searchsorted(self.keys[n - 1], key)
            hit = (self.keys[n - 1][i] == key) & (col >= n - 1) & (col < length[:, None])
            out[n - 1][hit] = self.index[n - 1][i[hit]]
        return out


@functools.lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def forward(grid: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(width + 1, words, languages): probability of all segmentations of each prefix. p has a last row of zeros."""
    _, words, width = grid.shape
    a = np.zeros((width + 1, words, p.shape[1]))
    a[0] = 1
    for j in range(width):
        for n in range(1, min(PIECE_BYTES, j + 1) + 1):
            a[j + 1] += a[j + 1 - n] * p[grid[n - 1, :, j]]
    return a


def _chunks(length: np.ndarray, cells: int = 1 << 15):
    """Groups of words of similar length."""
    order = np.argsort(length, kind="stable")
    a = 0
    while a < len(order):
        step = max(1, cells // max(1, int(length[order[min(a + 512, len(order) - 1)]])))
        b = min(len(order), a + step)
        yield order[a:b]
        a = b


class Model:
    """Log probability of words in each language."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p

    @classmethod
    def fit(cls, texts: dict[str, list[str]], path: str) -> "Model":
        pieces, languages = _pieces(path), sorted(texts)
        words = {}
        for k, language in enumerate(languages):
            for _, _, data, offsets in slices(pa.array(texts[language], pa.string())):
                start, end, _ = letter_runs(data, offsets)
                _, first, count = np.unique(span_hashes(data, start, end), return_index=True, return_counts=True)
                for a, b, c in zip(start[first].tolist(), end[first].tolist(), count.tolist()):
                    words.setdefault(data[a:b].tobytes(), np.zeros(len(languages)))[k] += c
        if not words:
            return cls(languages, np.zeros((pieces.size + 1, len(languages))))
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        counts = np.array(list(words.values()))
        p = np.full((pieces.size + 1, len(languages)), 1 / pieces.size)
        for _ in range(EM_STEPS):
            p[-1] = 0
            expected = np.zeros_like(p)
            for own in _chunks(length):
                width = int(length[own].max())
                grid = pieces.grid(data, start[own], length[own], width)
                a = forward(grid, p)
                b = np.zeros_like(a)  # b[j]: all segmentations of what follows the first j bytes
                b[length[own], np.arange(len(own))] = 1
                for j in range(width - 1, -1, -1):
                    for n in range(1, min(PIECE_BYTES, width - j) + 1):
                        b[j] += p[grid[n - 1, :, j + n - 1]] * b[j + n]
                z = np.maximum(b[0], 1e-300)
                for n in range(1, min(PIECE_BYTES, width) + 1):
                    g = grid[n - 1, :, n - 1:]
                    share = a[:width + 1 - n].transpose(1, 0, 2) * p[g] * b[n:].transpose(1, 0, 2) / z[:, None, :] * counts[own][:, None, :]
                    for k in range(p.shape[1]):
                        expected[:, k] += np.bincount(g.ravel(), share[:, :, k].ravel(), minlength=len(p))
            p = expected + 0.01
            p[-1] = 0
            p /= p.sum(0)
        return cls(languages, p)

    def words(self, pieces: Pieces, data, start, end) -> np.ndarray:
        length = end - start
        out = np.zeros((len(start), len(self.languages)), np.float32)
        for own in _chunks(length):
            width = int(length[own].max())
            a = forward(pieces.grid(data, start[own], length[own], width), self.p)
            out[own] = np.log(np.maximum(a[length[own], np.arange(len(own))], 1e-300))
        return out


def predict(df: DataFrame, model: Model, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score): the likeliest language of every whole text and its posterior under equal priors.

    A null text or one without letters is `und` with score 0; without any learned language every text is. Repeated rows
    stay."""
    held = df.sparkSession.sparkContext.broadcast(model)  # bounded: pieces x languages
    name = uuid.uuid4().hex  # of this model, for the cache of each Python worker

    def run(rows, data, offsets):
        m, pieces, known = held.value, _pieces(vocabulary_path), _word_cache(name)
        start, end, doc = letter_runs(data, offsets)
        total = np.zeros((len(offsets) - 1, max(1, len(m.languages))))
        if len(start) and m.languages:
            h, first, back = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
            at = known.places(h)
            new = np.flatnonzero(at < 0)
            if len(new):
                s = first[new]
                at = known.add(h, at, new, m.words(pieces, data, start[s], end[s]))
            value = known.values[at][back]
            for k in range(total.shape[1]):
                total[:, k] = np.bincount(doc, value[:, k], minlength=len(total))
        some = np.bincount(doc, minlength=len(total)) > 0
        best = total.argmax(1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names = m.languages or [UNKNOWN]
        return [rows.column(0), pa.array([names[b] if s else UNKNOWN for b, s in zip(best, some)]), np.where(some & bool(m.languages), score, 0.0)]

    return map_texts(_narrow(df, key, text), "_text", run, f"{_quoted(key)} {dict(df.dtypes)[key]}, lang_pred string, score double")


class _Known:
    """Values of different words by hash; emptied when it holds CACHE_ENTRIES."""

    def __init__(self):
        self.place, self.values = {}, None

    def places(self, hashes):
        if len(self.place) + len(hashes) > CACHE_ENTRIES:
            self.__init__()
        get = self.place.get
        return np.array([get(h, -1) for h in hashes.tolist()], np.int64)

    def add(self, hashes, at, new, values):
        n = len(self.place)
        if self.values is None or n + len(new) > len(self.values):
            grown = np.zeros((max(2 * n, n + len(new)), values.shape[1]), np.float32)
            if n:
                grown[:n] = self.values[:n]
            self.values = grown
        self.values[n:n + len(new)] = values
        at[new] = np.arange(n, n + len(new))
        self.place.update(zip(hashes[new].tolist(), at[new].tolist()))
        return at


@functools.lru_cache(maxsize=1)
def _word_cache(name: str) -> _Known:
    return _Known()


def learn(labelled: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = 400) -> Model:
    """Fits the model on at most about `bound` labelled texts of each language; null labels and texts are left out."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null")
    texts: dict[str, list[str]] = {}
    for r in per_class(rows, "lang", "key", bound):
        texts.setdefault(r["lang"], []).append(r["text"])
    return Model.fit(texts, vocabulary_path)
