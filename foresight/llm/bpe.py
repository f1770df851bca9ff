"""Byte-level BPE: a segment tree over byte positions keeps the leftmost smallest pair rank; a merge is three point updates.

`RankTable.encode` runs one tree per pre-token, many pre-tokens of one length class at once; `encode_one` is the same tree
for a single long pre-token. `Vocabulary` encodes whole documents: pre-tokens are found and hashed vectorised, each
different one is encoded once and kept in a bounded cache of the Python worker.
"""

from __future__ import annotations

import base64

import numpy as np

from foresight.llm.arrow import worker_cache
from foresight.llm.text import pre_tokens, span_hashes

NONE = np.iinfo(np.int64).max
LONG = 256          # longer pre-tokens get a tree of their own
CELLS = 1 << 18     # leaves in one batch of trees
CACHE_ENTRIES = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankTable:
    """Merge ranks as sorted arrays: (left id, right id) -> rank of their concatenation, which is also its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left = ranks.get(token[:k])
                if left is not None:
                    right = ranks.get(token[k:])
                    if right is not None:
                        keys.append(left << 32 | right)
                        values.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.append(np.array(keys, np.int64)[order], NONE)
        self.values = np.append(np.array(values, np.int64)[order], 0)
        self.pair = dict(zip(keys, values))
        first = self._find(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))
        self.first = first.reshape(256, 256)
        top = max(ranks.values()) + 1
        self.tokens = [b""] * top
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.token_length = np.array([len(t) for t in self.tokens], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)])
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        i = np.searchsorted(self.keys, key)
        return np.where(self.keys[i] == key, self.values[i], NONE)

    def encode_one(self, piece: bytes) -> list[int]:
        """Ids of one pre-token of any length, in O(n log n)."""
        n = len(piece)
        if n == 0:
            return []
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = 1 << (n - 1).bit_length()
        ids = [int(self.byte_id[b]) for b in piece]
        following, before, pair = [*range(1, n), -1], [-1, *range(n - 1)], self.pair
        big = (1 << 60, 0)
        tree = [big] * (2 * size)
        for i in range(n - 1):
            r = pair.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[size + i] = (r, i)
        for j in range(size - 1, 0, -1):
            tree[j] = min(tree[2 * j], tree[2 * j + 1])

        def put(i, value):
            j = size + i
            tree[j] = value
            j >>= 1
            while j:
                low = tree[2 * j] if tree[2 * j] <= tree[2 * j + 1] else tree[2 * j + 1]
                if tree[j] == low:
                    break
                tree[j] = low
                j >>= 1

        while tree[1] is not big and tree[1] != big:
            rank, i = tree[1]
            j = following[i]
            k = following[j]
            ids[i], ids[j], following[i] = rank, -1, k
            put(j, big)
            if k >= 0:
                before[k] = i
                r = pair.get(rank << 32 | ids[k])
                put(i, big if r is None else (r, i))
            else:
                put(i, big)
            if before[i] >= 0:
                p = before[i]
                r = pair.get(ids[p] << 32 | rank)
                put(p, big if r is None else (r, p))
        return [x for x in ids if x >= 0]

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all spans, number of ids of each): one segment tree per span, a batch of spans per pass."""
        length = end - start
        counts = np.zeros(len(start), np.int64)
        parts, todo = [], []  # parts: (spans, their ids in a row)
        for k, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            whole = self.ranks.get(data[a:b].tobytes()) if b - a <= 64 else None
            if whole is not None or b - a > LONG:
                own = [whole] if whole is not None else self.encode_one(data[a:b].tobytes())
                counts[k] = len(own)
                parts.append((np.array([k]), np.array(own, np.int64)))
            else:
                todo.append(k)
        rest = np.array(todo, np.int64)
        width = 2
        while len(rest):
            own = rest[length[rest] <= width]
            rest = rest[length[rest] > width]
            step = max(1, CELLS // width)
            for a in range(0, len(own), step):
                some = own[a:a + step]
                ids, counts[some] = self._batch(data, start[some], length[some], width)
                parts.append((some, ids))
            width *= 2
        stop = np.cumsum(counts)
        out = np.zeros(int(stop[-1]) if len(stop) else 0, np.int64)
        for some, ids in parts:
            n = counts[some]
            out[np.arange(len(ids)) + np.repeat(stop[some] - n - (np.cumsum(n) - n), n)] = ids
        return out, counts

    def _batch(self, data, start, length, n):
        m = len(start)
        col = np.arange(n)
        live = col < length[:, None]
        raw = np.where(live, data[np.minimum(start[:, None] + col, len(data) - 1)], 0)
        ids = np.where(live, self.byte_id[raw], -1)
        tree = np.full((m, 2 * n), NONE, np.int64)
        rank = self.first[raw[:, :-1], raw[:, 1:]]
        tree[:, n:2 * n - 1] = np.where(live[:, 1:] & (rank != NONE), rank * n + col[:-1], NONE)
        for j in range(n - 1, 0, -1):
            np.minimum(tree[:, 2 * j], tree[:, 2 * j + 1], out=tree[:, j])
        following = np.where(col + 1 < length[:, None], col + 1, -1)
        before = np.tile(col - 1, (m, 1))
        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            best = tree[row, 1]
            i = best % n
            new = best // n
            j = following[row, i]
            k = following[row, j]
            p = before[row, i]
            ids[row, i] = new
            ids[row, j] = -1
            following[row, i] = k
            has = k >= 0
            before[row[has], k[has]] = i[has]
            tree[row, n + j] = NONE
            at_i = np.full(len(row), NONE, np.int64)
            found = self._find(new[has], ids[row[has], k[has]])
            at_i[has] = np.where(found != NONE, found * n + i[has], NONE)
            tree[row, n + i] = at_i
            hp = p >= 0
            found = self._find(ids[row[hp], p[hp]], new[hp])
            tree[row[hp], n + p[hp]] = np.where(found != NONE, found * n + p[hp], NONE)
            p = np.where(hp, p, i)
            a, b, c = (n + i) >> 1, (n + j) >> 1, (n + p) >> 1
            while a[0]:
                for node in (a, b, c):
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                a, b, c = a >> 1, b >> 1, c >> 1
            row = row[tree[row, 1] != NONE]
        kept = ids >= 0
        return ids[kept], kept.sum(1)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids."""
        if len(ids) == 0:
            return b""
        length = self.token_length[ids]
        end = np.cumsum(length)
        index = np.arange(int(end[-1])) + np.repeat(self.token_start[ids] - (end - length), length)
        return self.token_bytes[index].tobytes()


class WordCache:
    """Ids of different pre-tokens by hash, in one growing array; emptied when it holds `limit` entries."""

    def __init__(self, encode, limit: int = CACHE_ENTRIES):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.int32)
        self.used = 0

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def lookup(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per span) for all spans of `data`."""
        if len(start) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        hashes, first, back = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.place) + len(hashes) > self.limit:
            self.clear()
        get, known = self.place.get, len(self.place)
        at = np.array([get(h, -1) for h in hashes.tolist()], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            s = first[new]
            ids, counts = self.encode(data, start[s], end[s])
            self.start, self.length = self._grown(self.start, known + len(new)), self._grown(self.length, known + len(new))
            self.ids = self._grown(self.ids, self.used + len(ids))
            self.ids[self.used:self.used + len(ids)] = ids
            at[new] = np.arange(known, known + len(new))
            self.start[at[new]] = self.used + np.cumsum(counts) - counts
            self.length[at[new]] = counts
            self.used += len(ids)
            self.place.update(zip(hashes[new].tolist(), at[new].tolist()))
        at = at[back]
        length = self.length[at]
        stop = np.cumsum(length)
        index = np.arange(int(stop[-1])) + np.repeat(self.start[at] - (stop - length), length)
        return self.ids[index], length


@worker_cache
def rank_vocabulary(path: str) -> tuple[RankTable, WordCache]:
    """Rank table and word cache of this Python worker."""
    table = RankTable(load_ranks(path))
    return table, WordCache(table.encode)


def encode_documents(cache: WordCache, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents of a slice, index of each document's first id)."""
    start, first = pre_tokens(data, offsets)
    end = np.append(start[1:], len(data)) if len(start) else start
    ids, counts = cache.lookup(data, start, end)
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return ids, at[first]
