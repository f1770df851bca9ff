"""Alignment of two tokenizers over the same bytes by sparse incidence matrices.

Tokens of either side are rows of a token-byte incidence matrix in CSR form. A·Bᵀ, by Gustavson's row products, has an entry for every
pair of tokens that overlap, its value being the number of shared bytes. Offsets where tokens of both sides end cut
them into groups; products of the token-group incidence matrices link what shares a group.

Everything up to the links happens where a text is read. The corpus-wide count of an id pair (documents that hold it
linked) needs all documents, the scores of a document need these counts: a sparse matrix-vector product. Tasks write blocks of
documents with the block's different pairs as a dictionary; only dictionaries are exchanged, once to count and once to bring
each block the counts of its own pairs. So a pair costs one row per block, however often a block holds it.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foresight.llm.arrow import map_texts
from foresight.llm.bpe import WordCache, encode_documents
from foresight.llm.packing import _tokenizer_cache
from foresight.llm.text import slices
from foresight.session import materialize

BLOCK_BYTES = 4 << 20
WINDOW_BYTES = 1 << 20
MARK = "▁"


@dataclass
class Csr:
    """Compressed sparse rows: row i has columns indices[indptr[i]:indptr[i + 1]] with these values."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transpose(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        count = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.concatenate([[0], np.cumsum(count)]), self.rows()[order], self.data[order], len(self.indptr) - 1)

    def __matmul__(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the other's rows k, weighted by the entries (i, k)."""
        width = np.diff(other.indptr)[self.indices]
        stop = np.cumsum(width)
        at = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(other.indptr[self.indices] - (stop - width), width)
        key = np.repeat(self.rows(), width) * other.columns + other.indices[at]
        value = np.repeat(self.data, width) * other.data[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        row, column = np.divmod(key[first], max(other.columns, 1))
        indptr = np.searchsorted(row, np.arange(len(self.indptr)))
        return Csr(indptr, column, np.add.reduceat(value, first) if len(first) else value[:0], other.columns)


def token_bytes(ends: np.ndarray) -> Csr:
    """Incidence of tokens that follow each other and the bytes they cover; `ends` are their byte ends."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64), n)


def token_groups(group: np.ndarray, n: int) -> Csr:
    """Incidence of tokens and groups, from each token's group."""
    return Csr(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), n)


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    return np.intersect1d(a_ends, b_ends, assume_unique=True)


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray, window: int = WINDOW_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, shared bytes) of all pairs that overlap, in order of A, then B.

    The product is taken over windows of about `window` bytes that end where both sides do, so memory does not grow
    with the text, unless a longer stretch has no common end."""
    common = common_ends(a_ends, b_ends)
    parts, start, a0, b0 = [], 0, 0, 0
    while start < (common[-1] if len(common) else 0):
        i = max(int(np.searchsorted(common, start + window, side="right")) - 1, int(np.searchsorted(common, start, side="right")))
        stop = int(common[i])
        a1, b1 = int(np.searchsorted(a_ends, stop)) + 1, int(np.searchsorted(b_ends, stop)) + 1
        p = token_bytes(a_ends[a0:a1] - start) @ token_bytes(b_ends[b0:b1] - start).transpose()
        parts.append((p.rows() + a0, p.indices + b0, p.data))
        start, a0, b0 = stop, a1, b1
    return tuple(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))


def group_links(a_group: np.ndarray, b_group: np.ndarray, n: int) -> Csr:
    """A tokens by B tokens of the same group. Its size is the sum over groups of A times B tokens."""
    return token_groups(a_group, n) @ token_groups(b_group, n).transpose()


class Vocabulary:
    """Bytes of every id of a tokenizer, and its encoder of many documents."""

    def __init__(self, tokens: list[bytes], encode):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.encode = encode

    def __len__(self):
        return len(self.length)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return _gather(self.flat, self.start[ids], self.length[ids])


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    stop = np.cumsum(length)
    return flat[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(start - (stop - length), length)]


@functools.lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> Vocabulary:
    """A byte-level tokenizer file; its pre-tokens are those of `text.pre_tokens`."""
    from tokenizers import Tokenizer
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]   # bytes that stand for themselves
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(byte.get(c, 0) for c in token)
    cache = _tokenizer_cache(path)
    return Vocabulary(tokens, lambda data, offsets: encode_documents(cache, data, offsets))


@functools.lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> Vocabulary:
    """A piece model that puts a blank before a text. Documents handed to its encoder begin with that blank.

    Where no piece holds a blank behind another character, merges never cross the start of a run of blanks, so runs with the
    word behind them are encoded once and kept by hash; a model with other pieces gets whole documents."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    apart = not any(MARK in p.lstrip(MARK) for p in pieces)
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(pieces))]
    tokens = [b"" if s else bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
              for i, (p, s) in enumerate(zip(pieces, special))]
    blank = model.piece_to_id(MARK)

    def pieces_of(data, start, end):
        texts = [data[a + 1:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist())]
        own = [x if t else [blank] for t, x in zip(texts, model.encode(texts, num_threads=1))]
        return np.fromiter((i for x in own for i in x), np.int64), np.array([len(x) for x in own], np.int64)

    cache = WordCache(pieces_of)

    def encode(data, offsets):
        first = np.zeros(len(data) + 1, bool)
        if apart:
            space = data == 0x20
            first[:-1] = space
            first[1:-1] &= ~space[:-1]
        first[offsets] = True
        start = np.flatnonzero(first[:-1])
        ids, counts = cache.lookup(data, start, np.append(start[1:], len(data)) if len(start) else start)
        at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return ids, at[np.searchsorted(start, offsets)]

    return Vocabulary(tokens, encode)


@dataclass
class Slice:
    """Tokens, links and groups of a slice of documents; documents without tokens have empty ranges."""
    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray     # index of each document's first A token
    b_first: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    g_first: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_bytes: np.ndarray
    link_first: np.ndarray


def _selected(values: np.ndarray, first: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    count = np.where(good, np.diff(first), 0)
    return values[np.repeat(good, np.diff(first))], np.concatenate([[0], np.cumsum(count)])


def align_slice(va: Vocabulary, vb: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> Slice:
    """Both encodings of documents that begin with a blank; one that is shorter than two bytes, or that either side does not spell exactly, has
    no tokens."""
    sides = [(v, *v.encode(data, offsets)) for v in (va, vb)]
    good = np.diff(offsets) > 1
    for v, ids, first in sides:
        length = np.concatenate([[0], np.cumsum(v.length[ids])])
        good &= np.diff(length[first]) == np.diff(offsets)
    for v, ids, first in sides:
        own, at = _selected(data, offsets, good)
        wrong = np.flatnonzero(v.spell(_selected(ids, first, good)[0]) != own)
        good[np.searchsorted(at, wrong, side="right") - 1] = False
    (a, a_first), (b, b_first) = (_selected(ids, first, good) for _, ids, first in sides)
    a_ends, b_ends = np.cumsum(va.length[a]), np.cumsum(vb.length[b])
    common = common_ends(a_ends, b_ends)
    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    link_a, link_b, shared = overlap_links(a_ends, b_ends)
    bytes_at = np.concatenate([[0], np.cumsum(np.where(good, np.diff(offsets), 0))])
    return Slice(a, b, a_first, b_first, a_group, b_group, np.searchsorted(common, bytes_at, side="right"),
                 link_a, link_b, shared, np.searchsorted(link_a, a_first))


@functools.lru_cache(maxsize=1)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal numbers below n, each with a byte behind it for what follows."""
    parts = [b"%d," % i for i in range(n)]
    length = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(length) - length, length


def group_texts(s: Slice, n_ids: int) -> list[bytes]:
    """Per document its groups as `a1,a2|b1;a3|b2,b3`, empty without tokens."""
    n = int(s.g_first[-1])
    of_a, of_b = np.bincount(s.a_group, minlength=n), np.bincount(s.b_group, minlength=n)
    place_a = np.arange(len(s.a)) + (np.cumsum(of_b) - of_b)[s.a_group]
    place_b = np.arange(len(s.b)) + np.cumsum(of_a)[s.b_group]
    ids = np.zeros(len(s.a) + len(s.b), np.int64)
    ids[place_a], ids[place_b] = s.a, s.b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[place_a[np.cumsum(of_a) - 1]] = ord("|")
    mark[place_b[np.cumsum(of_b) - 1]] = ord(";")
    flat, start, length = _decimals(n_ids)
    out = _gather(flat, start[ids], length[ids])
    stop = np.cumsum(length[ids])
    out[stop - 1] = mark
    at = np.concatenate([[0], stop])[s.a_first + s.b_first].tolist()
    raw = out.tobytes()
    return [raw[x:max(x, y - 1)] for x, y in zip(at[:-1], at[1:])]


def _varints(values: np.ndarray) -> bytes:
    """Unsigned numbers below 2^35, seven bits a byte, low ones first, the high bit set on all but the last byte."""
    width = 1 + sum((values >= (1 << 7 * k)).astype(np.int64) for k in range(1, 5))
    stop = np.cumsum(width)
    step = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - width, width)
    out = (np.repeat(values, width) >> (7 * step)) & 127
    out[step < np.repeat(width, width) - 1] |= 128
    return out.astype(np.uint8).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    step = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * step), first) if len(first) else np.zeros(0, np.int64)


def _with_blank(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("_key"), F.concat(F.lit(" "), F.col(text)).alias("_text"))


def align(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, a array<int>, b array<int> (ids), links array<struct<a, b, bytes>> (token places from 0, in order),
    groups array<struct<a, b>> (places where each group's tokens end).

    Texts that are null, empty or not spelt exactly by both sides have empty arrays. Repeated keys give repeated rows, an
    empty table none. Only key and text are read. Both files must lie at the same path on all executors."""
    def run(rows, data, offsets):
        s = align_slice(byte_vocabulary(a_path), piece_vocabulary(b_path), data, offsets)
        own_a, own_b = s.a_first[:-1], s.b_first[:-1]
        n_links, n_groups = np.diff(s.link_first), np.diff(s.g_first)
        lists = lambda values, first: pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)
        ints = lambda x: pa.array(x, pa.int32())
        links = [ints(s.link_a - np.repeat(own_a, n_links)), ints(s.link_b - np.repeat(own_b, n_links)), ints(s.link_bytes)]
        n = int(s.g_first[-1])
        ends = [ints(np.cumsum(np.bincount(g, minlength=n)) - np.repeat(own, n_groups)) for g, own in ((s.a_group, own_a), (s.b_group, own_b))]
        return [rows.column(0), lists(ints(s.a), s.a_first), lists(ints(s.b), s.b_first),
                lists(pa.StructArray.from_arrays(links, ["a", "b", "bytes"]), s.link_first), lists(pa.StructArray.from_arrays(ends, ["a", "b"]), s.g_first)]

    schema = f"_key {dict(df.dtypes)[key]}, a array<int>, b array<int>, links array<struct<a: int, b: int, bytes: int>>, groups array<struct<a: int, b: int>>"
    return map_texts(_with_blank(df, key, text), "_text", run, schema, cached=True).withColumnRenamed("_key", key)


def _blocks(df: DataFrame, a_path: str, b_path: str, key: str, text: str) -> DataFrame:
    """One row per block of documents: lists with an entry per document, its linked pairs as increasing places in the
    block's dictionary with how often each is linked, and the dictionary: pairs, and documents of the block that hold each."""
    kind = df.select(F.col(key).alias("_key")).schema["_key"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    key_type = to_arrow_type(kind)
    names = ["keys", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pairs", "places", "times", "pairs", "docs"]

    def run(batches):
        from pyspark import TaskContext
        va, vb = byte_vocabulary(a_path), piece_vocabulary(b_path)
        ids, task, number = len(va) * len(vb), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def flush():
            nonlocal number, held, size
            keys, counts, digests, pair, times, n_pairs = zip(*held)
            dictionary, place, docs = np.unique(np.concatenate(pair), return_inverse=True, return_counts=True)
            n_pairs, times = np.concatenate(n_pairs), np.concatenate(times)
            step = np.diff(place, prepend=0)
            first = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
            step[first] = place[first]
            columns = [pa.concat_arrays(keys), *np.concatenate(counts, axis=1), [d for own in digests for d in own], n_pairs,
                       _varints(step), _varints(times), dictionary, docs]
            types = [key_type, *[pa.int64()] * 4, pa.string(), pa.int32(), None, None, pa.int64(), pa.int32()]
            out = [pa.array([c], pa.binary()) if t is None else pa.array([c.to_pylist() if isinstance(c, pa.Array) else c], pa.list_(t)) for c, t in zip(columns, types)]
            batch = pa.RecordBatch.from_arrays([pa.array([f"{task}-{number}"]), *out], names=["block", *names])
            number, held, size = number + 1, [], 0
            return batch

        for batch in batches:
            for x, y, data, offsets in slices(batch.column(1)):
                s = align_slice(va, vb, data, offsets)
                n_links = np.diff(s.link_first)
                doc = np.repeat(np.arange(y - x), n_links)
                linked, times = np.unique(doc * ids + s.a[s.link_a] * np.int64(len(vb)) + s.b[s.link_b], return_counts=True)
                counts = np.stack([np.diff(s.a_first), np.diff(s.b_first), np.diff(s.g_first), n_links])
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(s, max(len(va), len(vb)))]
                held.append((batch.column(0).slice(x, y - x).cast(key_type), counts, digests, linked % ids, times, np.bincount(linked // ids, minlength=y - x)))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield flush()
        if held:
            yield flush()

    schema = (f"block string, keys array<{kind.simpleString()}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
              "digests array<string>, n_pairs array<int>, places binary, times binary, pairs array<bigint>, docs array<int>")
    return _with_blank(df, key, text).mapInArrow(run, schema)


def pair_counts(dictionaries: DataFrame, b_ids: int) -> DataFrame:
    """(pair, n, best) from (pair, docs): documents that hold an id pair linked, and whether no pair of its A id has more."""
    counts = dictionaries.groupBy("pair").agg(F.sum("docs").cast("bigint").alias("n")).withColumn("a", F.expr(f"pair div {b_ids}"))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scores(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, n_best (links whose id pair has its A id's highest count, ties
    included), count_sum (of its links' counts), groups_sha256 ('' without tokens).

    Texts that are null, empty or not spelt exactly by both sides have zeros and count nowhere. Rows that repeat a key are
    documents of their own; an empty table gives no rows. Only key and text are read."""
    b_ids = len(piece_vocabulary(b_path))
    blocks = materialize(_blocks(df, a_path, b_path, key, text), "aligned")
    entry = F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "e")
    dictionaries = blocks.select("block", entry).select("block", "place", F.col("e.pairs").alias("pair"), F.col("e.docs").alias("docs"))
    counts = materialize(pair_counts(dictionaries, b_ids), "pair-counts")
    own = dictionaries.select("block", "place", "pair").join(counts, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("e"))
    own = own.select("block", F.col("e.n").alias("n"), F.col("e.best").alias("best"))
    lists = ["keys", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pairs"]
    joined = blocks.select("block", *lists, "places", "times").join(own, "block", "left").select(*lists, "places", "times", "n", "best")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, n_a, n_b, n_groups, n_links, digests, n_pairs = (batch.column(i)[row].values for i in range(7))
                places, times = (_numbers(batch.column(i)[row].as_py()) for i in (7, 8))
                at = np.concatenate([[0], np.cumsum(n_pairs.to_numpy(zero_copy_only=False))]).astype(np.int64)
                total = np.concatenate([[0], np.cumsum(places)])
                place = total[1:] - np.repeat(total[at[:-1]], np.diff(at))
                sums = []
                for i in (10, 9):
                    values = batch.column(i)[row].values
                    values = np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False).astype(np.int64)
                    run_ = np.concatenate([[0], np.cumsum(values[place] * times)])
                    sums.append(pa.array(np.diff(run_[at]), pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, n_a, n_b, n_groups, n_links, *sums, digests], names=out)

    out = ["_key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kind = dict(df.dtypes)[key]
    return joined.mapInArrow(run, f"_key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string").withColumnRenamed("_key", key)
