"""Vector bin packing of token pieces: dot-product heuristic under limits on tokens, segments and loss-bearing tokens.

Documents are cut where it helps: whole windows of the sequence length are sequences of their own when the limits allow
it, the remainders are packed. An open sequence takes the piece whose size vector has the largest dot product with the
room left; a piece that does not fit is cut to the room. Packing works inside a task on bounded blocks of pieces, so the
data are not shuffled; what a block leaves open is carried to the next, and the last rest of a task is cut into powers of
two, which need no padding.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from foresight.llm.arrow import worker_cache
from foresight.llm.bpe import WordCache, encode_documents
from foresight.llm.sample import release_memory
from foresight.llm.text import slices
from foresight.session import small_batches

BLOCK_PIECES = 4096
BLOCK_TOKENS = 1 << 21


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold. A piece bears loss on every token but the first of its document.

    1,024 segments close a sequence early only where its pieces average under two tokens, that is, texts without a token."""
    tokens: int = 2048
    segments: int = 1024
    loss_tokens: int = 2048


class Packer:
    """Packs pieces (document, start, length) handed over in blocks; emits (document, start, length, sequence, offset)."""

    def __init__(self, limits: Limits):
        if limits.tokens < 1 or limits.tokens & (limits.tokens - 1) or limits.segments < 1 or limits.loss_tokens < 1:
            raise ValueError("the token limit is a power of two, the other limits are positive")
        self.limits = limits
        self.sequence = 0
        self.out: list[tuple] = []

    def _whole(self, doc, start, size, loss_first) -> bool:
        """A full window as a sequence of its own, if its loss fits."""
        return size - loss_first <= self.limits.loss_tokens

    def pack(self, doc: np.ndarray, start: np.ndarray, length: np.ndarray, last: bool) -> list[tuple]:
        """Packs the given pieces; returns those left over (none if last). `start` is the place in the document."""
        full = self.limits.tokens
        d, s, n = [], [], []
        for a, b, c in zip(doc.tolist(), start.tolist(), length.tolist()):
            while c >= full and self._whole(a, b, full, b == 0):
                self.out.append((a, b, full, self.sequence, 0))
                self.sequence += 1
                b, c = b + full, c - full
            if c:
                d.append(a), s.append(b), n.append(c)
        order = np.lexsort((s, d, -np.array(n, np.int64))) if n else []
        d, s, n = (np.array(x, np.int64)[order] for x in (d, s, n)) if len(order) else (np.zeros(0, np.int64),) * 3
        loss = n - (s == 0)
        weight = np.array([1 / full, 1 / self.limits.segments, 1 / self.limits.loss_tokens])
        left = int(n.sum())
        open_ = np.ones(len(n), bool)
        while left >= full or (left and last):
            room = np.array([full, self.limits.segments, self.limits.loss_tokens], np.int64)
            if left < full:  # the last rest: a power of two needs no padding
                room[0] = 1 << (left.bit_length() - 1)
            offset = 0
            while room[0] > 0 and room[1] > 0 and left:
                live = np.flatnonzero(open_)
                fits = live[(n[live] <= room[0]) & (loss[live] <= room[2])]
                pool = fits if len(fits) else live
                gain = (n[pool] * room[0] * weight[0] ** 2 + room[1] * weight[1] ** 2 + loss[pool] * room[2] * weight[2] ** 2)
                i = pool[int(np.argmax(gain))]
                if not len(fits):
                    take = int(min(n[i], room[0], room[2] + (s[i] == 0)))
                else:
                    take = int(n[i])
                if take <= 0:
                    break
                self.out.append((int(d[i]), int(s[i]), take, self.sequence, offset))
                offset += take
                room -= np.array([take, 1, take - (s[i] == 0)])
                s[i] += take
                n[i] -= take
                loss[i] = n[i] - (s[i] == 0)
                left -= take
                if n[i] == 0:
                    open_[i] = False
            self.sequence += 1
            if np.count_nonzero(open_) < len(open_) // 2:
                d, s, n, loss, open_ = d[open_], s[open_], n[open_], loss[open_], np.ones(int(open_.sum()), bool)
        return [(int(a), int(b), int(c)) for a, b, c in zip(d[open_], s[open_], n[open_])]


@worker_cache
def _tokenizer_cache(path: str) -> WordCache:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(data, start, end):
        parts = tokenizer.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist())], add_special_tokens=False)
        own = [x.ids for x in parts]
        return np.fromiter((i for x in own for i in x), np.int64), np.array([len(x) for x in own], np.int64)

    return WordCache(encode)


def pack_documents(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", limits: Limits = Limits(),
                   end_id: int = 1) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the byte-level tokenizer file plus `end_id`; a null or empty text is `end_id` alone.
    Repeated keys are packed as documents of their own. Empty tables give no rows. Sequence ids are unique, not dense:
    the task number is in the upper bits. Every task packs what it reads in the order of its input split, so a repeated
    task gives the same rows."""
    from foresight.llm.bpe_job import _narrow, _quoted

    small_batches(df.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        cache, packer = _tokenizer_cache(tokenizer_path), Packer(limits)
        base = TaskContext.get().partitionId() << 33
        names, doc_ids, held, tokens = [], [], [], 0   # held: (document, start, length) still to be packed

        def flush(last):
            nonlocal held, doc_ids, names, tokens
            a = np.array(held, np.int64).reshape(-1, 3)
            rest = packer.pack(a[:, 0], a[:, 1], a[:, 2], last)
            rows, packer.out = packer.out, []
            crc = [zlib.crc32(doc_ids[d][4 * s:4 * (s + n)]) for d, s, n, _, _ in rows]
            batch = pa.RecordBatch.from_arrays([
                pa.array([names[r[0]] for r in rows], names_type), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array(crc, pa.int64()),
                pa.array([len(doc_ids[r[0]]) // 4 for r in rows], pa.int64()),
                pa.array([base + r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())], names=out_names)
            keep = sorted({r[0] for r in rest})
            new = {d: i for i, d in enumerate(keep)}
            names, doc_ids = [names[d] for d in keep], [doc_ids[d] for d in keep]
            held = [(new[d], s, n) for d, s, n in rest]
            tokens = sum(len(x) // 4 for x in doc_ids)
            return batch

        names_type = pa.int64()
        for batch in batches:
            names_type = batch.column(0).type
            for a, b, data, offsets in slices(batch.column(1)):
                ids, first = encode_documents(cache, data, offsets)
                packed = ids.astype("<u4").tobytes()
                for i, name in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    own = packed[4 * first[i]:4 * first[i + 1]] + end_id.to_bytes(4, "little")
                    held.append((len(names), 0, len(own) // 4))
                    names.append(name)
                    doc_ids.append(own)
                    tokens += len(own) // 4
                    if len(held) >= BLOCK_PIECES or tokens >= BLOCK_TOKENS:
                        yield flush(False)
        if held:
            yield flush(True)
        release_memory()

    out_names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = dict(df.dtypes)[key]
    return _narrow(df, key, text).mapInArrow(run, f"{_quoted(key)} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
