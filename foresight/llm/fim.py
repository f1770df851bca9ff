"""Fill-in-the-middle transformation on piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable buffers, the text and the sentinels. Cutting
splits a descriptor, an arrangement permutes the three sections behind their sentinels, the inverse permutation restores
them, and digests stream the descriptors: the text itself is never copied to be rearranged. Cut places are counted in units
`[A-Za-z]+|[^A-Za-z]` and found for all texts of a slice at once. No shuffle: a document is transformed where it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType

from foresight.llm.arrow import map_texts

# The sentinels, in the order prefix, suffix, middle.
SENTINELS = (b"<P>", b"<S>", b"<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
DOCUMENT = (PREFIX, MIDDLE, SUFFIX)            # sections as they lie in a text
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"
TEXT, MARK = 0, 1


class PieceTable:
    """Descriptors over the immutable text and sentinel buffers."""

    __slots__ = ("buffers", "pieces")

    def __init__(self, text):
        self.buffers = (memoryview(text), memoryview(b"".join(SENTINELS)))
        self.pieces = [(TEXT, 0, len(self.buffers[TEXT]))]

    def cut(self, at: int) -> int:
        """Splits the descriptor over byte `at` of the document, if needed; returns the index of the piece that starts there.

        A cut at an edge leaves an empty piece, so that every cut adds exactly one."""
        place = 0
        for i, (buffer, start, length) in enumerate(self.pieces):
            if at <= place + length:
                left = at - place
                self.pieces[i:i + 1] = [(buffer, start, left), (buffer, start + left, length - left)]
                return i + 1
            place += length
        raise IndexError(at)

    def arrange(self, order) -> None:
        """Permutes the pieces: the new i-th is the old order[i]-th."""
        self.pieces = [self.pieces[i] for i in order]

    def mark(self, index: int, sentinel: int) -> None:
        """Puts a sentinel before the piece at `index`."""
        self.pieces.insert(index, (MARK, sum(map(len, SENTINELS[:sentinel])), len(SENTINELS[sentinel])))

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


def arranged(text, first: int, second: int, form: str) -> PieceTable:
    """The table of a text cut at bytes `first` <= `second`, in the given form."""
    table = PieceTable(text)
    if form == PLAIN:
        return table
    table.cut(first), table.cut(second)
    order = FORMS[form]
    table.arrange([DOCUMENT.index(section) for section in order])
    for i in reversed(range(3)):
        table.mark(i, order[i])
    return table


def restored(output, form: str) -> PieceTable:
    """The text of an arranged output: cut around the sentinels, inverse permutation, sentinels dropped.

    A text that is arranged holds no sentinel, and no sentinel overlaps another one, so each is found where it was put.
    An output without the sentinels of its form, or an unknown form, is an error."""
    table = PieceTable(output)
    if form == PLAIN:
        return table
    order, data, places, at = FORMS[form], bytes(output), [], 0
    for section in order:
        at = data.find(SENTINELS[section], at)
        if at < 0 or (section == order[0] and at):
            raise ValueError(f"no {form} output")
        places.append(at)
        at += len(SENTINELS[section])
    for place, section in zip(places, order):
        table.cut(place), table.cut(place + len(SENTINELS[section]))
    sections = table.pieces[2::2]   # before the first sentinel lies an empty piece, then sentinel and section take turns
    table.pieces = sections
    table.arrange([order.index(section) for section in DOCUMENT])
    return table


def _units(data: np.ndarray, offsets: np.ndarray):
    """(byte position of every unit, index of each document's first one, code points before each byte)."""
    low = data | np.uint8(0x20)
    letter = (low >= 97) & (low <= 122)
    head = (data & np.uint8(0xC0)) != 0x80
    inner = np.zeros(len(data), bool)
    inner[1:] = letter[1:] & letter[:-1]
    inner[offsets[:-1][offsets[:-1] < len(data)]] = False   # a run does not cross documents
    unit = np.flatnonzero(head & ~inner)
    return unit, np.searchsorted(unit, offsets), np.concatenate([[0], np.cumsum(head)])


def choose(key, n: int, has_sentinel: bool, seed: str = "1", plain_from: int = 90, spm_below: int = 20) -> tuple[int, int, str]:
    """(units before the middle, units before the suffix, form) of a document, drawn from the digest of seed and key."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = PLAIN if n == 0 or has_sentinel or h3 % 100 >= plain_from else "spm" if h4 % 100 < spm_below else "psm"
    return a, b, form


def _tables(keys: list, data: np.ndarray, offsets: np.ndarray, **options):
    """(n, form, prefix code points, middle code points, piece table) per document."""
    unit, first, chars = _units(data, offsets)
    raw = memoryview(data.tobytes())
    for key, u, v, start, end in zip(keys, first[:-1].tolist(), first[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        text, n = raw[start:end], v - u
        own = bytes(text)
        a, b, form = choose(key, n, any(s in own for s in SENTINELS), **options)
        x, y = (int(unit[u + k]) if k < n else end for k in (a, b))
        table = arranged(text, x - start, y - start, form)
        plain = form == PLAIN
        yield n, form, None if plain else int(chars[x] - chars[start]), None if plain else int(chars[y] - chars[x]), table


def _with_key(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"), F.col(key).alias("_id"))


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: key, n units, form, prefix_chars, middle_chars (null if plain), digests of the output and of the text
    rebuilt from output and form.

    A null text is an empty one, a null key is drawn as the empty key; rows that repeat a key are transformed alike; an empty
    table gives no rows. Only key and text are read."""
    def run(rows, data, offsets):
        columns = [[] for _ in range(6)]
        for n, form, prefix, middle, table in _tables(rows.column(0).to_pylist(), data, offsets, **options):
            values = (n, form, prefix, middle, table.sha256(), restored(table.bytes(), form).sha256())
            for column, value in zip(columns, values):
                column.append(value)
        return [rows.column(2), *columns]

    schema = f"`_id` {dict(df.dtypes)[key]}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return map_texts(_with_key(df, key, text), "_text", run, schema).withColumnRenamed("_id", key)


_RESULTS = {"n": LongType(), "form": StringType(), "prefix_chars": LongType(), "middle_chars": LongType(), "output": StringType()}


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The table with columns n, form, prefix_chars, middle_chars and output, which replace columns of these names.

    Options: seed, plain_from (percentage from which a text stays plain), spm_below (percentage of arranged texts that put the
    suffix first). Nulls and repeated keys as in `digests`; other columns stay as they are."""
    ids = df.select("*", F.col(key).cast("string").alias(_free(df, "_key")), F.col(text).alias(_free(df, "_text")))
    keep = [c for c in df.columns if c not in _RESULTS]
    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema
    for name, kind in _RESULTS.items():
        schema = schema.add(name, kind)
    key_column = ids.columns[-2]

    def run(rows, data, offsets):
        keys = rows.column(rows.schema.get_field_index(key_column)).to_pylist()
        results = [(n, form, prefix, middle, table.bytes().decode()) for n, form, prefix, middle, table in _tables(keys, data, offsets, **options)]
        own = [rows.column(rows.schema.get_field_index(c)) for c in keep]
        return own + [pa.array(list(x)) if x else [] for x in (list(zip(*results)) or [[]] * 5)]

    return map_texts(ids, ids.columns[-1], run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form", restored_as: str = "restored") -> DataFrame:
    """The table with the texts rebuilt from output and form in a column `restored_as`, which replaces one of that name.

    A null output or form gives null; an output that does not have its form is an error."""
    keep = [c for c in df.columns if c != restored_as]
    schema = df.select(*[F.col(f"`{c}`") for c in keep]).schema.add(restored_as, StringType())

    def run(batches):
        for batch in batches:
            texts, forms = (batch.column(batch.schema.get_field_index(c)) for c in (output, form))
            for a in range(0, batch.num_rows, 256):
                pairs = zip(texts.slice(a, 256).to_pylist(), forms.slice(a, 256).to_pylist())
                back = [None if t is None or f is None else restored(t.encode(), f).bytes().decode() for t, f in pairs]
                own = [batch.column(batch.schema.get_field_index(c)).slice(a, 256) for c in keep]
                yield pa.RecordBatch.from_arrays([*own, pa.array(back, pa.string())], names=[*keep, restored_as])

    return df.mapInArrow(run, schema)


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name
