"""Operator 13, fill-in-middle transformation with a piece table.

A document is never rearranged as text.  It is a list of *descriptors*
(buffer, start, stop) over two immutable byte buffers: the texts of the Arrow
batch as they came, and the three sentinels.  Cutting splits a descriptor in
two, an arrangement is a permutation of descriptors with sentinel descriptors
between them, its inverse permutation gives the text back, and hashes and
outputs stream the descriptors' bytes in order.

The cuts are in code points: ``h1`` to ``h4`` are the first four 8-digit
groups of the hex sha256 of ``<seed>:<id>``; the prefix ends after the smaller
of ``h1 % (n+1)`` and ``h2 % (n+1)`` code points of the ``n``, the middle after
the larger.  ``h3`` picks the documents that stay plain, ``h4`` the form:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

``restore`` needs the output and the form alone: it splits the output at its
sentinels (a text that holds one stays plain, and no cut can make one up, as a
sentinel begins with its only ``<``) and permutes the pieces back.

There is no shuffle; rows are independent and leave in slices of about
``SLICE`` bytes of output, so memory is that of an Arrow batch and a slice.

Defined results: a null text counts as empty and stays plain; a null id is
hashed as no digits; a repeated row gets the same cuts; very long texts are
cut and streamed whole; an empty table gives an empty table.  Of further
columns only those that the caller names are kept, so their names can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from martwright.llm.common import only, ship

# Fixed values of the contract: sentinels, seed, percentages.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
SEED, PLAIN_FROM, SPM_BELOW = 1, 90, 20
SLICE = 8_000_000  # bytes of output in a batch, about

TEXT, MARK = 0, 1  # the two buffers


class Piece(NamedTuple):
    """A stretch of one of the buffers."""

    buffer: int
    start: int
    stop: int


# Where each sentinel lies in its buffer.
MARKS = {name: Piece(MARK, SENTINELS.index(mark), SENTINELS.index(mark) + len(mark))
         for name, mark in (("P", PREFIX), ("S", SUFFIX), ("M", MIDDLE))}
# The order of the parts (0 prefix, 1 middle, 2 suffix) in each form, with the
# sentinel before each.
FORMS = {"psm": (("P", 0), ("S", 2), ("M", 1)), "spm": (("S", 2), ("P", 0), ("M", 1))}


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """``pieces`` with one boundary more, after the first ``at`` bytes: the
    descriptor that holds it is split.  At a place that has a boundary already
    an empty descriptor comes between."""
    out = []
    for k, p in enumerate(pieces):
        if at <= p.stop - p.start:
            return [*out, Piece(p.buffer, p.start, p.start + at), Piece(p.buffer, p.start + at, p.stop),
                    *pieces[k + 1:]]
        out.append(p)
        at -= p.stop - p.start
    raise IndexError("the cut lies behind the end")


def arrange(pieces: list[Piece], form: str) -> list[Piece]:
    """Three pieces in the order of ``form``, each after its sentinel."""
    return [p for mark, k in FORMS[form] for p in (MARKS[mark], pieces[k])]


def inverse(pieces: list[Piece], form: str) -> list[Piece]:
    """What ``arrange`` was given: sentinels dropped, the permutation undone."""
    out: list[Piece] = [None] * len(FORMS[form])
    for (_, k), piece in zip(FORMS[form], pieces[1::2]):
        out[k] = piece
    return out


def stream(pieces: Iterable[Piece], buffers: tuple) -> Iterator[memoryview]:
    """The bytes of the pieces, in order, without copying them."""
    for p in pieces:
        if p.stop > p.start:
            yield buffers[p.buffer][p.start:p.stop]


def sha256(pieces: Iterable[Piece], buffers: tuple) -> str:
    h = hashlib.sha256()
    for part in stream(pieces, buffers):
        h.update(part)
    return h.hexdigest()


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """h1 to h4 of an id."""
    name = f"{seed}:" + ("" if doc_id is None else str(doc_id))
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


def starts_of(data: memoryview) -> np.ndarray:
    """Where each code point starts, and the end: UTF-8 continuation bytes
    are those from 0x80 to 0xBF."""
    a = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((a & 0xC0) != 0x80), len(a))


def transform(doc_id, whole: Piece, buffers: tuple, seed: int = SEED, plain_from: int = PLAIN_FROM,
              spm_below: int = SPM_BELOW) -> tuple[list[Piece], int, str, int | None, int | None]:
    """The arranged pieces of the text ``whole``, its code points, the form,
    and the code points of prefix and middle (None: plain)."""
    data = buffers[whole.buffer][whole.start:whole.stop]
    held = bytes(data)
    # a text of ASCII alone has its code points at its bytes
    starts = None if held.isascii() else starts_of(data)
    n = len(held) if starts is None else len(starts) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= plain_from or any(s in held for s in (PREFIX, SUFFIX, MIDDLE)):
        return [whole], n, "plain", None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (first, second) if starts is None else (int(starts[first]), int(starts[second]))
    parts = cut(cut([whole], a), b)
    form = "spm" if h4 % 100 < spm_below else "psm"
    return arrange(parts, form), n, form, first, second - first


def split_output(data: memoryview, form: str) -> list[Piece]:
    """The arranged pieces of an output text: cuts around its sentinels."""
    held = bytes(data)
    marks = [SENTINELS[MARKS[name].start:MARKS[name].stop] for name, _ in FORMS[form]]
    at = [held.find(mark) for mark in marks]
    if at[0] != 0 or -1 in at or at != sorted(at):
        raise ValueError("the output has not the shape of its form")
    pieces = [Piece(TEXT, 0, len(held))]
    for mark, start in zip(marks, at):
        pieces = cut(cut(pieces, start), start + len(mark))
    return pieces[1:]  # nothing lies before the first sentinel


def _texts(column) -> Iterator[tuple[Piece, memoryview]]:
    """Each text of an Arrow string column as a piece of the column's own
    data buffer, which is not copied (null: an empty piece)."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    data = memoryview(buffers[2]) if buffers[2] is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        start = int(offsets[k])
        yield Piece(TEXT, start, int(offsets[k + 1]) if valid[k] else start), data


def _rows_out(batches, fields, make, size):
    """Rows of ``make(batch)`` (with the bytes they weigh) as batches of about
    ``size`` bytes."""
    import pyarrow as pa

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    for batch in batches:
        rows, weight = [], 0
        for row, heavy in make(batch):
            rows.append(row)
            weight += heavy
            if weight >= size:
                yield batch_of(rows)
                rows, weight = [], 0
        if rows:
            yield batch_of(rows)


def _mapped(df: DataFrame, schema: str, make) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    fields, size = to_arrow_schema(StructType.fromDDL(schema)), SLICE
    return df.mapInArrow(lambda batches: _rows_out(batches, fields, make, size), schema)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output, output_sha256``
    of each row; ``output`` is the training text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def make(batch):
        for doc_id, (whole, data) in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
            buffers = (data, memoryview(SENTINELS))
            pieces, n, form, prefix, middle = transform(doc_id, whole, buffers, seed, plain_from, spm_below)
            output = b"".join(stream(pieces, buffers))
            yield ((doc_id, n, form, prefix, middle, output.decode("utf-8", "replace"), sha256(pieces, buffers)),
                   len(output))

    return _mapped(only(docs, id_col, text_col),
                   f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, "
                   "output string, output_sha256 string", make)


def restore(outputs: DataFrame, *keep: str) -> DataFrame:
    """``restored, restored_sha256`` of each row of ``outputs``, from its
    columns ``output`` and ``form`` alone, with the columns ``keep`` before them.
    A null output or form gives null."""
    kept = only(outputs, *keep, "output", "form")
    fields = [kept.schema[c] for c in keep]

    def make(batch):
        at = len(keep)
        columns = [batch.column(k).to_pylist() for k in range(at)]
        forms = batch.column(at + 1).to_pylist()
        absent = batch.column(at).is_null().to_pylist()
        for k, (whole, data) in enumerate(_texts(batch.column(at))):
            row, form = tuple(c[k] for c in columns), forms[k]
            if form is None or absent[k]:
                yield (*row, None, None), 0
                continue
            buffers = (data[whole.start:whole.stop], memoryview(SENTINELS))
            if form == "plain":
                pieces = [Piece(TEXT, 0, whole.stop - whole.start)]
            else:
                pieces = inverse(split_output(buffers[TEXT], form), form)
            text = b"".join(stream(pieces, buffers))
            yield (*row, text.decode("utf-8", "replace"), sha256(pieces, buffers)), len(text)

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return _mapped(kept, ddl + "restored string, restored_sha256 string", make)
