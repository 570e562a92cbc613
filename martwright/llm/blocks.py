"""Blocks of tokenised text, and asking partitioned tables from them.

A *block* holds the word numbers of some documents and the words themselves.
It asks the owners of its distinct keys (64-bit hashes) by sending them sorted,
in a compressed piece for each part of the key space, and gets the answers in
the same order.  A key is sent once by each block however often it occurs
there, so a key that is everywhere costs a few bytes for each block and makes
no hot task; nothing is broadcast or collected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.common import ship, workers
from martwright.sinks.scratch import scratch_dir, scratch_table

SIZE = 2_000_000  # tokens of a block, about
PART = 2_000_000  # keys that one task merges, about
BUCKET_BYTES = 256 << 20  # of the texts in one bucket, about
END = b"\n</s>"  # ends each text, word number 0; no word holds a line end

REQUEST = "block long, kind string, part int, keys binary"
ANSWER = "block long, kind string, part int, a binary, b binary"


def pack(a: np.ndarray) -> bytes:
    """Compressed, all first bytes before all second ones and so on."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_ids(ids: list, kind=None) -> bytes:
    """Document ids of any type, nulls among them (pandas has no whole null)."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(ids, kind)], ["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_ids(b: bytes) -> list:
    import pyarrow as pa

    with pa.ipc.open_stream(b) as reader:
        return reader.read_all().column("id").to_pylist()


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection."""
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return x ^ (x >> np.uint64(31))


def bits_for(n: int, each: int) -> int:
    """Bits of a key that name its part, for parts of about ``each`` of ``n``."""
    return min(30, max(0, (-(-int(n) // each) - 1).bit_length()))


def bucket_count(docs: DataFrame, text_col: str) -> int:
    """Buckets for about ``BUCKET_BYTES`` of text each, as measured in one pass
    over the column; the session's shuffle width at least, and no more than
    Spark allows.  Blocks of a bucket are opened one by one, so a task's memory
    doesn't follow from this number."""
    spark = docs.sparkSession
    held = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(max(workers(spark), -(-held // BUCKET_BYTES)), most)


def one_by_one(batches) -> Iterator[dict]:
    """The rows of Arrow batches, each made when its turn comes."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def store_blocks(docs: DataFrame, id_col: str, text_col: str, flag: Column | None = None,
                 lower: bool = False, size: int | None = None) -> DataFrame:
    """The texts as blocks, in a table bucketed by block in the session's
    scratch folder (``sinks.scratch.clean`` drops it): a join with a block's
    answers shuffles the answers alone.  ``flag``: a condition kept with each
    document; ``lower``: lower-case A-Z.  A text lies whole in one block, so a
    block of a very long text is longer than ``size``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark, size = docs.sparkSession, size or SIZE
    ship(spark)
    schema = "block long, n long, ids binary, flags binary, sizes binary, tokens binary, words binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    id_kind = to_arrow_schema(StructType([docs.schema[id_col]])).field(0).type

    class Words(dict):
        def __missing__(self, word: bytes) -> int:
            n = self[word] = len(self)
            return n

    def new():
        return Words({END: 0}), [], [], [], [], 0

    def run(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        words, ids, flags, sizes, tokens, n = new()

        def block() -> pa.RecordBatch:
            text = zstandard.ZstdCompressor(level=1).compress(b" ".join(list(words)[1:]))
            row = [number, n, pack_ids(ids, id_kind), np.array(flags, np.uint8).tobytes(), np.array(sizes, "<i4").tobytes(),
                   pack(np.concatenate(tokens)), text]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for i, flagged, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "replace")
                parts = (data.lower() if lower else data).split()
                ids.append(i)
                flags.append(bool(flagged))
                sizes.append(len(parts) + 1)
                tokens += [np.fromiter(map(words.__getitem__, parts), "<i4", len(parts)), np.zeros(1, "<i4")]
                n += len(parts) + 1
                if n >= size:
                    yield block()
                    number += 1
                    words, ids, flags, sizes, tokens, n = new()
        if ids:
            yield block()

    made = docs.select(F.col(f"`{id_col}`"), F.lit(False) if flag is None else flag,
                       F.col(f"`{text_col}`")).mapInArrow(run, schema)
    version = uuid.uuid4().hex
    name = scratch_table(spark, f"blocks_{version}")
    (made.write.bucketBy(bucket_count(docs, text_col), "block")
     .option("path", f"{scratch_dir(spark)}/blocks-{version}").saveAsTable(name))
    return spark.table(name)


class Block:
    """A row of the table, opened."""

    TOKEN = np.int64  # type of the word numbers

    def __init__(self, row):
        self.number = int(row["block"])
        self.sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
        self.flags = np.frombuffer(row["flags"], np.uint8).astype(bool)
        self.tokens = unpack(row["tokens"], "<i4").astype(self.TOKEN, copy=False)
        self.words = [END, *zstandard.ZstdDecompressor().decompress(row["words"]).split()]
        self.hashes = np.fromiter(map(word_hash, self.words), np.uint64, len(self.words))
        self.start = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)


def requests(number: int, kind: str, keys: np.ndarray, bits: int, **values: np.ndarray) -> list[dict]:
    """A row for each part that holds some of the sorted ``keys``, with what
    belongs to them."""
    if not len(keys):
        return []
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    return [{"block": number, "kind": kind, "part": int(part[a]),
             "keys": pack(np.diff(keys[a:b], prepend=np.uint64(0))),
             **{k: pack(v[a:b]) for k, v in values.items()}} for a, b in zip(edges[:-1], edges[1:])]


class Merged:
    """The requests of one part: their keys brought together."""

    def __init__(self, pdf: pd.DataFrame):
        self.pdf = pdf.sort_values("block")
        keys = [np.cumsum(unpack(b, np.uint64), dtype=np.uint64) for b in self.pdf["keys"]]
        self.lengths = [len(k) for k in keys]
        keys = np.concatenate(keys)
        self.order = np.argsort(keys, kind="stable")
        ordered = keys[self.order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        self.starts = np.flatnonzero(first)
        self.group = np.empty(len(keys), np.int64)  # the distinct key of each entry
        self.group[self.order] = np.cumsum(first) - 1

    def values(self, name: str, kind) -> np.ndarray:
        return np.concatenate([unpack(b, kind) for b in self.pdf[name]])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """By distinct key."""
        return np.add.reduceat(values[self.order], self.starts)

    def answer(self, kind: str, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        """One row for each request, with its entries of ``a`` and ``b``."""
        cut = np.cumsum(self.lengths)[:-1]
        return pd.DataFrame({"block": self.pdf["block"].to_numpy(), "kind": kind, "part": self.pdf["part"].to_numpy(),
                             "a": [pack(v) for v in np.split(a, cut)], "b": [pack(v) for v in np.split(b, cut)]})


def answered(pdf: pd.DataFrame, kind: str, value: str, as_kind) -> np.ndarray:
    """All answers of a kind, in the order of the keys asked."""
    rows = pdf[pdf["kind"] == kind].sort_values("part")
    return np.concatenate([unpack(b, as_kind) for b in rows[value]] or [np.zeros(0, as_kind)])
