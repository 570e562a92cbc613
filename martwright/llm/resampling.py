"""Operator 11, target-distribution importance resampling by bit slices.

A document's features (runs of words) fall into ``BUCKETS`` buckets by their
CRC-32.  A bucket's gain is the log ratio of its share in the target texts to
its share in all documents, as an integer; a document's weight is the sum of
the gains of its features; the documents with the highest weight plus Gumbel
noise (a hash of the id) are a sample by importance without replacement.

Weights are summed in bit slices.  The counts of a document over all buckets
are planes of one bit for each bucket, plane j with bit j of every count; the
gains are planes likewise, those of the positive gains and of the negative
ones apart.  Then

    weight = sum over j, k of 2^(j+k) (|count_j & gain+_k| - |count_j & gain-_k|)

with |.| the number of set bits: whole-word ANDs and popcounts, and exact.

Corpus totals: each task adds up its own texts in one array of ``BUCKETS``
counts and sends that, so what is shuffled and what reaches the driver (one
row for each bucket) is bounded by the number of buckets.  The draw is a global
sort of (score, id) rows by range partitions with prefix sums of their counts
(``operators.positions``); equal scores of a hot id spread by the further keys.

Defined results: a null or empty text has no features, weight 0 and is never
drawn; very long texts count whole (planes grow with the log of the highest
count); rows that repeat an id are drawn each on its own; a null id is hashed
as no digits and comes after equal scores; an empty table gives an empty table,
empty target texts give gains by smoothing alone.  Only the named columns are
read, so others can't clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from martwright.llm.common import map_batches, only, ship
from martwright.operators.positions import with_positions
from martwright.sinks.scratch import written

BUCKETS, RUN, SCALE, SEED = 10_000, 1, 1000, 2024
LEAST_WORDS, PERCENT = 20, 10
GROUP = 64  # documents whose planes are made together
CACHE = 1_000_000  # features whose bucket a task remembers

# Every byte that is no part of a word (ASCII but 0-9 and a-z) becomes a space.
_WORD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").lower().translate(_WORD).split() if text else []


class Buckets(dict):
    """feature -> bucket, remembered."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        b = self[feature] = zlib.crc32(feature) % self.n
        return b

    def of(self, text: str | None, run: int) -> tuple[int, list[int]]:
        """How many words the text has, and the bucket of each feature."""
        parts = words(text)
        found = list(map(self.__getitem__, parts))
        for n in range(2, run + 1):
            found += [self[b" ".join(parts[k:k + n])] for k in range(len(parts) - n + 1)]
        return len(parts), found


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """Features of all texts in each bucket."""
    import pyarrow as pa

    ship(texts.sparkSession)

    def count(batches):
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                _, found = known.of(text.as_py(), run)
                if found:
                    at, n = np.unique(np.array(found, np.int64), return_counts=True)
                    total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = only(texts, text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most one row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The gain of each bucket, smoothed by one count in every bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
                     for a, b in zip(source.tolist(), target.tolist())], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as rows of 64-bit words, zero bits behind the last."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, pad)]).view(np.uint64)


def planes(values: np.ndarray) -> np.ndarray:
    """``[bit, word]``: plane k has bit k of every value (values of 0 or more)."""
    bits = int(values.max(initial=0)).bit_length()
    return _packed(np.stack([values >> k & 1 for k in range(bits)]).astype(np.uint8)) if bits else (
        np.zeros((0, -(-len(values) // 64)), np.uint64))


class GainPlanes:
    """Signed gains as planes, with the value of a bit in each."""

    def __init__(self, gain: np.ndarray):
        up, down = planes(np.maximum(gain, 0)), planes(np.maximum(-gain, 0))
        self.buckets = len(gain)
        self.bits = np.concatenate([up, down])
        self.value = np.array([1 << k for k in range(len(up))] + [-(1 << k) for k in range(len(down))], np.int64)

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """The weight of each row of ``counts[document, bucket]``."""
        out = np.zeros(len(counts), np.int64)
        live = np.arange(len(counts))
        bit = 0
        while len(live := live[(counts[live] >> bit).any(axis=1)]):
            plane = _packed((counts[live] >> bit & 1).astype(np.uint8))
            met = np.bitwise_count(plane[:, None, :] & self.bits[None]).sum(axis=2, dtype=np.int64)
            out[live] += (met @ self.value) << bit
            bit += 1
        return out


def noise(doc_id, seed: int = SEED, scale: int = SCALE) -> int:
    """Gumbel noise of an id."""
    name = f"{seed}:" + ("" if doc_id is None else str(doc_id))
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
          seed: int = SEED) -> DataFrame:
    """``id_col, n_words, n_features, weight, score`` of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(GainPlanes(gain))

    def run_batch(batch):
        held = shared.value
        known = Buckets(held.buckets)
        n_words, n_features, weight = [], [], []
        texts = batch.column(1)
        for at in range(0, len(texts), GROUP):
            found = []
            for text in texts.slice(at, GROUP):
                n, buckets = known.of(text.as_py(), run)
                n_words.append(n)
                found.append(np.array(buckets, np.int64))
            sizes = [len(f) for f in found]
            flat = np.repeat(np.arange(len(found)) * held.buckets, sizes) + np.concatenate(found)
            counts = np.bincount(flat, minlength=len(found) * held.buckets).reshape(len(found), held.buckets)
            n_features += sizes
            weight.append(held.weights(counts))
        weight = np.concatenate(weight) if weight else np.zeros(0, np.int64)
        ids = batch.column(0)
        drawn = np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
        return {id_col: ids, "n_words": n_words, "n_features": n_features, "weight": weight, "score": weight + drawn}

    return map_batches(only(docs, id_col, text_col),
                       f"`{id_col}` {kind}, n_words long, n_features long, weight long, score long", run_batch)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, run: int = RUN, seed: int = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``id_col, n_words, n_features, weight, score, rank`` of each row.  Of
    the N rows with ``least_words`` words, the floor(percent N / 100) highest
    scores are drawn and ranked from 1; the others' rank is null."""
    gain = gains(bucket_counts(docs, text_col, buckets, run), bucket_counts(target, target_col, buckets, run))
    scored = written(weigh(docs, gain, id_col, text_col, run, seed), "weighed")
    enough = F.col("n_words") >= least_words
    n = scored.where(enough).count()
    held = F.col(f"`{id_col}`")
    ranked = with_positions(scored.where(enough), F.desc("score"), held.asc_nulls_last(), F.col("n_features"),
                            F.col("n_words"), F.col("weight"), name="rank")
    drawn = F.when(F.col("rank") <= n * percent // 100, F.col("rank"))
    return ranked.withColumn("rank", drawn).unionByName(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
