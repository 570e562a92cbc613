"""Operator 8, SimHash near-dedup by meet-in-the-middle ball hashing.

A text's fingerprint has the bits that are set in over half the XXH64 hashes
of its word shingles.  Two fingerprints within ``distance`` bits have a common
variant within half of it, so every distinct fingerprint emits all its
variants up to that radius (2,081 for a distance of 4), the variants are
dealt out, and fingerprints that meet in a variant are verified and linked;
components of links are the groups.

The shuffle deals variants by *slice*, a linear function of their bits.  The
variants of a fingerprint that lie in a slice are the fingerprint XOR the error
patterns with the right image, so a slice is sent the fingerprint alone and
lists them itself: at most one row for each fingerprint and slice moves, never
more than one for each variant.  There are ``LEAST_SLICES`` slices, and more
when one would hold over ``SLICE`` variants; a slice lists its variants in parts
of ``LISTED``, so memory stays bounded.

Fingerprints that share a variant are all within ``distance`` of each other,
so linking each of them to the smallest loses no component; copies share one
fingerprint and are never expanded into pairs.

Defined results: a text without words (null, empty) has fingerprint zero and
is linked like any other; fewer words than a shingle make one shingle; repeated
rows and null ids each get the group of their text, whose id is the smallest
id that is not null (null if there is none); an empty table gives an empty one; a
very long text is shingled whole, in one task; extra columns are not read, whatever
their names, and ``keep_first`` returns them unchanged.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martwright.llm.common import fresh, map_batches, only, ship, stored
from martwright.llm.components import components

WORDS, SEED, DISTANCE = 4, 42, 4
SLICE = 64_000_000  # variants that one slice holds at most, about
LEAST_SLICES = 64
LISTED = 8_000_000  # of these, listed at once
_ROWS = 1 << 14


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint, unsigned."""
    parts = text.encode("utf-8", "replace").lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()[words - 1:] or [len(joined)]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _ROWS):
        part = np.ascontiguousarray(hashes[at:at + _ROWS]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, fp``: the fingerprint of each row, as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        found = np.array([fingerprint(t.as_py(), words) for t in batch.column(text_col)], np.uint64)
        return {"id": batch.column(id_col), "fp": found.view(np.int64)}

    return map_batches(only(docs, id_col, text_col), f"id {kind}, fp long", run)


# --- ball hashing ---------------------------------------------------------

def error_patterns(radius: int) -> np.ndarray:
    """All 64-bit words with at most ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for n in range(radius + 1)
                     for bits in itertools.combinations(range(64), n)], np.uint64)


def _columns(bits: int) -> np.ndarray:
    """The image of each single bit under the slice function (splitmix64)."""
    if bits == 0:
        return np.zeros(64, np.uint64)
    x = np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - bits)


def slice_of(words: np.ndarray, bits: int) -> np.ndarray:
    """The slice of each 64-bit word: linear, slice(a ^ b) = slice(a) ^ slice(b)."""
    out = np.zeros(len(words), np.uint64)
    for bit, image in enumerate(_columns(bits)):
        out ^= (words >> np.uint64(bit) & np.uint64(1)) * image
    return out


def linked_in_slice(fps: np.ndarray, at: int, bits: int, radius: int, distance: int) -> np.ndarray:
    """Links (low, high) among ``fps`` that meet in a variant of slice ``at``."""
    errors = error_patterns(radius)
    images = slice_of(errors, bits)
    needed = slice_of(fps, bits) ^ np.uint64(at)
    variants, owners = [], []
    for image in np.unique(needed):
        mine, some = np.flatnonzero(needed == image), errors[images == image]
        if len(some):
            variants.append((fps[mine][:, None] ^ some[None, :]).ravel())
            owners.append(np.repeat(mine.astype(np.int32), len(some)))
    if not variants:
        return np.zeros((0, 2), np.int64)
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    del variants, owners
    ordered = np.sort(variant)
    met = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(met):
        return np.zeros((0, 2), np.int64)
    place = np.searchsorted(met, variant)
    hit = met[np.minimum(place, len(met) - 1)] == variant
    place, member = place[hit], fps[owner[hit]].view(np.int64)
    del variant, owner
    order = np.lexsort((member, place))
    place, member = place[order], member[order]
    first = np.concatenate([[True], place[1:] != place[:-1]])
    low = member[first][np.cumsum(first) - 1]
    links = np.unique(np.stack([low[~first], member[~first]], 1), axis=0)
    apart = (links[:, 0] ^ links[:, 1]).view(np.uint64)
    bits_apart = np.unpackbits(apart.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
    return links[(bits_apart <= distance) & (links[:, 0] < links[:, 1])]


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``low, high``: links between distinct fingerprints ``fp``, enough of
    them to connect all within ``distance`` bits."""
    if distance % 2:
        raise ValueError("the distance must be even: variants of half of it meet")
    radius = distance // 2
    ship(distinct.sparkSession)
    errors = len(error_patterns(radius))
    listed = distinct.count() * errors
    bits = min(32, (max(LEAST_SLICES, -(-listed // SLICE)) - 1).bit_length())
    images = np.unique(slice_of(error_patterns(radius), bits))

    def deal(batch):
        fps = np.asarray(batch.column("fp")).astype(np.int64).view(np.uint64)
        slices = slice_of(fps, bits)[:, None] ^ images[None, :]
        return {"slice": slices.ravel().astype(np.int64), "fp": np.repeat(fps.view(np.int64), len(images))}

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy().astype(np.int64).view(np.uint64)
        at = int(pdf["slice"].iloc[0])
        more = max(0, (-(-len(fps) * errors // (LISTED << bits)) - 1).bit_length())
        found = np.concatenate([linked_in_slice(fps, (at << more) + part, bits + more, radius, distance)
                                for part in range(1 << more)])
        return pd.DataFrame({"low": found[:, 0], "high": found[:, 1]})

    return (map_batches(only(distinct, "fp"), "slice long, fp long", deal)
            .groupBy("slice").applyInPandas(link, "low long, high long"))


def _rooted(each: DataFrame, distance: int) -> DataFrame:
    """``each`` (distinct ``fp``) with ``root``, the smallest fingerprint of its group."""
    stars = components(fingerprint_links(each, distance))
    return (each.join(stars.withColumnRenamed("high", "fp"), "fp", "left")
            .withColumn("root", F.coalesce("low", "fp")).drop("low"))


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, component_id`` of each row."""
    rows = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    each = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    rooted = _rooted(each, distance)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "fp", "component_id")


def _tagged(docs: DataFrame, words: int, text_col: str, fp: str) -> DataFrame:
    """``docs`` with the fingerprint of each row as the column ``fp``."""
    import pyarrow as pa

    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            found = np.array([fingerprint(t.as_py(), words) for t in text], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))],
                                             names=[*batch.schema.names, fp])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(fp, LongType())]))


def keep_first(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group: that of its smallest id, null ids
    last; of rows that share it, the one with the least fingerprint, then the
    least hash of the whole row.  Groups are told apart by their root, not by
    an id, so groups without ids or with the same id keep a row each."""
    fp, row = fresh(docs, "_fp", "_row")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # nulls leave a hash as it is, so it takes in where they are
    rows = stored(_tagged(docs, words, text_col, fp).withColumn(
        row, F.xxhash64(*cols, *map(F.isnull, cols))), "fingerprinted")
    held = F.col(f"`{id_col}`")
    first = F.min(F.struct(held.isNull().alias("none"), held.alias("id"), F.col(row).alias("row")))
    each = stored(rows.groupBy(F.col(fp).alias("fp")).agg(first.alias("first")), "distinct")
    kept = _rooted(each, distance).groupBy("root").agg(
        F.min(F.struct("first.none", "first.id", "fp", "first.row")).alias("first"))
    kept = kept.select(F.col("first.fp").alias(fp), F.col("first.row").alias(row))
    return rows.join(kept, [fp, row], "left_semi").dropDuplicates([fp, row]).drop(fp, row)
