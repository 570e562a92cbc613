"""Operator 12, n-gram Jaccard join with PartEnum signatures.

Two texts link when the sets of their word shingles have a Jaccard similarity
of ``percent`` / 100 or more.  For sets of sizes x <= y that means a symmetric
difference of at most (x + y)(100 - percent)/(100 + percent), and y <= 100 x /
percent.

*Bands.*  Band j takes the pairs whose smaller size lies in [low_j, low_(j+1)),
so sets of sizes low_j to 100 (low_(j+1) - 1) / percent, and has one bound k on
the symmetric difference.  A set belongs to one band, or to two near an edge.

*Signatures.*  In a band the feature domain (64-bit hashes of shingles) is cut
into n1 parts, each into n2 smaller ones.  k differences over n1 parts leave a
part with at most k2 of them, and in it n2 - k2 smaller parts without any: for
every part and every subset of n2 - k2 smaller parts a set emits a signature of
its elements there, so two sets that link share one in the band they share.

*Joining.*  Equal sets (copies) are one class and emit once for each task that
meets them.  Signatures are counted by partial aggregates; only those with two
classes or more go on, each with its smallest class as *leader*.  First every
member is verified against its leaders, in chunks of ``CHUNK`` members, so a
leader with very many is split.  The links' components are found, and a
signature whose members are in one component is done.  In the others the pairs
across components are still open.  Open signatures that share members form a
family; a family of up to ``FAMILY_BLOCKS`` blocks is one group, in a larger one
each signature is (a text then goes to each of its open signatures, not to each
block of a very large family).  Members of a group are dealt into blocks of
about ``BLOCK`` texts, or ``BLOCK_BYTES`` if they are long, and tasks take pairs
of blocks, skip what has become connected and verify the rest, a text against
all of fitting size at once.  So a text is sent and cut into shingles once for
each block of its group, the pairs of a group of near copies are never made as
rows, and no link between components is lost.  Verification counts the shingles
of both whole texts.

Texts move by the hash of their text, and only those of candidates.  Set ids
and shingles are 64-bit hashes.

Defined results: a null or empty text, or one of separators alone, has an empty
set and is linked with nothing, not even its like (its component is its own
id); fewer words than a shingle make one shingle of them all; very long texts
count whole (signatures grow with the size of the set); rows that repeat an id
or a text get the class of their text; a component's id is its smallest id that
is not null (null if there is none); an empty table gives an empty table.  Only
the named columns are read, so others can't clash.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from martwright.llm.common import only, ship, words_of
from martwright.llm.components import components
from martwright.sinks.scratch import written

SHINGLE, PERCENT = 3, 90
GROWTH = 1.4  # of the sizes from band to band
INNER, LEFT_OUT = 1, 0  # n2, the smaller parts of a part, and k2, how many of them a subset leaves out
CHUNK = 256  # members verified against a leader by one task
BLOCK = 512  # members of an open group that meet another block in one task
BLOCK_BYTES = 4_000_000  # of their texts
FAMILY_BLOCKS = 8  # blocks up to which a family of open signatures is one group
CACHE = 1_000_000  # words whose hash a task remembers, and set ids it has seen


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection on 64-bit words."""
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return x ^ (x >> np.uint64(31))


class Shingles(dict):
    """word -> hash, remembered; texts to sets."""

    def __init__(self, words: int):
        super().__init__()
        self.words = words

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, text: str | None) -> np.ndarray:
        """The set of the text's shingles, sorted."""
        parts = [w.lower() for w in words_of(text)] if text else []
        if not parts:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))
        width = min(self.words, len(parts))
        out = np.full(len(parts) - width + 1, width, np.uint64)
        for k in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(out)])
        return np.unique(out)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 |a & b| >= percent |a | b|, for sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    met = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * met >= percent * (len(a) + len(b) - met)


class Band:
    """Sizes of a band and its partition of the domain."""

    def __init__(self, number: int, low: int, last: int, percent: int, inner: int, left_out: int):
        self.number, self.low, self.high = number, low, 100 * last // percent
        self.k = (last + self.high) * (100 - percent) // (100 + percent)
        self.left_out = min(left_out, self.k)
        self.inner = inner if self.left_out else 1
        self.parts = -(-(self.k + 1) // (self.left_out + 1))
        self.subsets = list(itertools.combinations(range(self.inner), self.inner - self.left_out))

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """One for each part and each subset of its smaller parts."""
        if not self.k:
            return np.zeros(0, np.uint64)  # only equal sets link
        dealt = mix(elements + np.uint64((self.number + 1) * 0xD1B54A32D192ED03 % 2 ** 64))
        cell = (dealt % np.uint64(self.parts * self.inner)).astype(np.int64)
        sums = np.zeros(self.parts * self.inner, np.uint64)
        np.add.at(sums, cell, mix(dealt))
        sums = sums.reshape(self.parts, self.inner)
        part = np.arange(self.parts, dtype=np.uint64) + np.uint64(self.number << 32)
        return np.concatenate([mix(mix(part * np.uint64(len(self.subsets)) + np.uint64(n)) + sums[:, s].sum(axis=1, dtype=np.uint64))
                               for n, s in enumerate(self.subsets)])


@lru_cache(maxsize=None)
def _bands(percent: int, upto: int, inner: int = INNER, left_out: int = LEFT_OUT) -> tuple[Band, ...]:
    out, low = [], 1
    while low <= upto:
        after = max(low + 1, int(low * GROWTH))
        out.append(Band(len(out), low, after - 1, percent, inner, left_out))
        low = after
    return tuple(out)


def bands_of(size: int, percent: int, inner: int = INNER, left_out: int = LEFT_OUT) -> list[Band]:
    """The bands of a set of ``size`` elements."""
    bands = _bands(percent, 1 << max(10, size.bit_length()), inner, left_out)
    return [b for b in bands if b.low <= size <= b.high]


def signatures(elements: np.ndarray, percent: int, inner: int = INNER, left_out: int = LEFT_OUT) -> np.ndarray:
    found = [b.signatures(elements) for b in bands_of(len(elements), percent, inner, left_out)]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _sets(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, parts: tuple[int, int]) -> DataFrame:
    """``id, text_hash, sid, n, sigs`` of each row: its set's id (null: empty
    set), size and signatures.  A task lists the signatures of a set once."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, text_hash long, sid long, n long, sigs array<long>"
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        known, seen = Shingles(words), set()
        for batch in batches:
            sids, sizes, sigs = [], [], []
            for text in batch.column(2):
                found = known.of(text.as_py())
                sizes.append(len(found))
                if not len(found):
                    sids.append(None)
                    sigs.append([])
                    continue
                sid = int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64))
                sids.append(sid)
                if sid in seen:
                    sigs.append([])
                    continue
                if len(seen) >= CACHE:
                    seen.clear()
                seen.add(sid)
                sigs.append(signatures(found, percent, *parts).view(np.int64))
            columns = [batch.column(0), batch.column(1), sids, sizes, sigs]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, fields)], schema=fields)

    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`"), F.xxhash64(text), text).mapInArrow(run, schema)


def _verified(pdf: pd.DataFrame, known: Shingles, percent: int) -> list[tuple[int, int]]:
    """Links of a leader with those members whose text is similar enough."""
    leader = int(pdf["leader"].iloc[0])
    first = known.of(pdf.loc[pdf["sid"] == leader, "text"].iloc[0])
    return [(leader, sid) for sid, text in zip(pdf["sid"].tolist(), pdf["text"])
            if sid != leader and similar(first, known.of(text), percent)]


def _open_links(pdf: pd.DataFrame, known: Shingles, percent: int) -> list[tuple[int, int]]:
    """Links across components among the rows of a pair of blocks; those that
    former links of this task have connected are skipped."""
    pdf = pdf.drop_duplicates("sid").reset_index(drop=True)
    same = pdf["low"].iloc[0] == pdf["high"].iloc[0]
    sets = [known.of(t) for t in pdf["text"]]
    order = np.argsort([len(e) for e in sets], kind="stable")
    sids, side, root = (pdf[c].to_numpy()[order] for c in ("sid", "side", "root"))
    sets = [sets[k] for k in order]
    size = np.array([len(e) for e in sets])
    end = np.cumsum(size)
    start = end - size
    held = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mine = np.zeros(len(held), bool)
    links = []
    for a in range(len(sids) - 1):
        last = int(np.searchsorted(size, 100 * size[a] // percent, side="right"))  # larger ones can't link
        wanted = root[a + 1:last] != root[a]
        if not same:
            wanted &= side[a + 1:last] != side[a]
        if not wanted.any():
            continue
        mine[held[start[a]:end[a]]] = True
        met = np.add.reduceat(mine[held[start[a + 1]:end[last - 1]]], start[a + 1:last] - start[a + 1], dtype=np.int64)
        mine[held[start[a]:end[a]]] = False
        for b in a + 1 + np.flatnonzero(wanted & (100 * met >= percent * (size[a] + size[a + 1:last] - met))):
            if root[a] != root[b]:
                links.append((int(min(sids[a], sids[b])), int(max(sids[a], sids[b]))))
                root[root == root[b]] = root[a]
    return links


def _blocks(members: str, size: str):
    """The number of blocks of a group of so many members and bytes."""
    return F.greatest(F.ceil(F.col(members) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("long")


def class_links(docs: DataFrame, sets: DataFrame, words: int, percent: int, text_col: str) -> DataFrame:
    """``low, high``: links between set ids, enough to connect all that link."""
    sigs = sets.select(F.explode("sigs").alias("sig"), "sid")
    met = sigs.groupBy("sig").agg(F.min("sid").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(sigs.join(met.drop("n"), "sig").distinct(), "shared")
    pairs = written(shared.where(F.col("sid") != F.col("leader")).select("leader", "sid").distinct(), "candidates")

    # one text for each candidate class
    wanted = pairs.select("sid").union(pairs.select(F.col("leader").alias("sid"))).distinct()
    chosen = sets.select("sid", "text_hash").join(wanted, "sid").groupBy("sid").agg(F.min("text_hash").alias("text_hash"))
    text = F.col(f"`{text_col}`")
    texts = written(docs.where(text.isNotNull()).select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
                    .join(chosen, "text_hash").groupBy("sid").agg(F.min("text").alias("text"))
                    .withColumn("bytes", F.octet_length("text")), "candidate-texts")

    count = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("m"))
    dealt = pairs.join(count, "leader").select(
        "leader", "sid", F.pmod(F.xxhash64("sid"), F.ceil(F.col("m") / CHUNK)).alias("chunk"))
    entries = dealt.union(dealt.select("leader", F.col("leader").alias("sid"), "chunk").distinct())

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _verified(pdf, Shingles(words), percent)
        return pd.DataFrame({"low": [a for a, _ in found], "high": [b for _, b in found]}, dtype="int64")

    links = written(entries.join(texts.drop("bytes"), "sid").groupBy("leader", "chunk").applyInPandas(verify, "low long, high long"),
                    "leader-links")
    more = _across(shared, texts, components(links), words, percent)
    return links.union(more)


def _open_blocks(shared: DataFrame, texts: DataFrame, stars: DataFrame) -> DataFrame:
    """``kind, key, sid, root, side, low, high``: the members of open signatures,
    in the blocks of their groups, once for each pair of blocks."""
    rooted = shared.join(stars.withColumnRenamed("high", "sid"), "sid", "left").select(
        "sig", "leader", "sid", F.coalesce("low", "sid").alias("root"))
    groups = rooted.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("least"), F.max("root").alias("most"))
    still = groups.where("least < most and m > 2").select("sig", "m")
    members = written(rooted.join(still, "sig"), "open-members")
    # signatures that hang together by members have much the same members
    tied = components(members.where("sid != leader").select(F.col("leader").alias("low"), F.col("sid").alias("high")))
    family = (members.select("sid", "root").distinct()
              .join(tied.withColumnRenamed("high", "sid").withColumnRenamed("low", "family"), "sid", "left")
              .withColumn("family", F.coalesce("family", "sid")))
    family = family.join(texts.select("sid", "bytes"), "sid")
    size = (family.groupBy("family").agg(F.count(F.lit(1)).alias("f"), F.sum("bytes").alias("w"))
            .select("family", _blocks("f", "w").alias("blocks")))
    family = written(family.join(size, "family"), "families")
    whole = F.col("blocks") <= FAMILY_BLOCKS
    together = family.where(whole).select(F.lit("family").alias("kind"), F.col("family").alias("key"), "sid", "root", "blocks")
    # many signatures have the same members: one of them stands for all
    mark = F.xxhash64("sid")
    apart = written(members.drop("m").join(family.where(~whole).select("sid", "bytes"), "sid"), "apart")
    chosen = (apart.groupBy("sig").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("w"), F.bit_xor(mark).alias("one"),
                                       F.sum(F.shiftright(mark, 20)).alias("two"))
              .groupBy("m", "one", "two").agg(F.min("sig").alias("sig"), F.min("w").alias("w"))
              .select("sig", _blocks("m", "w").alias("blocks")))
    signed = apart.join(chosen, "sig").select(F.lit("signature").alias("kind"), F.col("sig").alias("key"), "sid", "root", "blocks")
    blocked = together.union(signed).withColumn("side", F.pmod(F.xxhash64("sid", F.lit(1)), "blocks"))
    return (blocked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("kind", "key", "sid", "root", "side", F.least("side", "other").alias("low"),
                    F.greatest("side", "other").alias("high")))


def _across(shared: DataFrame, texts: DataFrame, stars: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between components among the members of one signature that the
    leader has not decided."""
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _open_links(pdf, Shingles(words), percent)
        return pd.DataFrame({"low": [a for a, _ in found], "high": [b for _, b in found]}, dtype="int64")

    return (_open_blocks(shared, texts, stars).join(texts.drop("bytes"), "sid")
            .groupBy("kind", "key", "low", "high").applyInPandas(verify, "low long, high long"))


def link_classes(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                 text_col: str = "text", parts: tuple[int, int] = (INNER, LEFT_OUT)) -> DataFrame:
    """``id, n_shingles, component_id`` of each row.  ``parts``: n2 and k2."""
    sets = written(_sets(docs, words, percent, id_col, text_col, parts), "shingle-sets")
    stars = components(class_links(docs, sets, words, percent, text_col))
    each = sets.where("sid is not null").groupBy("sid").agg(F.min("id").alias("least"))
    rooted = each.join(stars.withColumnRenamed("high", "sid"), "sid", "left").withColumn("root", F.coalesce("low", "sid"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("sid", "component_id")
    rows = sets.select("id", "sid", F.col("n").alias("n_shingles"))
    return (rows.where("sid is not null").join(named, "sid").select("id", "n_shingles", "component_id")
            .union(rows.where("sid is null").select("id", "n_shingles", F.col("id").alias("component_id"))))
