"""Operator 2, LM scoring: a Katz backoff model of words, order two.

    P(w | v) = d(r) r / c(v)        if r = c(v w) > 0
             = alpha(v) P(w)        otherwise
    P(w)     = d(c) c / N           for a known word
             = what the discounts leave, for the one unknown type

``d`` are Good-Turing discounts in Katz's form: counts over ``K`` stay, those
below give up the mass of unseen events.  ``alpha(v)`` is
(1 - sum of d(r) r / c(v)) / (1 - sum of P(w)), both over the words seen after
v, so P(. | v) sums to one exactly.  A history whose counts are all over ``K``
would leave nothing; it gets one count more in its denominator.

Texts are cut into *blocks* of about ``BLOCK`` tokens, kept as a bucketed table
of word numbers.  A block sends the hashes of its distinct words, bigrams and
histories to the partition that owns them, each once however often it occurs,
and gets counts (weights for histories) back in the same order.  So there are
three partitioned tables (unigrams, bigrams, histories); an n-gram costs a few
shuffled bytes for each block that holds it, a frequent one is a row for each
block and no hot task, and no table is broadcast or collected.  Only a dozen
totals reach the driver.

Words and bigrams are 64-bit hashes.  Defined results: a null or empty text is
the end token alone; rows that repeat an id count and are scored each; a null
id trains; without training text every word is unknown; an empty table gives
an empty table; a very long text lies whole in one block, whose task holds all
its words; extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm import blocks as block_table
from martwright.llm.blocks import (ANSWER, PART, REQUEST, Block, Merged, answered, bits_for, mix, one_by_one,
                                   requests, store_blocks, unpack_ids, word_hash)
from martwright.llm.common import stored

K = 5  # counts above it are not discounted
START = b"\n<s>"  # no word holds a line end
BLOCK = 750_000  # tokens of a block, about: a task holds a dozen arrays of that length


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) * np.uint64(0x9E3779B97F4A7C15) + second)


class Grams(Block):
    """A block's distinct words, bigrams and histories."""

    TOKEN = np.int32

    def __init__(self, row):
        super().__init__(row)
        self.held = self.flags
        self.train = np.repeat(~self.held, self.sizes)

    def unigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the words by hash, their hashes and training counts in it."""
        order = np.argsort(self.hashes)
        counts = np.bincount(self.tokens[self.train], minlength=len(self.words))
        return order, self.hashes[order], counts[order]

    def bigrams(self) -> None:
        """Fills in the distinct bigrams, in order of their hashes."""
        n = len(self.words)
        codes = np.empty(len(self.tokens), np.int64)
        codes[1:] = self.tokens[:-1]
        codes[self.start] = n  # the start of a text
        codes *= n + 1
        codes += self.tokens
        # one sort: the distinct codes, and the place of each occurrence among them
        by_code = np.argsort(codes).astype(np.int32)
        codes = codes[by_code]
        new = np.concatenate([[True], codes[1:] != codes[:-1]])[:len(codes)]
        self.occurrence = np.empty(len(codes), np.int32)
        self.occurrence[by_code] = np.cumsum(new, dtype=np.int32) - 1
        del by_code
        codes = codes[new]
        first, second = (codes // (n + 1)).astype(np.int32), (codes % (n + 1)).astype(np.int32)
        del codes, new
        hashes = np.append(self.hashes, np.uint64(word_hash(START)))
        keys = bigram_keys(hashes[first], hashes[second])
        order = np.argsort(keys).astype(np.int32)
        place = np.empty_like(order)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.first, self.second, self.keys = first[order], second[order], keys[order]
        self.occurrence = place[self.occurrence]
        self.counts = np.bincount(self.occurrence[self.train], minlength=len(keys))
        self.histories = hashes


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Total counts for each request, and who owns a key: its first request
    with a training count.  The part's counts of counts ride on the first row."""
    m = Merged(pdf)
    counts = m.values("counts", np.uint32).astype(np.int64)
    total = m.sums(counts)
    trained = np.flatnonzero(counts > 0)
    owner = np.zeros(len(counts), np.uint8)
    _, at = np.unique(m.group[trained], return_index=True)
    owner[trained[at]] = 1
    out = m.answer(pdf["kind"].iloc[0], total[m.group].astype(np.uint64), owner)
    sums = [int((total == r).sum()) for r in range(1, K + 2)] + [int(total.sum()), int((total > 0).sum())]
    for name, value in zip(STATS, sums):
        out[name] = [value] + [0] * (len(out) - 1)
    return out


STATS = [*(f"n{r}" for r in range(1, K + 2)), "total", "types"]


def discounts(n: list[int]) -> np.ndarray:
    """d(0) to d(k) from the counts of counts n[0] (of one) on, for the largest
    k up to ``K`` that gives discounts between 0 and 1."""
    for k in range(min(K, len(n) - 1), 0, -1):
        if min(n[:k + 1]) <= 0:
            continue
        cut = (k + 1) * n[k] / n[0]
        d = [((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) if cut != 1 else -1.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([0.0, *d])
    return np.array([0.0, 0.5])  # too few counts for Good-Turing: half of each single count


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts < len(d), d[np.minimum(counts, len(d) - 1)], 1.0)


class Model:
    """Totals and discounts, all that tasks share."""

    def __init__(self, unigram: dict, bigram: dict):
        self.total, self.types = int(unigram["total"]), int(unigram["types"])
        n = [int(unigram[s]) for s in STATS[:K + 1]]
        self.d1 = discounts(n)
        self.d2 = discounts([int(bigram[s]) for s in STATS[:K + 1]])
        kept = self.total - sum(r * n[r - 1] * (1 - self.d1[r]) for r in range(1, len(self.d1)))
        # as for histories: nothing left for the unknown type costs one count more
        self.norm = self.total + (self.total - kept <= 1e-9 * max(1, self.total))
        self.unknown = 1 - kept / self.norm

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.d1) / self.norm, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.types + 1))


def _weighted(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each history asked for: its log10 denominator and backoff weight."""
    m = Merged(pdf)
    count, mass, low = (m.sums(m.values(n, np.float64)) for n in ("counts", "mass", "low"))
    seen = count > 0
    denominator = np.where(seen, count + (count - mass <= 1e-9 * count), 1.0)
    left = np.where(seen, 1 - mass / denominator, 1.0)
    alpha = np.where(seen, left / np.maximum(1 - low, 1e-12), 1.0)
    return m.answer("history", np.log10(denominator)[m.group], np.log10(alpha)[m.group])


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``
    of every row; rows for which ``held`` is true don't train."""
    import pyarrow as pa

    spark = docs.sparkSession
    blocks = store_blocks(docs, id_col, text_col, held, lower=True, size=min(BLOCK, block_table.SIZE))
    bits = bits_for(blocks.agg(F.sum("n")).first()[0] or 0, PART)
    ask = REQUEST + ", counts binary"

    def counts_asked(batches):
        for row in one_by_one(batches):
            b = Grams(row)
            _, words, counts = b.unigrams()
            asked = requests(b.number, "unigram", words, bits, counts=counts.astype(np.uint32))
            b.bigrams()
            asked += requests(b.number, "bigram", b.keys, bits, counts=b.counts.astype(np.uint32))
            del b, row, words, counts
            yield pa.RecordBatch.from_pylist(asked, pa.schema(
                [("block", pa.int64()), ("kind", pa.string()), ("part", pa.int32()),
                 ("keys", pa.binary()), ("counts", pa.binary())]))
            del asked
            pa.default_memory_pool().release_unused()

    needed = blocks.select("block", "flags", "sizes", "tokens", "words")
    counted = stored(needed.mapInArrow(counts_asked, ask).groupBy("kind", "part").applyInPandas(
        _counted, ANSWER + "".join(f", {s} long" for s in STATS)), "katz-counts")
    totals = {r["kind"]: r for r in counted.groupBy("kind").agg(*[F.sum(s).alias(s) for s in STATS]).collect()}
    zero = dict.fromkeys(STATS, 0)
    model = spark.sparkContext.broadcast(Model(totals.get("unigram", zero), totals.get("bigram", zero)))
    counted = counted.drop(*STATS)

    def known(b: Grams, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the block's words, and of its bigrams."""
        words = np.empty(len(b.words), np.int64)
        words[np.argsort(b.hashes)] = answered(answers, "unigram", "a", np.uint64)
        return words, answered(answers, "bigram", "a", np.uint64).astype(np.int64)

    def histories_asked(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b, m = Grams(block.iloc[0]), model.value
        b.bigrams()
        words, pairs = known(b, answers)
        own = answered(answers, "bigram", "b", np.uint8).astype(bool)
        n = len(b.histories)
        mass = np.bincount(b.first[own], _discounted(pairs[own], m.d2), n)
        low = np.bincount(b.first[own], m.unigram(words[b.second[own]]), n)
        count = np.bincount(b.first, b.counts, n)
        order = np.argsort(b.histories)
        return pd.DataFrame(requests(b.number, "history", b.histories[order], bits, counts=count[order].astype(float),
                                      mass=mass[order], low=low[order]))

    weights = (needed.groupBy("block").cogroup(counted.groupBy("block"))
               .applyInPandas(histories_asked, ask + ", mass binary, low binary")
               .groupBy("part").applyInPandas(_weighted, ANSWER))

    def scored(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b, m = Grams(block.iloc[0]), model.value
        b.bigrams()
        words, pairs = known(b, answers)
        order = np.argsort(b.histories)
        denominator, alpha = np.empty((2, len(order)))
        denominator[order] = answered(answers, "history", "a", np.float64)
        alpha[order] = answered(answers, "history", "b", np.float64)
        seen = pairs > 0
        log = np.empty(len(pairs))
        log[seen] = np.log10(_discounted(pairs[seen], m.d2)) - denominator[b.first[seen]]
        log[~seen] = alpha[b.first[~seen]] + np.log10(m.unigram(words[b.second[~seen]]))
        return pd.DataFrame({
            id_col: pd.Series(unpack_ids(block.iloc[0]["ids"]), dtype=object), "held_out": b.held, "n_tokens": b.sizes,
            "n_known": np.add.reduceat((words[b.tokens] > 0).astype(np.int64), b.start), "train_tokens": m.total,
            "base_score": np.add.reduceat(m.base(words)[b.tokens], b.start),
            "score": np.add.reduceat(log[b.occurrence], b.start)})

    kind = docs.schema[id_col].dataType.simpleString()
    return (blocks.groupBy("block").cogroup(counted.union(weights).groupBy("block")).applyInPandas(
        scored, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double"))
