"""Operator 6, toxicity: a factorization machine over hashed terms.

The score of a text is sigmoid(w0 + sum of w over its terms + sum over pairs
of terms of <v, v'>): the pairwise part sees combinations (an insult next to
the mention of a group) that additive weights miss.  Terms are the distinct
lower-cased runs of letters of the whole text, and the first four bytes of
the longer ones, so that inflected forms share evidence; each is hashed to one
of ``2**BITS`` slots.

Training runs in numpy on a bounded sample of labelled rows (``SAMPLE``):
FTRL with an L1 penalty for w, AdaGrad with an L2 penalty for v.  In the first
part of a fit a term has factors only while its w is ``STRONG``, so that the
many weak terms of a long text add no noise to its pairs.  In the second part
every term that ``OFTEN`` rows hold has factors, whatever its w, as a term that
says nothing alone can in a pair; theirs are held short by a penalty on their
length, which takes those that no pair needs to zero.
Scoring is one pass over the documents without a shuffle.

``OFTEN`` and ``SHRINK`` were chosen by folds inside the training rows; the
held-out rows had no part in it.

Defined results: a null or empty text scores sigmoid(w0); without any
labelled row all weights are zero (score 0.5); repeated rows score alike; a null
id is scored like any other and stays null; a very long text is one set of
terms, so it takes time in proportion to its length; extra columns, whatever
their names, are not read, and ``keep_clean`` returns them unchanged; an empty
table gives an empty table.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from martwright.llm.common import labelled_sample, map_batches, only, ship

BITS = 18
FACTORS = 4
FACTOR_RATE = 0.2
STRONG = 0.5  # in the first part of a fit, a term has factors while its weight is at least this, up or down
OFTEN = 100  # in the second, every term that so many rows of the sample hold
START = 0.05  # deviation of the factors that begin there
LATE_RATE = 0.05
SHRINK = 0.07  # penalty on the length of their v, for each row that holds the term
SAMPLE = 16_000  # most labelled rows that a fit uses
EPOCHS = 8  # passes over the sample, and more for a small one
# letters and all that isn't ASCII stay, the rest parts words
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_CACHE_MOST = 200_000  # words that a scorer remembers


def _terms(text: str | None) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) if text else set()


def _slots(word: bytes) -> tuple[int, ...]:
    mask = (1 << BITS) - 1
    whole = zlib.crc32(word) & mask
    return (whole, zlib.crc32(b"^" + word[:4]) & mask) if len(word) >= 4 else (whole,)


def term_slots(text: str | None) -> np.ndarray:
    """The distinct slots of the text's terms."""
    found = {slot for word in _terms(text) for slot in _slots(word)}
    return np.array(sorted(found), np.int64)


@dataclass
class FactorizationMachine:
    w0: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    v: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, FACTORS), np.float32))

    def __post_init__(self) -> None:
        self._active: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_active": {}}

    def text_score(self, text: str | None) -> float:
        """The score of a text; words without weight are remembered as such."""
        if len(self._active) >= _CACHE_MOST:
            self._active.clear()
        active, found = self._active, set()
        for word in _terms(text):
            slots = active.get(word)
            if slots is None:
                slots = active[word] = tuple(s for s in _slots(word) if self.w[s] or self.v[s].any())
            if slots:
                found.update(slots)
        return self.score(np.array(sorted(found), np.int64))

    def logit(self, slots: np.ndarray) -> float:
        v = self.v[slots].astype(float)
        return float(self.w0 + self.w[slots].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v * v).sum()))

    def score(self, slots: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(slots), -30, 30))))


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The sums of the rows of ``values`` that share an ``at``."""
    return np.stack([np.bincount(at, column, n) for column in values.T], 1)


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 2.0,
        l1: float = 0.35, l2: float = 1e-2, batch: int = 256, seed: int = 7) -> FactorizationMachine:
    """A machine from the slots of each row and its 0/1 label."""
    fm, rng = FactorizationMachine(), np.random.default_rng(seed)
    n = len(rows)
    l1 *= np.sqrt(n)  # chance alone moves a term's gradient by about that much
    if not n:
        return fm
    share = min(max(float(labels.mean()), 1 / (n + 1)), n / (n + 1))
    fm.w0 = float(np.log(share / (1 - share)))
    z, q = np.zeros(1 << BITS), np.zeros(1 << BITS)  # FTRL's state for w
    start = rng.normal(0, 0.1, (1 << BITS, FACTORS)).astype(np.float32)
    often = np.bincount(np.concatenate(rows), minlength=1 << BITS) >= OFTEN
    late = np.zeros(1 << BITS, bool)  # slots whose factors begin in the second part
    gv, g0 = np.full((1 << BITS, FACTORS), 1e-2, np.float32), 1.0
    alpha, beta = rate, 1.0
    first = epochs + 30_000 // n
    for epoch in range(first + -(-first // 2)):
        if epoch == first:
            fm.v[np.abs(fm.w) < STRONG] = 0
            late = often & ~fm.v.any(1)
            fm.v[late] = rng.normal(0, START, (int(late.sum()), FACTORS))
        order = rng.permutation(n)
        for at in range(0, n, batch):
            part = order[at:at + batch]
            sizes = np.array([len(rows[i]) for i in part])
            idx = np.concatenate([rows[i] for i in part])
            row = np.repeat(np.arange(len(part)), sizes)
            has = fm.v[idx].any(1) if epoch >= first else np.abs(fm.w[idx]) >= STRONG
            ai, ar = idx[has], row[has]
            va = fm.v[ai].astype(float)
            sums = _sums(ar, va, len(part))
            squares = np.bincount(ar, (va * va).sum(1), len(part))
            linear = np.bincount(row, fm.w[idx], len(part))
            logit = fm.w0 + linear + 0.5 * ((sums ** 2).sum(1) - squares)
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[part]
            # FTRL on w, one step for each slot of the batch
            slots, inverse = np.unique(idx, return_inverse=True)
            g = np.bincount(inverse, error[row], len(slots))
            old = fm.w[slots]
            sigma = (np.sqrt(q[slots] + g * g) - np.sqrt(q[slots])) / alpha
            z[slots] += g - sigma * old
            q[slots] += g * g
            zs = z[slots]
            new = np.where(np.abs(zs) <= l1, 0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(q[slots])) / alpha + l2))
            fm.w[slots] = new
            if epoch < first:
                born = slots[(np.abs(new) >= STRONG) & ~fm.v[slots].any(1)]
                fm.v[born] = start[born]
            # AdaGrad on the factors that took part, then the penalty of the late ones
            if len(ai):
                touched, inv = np.unique(ai, return_inverse=True)
                gsum = _sums(inv, error[ar][:, None] * (sums[ar] - va), len(touched)) + l2 * fm.v[touched]
                gv[touched] += gsum ** 2
                step = np.where(late[touched], LATE_RATE, FACTOR_RATE)[:, None] / np.sqrt(gv[touched])
                moved = fm.v[touched] - step * gsum
                pull = SHRINK * np.bincount(inv) * late[touched] * step.mean(1)
                length = np.maximum(np.sqrt((moved ** 2).sum(1)), 1e-12)
                fm.v[touched] = moved * np.maximum(0, 1 - pull / length)[:, None]
            g0 += float(error.sum()) ** 2
            fm.w0 -= rate * float(error.sum()) / np.sqrt(g0)
    return fm


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", bound: int = SAMPLE,
          skip_mod: tuple[int, int] | None = None) -> FactorizationMachine:
    """Fit on at most ``bound`` labelled rows; only they reach the driver, as slots."""
    sample = labelled_sample(docs, labels, label_col, bound, skip_mod)

    def slots(batch):
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "slots": [term_slots(t.as_py()).astype("<i4").tobytes() for t in batch.column("text")]}

    got = sorted(map(tuple, map_batches(sample, "doc_id long, label int, slots binary", slots).collect()))
    return fit([np.frombuffer(r[2], "<i4").astype(np.int64) for r in got],
               np.array([float(r[1] > 0) for r in got]))


def score_toxicity(docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, score`` of each row; one pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def scores(batch):
        fm = held.value
        return {id_col: batch.column(id_col),
                "score": [fm.text_score(t.as_py()) for t in batch.column(text_col)]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(only(docs, id_col, text_col), f"`{id_col}` {kind}, score double", scores)


def keep_clean(docs: DataFrame, machine: FactorizationMachine, most: float = 0.7,
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``most``, unchanged."""
    import pyarrow as pa

    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            fm = held.value
            text = batch.column(batch.schema.get_field_index(text_col))
            ok = pa.array([fm.text_score(t.as_py()) < most for t in text], pa.bool_())
            yield batch.filter(ok)

    return docs.mapInArrow(run, docs.schema)
