"""Operator 4, quality rules: gradient-boosted trees over document statistics.

Each text gives a row of statistics (``STATISTICS``).  Trees are fitted in
numpy on a bounded sample of labelled rows: logistic loss, Newton steps,
quantile bins, and monotonic constraints on the statistics in ``MONOTONE``
(more symbols, repeats or copied lines never raise the score).  The ensemble is
flattened into arrays of features, thresholds, children and values; a batch is
scored by walking all its rows through all trees at once, level by level.

A document is kept if it passes the base rule (at least ``MIN_WORDS`` words, at
most half of them in repeated three-word windows) and its score is at least
``KEEP``.  One pass over the documents, no shuffle.

Defined results: a null or empty text has no words and fails; without any
labelled row the trees are empty and the base rule decides; repeated rows and
null ids are judged row by row; an empty table gives an empty table; a very
long text is counted whole, in one task, with sorts of its words; extra columns
are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from martwright.llm.common import labelled_sample, map_batches, only

MIN_WORDS, KEEP = 50, 0.5
SAMPLE = 12_000  # most labelled rows that a fit uses
TREES, DEPTH, BINS, RATE, SMALLEST = 120, 4, 64, 0.1, 20

STATISTICS = ("words", "word_length", "distinct", "top_word", "symbols", "pipes", "repeats", "copied_lines",
              "lines", "line_words", "digits", "capitals", "stops", "commas", "other_marks", "marked_words")
# -1: a larger value never raises the score
MONOTONE = {"symbols": -1, "repeats": -1, "copied_lines": -1}

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_KINDS = {
    "digits": b"0123456789",
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "stops": b".!?",
    "commas": b",;:",
    "other_marks": b"-_=+/\\\"'()[]{}@^~`",
}


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(ids) < 4:
        return 0
    _, pair = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
    _, number, count = np.unique(pair[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[number] > 1)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[again + k] = True
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The contract's counts (words, word_chars, symbols, dup_lines,
    repeat_words) and the row of ``STATISTICS``."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return [0, 0, _count(np.bincount(np.frombuffer(data, np.uint8), minlength=256), _SYMBOLS), 0, 0], [0.0] * len(STATISTICS)
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    size = sum(map(len, words))
    chars = len(text) - (len(data) - size)
    marks = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    symbols = _count(marks, _SYMBOLS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    copied = len(lines) - len(set(lines))
    repeats = repeated_words(ids, len(numbers))
    marked = sum(1 for w in numbers if not w[-1:].isalpha() and w[-1] < 128)
    row = [n, chars / n, len(numbers) / n, np.bincount(ids).max() / n, symbols / n, marks[ord("|")] / n, repeats / n,
           copied / len(lines), len(lines), n / len(lines),
           *(_count(marks, np.frombuffer(_KINDS[k], np.uint8)) / n for k in _KINDS), marked / len(numbers)]
    return [n, chars, symbols, copied, repeats], [float(x) for x in row]


def _count(marks: np.ndarray, which: np.ndarray) -> int:
    return int(marks[which].sum())


# --- trees ----------------------------------------------------------------

@dataclass
class Trees:
    """Flattened trees: a leaf is its own child."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray  # left if the value is at most this
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total = np.full(len(rows), self.start)
        if len(self.roots) and len(rows):
            at = np.repeat(self.roots[None, :], len(rows), 0)
            row = np.arange(len(rows))[:, None]
            for _ in range(DEPTH):
                low = rows[row, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, names: tuple[str, ...] = STATISTICS,
        monotone: dict[str, int] = MONOTONE, trees: int = TREES, l2: float = 1.0) -> Trees:
    """Boosted trees for 0/1 labels."""
    n = len(rows)
    if not n:
        none = np.zeros(0, np.int64)
        return Trees(0.0, none, none, none.astype(float), none, none, none.astype(float))
    share = min(max(float(labels.mean()), 1 / (n + 1)), n / (n + 1))
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], 1)
    sign = [monotone.get(name, 0) for name in names]
    score = np.full(n, start)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, 0), (threshold, np.inf), (left, len(left)), (right, len(right)), (value, 0.0)):
            a.append(v)
        return len(value) - 1

    def grow(at: int, members: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> None:
        G, H = g[members].sum(), h[members].sum()
        value[at] = RATE * float(np.clip(-G / (H + l2), low, high))
        if depth == DEPTH or len(members) < 2 * SMALLEST:
            return
        best = (1e-6, -1, -1, 0.0, 0.0)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[members, j]
            gl = np.cumsum(np.bincount(b, g[members], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[members], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
            vl = np.clip(-gl / (hl + l2), low, high)
            vr = np.clip(-(G - gl) / (H - hl + l2), low, high)
            ok = (nl >= SMALLEST) & (len(members) - nl >= SMALLEST)
            if sign[j]:
                ok &= (vr - vl) * sign[j] >= 0
            # the loss that the two values save against the parent's
            v = np.clip(-G / (H + l2), low, high)
            saved = np.where(ok, -(gl * vl + (hl + l2) * vl ** 2 / 2 + (G - gl) * vr + (H - hl + l2) * vr ** 2 / 2)
                             + G * v + (H + l2) * v ** 2 / 2, -np.inf)
            k = int(saved.argmax())
            if saved[k] > best[0]:
                best = (float(saved[k]), j, k, float(vl[k]), float(vr[k]))
        _, j, k, vl, vr = best
        if j < 0:
            return
        middle = (vl + vr) / 2
        bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}
        feature[at], threshold[at] = j, float(edges[j][k])
        left[at], right[at] = node(), node()
        goes = binned[members, j] <= k
        grow(left[at], members[goes], g, h, depth + 1, *bounds[sign[j]][0])
        grow(right[at], members[~goes], g, h, depth + 1, *bounds[sign[j]][1])

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(node())
        grow(roots[-1], np.arange(n), p - labels, p * (1 - p), 0, -np.inf, np.inf)
        one = Trees(0.0, np.array(roots[-1:]), np.array(feature), np.array(threshold), np.array(left),
                    np.array(right), np.array(value))
        at = np.full(n, roots[-1])
        for _ in range(DEPTH):
            at = np.where(rows[np.arange(n), one.feature[at]] <= one.threshold[at], one.left[at], one.right[at])
        score += one.value[at]
    return Trees(start, np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right),
                 np.array(value))


# --- Spark ----------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bound: int = SAMPLE) -> Trees:
    """Fit on at most ``bound`` labelled rows; their statistics reach the driver."""
    sample = labelled_sample(docs, labels, label_col, bound)

    def rows(batch):
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "row": [statistics(t.as_py())[1] for t in batch.column("text")]}

    got = sorted(map(tuple, map_batches(sample, "doc_id long, label int, row array<double>", rows).collect()))
    return fit(np.array([r[2] for r in got], float).reshape(len(got), len(STATISTICS)),
               np.array([float(r[1] > 0) for r in got]))


def judge(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS, keep: float = KEEP) -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``score`` and ``kept`` of each row."""
    held = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batch):
        got = [statistics(t.as_py()) for t in batch.column(text_col)]
        counts = np.array([g[0] for g in got], np.int64).reshape(len(got), 5)
        score = held.value.score(np.array([g[1] for g in got], float).reshape(len(got), len(STATISTICS)))
        failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > 50 * counts[:, 0])
        return {id_col: batch.column(id_col), **dict(zip(COUNTS, counts.T)), "base_failed": failed,
                "score": score, "kept": ~failed & (score >= keep) if len(held.value.roots) else ~failed}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(only(docs, id_col, text_col), f"`{id_col}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, "
                       "base_failed boolean, score double, kept boolean", run)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
