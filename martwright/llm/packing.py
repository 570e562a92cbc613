"""Operator 9, best-fit packing: documents into sequences of at most
``capacity`` tokens.

A document is its byte-BPE ids and an end id.  One longer than the capacity is
cut into full pieces, its first piece taking what is over.  Pieces are dealt
evenly into groups of about ``GROUP``, and each group is packed by bin
completion: around the largest piece left, the undominated fillings are
enumerated; branches that can't beat the incumbent's waste are cut; the
incumbent is best-fit decreasing at first.  The search starts with the bins that
have the most room and those with the most pieces, and takes in more, at last all.  It ends at the lower bound
(L2), when it has proved the incumbent, or after ``STEPS`` steps with the best
packing so far.

Ids are those of ``tokenizers`` for the same vocabulary, its added token
included; ``tiktoken`` makes them here as it is faster (a test holds one against
the other).

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; null document ids stay; an empty table gives an empty table; a
very long text is encoded whole in one task and leaves as its pieces; extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martwright.llm.common import map_batches, only, stored

CAPACITY, END_ID = 1024, 2
GROUP = 8192  # pieces packed together
STEPS = 200_000  # of the search in one group: the only limit on it
PORTION = 32  # fillings around one piece that are ordered at a time
POOREST = 4  # bins with the most room that the search takes first
SHARES = 12  # parts of the steps, of which a search over some of the bins has one
# Fixed value: the one added token of the vocabulary, matched in texts as it stands.
ADDED_TOKEN, ADDED_ID = "<|endoftext|>", 50256

PIECES = "piece int, start long, length long, ids_crc32 long"


# --- tokens ---------------------------------------------------------------

@lru_cache(2)
def encoder(vocabulary: str):
    """The byte-BPE encoder of a rank file (path or public file name)."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


class _Words(dict):
    """Ids of a space and a word, made when first asked for; bounded."""

    MOST = 400_000

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.MOST:
            self.clear()
        got = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return got


@lru_cache(2)
def _words(vocabulary: str) -> _Words:
    return _Words(encoder(vocabulary).encode_ordinary)


# White space that the vocabulary's pattern joins into runs, other than the four below.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def token_bytes(text: str, vocabulary: str) -> bytes:
    """The text's ids, little-endian and unsigned.

    The pattern starts a new token at a space that follows a word, so words
    can be encoded one by one and remembered.  Inside a run of white space
    that does not hold; such texts are encoded whole.
    """
    if not text:
        return b""
    if ADDED_TOKEN in text:
        return np.array([ADDED_ID], "<u4").tobytes().join(
            token_bytes(part, vocabulary) for part in text.split(ADDED_TOKEN))
    if "  " in text or "\n " in text or "\t " in text or "\r " in text or _ODD_SPACE.search(text):
        return np.array(encoder(vocabulary).encode_ordinary(text), "<u4").tobytes()
    first, *rest = text.split(" ")
    head = np.array(encoder(vocabulary).encode_ordinary(first), "<u4").tobytes()
    return head + b"".join(map(_words(vocabulary).__getitem__, rest))


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, ids) of a document's pieces."""
    n = len(ids) // 4
    at, first = 0, n % capacity or capacity
    while at < n:
        size = first if at == 0 else capacity
        yield at, size, ids[4 * at:4 * (at + size)]
        at += size


def pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
           end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: id, piece, start, length, crc32 of its ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batch):
        rows = []
        for i, text in zip(batch.column(id_col).to_pylist(), batch.column(text_col)):
            ids = token_bytes(text.as_py() or "", vocabulary) + end
            rows += [(i, k, at, n, zlib.crc32(part)) for k, (at, n, part) in enumerate(cut(ids, capacity))]
        return dict(zip((id_col, "piece", "start", "length", "ids_crc32"),
                        map(list, zip(*rows)) if rows else [[]] * 5))

    return map_batches(only(docs, id_col, text_col), f"`{id_col}` {kind}, {PIECES}", run)


# --- packing --------------------------------------------------------------

def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths: each piece, longest first, into the fullest bin that takes it."""
    open_bins: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = np.zeros(capacity + 1, bool)
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = int(rooms[n:].argmax()) + n if rooms[n:].any() else -1
        if fit < 0:
            bin_, room = [], capacity
            bins.append(bin_)
        else:
            bin_, room = open_bins[fit].pop(), fit
            rooms[fit] = bool(open_bins[fit])
        bin_.append(n)
        open_bins[room - n].append(bin_)
        rooms[room - n] = True
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Martello and Toth's L2: for each k, pieces over capacity - k are alone,
    those over half aren't together, and those from k to half fill the rest."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    number, size = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    below = np.where(k > 0, k - 1, 0)
    large = number[capacity] - number[half]
    alone = number[capacity] - number[capacity - k]
    middle = large - alone
    room = middle * capacity - (size[capacity - k] - size[half])
    small = size[half] - np.where(k > 0, size[below], 0)
    return int((large + np.maximum(0, -(-(small - room) // capacity))).max())


class Budget:
    """Steps of the search that are left; it ends when there are none."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self) -> bool:
        self.left -= 1
        return self.left >= 0


def fillings(left: list[int], mask: int, first: int, capacity: int, waste: int, budget: Budget) -> Iterator[list[int]]:
    """Undominated ways to fill the bin that ``first`` opens.

    ``left``: how many pieces of each length remain (``first`` among them);
    ``mask``: its lengths as bits.  A filling is dominated if one more piece
    fits, or a longer piece can stand in for one or two of its own.  Those
    that waste more than ``waste`` are cut.  Fillings without waste by two or
    three pieces come first, then all others in portions of ``PORTION``, the
    fullest of a portion first; the iterator goes on where it stopped, so none
    is left out unless the budget ends.
    """
    room = capacity - first
    if left[first] == 1:
        mask &= ~(1 << first)
    if not room or mask >> room & 1:  # filled by one piece, which stands in for any other filling
        yield [room] if room else []
        return

    def spare(n: int, chosen: list[int]) -> int:
        return left[n] - (n == first) - chosen.count(n)

    def largest(room: int, last: int, chosen: list[int]) -> Iterator[int]:
        n = min(room, last)
        while (bits := mask & ((2 << n) - 1)) and (n := bits.bit_length() - 1):
            if spare(n, chosen) > 0:
                yield n
            n -= 1

    def dominated(chosen: list[int], rest: int) -> bool:
        usable = mask
        for n in set(chosen):
            if spare(n, chosen) <= 0:
                usable &= ~(1 << n)
        ones = (1 << rest) - 1
        return any(usable >> (a + 1) & ones or any(
            usable >> (a + b) & (ones << 1 | 1) for b in chosen[k + 1:]) for k, a in enumerate(chosen))

    def exact() -> Iterator[list[int]]:
        pair = _exact_pair(spare, mask, room, [])
        if pair:
            yield pair
        for n in largest(room, room, []):
            if not budget.spend():
                return
            pair = _exact_pair(spare, mask, room - n, [n])
            if pair:
                yield [n, *pair]

    def walk(room: int, last: int, chosen: list[int]) -> Iterator[tuple[int, list[int]]]:
        fits = False
        for n in largest(room, last, chosen):
            fits = True
            if not budget.spend():
                return
            yield from walk(room - n, n, [*chosen, n])
        if not fits and room <= waste and next(largest(room, room, chosen), 0) == 0 and not dominated(chosen, room):
            yield room, chosen

    seen = set()
    for filling in exact():
        key = tuple(sorted(filling))
        if key not in seen:
            seen.add(key)
            yield filling
    others = walk(room, room, [])
    while portion := sorted(itertools.islice(others, PORTION)):
        yield from (chosen for _, chosen in portion if tuple(sorted(chosen)) not in seen)


def _exact_pair(spare, mask: int, room: int, chosen: list[int]) -> list[int] | None:
    """Two lengths left beside ``chosen`` that make up ``room``."""
    a = room - 1
    while a * 2 >= room and (bits := mask & ((2 << a) - 1)):
        a = bits.bit_length() - 1
        b = room - a
        if a * 2 < room or a == 0:
            return None
        if mask >> b & 1 and spare(a, chosen) > 0 and spare(b, [*chosen, a]) > 0:
            return [a, b]
        a -= 1
    return None


def complete(lengths: list[int], capacity: int, best: list[list[int]], bound: int, budget: Budget) -> list[list[int]]:
    """Bin completion: bins of ``lengths``, fewer than ``best`` if the search
    finds such before the budget ends.  An emptied search proves ``best``."""
    left, mask, total = [0] * (capacity + 1), 0, sum(lengths)
    for n in lengths:
        left[n] += 1
        mask |= 1 << n
    bins: list[list[int]] = []
    stack: list[Iterator[list[int]]] = []
    wasted, remaining = 0, len(lengths)

    def take(n: int, by: int) -> None:
        nonlocal mask
        left[n] += by
        mask = mask | 1 << n if left[n] else mask & ~(1 << n)

    def branch() -> Iterator[list[int]]:
        first = mask.bit_length() - 1
        allowed = (len(best) - 1) * capacity - total - wasted
        if allowed < 0:
            return iter([])
        return ([first, *f] for f in fillings(left, mask, first, capacity, allowed, budget))

    stack.append(branch())
    while stack and budget.left > 0 and len(best) > bound:
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            if bins:
                undone = bins.pop()
                wasted -= capacity - sum(undone)
                remaining += len(undone)
                for n in undone:
                    take(n, 1)
            continue
        budget.spend()
        waste = capacity - sum(filling)
        if total + wasted + waste > (len(best) - 1) * capacity:
            continue
        bins.append(filling)
        wasted += waste
        remaining -= len(filling)
        for n in filling:
            take(n, -1)
        if not remaining:
            best = [list(b) for b in bins]
        stack.append(branch() if remaining else iter([]))
    return best


def pack(lengths: list[int], capacity: int = CAPACITY, steps: int = STEPS) -> list[list[int]]:
    """Bins of lengths, as few as the search finds.

    Best-fit decreasing is the first incumbent.  It leaves room behind large
    pieces once the small ones are used up, so the search takes the bins with
    the most room together with those of the most pieces, and completes bins
    anew over the pieces of both; it takes twice as many when that gains
    nothing, and at last all, with the steps that are left.
    """
    if not lengths:
        return []
    best = best_fit_decreasing(lengths, capacity)
    bound, budget, some = lower_bound(lengths, capacity), Budget(steps), POOREST
    while len(best) > bound and budget.left > 0:
        best.sort(key=sum)
        poor, rest = best[:some], best[some:]
        rest.sort(key=len, reverse=True)
        chosen, others = poor + rest[:some], rest[some:]
        held = [n for b in chosen for n in b]
        share = Budget(min(budget.left, steps // SHARES) if others else budget.left)
        given = share.left
        found = complete(held, capacity, chosen, max(1, -(-sum(held) // capacity)), share)
        budget.left -= given - max(0, share.left)
        if len(found) < len(chosen):
            best = found + others
        elif others:
            some *= 2
        else:
            break
    return best


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece with its ``sequence_id`` and ``offset``.

    Only lengths and checksums are shuffled, never tokens.
    """
    table = stored(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    groups = -(-max(1, table.count()) // GROUP)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        by_length: dict[int, list[int]] = {}
        for at, n in enumerate(pdf["length"].tolist()):
            by_length.setdefault(n, []).append(at)
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        start = int(pdf["_group"].iloc[0]) << 32
        for k, bin_ in enumerate(pack([int(n) for n in pdf["length"]], capacity)):
            at = 0
            for n in bin_:
                row = by_length[n].pop()
                sequence[row], offset[row] = start + k, at
                at += n
        return pdf.drop(columns="_group").assign(sequence_id=sequence, offset=offset)

    kind = docs.schema[id_col].dataType.simpleString()
    # numbered row by row: whatever ids repeat, the groups are even
    dealt = table.withColumn("_group", F.monotonically_increasing_id() % groups)
    return dealt.groupBy("_group").applyInPandas(
        place, f"`{id_col}` {kind}, {PIECES}, sequence_id long, offset long")
