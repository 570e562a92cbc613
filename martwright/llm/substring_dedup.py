"""Operator 7, substring dedup with suffix automata of reference shards.

A window of ``length`` consecutive words is *owned* by the smallest id of the
documents that hold it; a document loses the words of every window that another,
smaller document owns, judged on the input.

1. Each window is named by its *anchor*, the smallest hash among its runs of
   ``SHINGLE`` words: equal windows have equal anchors.  Blocks of documents ask
   how many documents hold each of their anchors (see ``blocks``); a window
   whose anchor one document alone holds can't repeat.
2. The rest, runs of neighbouring windows with one anchor, are dealt by anchor
   to reference shards, each distinct run of a block once with its smallest
   id; a task gets many small shards, and works through them one by one.  A shard builds one suffix automaton over its runs, carries smallest ids
   up the suffix links, streams every run for its matching statistics, and
   where at least ``length`` words match it names the owner of the window.
3. The owners go back to the blocks, which cut the maximal spans.

Shards are built where their runs lie, instead of being broadcast to every
document: runs that could match are in one shard, so each is streamed through
one automaton only, and work grows with the input.  An anchor that more than
``HOT`` documents hold (a licence line, say) has no bound on its runs, so its
windows are dealt one by one, by their own hash: then each shard stays small
whatever repeats.

Ids must be integers.  Defined results: a null or empty text has no words; a
null id counts as larger than any other; rows that repeat an id own windows
together and lose none to each other; an empty table gives an empty table; a
very long text lies whole in one block, whose task holds all its words; extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from martwright.llm.blocks import (ANSWER, PART, REQUEST, Block, Merged, answered, bits_for, mix, one_by_one, pack,
                                   requests, store_blocks, unpack_ids)
from martwright.llm.common import stored

LENGTH, SHINGLE = 13, 6
HOT = 2000  # documents; windows of a more frequent anchor are dealt by themselves
PART_RUNS = 8_000  # runs that one task gets together, about
SHARD_BITS = 8  # of the key, after those that name the part: shards of a few dozen runs
RUN = 64  # most windows in a run
NOBODY = np.iinfo(np.int64).max


class SuffixAutomaton:
    """Of several word sequences; each state knows the smallest id it occurs in."""

    def __init__(self):
        self.next, self.link, self.size, self.least = [{}], [-1], [0], [NOBODY]

    def _new(self, size: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.size.append(size)
        self.least.append(NOBODY)
        return len(self.size) - 1

    def _follow(self, p: int, word, q: int) -> int:
        """``q`` if it is p's own continuation, else a copy that is."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._new(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list, owner: int) -> None:
        nxt, link, size, least = self.next, self.link, self.size, self.least
        last = 0
        for word in words:
            known = nxt[last].get(word)
            if known is not None:
                last = known if size[known] == size[last] + 1 else self._follow(last, word, known)
            else:
                state, p = len(size), last
                nxt.append({})
                size.append(size[last] + 1)
                least.append(NOBODY)
                link.append(0)
                while p >= 0:
                    edges = nxt[p]
                    q = edges.get(word)
                    if q is not None:
                        link[state] = q if size[q] == size[p] + 1 else self._follow(p, word, q)
                        break
                    edges[word] = state
                    p = link[p]
                last = state
            if owner < least[last]:
                least[last] = owner

    def finish(self) -> None:
        """Smallest ids up the suffix links, longest states first."""
        least, link = self.least, self.link
        for s in np.argsort(np.array(self.size), kind="stable")[:0:-1].tolist():
            if least[s] < least[link[s]]:
                least[link[s]] = least[s]

    def owners(self, words: list, length: int) -> list[int]:
        """For each window of ``length`` words the smallest id that holds it,
        from the matching statistics; ``NOBODY`` where less matches."""
        nxt, link, size = self.next, self.link, self.size
        state = matched = 0
        out = []
        for at, word in enumerate(words):
            while state and word not in nxt[state]:
                state = link[state]
                matched = size[state]
            if word in nxt[state]:
                state = nxt[state][word]
                matched += 1
            while size[link[state]] >= length if state else False:
                state = link[state]
                matched = size[state]
            if at >= length - 1:
                out.append(self.least[state] if matched >= length else NOBODY)
        return out


def _rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:len(hashes) - n + 1 + j]
    return mix(out)


class Windows(Block):
    """A block's windows, anchors and runs."""

    def __init__(self, row, length: int):
        super().__init__(row)
        self.length = length
        self.ids = np.array([NOBODY if i is None else int(i) for i in unpack_ids(row["ids"])], np.int64)
        stream = self.hashes[self.tokens]
        shingle = min(SHINGLE, length)
        s = _rolling(stream, shingle)
        n = max(0, len(stream) - length + 1)
        anchor = s[:n].copy()
        for j in range(1, length - shingle + 1):
            np.minimum(anchor, s[j:n + j], out=anchor)
        document = np.repeat(np.arange(len(self.sizes)), self.sizes)[:n]
        end = self.start + self.sizes - 1  # of the words, without the end mark
        inside = np.arange(n) + length <= end[document] if n else np.zeros(0, bool)
        self.at = np.flatnonzero(inside)  # where the windows start
        self.anchor, self.document = mix(anchor[self.at]), document[self.at]
        self.stream = stream

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, in how many documents each is, and each window's number."""
        first = np.ones(len(self.anchor), bool)  # neighbours mostly have one anchor
        first[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.document[1:] != self.document[:-1])
        keys, number = np.unique(self.anchor[first], return_inverse=True)
        pairs = np.unique(number * len(self.sizes) + self.document[first])
        held_by = np.bincount(pairs // max(1, len(self.sizes)), minlength=len(keys))
        return keys, held_by, number[np.cumsum(first) - 1]

    def runs(self, held_by: np.ndarray, number: np.ndarray) -> None:
        """The distinct runs of windows that can repeat, in order of shard key:
        ``keys``, ``least`` (smallest id), ``texts``; and for each window that
        can repeat its place in the list of all runs' windows."""
        can = np.flatnonzero(held_by[number] >= 2)
        at, anchor, document = self.at[can], self.anchor[can], self.document[can]
        hot = held_by[number[can]] > HOT
        fresh = np.ones(len(can), bool)
        fresh[1:] = ((at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])
                     | hot[1:] | hot[:-1])
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.append(first, len(can)))
        if len(sizes) and sizes.max() > RUN:  # cut the long ones
            inside = np.arange(len(can)) - np.repeat(first, sizes)
            fresh |= inside % RUN == 0
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.append(first, len(can)))
        key = anchor[first]
        if hot.any():
            own = _rolling(self.stream, self.length)
            key = np.where(hot[first], mix(own[at[first]]), key)
        slots: dict[bytes, int] = {}
        tokens = self.tokens.astype("<i4")
        begin, extent = at[first].tolist(), (sizes + self.length - 1).tolist()
        slot = np.fromiter((slots.setdefault(tokens[a:a + n].tobytes(), len(slots)) for a, n in zip(begin, extent)),
                           np.int64, len(begin))
        _, sample = np.unique(slot, return_index=True)  # slots are numbered as they come
        least = np.full(len(slots), NOBODY)
        np.minimum.at(least, slot, self.ids[document[first]])
        order = np.argsort(key[sample], kind="stable")
        self.keys, self.least = key[sample][order], least[order]
        chosen = sample[order]
        self.begin, self.extent = at[first][chosen], sizes[chosen] + self.length - 1
        # each run's windows follow one another in the answers
        offset = np.empty(len(order), np.int64)
        offset[order] = np.concatenate([[0], np.cumsum(sizes[chosen])[:-1]]) if len(order) else 0
        run = np.cumsum(fresh) - 1
        self.window_at, self.window_document = at, document
        self.answer_at = offset[slot[run]] + np.arange(len(can)) - first[run] if len(can) else np.zeros(0, np.int64)

    def text(self, a: int, n: int) -> bytes:
        return b" ".join([self.words[t] for t in self.tokens[a:a + n].tolist()])


def _held_by(pdf: pd.DataFrame) -> pd.DataFrame:
    m = Merged(pdf)
    total = m.sums(m.values("counts", np.uint32).astype(np.int64))
    out = m.answer("anchor", total[m.group].astype(np.uint32), np.zeros(len(m.group), np.uint8))
    out["runs"] = [int(total[total > 1].sum())] + [0] * (len(out) - 1)
    return out


def _owned(length: int):
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        pdf = pdf.sort_values("block")
        texts = [zstandard.ZstdDecompressor().decompress(b).split(b"\n") for b in pdf["texts"]]
        ids = [np.frombuffer(b, np.int64) for b in pdf["least"]]
        shards: dict[int, dict[bytes, int]] = {}  # runs with their smallest id
        for runs, own, at in zip(texts, ids, pdf["shards"]):
            for text, i, s in zip(runs, own.tolist(), np.frombuffer(at, np.uint16).tolist()):
                least = shards.setdefault(s, {})
                if i < least.get(text, NOBODY + 1):
                    least[text] = i
        owners: dict[bytes, list[int]] = {}
        for least in shards.values():
            automaton, words = SuffixAutomaton(), {}
            for text in sorted(least):
                words[text] = text.split()
                automaton.add(words[text], least[text])
            automaton.finish()
            for text, w in words.items():
                owners[text] = automaton.owners(w, length)
        return pd.DataFrame({
            "block": pdf["block"].to_numpy(), "kind": "owner", "part": pdf["part"].to_numpy(),
            "a": [pack(np.array([o for text in runs for o in owners[text]], np.int64)) for runs in texts],
            "b": [b""] * len(pdf)})
    return part


def drop_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, text`` of every row: the words that stay,
    joined by one space."""
    import pyarrow as pa

    blocks = store_blocks(docs, id_col, text_col)
    bits = bits_for(blocks.agg(F.sum("n")).first()[0] or 0, 4 * PART)

    def anchors_asked(batches):
        for row in one_by_one(batches):
            b = Windows(row, length)
            keys, counts, _ = b.anchors()
            yield pa.RecordBatch.from_pylist(
                requests(b.number, "anchor", keys, bits, counts=counts.astype(np.uint32)),
                pa.schema([("block", pa.int64()), ("kind", pa.string()), ("part", pa.int32()),
                           ("keys", pa.binary()), ("counts", pa.binary())]))

    held = stored(blocks.drop("n").mapInArrow(anchors_asked, REQUEST + ", counts binary")
                  .groupBy("part").applyInPandas(_held_by, ANSWER + ", runs long"), "anchors")
    shards = bits_for(held.agg(F.sum("runs")).first()[0] or 0, PART_RUNS)
    held = held.drop("runs")

    def opened(block: pd.DataFrame, answers: pd.DataFrame) -> Windows | None:
        b = Windows(block.iloc[0], length)
        if len(b.at):
            _, _, number = b.anchors()
            b.runs(answered(answers, "anchor", "a", np.uint32).astype(np.int64), number)
        return b

    def runs_asked(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        out, b = [], opened(block, answers)
        if len(b.at) and len(b.keys):
            part = (b.keys >> np.uint64(64 - shards)).astype(np.int64) if shards else np.zeros(len(b.keys), np.int64)
            shard = (b.keys >> np.uint64(64 - shards - SHARD_BITS) & np.uint64((1 << SHARD_BITS) - 1)).astype(np.uint16)
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                texts = b"\n".join(b.text(a, n) for a, n in zip(b.begin[i:j].tolist(), b.extent[i:j].tolist()))
                out.append((b.number, int(part[i]), zstandard.ZstdCompressor(level=3).compress(texts),
                            b.least[i:j].tobytes(), shard[i:j].tobytes()))
        return pd.DataFrame(out, columns=["block", "part", "texts", "least", "shards"])

    owners = (blocks.drop("n").groupBy("block").cogroup(held.groupBy("block"))
              .applyInPandas(runs_asked, "block long, part int, texts binary, least binary, shards binary")
              .groupBy("part").applyInPandas(_owned(length), ANSWER))

    def cut(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b = opened(block, answers)
        gone = np.zeros(len(b.tokens) + 1, np.int64)
        if len(b.at) and len(b.keys):
            owner = answered(answers, "owner", "a", np.int64)[b.answer_at]
            lost = b.window_at[owner < b.ids[b.window_document]]
            np.add.at(gone, lost, 1)
            np.add.at(gone, lost + length, -1)
        gone = np.cumsum(gone[:-1]) > 0
        texts = []
        for a, n in zip(b.start.tolist(), (b.sizes - 1).tolist()):
            kept = b.tokens[a:a + n][~gone[a:a + n]].tolist()
            texts.append(b" ".join([b.words[t] for t in kept]).decode("utf-8", "replace"))
        return pd.DataFrame({id_col: pd.Series(unpack_ids(block.iloc[0]["ids"]), dtype=object), "n_words": b.sizes - 1,
                             "n_removed": np.add.reduceat(gone, b.start).astype(np.int64) if len(gone) else 0,
                             text_col: texts})

    kind = docs.schema[id_col].dataType.simpleString()
    return (blocks.drop("n").groupBy("block").cogroup(held.union(owners).groupBy("block"))
            .applyInPandas(cut, f"`{id_col}` {kind}, n_words long, n_removed long, `{text_col}` string"))
