"""Operator 5, SentencePiece encoding and decoding by suffix-array matching.

The text becomes SentencePiece's form (a space mark in front and for each
space) and is cut before every run of space marks that follows another
character, and behind every run of letters: no piece of the model reaches over
these places (checked when it is loaded), so the parts are encoded one by one,
each distinct part once.

1. All new parts are put behind one another as code points, with a separator
   that is no code point, and their suffixes sorted by as many characters as
   the longest piece has (prefix doubling).
2. Every piece of the model is looked up by binary search, all at once, which
   gives the range of suffixes that begin with it: its occurrences.
3. The occurrences are edges from start to end; sorted by their end they are
   relaxed from left to right.  The last piece of the encoding of a prefix is
   unique: it is the edge that the encoding of the rest can stand before, which
   holds if the two pieces, put together, are encoded as themselves.  So each
   position has one best edge, and going back from the end gives the pieces.

This gives the ids of the library for BPE models (merges by score, leftmost
first); characters without a piece become byte pieces.  Decoding joins pieces,
turns byte pieces into text and space marks into spaces.

Defined results: a null or empty text has no ids and decodes to an empty text;
U+2581 in a text decodes to a space, as in the library; repeated rows and null
ids are encoded row by row; an empty table gives an empty table; a very long
text is encoded whole, part by part, in one task; extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from martwright.llm.common import map_batches, only

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CHUNK = 800_000  # code points whose suffixes are sorted together, about
REMEMBERED = 600_000  # parts that a task remembers
SEPARATOR = 0x110000
_LETTER = r"[^\W\d_]"
_MARKS = "\n!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"


class Codec:
    """A SentencePiece BPE model without its library's encoder."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        self.bytes_at = {i: int(p[3:5], 16) for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_ids = {v: k for k, v in self.bytes_at.items()}
        self.score = {p: model.get_score(i) for i, p in enumerate(self.pieces)
                      if i not in special and i not in self.bytes_at}
        self.ids = {p: i for i, p in enumerate(self.pieces) if p in self.score}
        self.raw = [bytes([self.bytes_at[i]]) if i in self.bytes_at else p.encode() if p in self.score else b""
                    for i, p in enumerate(self.pieces)]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece reaches over a space")
        # marks that no piece has behind a letter: texts are cut there too
        behind = {m for p in self.ids for m in re.findall(f"{_LETTER}(?=(.))", p, re.DOTALL)}
        marks = re.escape("".join(m for m in _MARKS if m not in behind))
        cuts = f"(?<=[^{MARK}])(?={MARK})" + (f"|(?<={_LETTER})(?=[{marks}])" if marks else "")
        self.cuts = re.compile(cuts)
        # pieces that their own text gives, as code points, zeros behind
        usable = [p for p in self.ids if self.merged(p) == [p]]
        self.longest = max(map(len, usable))
        self.length = np.array([len(p) for p in usable])
        self.codes = np.zeros((len(usable), self.longest), np.int64)
        for row, p in enumerate(usable):
            self.codes[row, :len(p)] = [ord(c) for c in p]
        self.number = np.array([self.ids[p] for p in usable])
        self.fits: dict[int, bool] = {}
        self.remembered: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """A short text's symbols after all merges, best score and leftmost first."""
        symbols = list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = self.score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _symbol(self, number: int) -> str:
        """Of a piece id, or a character beyond them."""
        return self.pieces[number] if number < len(self.pieces) else chr(number - len(self.pieces))

    def stand_together(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the first symbol can stand before the second."""
        keys, back = np.unique(first * (1 << 24) + second, return_inverse=True)
        out = np.empty(len(keys), bool)
        for n, key in enumerate(keys.tolist()):
            fits = self.fits.get(key)
            if fits is None:
                a, b = self._symbol(key >> 24), self._symbol(key & 0xFFFFFF)
                if len(self.fits) >= 1 << 20:
                    self.fits.clear()
                fits = self.fits[key] = self.merged(a + b) == [a, b]
            out[n] = fits
        return out[back]

    def _suffixes(self, text: np.ndarray) -> np.ndarray:
        """Starts of all suffixes, sorted by their first ``longest`` characters."""
        rank = np.unique(text, return_inverse=True)[1]
        width = 1
        while width < self.longest:
            after = np.zeros(len(rank), np.int64)
            after[:-width] = rank[width:] + 1
            rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1]
            width *= 2
        return np.argsort(rank, kind="stable")

    def _ranges(self, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each piece the suffixes, in order, that begin with it."""
        padded = np.append(text, np.full(self.longest, -1))
        edges = []
        for upper in (False, True):
            low, high = np.zeros(len(self.codes), np.int64), np.full(len(self.codes), len(order))
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
                for k in range(self.longest):
                    at = np.flatnonzero(same & (self.length[open_] > k))
                    if not len(at):
                        break
                    here, want = padded[order[middle[at]] + k], self.codes[open_[at], k]
                    less[at] = here < want
                    same[at] = here == want
                right = less | same if upper else less
                low[open_[right]] = middle[right] + 1
                high[open_[~right]] = middle[~right]
            edges.append(low)
        return edges[0], edges[1]

    def _encode_parts(self, parts: list[str]) -> list[list[int]]:
        """The symbols of each part."""
        sizes = np.array([len(p) for p in parts])
        text = np.full(sizes.sum() + len(parts), SEPARATOR, np.int64)
        start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        inside = np.ones(len(text), bool)
        inside[start + sizes] = False
        text[inside] = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        order = self._suffixes(text)
        low, high = self._ranges(text, order)
        count = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        begin, size, number = order[at], np.repeat(self.length, count), np.repeat(self.number, count)
        # characters that are no piece stand for themselves
        known = np.zeros(len(text), bool)
        known[begin[size == 1]] = True
        alone = np.flatnonzero(inside & ~known)
        begin = np.concatenate([begin, alone])
        size = np.concatenate([size, np.ones(len(alone), np.int64)])
        number = np.concatenate([number, len(self.pieces) + text[alone]])
        # edges by where they end in their part, relaxed from left to right
        first = np.repeat(start, sizes + 1)  # the part's start, for each place in the text
        end = begin + size
        place = end - first[begin]
        by_place = np.argsort(place, kind="stable")
        begin, end, number, place = begin[by_place], end[by_place], number[by_place], place[by_place]
        last = np.full(len(text) + 1, -1, np.int64)  # the best edge's symbol that ends here
        came = np.zeros(len(text) + 1, np.int64)  # and where it begins
        bounds = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])) if len(place) else [0]
        for i, j in zip(bounds[:-1], bounds[1:]):
            b, e, s = begin[i:j], end[i:j], number[i:j]
            opening = b == first[b]
            ok = opening.copy()
            rest = np.flatnonzero(~opening & (last[b] >= 0))
            ok[rest] = self.stand_together(last[b[rest]], s[rest])
            last[e[ok]], came[e[ok]] = s[ok], b[ok]
        out = []
        last, came = last.tolist(), came.tolist()
        for a, n in zip(start.tolist(), sizes.tolist()):
            symbols, at = [], a + n
            while at > a:
                symbols.append(last[at])
                at = came[at]
            out.append(symbols[::-1])
        return out

    def _ids_of(self, symbols: list[int]) -> bytes:
        n = len(self.pieces)
        if max(symbols) >= n:  # characters without a piece become their bytes
            symbols = [i for s in symbols for i in (
                [s] if s < n else [self.byte_ids[b] for b in chr(s - n).encode("utf-8", "replace")])]
        return struct.pack(f"<{len(symbols)}i", *symbols)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        split = [self.cuts.split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        memory = self.remembered
        new = {p for parts in split for p in set(parts) if p not in memory}
        if len(memory) + len(new) > REMEMBERED:
            memory = self.remembered = {}
            new = {p for parts in split for p in parts}
        chunk, size = [], 0
        for part in sorted(new):  # neighbours share pieces
            chunk.append(part)
            size += len(part) + 1
            if size >= CHUNK:
                memory.update(zip(chunk, map(self._ids_of, self._encode_parts(chunk))))
                chunk, size = [], 0
        if chunk:
            memory.update(zip(chunk, map(self._ids_of, self._encode_parts(chunk))))
        return [b"".join([memory[p] for p in parts]) for parts in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids."""
        raw = b"".join(map(self.raw.__getitem__, struct.unpack(f"<{len(ids) // 4}i", ids)))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(2)
def codec(model: str = MODEL) -> Codec:
    """The codec of a model file (path or public file name), one for each worker."""
    import public_tokenizers

    return Codec(model if "/" in model else public_tokenizers.path(model))


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
           rows: int = 1536) -> DataFrame:
    """``id_col, ids`` (array of int) of each row; no shuffle."""
    import pyarrow as pa

    def run(batch):
        held, texts = codec(model), batch.column(text_col)
        out = []
        for at in range(0, len(texts), rows):
            out += held.encode(texts.slice(at, rows).to_pylist())
        lengths = np.array([len(b) // 4 for b in out], np.int64)
        values = pa.array(np.frombuffer(b"".join(out), "<i4"))
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return {id_col: batch.column(id_col), "ids": pa.ListArray.from_arrays(offsets, values, type=pa.list_(
            pa.field("element", pa.int32())))}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(only(docs, id_col, text_col), f"`{id_col}` {kind}, ids array<int>", run)


def round_trip(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
               rows: int = 1536) -> DataFrame:
    """``id_col, text, n_ids, ids_crc32, decoded``: each text encoded and
    decoded in one pass, with the checksum of its ids (32-bit little-endian)."""
    def run(batch):
        held, texts = codec(model), batch.column(text_col)
        ids = []
        for at in range(0, len(texts), rows):
            ids += held.encode(texts.slice(at, rows).to_pylist())
        return {id_col: batch.column(id_col), "text": texts, "n_ids": [len(b) // 4 for b in ids],
                "ids_crc32": [zlib.crc32(b) for b in ids], "decoded": [held.decode(b) for b in ids]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(only(docs, id_col, text_col), f"`{id_col}` {kind}, text string, n_ids long, ids_crc32 long, decoded string", run)


def decode(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``text`` from ``ids_col`` instead of the ids."""
    def run(batch):
        held = codec(model)
        texts = [held.decode(np.array(v.as_py() or [], "<i4").tobytes()) for v in batch.column(ids_col)]
        return {id_col: batch.column(id_col), "text": texts}

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(only(encoded, id_col, ids_col), f"`{id_col}` {kind}, text string", run)
