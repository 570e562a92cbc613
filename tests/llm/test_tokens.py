"""Packing, SentencePiece, top-k search and the pipeline."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from fixtures import messy, nothing, small  # noqa: F401
from helpers import pairs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from martwright.llm import packing, sentencepiece_codec, topk
from martwright.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


# --- packing --------------------------------------------------------------

def brute_pieces(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        out += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=repr)


def test_packing_against_the_tokenizer(spark, messy, nothing):
    for df in (messy, spark.read.parquet(f"{SMALL}/documents.parquet")):
        got = packing.pack_documents(df).collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == \
            brute_pieces(pairs(df))
        bins = {}
        for r in got:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 1024
        best = packing.lower_bound([r.length for r in got], 1024)
        assert best <= len(bins) <= best + 2
    assert packing.pack_documents(nothing).count() == 0


def test_tokens_of_odd_white_space():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(8)
    texts = ["", " ", "  ", "a  b", " \n \n b", "a \n b ", "\x1ca\x1d b", "a\xa0 \xa0b", "<|endoftext|> x", "<|endoftext|>", "a<|endoftext|><|endoftext|>  b", "a <|endoftext|>b \n<|endoftext|>", "<|endoftext", "it's 1,000 é　中文"]
    texts += ["".join(rng.choice(" \n\t\r\xa0ab'1.é🤗") for _ in range(rng.randrange(30))) for _ in range(2000)]
    for text in texts:
        got = np.frombuffer(packing.token_bytes(text, "byte_bpe_50k.tiktoken"), "<u4").tolist()
        assert got == t.encode(text, add_special_tokens=False).ids, repr(text)


def fewest(lengths, capacity):
    best = [len(lengths)]
    lengths = sorted(lengths, reverse=True)

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= lengths[k]:
                rest = list(rooms)
                rest.remove(room)
                place(k + 1, [*rest, room - lengths[k]])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


def test_small_groups_are_packed_best():
    rng = random.Random(9)
    for _ in range(300):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 10))]
        bins = packing.pack(lengths, 40)
        assert sorted(n for b in bins for n in b) == sorted(lengths)
        assert all(sum(b) <= 40 for b in bins)
        assert len(bins) == fewest(lengths, 40)
    assert packing.pack([]) == []


def test_the_search_gains_over_best_fit():
    """Large pieces with room for a few: best fit wastes, bin completion less."""
    rng = random.Random(4)
    gained = 0
    for _ in range(6):
        lengths = [rng.randint(200, 700) for _ in range(400)]
        bins = packing.pack(lengths, 1024)
        assert sorted(n for b in bins for n in b) == sorted(lengths) and max(map(sum, bins)) <= 1024
        gained += len(packing.best_fit_decreasing(lengths, 1024)) - len(bins)
    assert gained > 0


def test_every_undominated_filling_comes():
    """No filling is left out while the budget lasts, however many there are."""
    rng = random.Random(5)
    for _ in range(200):
        lengths = [rng.randint(3, 30) for _ in range(12)]
        left = [lengths.count(n) for n in range(61)]
        mask = sum(1 << n for n in set(lengths))
        first = max(lengths)
        got = [tuple(sorted(f)) for f in packing.fillings(left, mask, first, 60, 60, packing.Budget(10 ** 6))]
        assert len(got) == len(set(got))
        rest = list(lengths)
        rest.remove(first)
        least = min(60 - first - sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)
                    if sum(c) <= 60 - first)
        assert min(60 - first - sum(f) for f in got) == least


# --- SentencePiece --------------------------------------------------------

def test_sentencepiece_against_the_library(spark, messy, nothing, small):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    texts = [t for _, t in small] + [t for _, t in pairs(messy)] + ["  x  y ", "aaaa     bbbb", "日本語 🤗🤗", "\n\n\t a"]
    texts += ["".join(rng.choice("aabcdeeinorst   \n.,'1") for _ in range(rng.randrange(60))) for _ in range(2000)]
    codec = sentencepiece_codec.codec()
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == model.encode(text or ""), repr(text)[:80]
        assert codec.decode(ids) == (text or "")
    encoded = sentencepiece_codec.encode(messy)
    got = {(r.doc_id, tuple(r.ids)) for r in encoded.collect()}
    assert got == {(i, tuple(model.encode(t or ""))) for i, t in pairs(messy)}
    back = sentencepiece_codec.decode(encoded)
    assert sorted(map(repr, pairs(back))) == sorted(repr((i, t or "")) for i, t in pairs(messy))
    assert sentencepiece_codec.encode(nothing).count() == sentencepiece_codec.round_trip(nothing).count() == 0


def test_sentencepiece_query(spark):
    got = Q.op5_sentencepiece(spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert got.where("not round_trip").count() == 0


# --- top-k ----------------------------------------------------------------

def brute_top(rows, k, every):
    valid = [(i, np.floor(64 * np.array(v, float)).astype(np.int64)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max(len(v) for _, v in valid)
    valid = [(i, np.append(v, np.zeros(size - len(v), np.int64))) for i, v in valid]
    out = []
    for i, q in {i: v for i, v in valid if i % every == 0}.items():
        best = sorted((-int(q @ v), j) for j, v in valid if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("cell, first, block", [(2048, 4096, 8192), (16, 30, 4)])
def test_top_k_against_brute_force(spark, monkeypatch, cell, first, block):
    for name, value in (("CELL", cell), ("FIRST", first), ("QUERIES", block)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(int(i), (centres[i % 6] * rng.uniform(0.2, 2) + rng.normal(0, 0.05, 8)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(200)]  # a third are one vector
    rows += [(None, [1.0] * 8), (700, None), (701, [1.0, None]), (702, [float("nan")] * 8), (703, []),
             (704, [1.0, 2.0]), (705, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("clash"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, topk.top_k(df, F.col("id") % 5 == 0).collect()))
    assert got == brute_top(rows, 20, 5)
    few = df.where("vec_id < 7")
    assert sorted(map(tuple, topk.top_k(few, F.col("id") % 2 == 0).collect())) == \
        brute_top([r for r in rows if r[0] is not None and r[0] < 7], 20, 2)
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_vectors_go_only_where_they_are_asked_for(spark, monkeypatch):
    """Rows dealt equal those of the (sub-cell, block) pairs that queries ask for."""
    for name, value in (("CELL", 16), ("FIRST", 30), ("QUERIES", 8)):
        monkeypatch.setattr(topk, name, value)
    seen, deal = [], topk.deal
    monkeypatch.setattr(topk, "deal", lambda placed, pairs: seen.append((placed, pairs)) or deal(placed, pairs))
    rng = np.random.default_rng(6)
    rows = [(i, (np.eye(8)[i % 8] * 40 + rng.normal(0, 1, 8)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("id") % 5 == 0).collect()))
    assert got == brute_top(rows, 20, 5)
    for placed, pairs in seen:
        size = {(r.cell, r.part): r["count"] for r in placed.groupBy("cell", "part").count().collect()}
        asked = [tuple(r) for r in pairs.select("cell", "part", "block").collect()]
        assert len(asked) == len(set(asked))
        dealt = deal(placed, pairs)
        assert dealt.count() == sum(size.get(a[:2], 0) for a in asked)
        assert dealt.count() < 0.5 * len(rows) * 20  # all blocks, the former way


def test_vector_bytes():
    for x in ([], [0, -5], [2 ** 15 - 1], [2 ** 15], [-2 ** 40, 3]):
        assert topk.decode(topk.encode(np.array(x, np.int64))).tolist() == x


def test_pruning_skips_far_cells():
    rng = np.random.default_rng(2)
    x = np.concatenate([c + rng.normal(0, 1, (200, 4)) for c in np.eye(4) * 500]).round().astype(np.int64)
    index = topk.Index(4, int((x * x).sum(1).max()), x)
    cell, distance = index.place(x)
    index.hold([(int(c), int((cell == c).sum()), float(distance[cell == c].min()), float(distance[cell == c].max()))
                for c in np.unique(cell)])
    q = x[:1]
    bound, _ = index.bounds(q)
    scores = np.sort(x @ q[0])[-20]
    radius = np.sqrt((q * q).sum() + index.longest - 2 * scores)
    assert 0 < (bound[0] <= radius).sum() < len(index.cell)


# --- pipeline -------------------------------------------------------------

def test_pipeline_stages(spark, messy, nothing, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash", "pii", "packing"]
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), messy, nothing):
        columns = docs.columns
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            if name != "packing":
                assert out.columns == columns
                assert out.count() <= docs.count()
                path = str(tmp_path / f"{docs.count()}-{n}-{len(columns)}-{random.random()}")
                out.write.parquet(path)
                docs = spark.read.parquet(path)
                extra = columns[5:]
                assert not extra or docs.where(" or ".join(f"`{c}` <> 'clash'" for c in extra)).isEmpty()
        assert sorted(out.columns) == sorted(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()), key=repr) == \
            brute_pieces(pairs(docs))


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert 0 < got.select("doc_id").distinct().count() < spark.read.parquet(f"{SMALL}/documents.parquet").count()
