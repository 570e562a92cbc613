"""Importance resampling against plain sums and a plain sort."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martwright.llm import resampling

from fixtures import messy, nothing, small  # noqa: F401
from helpers import pairs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, run=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[k:k + n]) for n in range(1, run + 1) for k in range(len(words) - n + 1)]


def brute(rows, target, buckets=10_000, run=1, seed=2024, least=20, percent=10):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    source = Counter(bucket(f) for _, t in rows for f in features(t, run)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t, run)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        n, found = features(text, run)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_brute_force(spark, messy, small):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    wanted = [r.text for r in target.collect()]
    assert got(resampling.resample(messy, target)) == brute(pairs(messy), wanted)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(resampling.resample(docs, target)) == brute(small, wanted)
    assert got(resampling.resample(docs, target, buckets=77, run=3, seed=5, least_words=100, percent=35)) == brute(
        small, wanted, 77, 3, 5, 100, 35)


def test_nothing(spark, messy, nothing):
    target = spark.createDataFrame([(None,), ("",)], "text string")
    assert resampling.resample(nothing, target).count() == 0
    assert got(resampling.resample(messy, target)) == brute(pairs(messy), [])


@pytest.mark.parametrize("buckets", [1, 63, 64, 200])
def test_bit_slices_give_the_exact_sum(buckets):
    rng = np.random.default_rng(buckets)
    gain = rng.integers(-20_000, 20_000, buckets)
    counts = np.where(rng.random((30, buckets)) < 0.3, rng.integers(0, 9, (30, buckets)), 0)
    counts[0, 0], counts[1] = 123_456_789, 0
    assert resampling.GainPlanes(gain).weights(counts).tolist() == (counts @ gain).tolist()
    assert resampling.GainPlanes(np.zeros(buckets, np.int64)).weights(counts).tolist() == [0] * 30


def test_a_hot_id_and_equal_scores(spark):
    text = "alpha beta gamma delta " * 6
    rows = [(7, text)] * 50 + [(k, text) for k in range(20)] + [(None, text)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("alpha alpha",)], "text string")
    found = resampling.resample(df, target, percent=40)
    assert got(found) == brute(rows, ["alpha alpha"], percent=40)
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == list(range(1, 31))
