"""Substring dedup and SimHash groups against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from fixtures import messy, nothing, small  # noqa: F401
from helpers import components, pairs

from martwright.llm import blocks, simhash, substring_dedup
from martwright.llm.components import components as spark_components


# --- substrings -----------------------------------------------------------

def brute_repeats(rows, length):
    first = {}
    key = lambda i: 2 ** 63 - 1 if i is None else i
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - length + 1):
            window = tuple(w[k:k + length])
            first[window] = min(first.get(window, key(i)), key(i))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < key(i):
                gone.update(range(k, k + length))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def got_repeats(df, length=substring_dedup.LENGTH):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text)
                   for r in substring_dedup.drop_repeats(df, length).collect()), key=repr)


@pytest.mark.parametrize("size, shard, hot", [(2_000_000, 8_000, 2_000), (2_000, 50, 3)])
def test_repeats_against_brute_force(spark, monkeypatch, size, shard, hot):
    monkeypatch.setattr(blocks, "SIZE", size)
    monkeypatch.setattr(substring_dedup, "PART_RUNS", shard)
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)
    got = got_repeats(df)
    assert got == brute_repeats(pairs(df), 13)
    assert sum(r[2] for r in got) > 0


def test_repeats_on_awkward_tables(messy, nothing):
    assert got_repeats(messy) == brute_repeats(pairs(messy), 13)
    assert got_repeats(messy, 3) == brute_repeats(pairs(messy), 3)
    assert got_repeats(nothing) == []


def test_automaton_owners():
    rng = random.Random(2)
    for _ in range(150):
        texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 20))] for _ in range(5)]
        ids = rng.sample(range(100), 5)
        automaton = substring_dedup.SuffixAutomaton()
        for words, i in zip(texts, ids):
            automaton.add(words, i)
        automaton.finish()
        probe = [rng.randrange(4) for _ in range(30)]
        for n in (1, 3, 5):
            expected = [min([i for words, i in zip(texts, ids) if any(
                words[a:a + n] == probe[k:k + n] for a in range(len(words) - n + 1))],
                default=substring_dedup.NOBODY) for k in range(30 - n + 1)]
            assert automaton.owners(probe, n) == expected


# --- SimHash --------------------------------------------------------------

def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def near(words, distance=4):
    words = sorted(words)
    return [(a, b) for k, a in enumerate(words) for b in words[:k] if (a ^ b).bit_count() <= distance]


def test_groups_against_brute_force(messy):
    for df in (messy, messy.sparkSession.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        rows = pairs(df)
        fp = {t: brute_fingerprint(t) for _, t in rows}
        group = components(set(fp.values()), near(set(fp.values())))
        least = {}
        for i, t in rows:
            g = group[fp[t]]
            least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
        expected = sorted(((i, fp[t], least[group[fp[t]]]) for i, t in rows), key=repr)
        got = sorted(((r.id, r.fp % 2 ** 64, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
        assert got == expected


def test_one_row_of_each_group_stays(messy, nothing):
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    # one row for each group by brute force (two groups may share their smallest id)
    fps = {brute_fingerprint(t) for _, t in pairs(messy)}
    group = components(fps, near(fps))
    assert sorted(group[brute_fingerprint(t)] for _, t in pairs(kept)) == sorted(set(group.values()))
    assert simhash.keep_first(nothing).count() == simhash.near_duplicates(nothing).count() == 0


def test_each_group_keeps_a_row_whatever_its_ids(spark, messy):
    rows = [(None, f"text number {k} without an id, long enough {k * 7919}") for k in range(30)]
    rows += [(7, f"text number {k} under one id, long enough {k * 7919}") for k in range(30)]
    rows += [(None, rows[0][1]), (8, rows[1][1]), (4, rows[1][1]), (7, rows[40][1]), (2, rows[40][1])]
    shared = spark.createDataFrame([(*r, "a", None) for r in rows] + [(None, rows[0][1], None, "a")],
                                   "doc_id long, text string, fp string, _fp string").repartition(3)
    for df in (shared, messy):
        all_rows = pairs(df)
        fp = {t: brute_fingerprint(t) for _, t in all_rows}
        group = components(set(fp.values()), near(set(fp.values())))
        expected = {}
        for i, t in all_rows:
            expected.setdefault(group[fp[t]], []).append((i is None, i or 0))
        got = [(group[fp[t]], (i is None, i or 0)) for i, t in pairs(simhash.keep_first(df))]
        assert sorted(got) == sorted((g, min(ids)) for g, ids in expected.items())


@pytest.mark.parametrize("bits", [0, 1, 6, 9])
@pytest.mark.parametrize("distance", [0, 2, 4])
def test_ball_hashing_connects_all_near_words(bits, distance):
    rng = random.Random(bits)
    words = {rng.getrandbits(64) for _ in range(30)}
    for w in list(words)[:20]:
        for _ in range(5):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                w ^= 1 << b
            words.add(w)
    fps = np.array(sorted(words), np.uint64)
    radius = distance // 2
    images = np.unique(simhash.slice_of(simhash.error_patterns(radius), bits))
    links = []
    for at in range(1 << bits):
        there = fps[np.isin(simhash.slice_of(fps, bits) ^ np.uint64(at), images)]
        links += [(a % 2 ** 64, b % 2 ** 64) for a, b in
                  simhash.linked_in_slice(there, at, bits, radius, distance).tolist()]
    assert all((a ^ b).bit_count() <= distance for a, b in links)
    assert components(words, links) == components(words, near(words, distance))


def test_slices_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    words = [rng.getrandbits(63) for _ in range(200)]
    words += [w ^ 1 << rng.randrange(63) ^ 1 << rng.randrange(63) for w in words[:60]]
    df = spark.createDataFrame([(w,) for w in set(words)], "fp long")
    found = {}
    for listed in (8_000_000, 1_000):
        monkeypatch.setattr(simhash, "LISTED", listed)
        found[listed] = {(r.low, r.high) for r in simhash.fingerprint_links(df).distinct().collect()}
        assert components(set(words), found[listed]) == components(set(words), near(set(words)))
    with pytest.raises(ValueError):
        simhash.fingerprint_links(df, 3)


def test_components(spark):
    rng = random.Random(6)
    links = {(min(a, b), max(a, b)) for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(220)) if a != b}
    links |= {(1000 + k, 1001 + k) for k in range(40)} | {(2000, 2001 + k) for k in range(500)}
    nodes = {n for link in links for n in link}
    expected = {n: c for n, c in components(nodes, links).items() if n != c}
    got = {r.high: r.low for r in spark_components(spark.createDataFrame(sorted(links), "low long, high long")).collect()}
    assert got == expected
    assert spark_components(spark.createDataFrame([], "low long, high long")).count() == 0
