"""The n-gram Jaccard join against all pairs of sets."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from martwright.llm import jaccard_join

from fixtures import messy, nothing  # noqa: F401
from helpers import components, pairs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words=3):
    parts = (text or "").translate(LOWER).encode().split()
    return frozenset(tuple(parts[k:k + words]) for k in range(max(1, len(parts) - words + 1))) if parts else frozenset()


def brute(rows, words=3, percent=90):
    """(id, size, smallest id of the component) of each row."""
    sets = [shingles(t, words) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    links = []
    for a, b in itertools.combinations(range(len(distinct)), 2):
        x, y = distinct[a], distinct[b]
        if 100 * len(x & y) >= percent * len(x | y):
            links.append((a, b))
    group = components(range(len(distinct)), links)
    place = {s: group[k] for k, s in enumerate(distinct)}
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[place[s]] = min(i, least.get(place[s], i))
    return sorted(((i, len(s), least.get(place[s]) if s else i) for (i, _), s in zip(rows, sets)), key=repr)


def got(df, **options):
    return sorted(((r.id, r.n_shingles, r.component_id) for r in jaccard_join.link_classes(df, **options).collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


@pytest.fixture(scope="module")
def near_copies():
    """Chains and clusters of texts around the threshold, of many sizes."""
    rng = random.Random(3)
    rows, n = [], 0
    for size in (1, 2, 3, 4, 9, 11, 12, 13, 20, 21, 30, 45, 64, 90, 150, 400, 1500):
        for _ in range(3):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for _ in range(6):
                rows.append((n, " ".join(base)))
                n += 1
                base = edited(rng, base, rng.randrange(max(2, size // 40 + 2)))
                if rng.random() < 0.3:
                    base = base + [f"tail{rng.randrange(9)}"] * (1 + size // 100)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [(1, 0), (3, 1), (4, 2)])
def test_against_all_pairs(spark, near_copies, parts):
    df = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(4)
    expected = brute(near_copies)
    assert len({c for _, _, c in expected}) < len(expected) - 50
    assert got(df, parts=parts) == expected


def test_other_settings(spark, near_copies):
    df = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(4)
    assert got(df, words=2, percent=70) == brute(near_copies, 2, 70)
    assert got(df, words=5, percent=100) == brute(near_copies, 5, 100)


def test_messy_and_given_tables(spark, messy, nothing):
    assert jaccard_join.link_classes(nothing).count() == 0
    assert got(messy) == brute(pairs(messy))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(docs) == brute(pairs(docs))


@pytest.mark.parametrize("family_blocks", [0, 2, 100])
def test_a_large_group_in_blocks(spark, monkeypatch, family_blocks):
    """A hub that all share signatures with, but few link to: the leader alone
    decides little, and the open pairs go through blocks."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(edited(rng, base, rng.randrange(1, 4)))) for k in range(150)]
    rows += [(1000 + k, rows[0][1]) for k in range(100)]
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCKS", family_blocks)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_open_texts_are_sent_once_for_each_block(spark):
    """A family of 600 open classes goes to two blocks, so each text to two
    tasks, not to ten and for every signature; long texts make more blocks."""
    shared = spark.sql("SELECT s.id AS sig, 0L AS leader, m.id AS sid FROM range(5) s, range(600) m WHERE m.id != s.id")
    stars = spark.createDataFrame([], "low long, high long")
    for length, blocks in ((40, 2), (20_000, 3)):
        texts = spark.range(600).selectExpr("id AS sid", f"repeat('x', {length}) AS text", f"{length} AS bytes")
        dealt = jaccard_join._open_blocks(shared, texts, stars).collect()
        assert len(dealt) == 600 * blocks and len({(r.kind, r.key) for r in dealt}) == 1
        meet = {}
        for r in dealt:
            assert r.side in (r.low, r.high) and r.low <= r.high < blocks
            meet.setdefault((r.low, r.high), []).append(r.sid)
        assert len(meet) == blocks * (blocks + 1) // 2 and set().union(*meet.values()) == set(range(600))


@pytest.mark.parametrize("same", [True, False])
def test_open_links_of_a_block_connect_what_all_pairs_do(same):
    rng = random.Random(5)
    base, texts = [f"w{k}" for k in range(80)], []
    for _ in range(120):
        texts.append(" ".join(edited(rng, base[:rng.randrange(70, 81)], rng.randrange(5))))
    texts = sorted(set(texts)) + ["one", "one two three four"]
    sids = rng.sample(range(-10 ** 6, 10 ** 6), len(texts))
    rows = pd.DataFrame({"sid": sids, "root": [s // 3 for s in sids], "side": [k % 2 for k in range(len(sids))],
                         "low": 0, "high": 0 if same else 1, "text": texts})
    rows.loc[:20, "root"] = 7
    known = jaccard_join.Shingles(3)
    found = jaccard_join._open_links(pd.concat([rows, rows[:9]]), known, 90)
    sets = [known.of(t) for t in texts]
    side, root = rows["side"].tolist(), rows["root"].tolist()
    links = [(sids[a], sids[b]) for a, b in itertools.combinations(range(len(sids)), 2)
             if (same or side[a] != side[b]) and jaccard_join.similar(sets[a], sets[b], 90)]
    assert all(a < b and ((a, b) in links or (b, a) in links) for a, b in found) and len(found) < len(links)
    tied = [(("root", r), s) for s, r in zip(sids, root)]
    nodes = sids + [("root", r) for r in set(root)]
    place = {n: k for k, n in enumerate(nodes)}
    one, two = (components(range(len(nodes)), [(place[a], place[b]) for a, b in tied + each]) for each in (found, links))
    assert len({(one[k], two[k]) for k in range(len(nodes))}) == len({one[k] for k in range(len(nodes))}) \
        == len({two[k] for k in range(len(nodes))})


@pytest.mark.parametrize("percent", [70, 90, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for parts in ((1, 0), (3, 1)):
        for _ in range(300):
            n = int(rng.integers(2, 400))
            common = rng.integers(0, 2 ** 63, n).astype(np.uint64)
            apart = int(n * (100 - percent) // percent)  # as many as the threshold allows
            left = int(rng.integers(0, apart + 1))
            extra = rng.integers(0, 2 ** 63, apart).astype(np.uint64)
            a, b = np.unique(np.append(common, extra[:left])), np.unique(np.append(common, extra[left:]))
            assert jaccard_join.similar(a, b, percent) == (
                100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)))
            if jaccard_join.similar(a, b, percent) and not np.array_equal(a, b):
                assert len(np.intersect1d(jaccard_join.signatures(a, percent, *parts),
                                          jaccard_join.signatures(b, percent, *parts)))


def test_sizes_lie_in_a_common_band():
    for percent in (50, 90, 99):
        for small in range(1, 400):
            for large in range(small, 100 * small // percent + 1):
                shared = ({b.number for b in jaccard_join.bands_of(small, percent)}
                          & {b.number for b in jaccard_join.bands_of(large, percent)})
                bound = (small + large) * (100 - percent) / (100 + percent)
                assert any(jaccard_join._bands(percent, 1024)[n].k >= int(bound) for n in shared)
