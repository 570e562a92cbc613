"""Katz model, quality trees, toxicity machine."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest
from fixtures import messy, nothing, small  # noqa: F401
from helpers import pairs
from pyspark.sql import functions as F

from martwright.llm import blocks, katz, quality, toxicity
from martwright.llm import queries as Q
from martwright.llm.common import labelled_sample

SMALL = "/root/testdata/sf0.001"
START, END = "<start>", "<end>"


def brute_katz(rows, held):
    """(doc_id, n_tokens, n_known, N, base, score) by plain dictionaries."""
    texts = [(i, [*(w.decode() for w in (t or "").encode().lower().split()), END]) for i, t in rows]
    one, two, history = collections.Counter(), collections.Counter(), collections.Counter()
    for (_, words), h in zip(texts, held):
        if not h:
            before = [START, *words[:-1]]
            one.update(words)
            two.update(zip(before, words))
            history.update(before)
    total, types = sum(one.values()), len(one)

    def counts(c):
        of = collections.Counter(c.values())
        return [of[r] for r in range(1, katz.K + 2)]

    d1, d2 = katz.discounts(counts(one)), katz.discounts(counts(two))

    def cut(r, d):
        return r * (d[r] if r < len(d) else 1)

    kept = sum(cut(r, d1) for r in one.values())
    norm = total + (total - kept <= 1e-9 * max(1, total))
    unknown = 1 - kept / norm
    mass, low = collections.Counter(), collections.Counter()

    def p1(w):
        return cut(one[w], d1) / norm if one[w] else unknown

    for (v, w), r in two.items():
        mass[v] += cut(r, d2)
        low[v] += p1(w)

    def p2(v, w):
        if not history[v]:
            return p1(w)
        n = history[v] + (history[v] - mass[v] <= 1e-9 * history[v])
        r = two[v, w]
        return cut(r, d2) / n if r else (1 - mass[v] / n) / (1 - low[v]) * p1(w)

    for v in list(history)[:30]:  # exactly normalised over the words and the unknown type
        assert sum(p2(v, w) for w in one) + p2(v, "\x01never") == pytest.approx(1, abs=1e-9)
    return [(i, len(ws), sum(one[w] > 0 for w in ws), total,
             sum(math.log10((one[w] + 1) / (total + types + 1)) for w in ws),
             sum(math.log10(p2(v, w)) for v, w in zip([START, *ws[:-1]], ws))) for i, ws in texts]


def same_rows(got, expected):
    got, expected = (sorted(x, key=lambda r: (str(r[0]), r[1:3], round(r[4], 6), round(r[5], 6))) for x in (got, expected))
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for g, e in zip(got, expected):
        assert np.allclose(g[4:], e[4:], rtol=1e-9), (g, e)


@pytest.mark.parametrize("size", [3_000, 4_000_000])
def test_katz_query_against_brute_force(spark, small, monkeypatch, size):
    monkeypatch.setattr(blocks, "SIZE", size)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in small]
    got = Q.op2_katz(spark, SMALL).collect()
    assert {r.doc_id for r in got if r.held_out} == {i for (i, _), h in zip(small, held) if h}
    same_rows([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got],
              brute_katz(small, held))


def test_katz_on_awkward_tables(messy, nothing):
    got = katz.score(messy, F.lit(False)).collect()
    rows = pairs(messy)
    same_rows([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got],
              brute_katz(rows, [False] * len(rows)))
    assert katz.score(nothing, F.lit(False)).count() == 0
    untrained = katz.score(messy.limit(4), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in untrained)


# --- quality --------------------------------------------------------------

def brute_counts(text):
    ws = " \t\n\x0b\x0c\r"
    words = [w.decode() for w in (text or "").encode().split()]
    seen, copied = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(ws):
            copied += line in seen
            seen.add(line)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered |= {k, k + 1, k + 2}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), copied, len(covered)]


def test_quality_counts_against_brute_force(small, messy):
    for _, text in [*small, *pairs(messy), (0, "a b c a b c"), (0, "a a a a"), (0, "a b a b a")]:
        assert quality.statistics(text)[0] == brute_counts(text)


def test_quality_verdicts(spark, messy, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    train = labels.where("doc_id % 5 <> 0")
    trees = quality.train(docs, train)
    held = quality.judge(docs, trees).join(labels.where("doc_id % 5 = 0"), "doc_id").where("not base_failed")
    r = held.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()
    assert r[0] > 0.98
    judged = quality.judge(messy, trees)
    assert judged.count() == messy.count()
    assert judged.where("kept and (n_words < 50 or 100 * n_repeat_words > 50 * n_words)").count() == 0
    assert quality.judge(nothing, trees).count() == 0
    empty = quality.train(docs, labels.limit(0))
    assert quality.judge(messy, empty).where("kept = base_failed").count() == 0


def test_trees_are_monotone():
    rng = np.random.default_rng(3)
    rows = rng.random((3000, 3))
    labels = ((rows[:, 0] + 0.3 * np.sin(20 * rows[:, 1]) + rng.normal(0, 0.2, 3000)) < 0.6).astype(float)
    trees = quality.fit(rows, labels, ("a", "b", "c"), {"a": -1, "b": 1})
    probe = np.repeat(rng.random((200, 1, 3)), 50, 1)
    for j, sign in ((0, -1), (1, 1)):
        p = probe.copy()
        p[:, :, j] = np.linspace(0, 1, 50)
        s = trees.score(p.reshape(-1, 3)).reshape(200, 50)
        assert (np.diff(s, axis=1) * sign >= -1e-12).all()
    assert np.mean((trees.score(rows) > 0.5) == labels) > 0.75


def test_flattened_trees_against_a_recursive_walk(spark, small):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.train(docs, labels)
    assert len(trees.roots) > 10

    def walk(node, row):
        if trees.left[node] == node == trees.right[node]:
            return trees.value[node]
        side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
        return walk(side[node], row)

    verdicts = {(r.doc_id, r.n_words): r.kept for r in quality.judge(
        spark.createDataFrame(small, "doc_id long, text string"), trees).collect()}
    for i, text in small:
        counts, row = quality.statistics(text)
        p = 1 / (1 + math.exp(-(trees.start + sum(walk(r, row) for r in trees.roots))))
        assert trees.score(np.array([row], float))[0] == pytest.approx(p, abs=1e-9)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert verdicts[i, counts[0]] == (not failed and p >= quality.KEEP)


# --- toxicity -------------------------------------------------------------

def test_scores_against_all_pairs(messy):
    """The score by an explicit loop over the pairs of a text's terms."""
    rng = np.random.default_rng(9)
    fm = toxicity.FactorizationMachine(-1.5)
    some = rng.random(1 << toxicity.BITS) < 0.3
    fm.w[some] = rng.normal(0, 0.3, int(some.sum()))
    fm.v[some] = rng.normal(0, 0.2, (int(some.sum()), toxicity.FACTORS))
    scores = {(r.doc_id, r.text): r.score for r in messy.select("doc_id", "text").join(
        toxicity.score_toxicity(messy.select("doc_id", "text").where("doc_id is not null"), fm), "doc_id").collect()}
    for i, text in pairs(messy):
        slots = toxicity.term_slots(text).tolist()
        assert slots == sorted(set(slots))
        logit = fm.w0 + sum(float(fm.w[a]) for a in slots)
        for n, a in enumerate(slots):
            for b in slots[:n]:
                logit += sum(float(x) * float(y) for x, y in zip(fm.v[a], fm.v[b]))
        p = 1 / (1 + math.exp(-min(30, max(-30, logit))))
        assert fm.text_score(text) == pytest.approx(p, rel=1e-6, abs=1e-9)
        if i is not None and [x for x, _ in pairs(messy)].count(i) == 1:
            assert scores[i, text] == pytest.approx(p, rel=1e-6, abs=1e-9)



def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = Q.op6_toxicity(spark, d)
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
    r = (got.where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
         .groupBy("toxic").agg(F.avg("predicted").alias("p")).collect())
    rate = {x.toxic: x.p for x in r}
    assert rate[1] > 0.7 and rate[0] < 0.01  # a tenth of the toxic labels here are on texts without a trace of it


def test_pairs_count_beyond_single_terms():
    """An insult alone or a group alone is fine; both together are not."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array([1] * int(a) + [2] * int(b) + [10 + int(x) for x in rng.integers(0, 50, 5)]))
        labels.append(float(a and b))
    rows = [np.unique(r).astype(np.int64) for r in rows]
    fm = toxicity.fit(rows, np.array(labels), epochs=40)
    score = lambda *s: fm.score(np.array(s, np.int64))
    assert score(1, 2) > 0.7 > 0.3 > max(score(1), score(2), score())
    assert abs(float(fm.v[1] @ fm.v[2])) > 0.1


def test_pairs_with_a_term_that_is_neutral_alone():
    """Term 2 turns 1 from clean to toxic and 3 from toxic to clean, and says nothing by itself."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.unique([1 if a else 3] + [2] * int(b) + [10 + int(x) for x in rng.integers(0, 50, 5)]).astype(np.int64))
        labels.append(float(a == b))
    assert abs(np.mean([y for r, y in zip(rows, labels) if 2 in r]) - np.mean(labels)) < 0.03
    fm = toxicity.fit(rows, np.array(labels), epochs=40)
    score = lambda *s: fm.score(np.array(s, np.int64))
    assert min(score(1, 2), score(3)) > 0.7 > 0.3 > max(score(1), score(2, 3))


def test_labelled_sample_has_a_row_for_each_id(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, f"copy {k}") for k in range(200)] + [(None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = [sorted(map(tuple, labelled_sample(d, labels, "toxic", 40).collect())) for d in (docs, docs.repartition(5))]
    assert got[0] == got[1]
    assert [(i, label) for i, _, label in got[0]] == [(i, i % 2) for i in range(40)]
    assert set((i, t) for i, t, _ in got[0]) <= set(rows)


def test_toxicity_on_awkward_tables(spark, messy, nothing):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    fm = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(messy, fm)
    assert scored.count() == messy.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    clean = toxicity.keep_clean(messy, fm)
    assert clean.columns == messy.columns
    assert clean.count() == scored.where("score < 0.7").count()
    assert toxicity.score_toxicity(nothing, fm).count() == toxicity.keep_clean(nothing, fm).count() == 0
    untaught = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_toxicity(messy, untaught).where("score <> 0.5").count() == 0
