"""Fill-in-middle against plain string slicing, and restoring from outputs."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from fixtures import messy, nothing  # noqa: F401
from martwright.llm import fim


def brute(doc_id, text, seed=1, plain_from=90, spm_below=20):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= plain_from:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_against_slicing(spark, messy):
    marked = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(["holds <P> itself", "<S>", "<P", "P><S", "<M><M>", "<" * 50, "é", "🤗<M"], 500)],
        "doc_id long, text string, lang string, source string, n_chars int")
    for df in (messy.select(marked.columns).union(marked), spark.read.parquet("/root/testdata/sf0.001/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        made = fim.fill_in_middle(df)
        got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=repr)
        assert got == sorted(((i, *brute(i, t)) for i, t in rows), key=repr)
        assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in made.collect())
        back = fim.restore(made, "doc_id").collect()
        assert sorted((repr(r.doc_id), r.restored) for r in back) == sorted((repr(i), t or "") for i, t in rows)
        assert all(r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest() for r in back)


def test_settings_reach_the_cuts(spark):
    df = spark.createDataFrame([(k, f"text {k} of some length") for k in range(200)], "doc_id long, text string")
    forms = {r.form for r in fim.fill_in_middle(df, plain_from=0).collect()}
    assert forms == {"plain"}
    made = fim.fill_in_middle(df, seed=7, plain_from=100, spm_below=100).collect()
    assert [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made] == [
        (k, *brute(k, f"text {k} of some length", 7, 100, 100)) for k in range(200)]


def test_empty_table_and_null_outputs(spark, nothing):
    made = fim.fill_in_middle(nothing)
    assert made.count() == fim.restore(made).count() == 0
    df = spark.createDataFrame([(1, None, "psm"), (2, "x", None), (3, "x", "plain")], "k int, output string, form string")
    assert [tuple(r) for r in fim.restore(df, "k").collect()] == [
        (1, None, None), (2, None, None), (3, "x", hashlib.sha256(b"x").hexdigest())]


TEXT = st.text(st.sampled_from("<>PSMaé🤗\n "), max_size=30)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(0, 10 ** 6))
def test_pieces_round_trip(text, doc_id):
    data = memoryview(text.encode())
    whole, buffers = fim.Piece(fim.TEXT, 0, len(data)), (data, memoryview(fim.SENTINELS))
    pieces, n, form, _, _ = fim.transform(doc_id, whole, buffers)
    output = b"".join(fim.stream(pieces, buffers))
    assert (n, form, output.decode()) == (lambda b: (b[0], b[1], b[4]))(brute(doc_id, text))
    if form != "plain":
        assert b"".join(fim.stream(fim.inverse(pieces, form), buffers)) == bytes(data)
        split = fim.split_output(memoryview(output), form)
        assert b"".join(fim.stream(fim.inverse(split, form), (memoryview(output),))) == bytes(data)


def test_cut_splits_descriptors():
    pieces = [fim.Piece(0, 2, 5), fim.Piece(1, 0, 3)]
    assert fim.cut(pieces, 0) == [fim.Piece(0, 2, 2), *[fim.Piece(0, 2, 5), fim.Piece(1, 0, 3)]]
    assert fim.cut(pieces, 4) == [fim.Piece(0, 2, 5), fim.Piece(1, 0, 1), fim.Piece(1, 1, 3)]
    with pytest.raises(IndexError):
        fim.cut(pieces, 7)
    with pytest.raises(ValueError):
        fim.split_output(memoryview(b"<P>a<M>b"), "psm")


def test_slices_of_output_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(k, "word " * 2000) for k in range(40)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(fim, "SLICE", 30_000)
    assert fim.fill_in_middle(df).count() == 40
