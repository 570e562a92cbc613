"""Queries with an SQL form against DuckDB; all against the contract's columns."""

from __future__ import annotations

import random

import duckdb
import pytest

from martwright.llm import queries as Q
from scripts.oracle_check import _digest, _duck_rows, _spark_rows

SMALL = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                "base_sha256": "string", "spans": "string"},
    "op2_katz": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                 "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op3_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                    "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op8_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                    "sequence_id": "bigint", "offset": "bigint"},
    "op10_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op11_resampling": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    "op12_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op13_fim": {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint",
                 "output_sha256": "string", "restored_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    scols, srows = _spark_rows(Q.QUERIES[name](spark, SMALL))
    dcols, drows = _duck_rows(con, Q.ORACLE[name])
    assert scols == dcols
    assert len(srows) == len(drows) > 0
    assert _digest(srows, None) == _digest(drows, None)


def test_pii_sql_states_the_same_rules(spark, scratch):
    """Context past other matches, IBANs before capitals, a text of numbers alone."""
    rng = random.Random(6)
    texts = ["Call (784) 555-9263 or (784) 555-9264.", "DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89 3704 0044 0532 0130 00 Please",
             "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32", "XDE89370400440532013000 DE89370400440532013000x",
             None, "", " ".join(str(k) for k in range(10, 20_000)), "call " + "784 555 9263, " * 50]
    words = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "SSN", "219-09-9999", "call", "784 555 9263", "A1", "ok", "B",
             "+1 784 555 9263", "4111 1111 1111 1111", "1.2.3.4", "x@y.z", "-", "9", ",", "é"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    _, srows = _spark_rows(Q.op1_pii(spark, scratch))
    _, drows = _duck_rows(con, Q.ORACLE["op1_pii"])
    assert sorted(map(str, srows)) == sorted(map(str, drows))
    assert sum("iban" in str(r) for r in srows) > 50 and sum("local_phone" in str(r) for r in srows) > 20


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    got = dict(Q.QUERIES[name](spark, SMALL).dtypes)
    assert {k: got.get(k) for k in COLUMNS[name]} == COLUMNS[name]


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))
