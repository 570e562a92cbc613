"""Tables of blocks: their buckets and their clean-up."""

from __future__ import annotations

from fixtures import messy, nothing  # noqa: F401
from pyspark.sql import functions as F

from martwright.llm import blocks, katz, substring_dedup
from martwright.llm.common import workers
from martwright.sinks import scratch


def _block_tables(spark):
    return [t.name for t in spark.catalog.listTables() if "blocks_" in t.name]


def _buckets(spark, table):
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def test_buckets_follow_the_bytes_of_the_texts(spark, messy, nothing, monkeypatch):
    size = messy.agg(F.sum(F.octet_length("text"))).first()[0]
    assert blocks.bucket_count(messy, "text") == blocks.bucket_count(nothing, "text") == workers(spark)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 10_000)
    assert blocks.bucket_count(messy, "text") == -(-size // 10_000) > workers(spark)
    assert blocks.bucket_count(messy.union(messy), "text") == -(-2 * size // 10_000)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 1)
    assert blocks.bucket_count(messy, "text") == 100_000


def test_no_table_is_left_and_results_do_not_depend_on_buckets(spark, messy, monkeypatch):
    def results():
        repeats = substring_dedup.drop_repeats(messy)
        scores = katz.score(messy, F.lit(False))
        made = _block_tables(spark)
        rows = (sorted(repeats.collect(), key=repr), sorted(scores.drop("score", "base_score").collect(), key=repr))
        return rows, sorted(_buckets(spark, t) for t in made)

    scratch.clean(spark)
    plain, few = results()
    scratch.clean(spark)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(blocks, "SIZE", 2_000)
    dealt, many = results()
    assert dealt == plain and len(few) == len(many) == 2
    assert set(few) == {workers(spark)} and min(many) > workers(spark)
    assert scratch.clean(spark) and not _block_tables(spark)
