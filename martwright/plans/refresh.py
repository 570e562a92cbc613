"""The refresh job: publish the three datasets, then the four marts.

The marts are computed from the *published* datasets, not from the dataset
plans in memory.  That cuts the lineage at a written table on the shared
file system: if executors are lost while the marts run, Spark recomputes from
those files, not from the source scans and joins.  The marts do not read each
other, so their order carries no data; they are written one after another
only to keep the job's resource use flat.
"""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martwright.plans import datasets, marts
from martwright.sinks import publish
from martwright.sources.tables import read_published

DATASETS = ("sales_lines", "catalog", "transactions")
MARTS = ("daily_revenue", "artist_productivity", "artist_revenue", "visit_frequency")


@dataclass(frozen=True)
class Target:
    """Where the job publishes: a folder (one sub-folder per table) or a
    catalog database (one table per name); ``versioned`` for a replace that
    readers never find half done."""

    base_path: str | None = None
    database: str | None = None
    fmt: str = "parquet"
    versioned: bool = False

    def location(self, name: str) -> dict[str, str]:
        if self.database is not None:
            return {"table": f"{self.database}.{name}"}
        if self.base_path is None:
            raise ValueError("Target needs base_path or database")
        return {"path": posixpath.join(self.base_path, name)}


# Intermediate table of the refresh: raw revenue per day and per artist from
# one scan of the line dataset (replaced on every run).
LINE_TOTALS = "sales_line_totals"

# Which published dataset each mart aggregates.
MART_SOURCE = {"daily_revenue": "sales_lines", "artist_productivity": "catalog",
               "artist_revenue": "sales_lines", "visit_frequency": "transactions"}
MART_FUNCTIONS = {"daily_revenue": marts.daily_revenue,
                  "artist_productivity": marts.artist_productivity,
                  "artist_revenue": marts.artist_revenue,
                  "visit_frequency": marts.visit_frequency}


def _dataset_plan(name: str, sales: Mapping[str, DataFrame], catalog: Mapping[str, DataFrame],
                  transactions: Mapping[str, DataFrame], **transaction_kw) -> DataFrame:
    if name == "sales_lines":
        return datasets.sales_lines(sales["artist"], sales["album"], sales["track"],
                                    sales["invoice_line"], sales["invoice"])
    if name == "catalog":
        return datasets.catalog(catalog["artist"], catalog["album"], catalog["track"],
                                catalog["genre"])
    return datasets.transactions(transactions["track"], transactions["invoice_line"],
                                 transactions["invoice"], transactions["customer"],
                                 album=transactions.get("album"), **transaction_kw)


def refresh(spark: SparkSession, sales: Mapping[str, DataFrame],
            catalog: Mapping[str, DataFrame], transactions: Mapping[str, DataFrame],
            target: Target, only: Sequence[str] | None = None, report_order: bool = False,
            **transaction_kw) -> dict[str, str]:
    """Publish datasets, then marts from the published datasets.

    ``only`` limits the run to some of the seven outputs, so each can keep
    its own cadence (the source refreshed transactions every few hours and
    the song catalogue every few days).  A mart refreshed without its dataset
    aggregates the dataset as last published.  Role tables that the chosen
    outputs do not use are never opened when the role mappings are lazy.

    ``report_order`` stores each output sorted as its report is; the files
    then are in this order, one after another.

    With an ``album`` table among its roles (and ``album_id`` in ``track``),
    ``transactions`` repeats lines as the source's album join does; without one
    album ids are taken not to repeat.

    Returns ``{name: path or table}`` for the outputs written.  Each output is
    replaced as a whole or not at all (see ``publish``).
    """
    def arranged(name: str, df: DataFrame) -> DataFrame:
        return marts.ordered(name, df) if report_order else df


    wanted = list(only) if only else [*DATASETS, *MARTS]
    unknown = set(wanted) - set(DATASETS) - set(MARTS)
    if unknown:
        raise ValueError(f"unknown outputs: {sorted(unknown)}")
    written: dict[str, str] = {}
    for name in DATASETS:
        if name in wanted:
            plan = _dataset_plan(name, sales, catalog, transactions, **transaction_kw)
            written[name] = publish(arranged(name, plan), fmt=target.fmt, versioned=target.versioned,
                                    **target.location(name))
    pending = [m for m in MARTS if m in wanted]
    if {"daily_revenue", "artist_revenue"} <= set(pending):
        # Both marts of the line dataset from one scan of it.  The combined
        # per-day / per-artist totals are small; they are written once to
        # the target (a fixed name, replaced on every run) and the two marts
        # are split from that table, so the lines are not scanned twice and
        # the lineage stops at a written table.
        lines = read_published(spark, fmt=target.fmt, **target.location("sales_lines"))
        publish(marts.sales_line_totals(lines), fmt=target.fmt, versioned=target.versioned,
                **target.location(LINE_TOTALS))
        totals = read_published(spark, fmt=target.fmt, **target.location(LINE_TOTALS))
        daily, artist = marts.split_sales_line_totals(totals, report_order)
        written["daily_revenue"] = publish(arranged("daily_revenue", daily), fmt=target.fmt,
                                           versioned=target.versioned, **target.location("daily_revenue"))
        written["artist_revenue"] = publish(artist, fmt=target.fmt,
                                            versioned=target.versioned, **target.location("artist_revenue"))
        pending = [m for m in pending if m not in ("daily_revenue", "artist_revenue")]
    for name in pending:
        stored = read_published(spark, fmt=target.fmt, **target.location(MART_SOURCE[name]))
        if report_order and name == "artist_revenue":  # its order needs the unrounded sum
            mart = marts.ordered_artist_revenue(stored)
        else:
            mart = arranged(name, MART_FUNCTIONS[name](stored))
        written[name] = publish(mart, fmt=target.fmt, versioned=target.versioned, **target.location(name))
    return {n: written[n] for n in [*DATASETS, *MARTS] if n in written}
