"""Command-line entry points (for ``spark-submit`` or ``python -m``).

    python -m martwright.jobs refresh --source DIR --target-path DIR
    python -m martwright.jobs refresh --jdbc-url URL --jdbc-props props.json \\
        --partitions 64 --target-database sales
    python -m martwright.jobs stream-daily-revenue --source DIR --landing DIR \\
        [--landing-invoice DIR] [--landing-track DIR] --target-path DIR [--every "3 hours" | --available-now]
    python -m martwright.jobs submit-flags    # --conf flags for spark-submit

``--source`` is a folder with one parquet table per role: ``artist album
track genre invoice_line invoice customer`` (column names as in
FIXTURES.md section 1).  With ``--jdbc-url`` the same tables are read over
JDBC, each split into ``--partitions`` slices on its id column; connection
properties (user, secret, driver) come from a JSON file, never from the
command line.  ``--names`` gives a JSON file for sources with other names:

    {"invoice_line": {"table": "\\"InvoiceLine\\"",
                      "columns": {"invoice_id": "InvoiceId"}}}

A role without an entry keeps its own names, and so does a column.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from martwright.plans.refresh import Target, refresh
from martwright.session import build_session, submit_conf_args
from martwright.sources.jdbc import read_jdbc_table
from martwright.sources.tables import read_parquet_tables

ROLES = ("artist", "album", "track", "genre", "invoice_line", "invoice", "customer")
ROLE_KEYS = {"artist": "artist_id", "album": "album_id", "track": "track_id",
             "genre": "genre_id", "invoice_line": "invoice_line_id",
             "invoice": "invoice_id", "customer": "customer_id"}


def _role_reader(spark: SparkSession, args) -> Callable[[str], DataFrame]:
    """role -> DataFrame, opened on first use (a job opens only what it reads)."""
    names: dict[str, dict] = {}
    if args.names:
        with open(args.names, encoding="utf-8") as fh:
            names = json.load(fh)

    def renamed(r: str, df: DataFrame) -> DataFrame:
        """Source column names to the role's."""
        columns = names.get(r, {}).get("columns", {})
        there = {c.lower(): c for c in df.columns}
        for own, source in columns.items():
            if source.lower() not in there:
                raise ValueError(f"{r}: no column {source}")
            df = df.withColumnRenamed(there[source.lower()], own)
        return df

    def source_column(r: str, own: str) -> str:
        return names.get(r, {}).get("columns", {}).get(own, own)

    if args.jdbc_url:
        props = {}
        if args.jdbc_props:
            with open(args.jdbc_props, encoding="utf-8") as fh:
                props = json.load(fh)
        opened: dict[str, DataFrame] = {}

        def jdbc_role(r: str) -> DataFrame:
            if r not in opened:
                opened[r] = renamed(r, read_jdbc_table(
                    spark, args.jdbc_url, names.get(r, {}).get("table", r), properties=props,
                    partition_column=source_column(r, ROLE_KEYS[r]), num_partitions=args.partitions,
                    balanced=args.balanced))
            return opened[r]
        return jdbc_role
    tables = {r: names.get(r, {}).get("table", r) for r in ROLES}
    opened_tables = read_parquet_tables(spark, args.source, tables.values())
    return lambda r: renamed(r, opened_tables[tables[r]])


class _Roles(Mapping[str, DataFrame]):
    """A lazy view of some roles: a table is opened when a plan asks for it."""

    def __init__(self, role: Callable[[str], DataFrame], names: tuple[str, ...]):
        self._role, self._names = role, names

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._role(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _split(role: Callable[[str], DataFrame], album_ids_unique: bool = False):
    sales = _Roles(role, ("artist", "album", "track", "invoice_line", "invoice"))
    catalog = _Roles(role, ("artist", "album", "track", "genre"))
    transactions = _Roles(role, ("track", "invoice_line", "invoice", "customer",
                                 *([] if album_ids_unique else ["album"])))
    return sales, catalog, transactions


def _target(args) -> Target:
    if args.target_database:
        return Target(database=args.target_database, fmt=args.format, versioned=args.versioned)
    return Target(base_path=args.target_path, fmt=args.format, versioned=args.versioned)


def cmd_refresh(spark: SparkSession, args) -> dict[str, str]:
    sales, catalog, transactions = _split(_role_reader(spark, args), args.album_ids_unique)
    only = [n.strip() for n in args.only.split(",") if n.strip()] if args.only else None
    return refresh(spark, sales, catalog, transactions, _target(args), only=only,
                   report_order=args.report_order)


def cmd_stream_daily_revenue(spark: SparkSession, args):
    from martwright.streaming import start_daily_revenue

    role = _role_reader(spark, args)
    folders = {"invoice_line": args.landing, "invoice": args.landing_invoice, "track": args.landing_track}
    q = start_daily_revenue(spark, lambda name: _role_reader(spark, args)(name),
                            {name: (path, role(name).schema) for name, path in folders.items() if path},
                            target_path=args.target_path,
                            checkpoint_location=args.checkpoint,
                            processing_time=args.every, available_now=args.available_now,
                            max_files_per_trigger=args.max_files_per_trigger)
    q.awaitTermination()
    return q


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="martwright")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def source_args(p):
        p.add_argument("--shuffle-partitions", type=int,
                       help="starting shuffle width, about the largest shuffle / 256 MB")
        p.add_argument("--source", help="folder with one parquet table per role")
        p.add_argument("--jdbc-url", help="read the role tables over JDBC instead")
        p.add_argument("--jdbc-props", help="JSON file with connection properties")
        p.add_argument("--names", help="JSON file with the source's table and column names")
        p.add_argument("--balanced", action="store_true",
                       help="JDBC slices of about equal rows, all up to the same highest id")
        p.add_argument("--partitions", type=int,
                       help="JDBC read slices per table, split on its id column (needed with --jdbc-url)")

    r = sub.add_parser("refresh", help="publish the three datasets and the four marts")
    source_args(r)
    r.add_argument("--target-path", help="folder to publish into (one sub-folder per table)")
    r.add_argument("--target-database", help="catalog database to publish into instead")
    r.add_argument("--format", default="parquet", help="Spark format of the published tables")
    r.add_argument("--report-order", action="store_true",
                   help="store each output in its report order")
    r.add_argument("--versioned", action="store_true",
                   help="keep versions and switch them, so that readers never find a table missing")
    r.add_argument("--album-ids-unique", action="store_true",
                   help="album ids don't repeat: leave out the transactions' album join, which then changes nothing")
    r.add_argument("--only", help="comma list of outputs to refresh, e.g. transactions,"
                                  "visit_frequency (default: all seven)")

    s = sub.add_parser("stream-daily-revenue", help="keep the daily revenue mart current")
    source_args(s)
    s.add_argument("--landing", required=True, help="folder where invoice-line files arrive")
    s.add_argument("--landing-invoice", help="folder where invoice files arrive, if they do")
    s.add_argument("--landing-track", help="folder where track files arrive, if they do")
    s.add_argument("--target-path", required=True, help="folder of the daily revenue mart")
    s.add_argument("--checkpoint", help="defaults to a folder under spark.checkpoint.dir")
    s.add_argument("--every", help='trigger interval, e.g. "3 hours"')
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int,
                   help="cap on new files taken per micro-batch")

    sub.add_parser("submit-flags",
                   help="print the spark-submit --conf flags for cluster runs")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    if args.cmd == "submit-flags":
        return " ".join(submit_conf_args())
    if not args.source and not args.jdbc_url:
        raise SystemExit("give --source or --jdbc-url")
    if args.jdbc_url and not args.partitions:
        raise SystemExit("give --partitions: one connection would read a whole table")
    if args.cmd == "refresh" and not (args.target_path or args.target_database):
        raise SystemExit("give --target-path or --target-database")
    spark = spark or build_session(shuffle_partitions=args.shuffle_partitions)
    if args.cmd == "refresh":
        return cmd_refresh(spark, args)
    return cmd_stream_daily_revenue(spark, args)


def cli() -> int:
    """Console entry point: run and print what was written."""
    print(main(sys.argv[1:]))
    return 0


if __name__ == "__main__":
    sys.exit(cli())
