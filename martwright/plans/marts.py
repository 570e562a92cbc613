"""The four summary marts (Q4-Q7) and their report orders.

All marts are hash aggregations over a few group keys.  Spark splits each
into a partial (map-side) and a final aggregate, so even a group that holds a
third of all rows is pre-reduced inside every input task before the shuffle;
only one partial row per group and task crosses the network.

Money is summed without rounding in between (``functions.exact_sum``): the same
rows give the same bits under any partitioning, also through several steps.

The unordered functions are what gets stored: an ``ORDER BY`` in front of a
table write gives no order on read.  The order of each source query is
available as a separate read-side step in :func:`ordered`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.functions.exact_sum import exact_sum, merged_parts, sum_of_parts, sum_parts
from martwright.functions.exprs import day_of, money_round
from martwright.operators.positions import with_positions
from martwright.plans import datasets

_RAW_REVENUE = "_raw_revenue"


def daily_revenue(sales_lines: DataFrame) -> DataFrame:
    """Revenue per calendar day, rounded to 2 places (Q4).

    Grouped by the *day* of the invoice timestamp (the target is a daily
    table); lines without an invoice form one null-day row.
    """
    return (sales_lines
            .groupBy(day_of("invoice_date").alias("invoice_date"))
            .agg(money_round(exact_sum("total_price")).alias("total_revenue")))


def artist_productivity(catalog: DataFrame) -> DataFrame:
    """Songs per (artist name, genre name) (Q5).

    ``count(genre_name)`` skips nulls, so the unknown-genre group of an
    artist is present with a count of 0.
    """
    return (catalog.groupBy("artist_name", "genre_name")
            .agg(F.count("genre_name").alias("counted_songs")))


def _artist_revenue_raw(sales_lines: DataFrame) -> DataFrame:
    return (sales_lines.groupBy("artist_name")
            .agg(exact_sum("total_price").alias(_RAW_REVENUE))
            .transform(_shown_revenue))


def _shown_revenue(raw: DataFrame) -> DataFrame:
    return raw.select("artist_name", money_round(_RAW_REVENUE).alias("total_revenue"), _RAW_REVENUE)


def artist_revenue(sales_lines: DataFrame) -> DataFrame:
    """Revenue per artist *name* (artists sharing a name merge), 2 places (Q6)."""
    return _artist_revenue_raw(sales_lines).drop(_RAW_REVENUE)


_SET = "_grouping_set"


def sales_line_totals(sales_lines: DataFrame) -> DataFrame:
    """Raw revenue per day *and* per artist name from one scan (Q4 + Q6).

    ``GROUPING SETS ((day), (artist_name))``: every line is read once and
    expanded into its two groups inside the scan's own tasks, then partially
    aggregated, so the published line dataset is scanned once for both
    marts.  ``_grouping_set`` tells the sets apart (1: day, 2: artist), so a
    null day or a null artist name stays its own group.  The result is
    small (days plus artists); split it with :func:`split_sales_line_totals`.
    """
    lines = sales_lines.select(day_of("invoice_date").alias("invoice_date"), "artist_name",
                               "total_price")
    return (lines.groupingSets([["invoice_date"], ["artist_name"]],
                               "invoice_date", "artist_name")
            .agg(exact_sum("total_price").alias(_RAW_REVENUE), F.grouping_id().alias(_SET)))


def split_sales_line_totals(totals: DataFrame, ordered_report: bool = False) -> tuple[DataFrame, DataFrame]:
    """(daily_revenue, artist_revenue) from :func:`sales_line_totals`; with
    ``ordered_report`` the artists are in report order."""
    daily = (totals.where(F.col(_SET) == 1)
             .select("invoice_date", money_round(_RAW_REVENUE).alias("total_revenue")))
    artists = totals.where(F.col(_SET) == 2)
    if ordered_report:
        artists = artists.orderBy(F.col(_RAW_REVENUE).desc_nulls_first())
    artist = (artists
              .select("artist_name", money_round(_RAW_REVENUE).alias("total_revenue")))
    return daily, artist


def visit_frequency(transactions: DataFrame) -> DataFrame:
    """Distinct purchase instants per country, countries not null (Q7).

    ``count(distinct invoice_date)`` counts instants: two invoices at one
    timestamp count once, two on one day at different times count twice.
    Spark plans it as an aggregate on (country, invoice_date) followed by one
    on country, so a large country is spread over the date values first.
    """
    return (transactions.where(F.col("country").isNotNull())
            .groupBy("country")
            .agg(F.countDistinct("invoice_date").alias("frequency_level")))


# ---------------------------------------------------------------------------
# The same marts computed straight from the source tables.  The refresh job
# aggregates the published datasets (one scan, no join); these are for
# running a mart without its dataset.  Catalyst neither pushes an aggregate
# below a join nor drops a join it cannot prove key-preserving, so the plans
# are written the way they should run at scale:

def daily_revenue_from_sources(artist: DataFrame, album: DataFrame, track: DataFrame,
                               invoice_line: DataFrame, invoice: DataFrame) -> DataFrame:
    """Q4 from the sources, with line totals pre-aggregated per invoice.

    Lines are summed per invoice before the invoice join, so the join (and
    its shuffle) sees one row per invoice instead of one per line; a hot
    invoice collapses in the map-side partial sum.  Exact for any invoice
    table: each invoice match repeats an invoice's partial sum exactly as it
    would repeat each of its lines.
    """
    per_invoice = (datasets.artist_lines(artist, album, track, invoice_line)
                   .groupBy("invoice_id")
                   .agg(*sum_parts("total_price", "_sum")))
    return (per_invoice
            .join(invoice.select("invoice_id", "invoice_date"), "invoice_id", "left")
            .groupBy(day_of("invoice_date").alias("invoice_date"))
            .agg(*merged_parts("_sum"))
            .select("invoice_date", money_round(sum_of_parts("_sum")).alias("total_revenue")))


def artist_revenue_from_sources(artist: DataFrame, album: DataFrame, track: DataFrame,
                                invoice_line: DataFrame, invoice: DataFrame,
                                invoice_id_is_key: bool = False,
                                ordered_report: bool = False,
                                positions: bool = False) -> DataFrame:
    """Q6 from the sources.

    Lines are summed per (invoice, artist) before the invoice join, so the
    join sees a row for each invoice and artist instead of one for each line.
    Exact for any invoice table: a repeated invoice row repeats the sums as it
    would repeat the lines.

    The join only adds a date that this mart does not use.  A caller who
    knows that invoice ids don't repeat may say so with
    ``invoice_id_is_key``; the join changes no row then and is left out.
    ``ordered_report`` sorts the result, ``positions`` numbers its rows.
    """
    lines = datasets.artist_lines(artist, album, track, invoice_line)
    if invoice_id_is_key:
        raw = _artist_revenue_raw(lines)
    else:
        raw = _shown_revenue(lines.groupBy("invoice_id", "artist_name")
                             .agg(*sum_parts("total_price", "_sum"))
                             .join(invoice.select("invoice_id"), "invoice_id", "left")
                             .groupBy("artist_name").agg(*merged_parts("_sum"))
                             .select("artist_name", sum_of_parts("_sum").alias(_RAW_REVENUE)))
    if positions:
        return _positioned_revenue(raw)
    return _by_revenue(raw) if ordered_report else raw.drop(_RAW_REVENUE)


def artist_productivity_from_sources(artist: DataFrame, album: DataFrame, track: DataFrame,
                                     genre: DataFrame) -> DataFrame:
    """Q5 from the sources, with tracks counted per (album, genre) first.

    Tracks are reduced to one count per (album id, genre id) in the map
    tasks before any join, and to one per (artist name, genre id) before the
    genre join, so the joins see groups, not tracks.  Exact for any dimension tables: a join match repeats a
    group's count exactly as it would repeat each of its tracks.  Unknown or
    null genres keep their group with a count of 0, as ``count(genre_name)``
    does.
    """
    counted = (track.where(F.col("track_id").isNotNull())
               .groupBy("album_id", F.col("genre_id").alias("track_genre_id"))
               .agg(F.count(F.lit(1)).alias("_n")))
    genres = genre.select(F.col("genre_id"), F.col("name").alias("genre_name"))
    joined = (counted
              .join(album.select("album_id", "artist_id"), "album_id")
              .join(artist.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
              .groupBy("artist_name", "track_genre_id").agg(F.sum("_n").alias("_n"))
              .join(genres, F.col("track_genre_id") == F.col("genre_id"), "left"))
    return (joined.groupBy("artist_name", "genre_name")
            .agg(F.sum(F.when(F.col("genre_name").isNotNull(), F.col("_n"))
                       .otherwise(F.lit(0))).alias("counted_songs")))


def visit_frequency_from_sources(track: DataFrame, invoice_line: DataFrame,
                                 invoice: DataFrame, customer: DataFrame) -> DataFrame:
    """Q7 from the sources, with the lines reduced to distinct invoices first.

    A count of distinct instants does not depend on how many lines an invoice
    has, so the lines are cut to their distinct invoice ids (partial
    aggregation in every map task) before meeting the invoices: the invoice
    join shuffles one row per invoice instead of one per line.
    """
    return (visits_from_sources(track, invoice_line, invoice, customer)
            .groupBy("country")
            .agg(F.countDistinct("invoice_date").alias("frequency_level")))


def visits_from_sources(track: DataFrame, invoice_line: DataFrame, invoice: DataFrame,
                        customer: DataFrame) -> DataFrame:
    """``country, invoice_date`` of the invoices that have lines, countries not null."""
    invoices_with_lines = datasets.track_lines(track, invoice_line).select("invoice_id").distinct()
    invoices = datasets.customer_invoices(invoice, customer).select(
        "invoice_id", "country", "invoice_date")
    return (invoices_with_lines.join(invoices, "invoice_id")
            .where(F.col("country").isNotNull()).select("country", "invoice_date"))


def daily_totals(df: DataFrame, ts_col: str, value_col: str,
                 out_value: str = "total_value") -> DataFrame:
    """Any timestamped table summed per day (P8 + A2 on a generic table)."""
    return (df.groupBy(F.date_trunc("day", F.col(ts_col)).cast("date").alias("day"))
            .agg(money_round(exact_sum(value_col)).alias(out_value)))


# ---------------------------------------------------------------------------
# Report orders.  Null placement: the three extracts sort nulls last (their
# source database does), the marts sort nulls first (their warehouse does).

# The keys of each report: column, ascending or not, nulls first or not.
_REPORT_KEYS = {
    # the source leaves ties open; with more keys the range boundaries can
    # split the rows of one artist (or customer) over many tasks
    "sales_lines": [(k, True, False) for k in ("artist_id", "invoice_id", "invoice_line_id", "track_id")],
    "catalog": [("artist_id", True, False), ("track_id", True, False)],
    "transactions": [(k, True, False) for k in ("customer_id", "invoice_id", "track_id")],
    "daily_revenue": [("invoice_date", True, True)],
    "artist_productivity": [("genre_name", True, True), ("counted_songs", False, True)],
    "artist_revenue": [(_RAW_REVENUE, False, True)],
    "visit_frequency": [("frequency_level", False, True), ("country", True, True)],
}


def _sort_column(name: str, ascending: bool, nulls_first: bool):
    c = F.col(name)
    if ascending:
        return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()


def ordered(name: str, df: DataFrame) -> DataFrame:
    """Apply the source query's ORDER BY to a dataset or mart by name."""
    if name == "artist_revenue" or name not in _REPORT_KEYS:
        raise KeyError(f"no report order for {name!r}; artist_revenue uses ordered_artist_revenue")
    return df.orderBy(*[_sort_column(*k) for k in _REPORT_KEYS[name]])


def positioned(name: str, df: DataFrame) -> DataFrame:
    """A dataset or mart with its report order as the column ``position``.

    The order is the source query's; ties that it leaves open go by the
    remaining columns, ascending with nulls last, so that the positions of
    different rows are fixed.  ``artist_revenue`` takes the sales lines, as
    its order is that of a sum it doesn't show.
    """
    if name == "artist_revenue":
        return _positioned_revenue(_artist_revenue_raw(df))
    return _positioned(name, df)


def _positioned(name: str, df: DataFrame) -> DataFrame:
    keys = _REPORT_KEYS[name]
    rest = [(c, True, False) for c in df.columns if c not in {k for k, *_ in keys}]
    return with_positions(df, *[_sort_column(*k) for k in keys + rest])


def _positioned_revenue(raw: DataFrame) -> DataFrame:
    return _positioned("artist_revenue", raw).drop(_RAW_REVENUE)


def _by_revenue(raw: DataFrame) -> DataFrame:
    return raw.orderBy(F.col(_RAW_REVENUE).desc_nulls_first()).drop(_RAW_REVENUE)


def ordered_artist_revenue(sales_lines: DataFrame) -> DataFrame:
    """Artist revenue ordered by the *unrounded* sum, descending."""
    return _by_revenue(_artist_revenue_raw(sales_lines))
