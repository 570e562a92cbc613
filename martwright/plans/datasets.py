"""The three wide datasets (Q1-Q3).

Each source query is a chain of left joins followed by a not-null filter on a
key of a middle table.  That filter rejects every row in which the chain up to
that table did not match, so those joins are inner joins; only the tail after
the filtered table stays optional.  Writing the inner joins ourselves (rather
than hoping ``EliminateOuterJoin`` catches all of them) lets Catalyst push the
key filters into the scans and reorder freely.

Join shape at scale (a star join): the large line table is joined to one
*base* dimension at a time (track, then album, then artist).  Each
dimension is then a plain scan whose size estimate comes from its files, so
Spark's ``autoBroadcastJoinThreshold`` check broadcasts it only when it really
is small and plans a sort-merge join (AQE splitting skewed keys) when it is
not.  Pre-joining the dimensions would hide their size: without CBO a join's
estimate is the product of its inputs, so the chain would never be broadcast
up front and the fact table would be shuffled before AQE saw the real size.
The optional invoice (and customer) tail is joined last, on the invoice key;
there AQE splits a hot partition by its bytes, and ``salted=True`` spreads heavy
invoices by their row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.functions.exprs import full_name, line_total, repair_text
from martwright.operators.multiplicity import repeated, with_matches
from martwright.operators.skew import salted_join
from martwright.plans.schemas import CATALOG, SALES_LINES, TRANSACTIONS, conform

# The replacement character and the letters that replace it in
# the last name and in the address.
REPLACEMENT_CHAR = "\ufffd"  # U+FFFD
LAST_NAME_REPAIR = (REPLACEMENT_CHAR, "o")
ADDRESS_REPAIR = (REPLACEMENT_CHAR, "d")


def artist_lines(artist: DataFrame, album: DataFrame, track: DataFrame,
                 invoice_line: DataFrame) -> DataFrame:
    """Lines whose track -> album -> artist chain exists and whose invoice key
    is not null, with artist, album and song names and the line total.

    The inner part of Q1, shared by :func:`sales_lines` and the source-level
    marts.
    """
    lines = invoice_line.where(F.col("invoice_id").isNotNull())
    return (
        lines
        .join(track.select("track_id", "album_id", F.col("name").alias("song_title")),
              "track_id")
        .join(album.select("album_id", "artist_id", F.col("title").alias("album_title")),
              "album_id")
        .join(artist.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .withColumn("total_price", line_total("quantity", "unit_price"))
    )


def _line_join(lines: DataFrame, invoices: DataFrame, salted: bool) -> DataFrame:
    """The optional invoice tail of the lines."""
    if salted:
        return salted_join(lines, invoices, "invoice_id", "left")
    return lines.join(invoices, "invoice_id", "left")


def sales_lines(artist: DataFrame, album: DataFrame, track: DataFrame,
                invoice_line: DataFrame, invoice: DataFrame, salted: bool = False) -> DataFrame:
    """Invoice lines with artist, album and song, plus the line total (Q1).

    A line is kept when its track, the track's album and the album's artist
    all exist and its invoice key is not null; the invoice itself is
    optional (a missing invoice gives a null date).  ``salted`` spreads the
    lines of invoices that have a large share of them (see ``operators.skew``).
    """
    joined = _line_join(artist_lines(artist, album, track, invoice_line),
                        invoice.select("invoice_id", "invoice_date"), salted)
    out = joined.select(
        "artist_id", "track_id", "invoice_line_id", "invoice_id",
        "artist_name", "album_title", "song_title", "total_price", "invoice_date")
    return conform(out, SALES_LINES)


def catalog(artist: DataFrame, album: DataFrame, track: DataFrame,
            genre: DataFrame) -> DataFrame:
    """Song catalogue with genre (Q2).

    A track is kept when its album and the album's artist exist; the genre is
    optional, and ``genre_id`` comes from the genre table, so it is null when
    the track's genre is unknown.
    """
    tracks = track.where(F.col("track_id").isNotNull()).select(
        "track_id", "album_id", F.col("genre_id").alias("track_genre_id"),
        F.col("name").alias("song_title"), "unit_price", "bytes")
    genres = genre.select(F.col("genre_id"), F.col("name").alias("genre_name"))
    joined = (
        tracks
        .join(album.select("album_id", "artist_id", F.col("title").alias("album_title")),
              "album_id")
        .join(artist.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .join(genres, F.col("track_genre_id") == F.col("genre_id"), "left")
    )
    out = joined.select(
        "artist_id", "album_id", "track_id", "genre_id",
        "artist_name", "album_title", "song_title", "genre_name",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("bytes").cast("bigint").alias("bytes"))
    return conform(out, CATALOG)


def transactions(track: DataFrame, invoice_line: DataFrame, invoice: DataFrame,
                 customer: DataFrame,
                 last_name_repair: tuple[str, str] = LAST_NAME_REPAIR,
                 address_repair: tuple[str, str] = ADDRESS_REPAIR,
                 album: DataFrame | None = None, salted: bool = False) -> DataFrame:
    """Customer transactions at line grain with cleaned names (Q3).

    A line is kept when its track exists and its invoice key is not null;
    the invoice and the invoice's customer are optional.

    The source query also joins ``album`` and uses none of its columns: a line
    is repeated for each album row with its track's album id.  With ``album``
    given (and ``album_id`` in ``track``) that is done exactly, by counting the
    album rows of each id; the counts meet the tracks and the lines are repeated
    last, after all shuffles.  Leaving ``album`` out says that album ids don't
    repeat, so that the join would change no row.

    ``invoice (+) customer`` is built first at invoice grain and then joined
    to the lines, which is the same result as the source's chain
    ``lines (+) invoice (+) customer`` (the customer key comes from the
    invoice) but shuffles the large line side once instead of twice.

    ``total`` is the invoice amount repeated on each of its lines; summing it
    over lines over-counts.
    """
    invoices = customer_invoices(invoice, customer, last_name_repair, address_repair)
    if album is not None:
        track = with_matches(track, "album_id", album, "album_id")
    joined = _line_join(track_lines(track, invoice_line), invoices, salted)
    if album is not None:
        joined = repeated(joined)
    out = joined.select(
        F.col("customer_id_out").alias("customer_id"), "track_id", "invoice_id",
        "full_name", "address", "city", "state", "country", "postal_code", "email",
        "total", "invoice_date")
    return conform(out, TRANSACTIONS)


def track_lines(track: DataFrame, invoice_line: DataFrame) -> DataFrame:
    """(invoice_id, track_id) of lines whose track exists and whose invoice
    key is not null: the inner part of Q3 (with the tracks' number of album
    matches where they have it)."""
    return (invoice_line.where(F.col("invoice_id").isNotNull())
            .select("invoice_id", "track_id")
            .join(track.select("track_id", *[c for c in track.columns if c == "_matches"]), "track_id"))


def customer_invoices(invoice: DataFrame, customer: DataFrame,
                      last_name_repair: tuple[str, str] = LAST_NAME_REPAIR,
                      address_repair: tuple[str, str] = ADDRESS_REPAIR) -> DataFrame:
    """Invoices with their (optional) customer, at invoice grain: the tail of Q3.

    ``customer_id_out`` is the customer table's id (null when the customer is
    missing); the invoice's own customer key is not kept.
    """
    customers = customer.select(
        F.col("customer_id").alias("cust_key"),
        F.col("customer_id").alias("customer_id_out"),
        full_name("first_name", repair_text("last_name", *last_name_repair)).alias("full_name"),
        repair_text("address", *address_repair).alias("address"),
        "city", "state", "country", "postal_code", "email")
    return (
        invoice.select("invoice_id", F.col("customer_id").alias("cust_key"),
                       F.col("total").cast("double").alias("total"), "invoice_date")
        .join(customers, "cust_key", "left")
        .drop("cust_key")
    )
