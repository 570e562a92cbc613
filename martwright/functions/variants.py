"""Lists of mixed types and records with free fields, as VARIANT.

A Spark array has one element type and a struct fixed fields.  A list such as
``[1, "a", True, None]`` is an array of variants: each element keeps its own type
and is read back by index with the type wanted.  A record with whatever fields
its writer gave is one variant object, read by field name.  Both are evaluated
inside the JVM; reading a value as a type it can't become gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martwright.functions.collections import list_get


def mixed_list(*items: Column | str) -> Column:
    """A list of the items, each with its own type (null stays null)."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("variant") for c in items])


def mixed_get(a: Column | str, index: int, kind: str) -> Column:
    """The element at ``index`` (from the back if negative) as ``kind``; null
    past the ends or if it is no such value."""
    return F.try_variant_get(list_get(a, index), "$", kind)


def mixed_type(a: Column | str, index: int) -> Column:
    """The type of the element at ``index``, null past the ends or for null."""
    return F.schema_of_variant(list_get(a, index))


def free_record(**fields: Column) -> Column:
    """A record of the given fields as one variant; null fields are left out."""
    kept = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in fields]),
                                          F.array(*[c.cast("variant") for c in fields.values()])),
                        lambda k, v: v.isNotNull())
    return F.to_variant_object(kept)


def field(record: Column | str, name: str, kind: str) -> Column:
    """A field of a free record as ``kind``, null if it hasn't got it."""
    return F.try_variant_get(F.col(record) if isinstance(record, str) else record, f"$.{name}", kind)


def append_records(*tables: DataFrame, name: str = "record") -> DataFrame:
    """Rows of tables with different columns as one column of free records."""
    out = None
    for t in tables:
        rows = t.select(free_record(**{c: F.col(f"`{c}`") for c in t.columns}).alias(name))
        out = rows if out is None else out.unionByName(rows)
    return out
