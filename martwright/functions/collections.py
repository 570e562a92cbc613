"""List and dictionary rules as array / map column expressions.

Positions in the arguments are Python-style (0-based, negative counts from
the end); the helpers translate them to Spark's 1-based array functions.
Everything is a built-in JVM expression evaluated on the executors; no
Python runs per row.  Where a code-generated form exists (slices,
``array_remove``, ``array_insert``) it is preferred to a higher-order
function with a lambda, which Spark evaluates interpreted, element by
element.  Lambdas remain only where no built-in exists: dropping a map key
(``map_filter``) and finding a null element (evaluated only when the value
searched for is itself null).

These helpers work on arrays and maps that live *inside a row*; they never
build one array out of a whole group of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ColumnOrName = Column | str


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def _spark_pos(a: Column, index0) -> Column:
    """0-based / negative Python index -> 1-based / negative Spark index."""
    i = _c(index0)
    return F.when(i >= 0, i + 1).otherwise(i)


# --- lists -------------------------------------------------------------------

def list_get(a: ColumnOrName, index0) -> Column:
    """``a[i]``; null (not an error) when out of range."""
    arr = _c(a)
    return F.try_element_at(arr, _spark_pos(arr, index0))


def list_len(a: ColumnOrName) -> Column:
    """``len(a)``; null for a null list."""
    return F.array_size(_c(a))


def list_append(a: ColumnOrName, value) -> Column:
    """``a.append(v)``."""
    return F.array_append(_c(a), _c(value))


def list_extend(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a.extend(b)``."""
    return F.concat(_c(a), _c(b))


def list_insert(a: ColumnOrName, index0, value) -> Column:
    """``a.insert(i, v)`` with Python's clamping.

    Past the end it appends (Spark alone would pad with nulls); a negative
    index counts from the end and stops at the front; a null list or index
    gives null.
    """
    arr, i = _c(a), _c(index0)
    n = F.array_size(arr)
    at = F.when(i < 0, F.greatest(n + i, F.lit(0))).otherwise(F.least(i, n))
    return F.when(i.isNotNull() & arr.isNotNull(), F.array_insert(arr, F.coalesce(at, F.lit(0)) + 1, _c(value)))


def list_set(a: ColumnOrName, index0, value) -> Column:
    """``a[i] = v`` (R17); an index out of range leaves the list unchanged."""
    arr, i = _c(a), _c(index0)
    n = F.array_size(arr)
    k = F.when(i < 0, n + i).otherwise(i)  # 0-based target
    # slices instead of a ``transform`` lambda: slices are code-generated,
    # higher-order functions are interpreted per element
    replaced = F.concat(F.slice(arr, F.lit(1), k), F.array(_c(value)),
                        F.slice(arr, k + 2, F.greatest(n - k - 1, F.lit(0))))
    return F.when((k >= 0) & (k < n), replaced).otherwise(arr)


def _first_position(arr: Column, v: Column) -> Column:
    """1-based position of the first element equal to ``v`` (0 if absent).

    A null ``v`` matches the first null element, as ``None`` does in Python;
    ``array_position`` alone cannot look for null.
    """
    first_null = F.array_position(F.transform(arr, lambda x: x.isNull()), F.lit(True))
    return F.when(v.isNull(), first_null).otherwise(F.array_position(arr, v))


def list_remove_first(a: ColumnOrName, value) -> Column:
    """``a.remove(v)``: drop the *first* equal element only.

    (``array_remove`` drops every match.)  Unchanged when absent.
    """
    arr = _c(a)
    p = _first_position(arr, _c(value))
    n = F.array_size(arr)
    return F.when(p == 0, arr).otherwise(
        F.concat(F.slice(arr, F.lit(1), p - 1), F.slice(arr, p + 1, n - p)))


def list_count(a: ColumnOrName, value) -> Column:
    """``a.count(v)``."""
    arr, v = _c(a), _c(value)
    # size minus size-without-v (code-generated); only a null v needs the
    # element-wise filter
    return F.when(v.isNull(), F.array_size(F.filter(arr, lambda x: x.isNull()))).otherwise(
        F.array_size(arr) - F.array_size(F.array_remove(arr, v)))


def list_index(a: ColumnOrName, value) -> Column:
    """``a.index(v)``, 0-based; null when absent."""
    p = _first_position(_c(a), _c(value))
    return F.when(p > 0, p - 1).cast("int")


def list_pop(a: ColumnOrName) -> Column:
    """The list after ``a.pop()`` (R18); an empty list stays empty."""
    arr = _c(a)
    return F.slice(arr, F.lit(1), F.greatest(F.array_size(arr) - 1, F.lit(0)))


def list_pop_at(a: ColumnOrName, index0) -> Column:
    """The list after ``a.pop(i)`` (R18); unchanged when ``i`` is out of range.
    The element it returns is ``list_get(a, i)``."""
    arr, i = _c(a), _c(index0)
    n = F.array_size(arr)
    k = F.when(i < 0, n + i).otherwise(i)  # 0-based
    rest = F.concat(F.slice(arr, F.lit(1), k), F.slice(arr, k + 2, F.greatest(n - k - 1, F.lit(0))))
    return F.when((k >= 0) & (k < n), rest).otherwise(arr)


def list_last(a: ColumnOrName) -> Column:
    """The element ``a.pop()`` returns; null for an empty list."""
    return F.try_element_at(_c(a), F.lit(-1))


def list_sort(a: ColumnOrName) -> Column:
    return F.array_sort(_c(a))


def list_clear(a: ColumnOrName) -> Column:
    """An empty list of the same element type."""
    arr = _c(a)
    return F.slice(arr, F.lit(1), F.lit(0))


def render_list(a: ColumnOrName, sep: str = ",") -> Column:
    """Text form of a list, nulls shown as ``null`` (for reports and checks)."""
    return F.array_join(_c(a), sep, "null")


# --- dictionaries --------------------------------------------------------------

def map_get(m: ColumnOrName, key) -> Column:
    """``d.get(k)``: null when the key is missing."""
    return F.try_element_at(_c(m), _c(key))


def map_get_strict(m: ColumnOrName, key) -> Column:
    """``d[k]``: raises when the key is missing."""
    mm, k = _c(m), _c(key)
    return F.when(F.map_contains_key(mm, k), F.element_at(mm, k)).otherwise(
        F.raise_error(F.concat(F.lit("missing key: "), k.cast("string"))))


def map_remove(m: ColumnOrName, key) -> Column:
    """``del d[k]`` / ``d.pop(k)`` (R20); no key is null, so a null ``k``
    changes nothing."""
    k = _c(key)
    return F.map_filter(_c(m), lambda kk, _v: ~kk.eqNullSafe(k))


def map_set(m: ColumnOrName, key, value) -> Column:
    """``d[k] = v`` (R20): the old key is filtered out first, because
    ``map_concat`` refuses duplicate keys.  A null key, which a map can't
    hold, changes nothing."""
    k = _c(key)
    return F.when(k.isNull(), _c(m)).otherwise(F.map_concat(map_remove(m, key), F.create_map(k, _c(value))))


def map_update(m: ColumnOrName, other: ColumnOrName) -> Column:
    """``d.update(e)`` (R22): all entries of both, those of ``other`` win."""
    o = _c(other)
    return F.map_concat(F.map_filter(_c(m), lambda k, _v: ~F.map_contains_key(o, k)), o)


def map_fromkeys(keys: ColumnOrName, value) -> Column:
    """``dict.fromkeys(keys, v)`` (R22); repeated and null keys count once and not at all."""
    distinct = F.array_distinct(F.array_compact(_c(keys)))
    return F.map_from_entries(F.transform(distinct, lambda k: F.struct(k, _c(value))))


def map_clear(m: ColumnOrName) -> Column:
    """``d.clear()`` (R22): an empty map of the same type."""
    return F.map_filter(_c(m), lambda _k, _v: F.lit(False))


def literal_map(pairs: dict) -> Column:
    """A constant map column from a small Python dict (a lookup table)."""
    items = []
    for k, v in pairs.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# --- rows from collections --------------------------------------------------------

def map_rows(df: DataFrame, keep: list[str], m: ColumnOrName,
             key_name: str = "key", value_name: str = "value") -> DataFrame:
    """One row per (key, value) of a map column."""
    return df.select(*keep, F.explode(_c(m)).alias(key_name, value_name))


def zip_rows(df: DataFrame, keep: list[str], arrays: dict[str, ColumnOrName]) -> DataFrame:
    """Parallel lists to rows: element i of every list goes to row i.

    The shorter lists are padded with nulls, and a null list counts as an
    empty one.  The lists are first given their output names so ``arrays_zip``
    names the struct fields after them.
    """
    named = df.select(*keep, *[_c(v).alias(k) for k, v in arrays.items()])
    for k in arrays:
        named = named.withColumn(k, F.coalesce(k, F.array().cast(named.schema[k].dataType)))
    return named.select(*keep, F.inline(F.arrays_zip(*arrays.keys())))
