"""Helpers for writing longer row-local expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` by name.

    A one-element ``transform`` keeps an intermediate array out of the row: no extra projection
    writes it out, and the optimizer cannot inline (and so repeat) an expensive expression.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sql_let(name: str, value: str, body: str) -> str:
    """``let`` for SQL text."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def sql_raw(text: str) -> str:
    """SQL literal without escapes; the text must not hold an apostrophe."""
    return "r'" + text + "'"


def sql_bucket(key: str, buckets: int) -> str:
    """Bucket number of a key; ``buckets`` must be a power of two."""
    return f"cast(crc32(cast({key} as binary)) & {buckets - 1} as int)"


def sql_lookup(index: str, key: str, buckets: int) -> str:
    """Value of ``key`` in an ``array<map>`` spread over ``buckets`` maps; NULL when absent.

    A map is searched entry by entry, so a table of thousands of keys is spread over many small
    maps and the right one is picked by the CRC of the key.
    """
    return f"try_element_at(get({index}, {sql_bucket(key, buckets)}), {key})"


def lookup_in(index: Column, key: Column, buckets: int) -> Column:
    """The same from columns."""
    bucket = F.crc32(key.cast("binary")).bitwiseAND(F.lit(buckets - 1)).cast("int")
    return F.try_element_at(F.get(index, bucket), key)


def apply_sql(value: Column, sql_lambda: str) -> Column:
    """Apply a SQL lambda to a column.

    Large expressions are written as SQL text because building the same tree call by call costs
    more driver time than running it on a small table.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(sql_lambda)), F.lit(0))
