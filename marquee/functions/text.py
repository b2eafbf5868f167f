"""Names inside nested columns, previews and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def names_of(entries: Column) -> Column:
    """All ``name`` values, nulls included; a file scan then reads only the names."""
    return entries["name"]


def filled_names(entries: Column) -> Column:
    """``name`` values that are neither null nor empty."""
    return F.filter(names_of(entries), lambda name: F.coalesce(name, F.lit("")) != "")


def first_name(entries: Column) -> Column:
    return F.try_element_at(names_of(entries), F.lit(1))


def has_name(names: Column, wanted: str) -> Column:
    """Exact membership; false (not null) when the array holds nulls."""
    return F.coalesce(F.array_contains(names, wanted), F.lit(False))


def contains_ignoring_case(text: Column, wanted: str) -> Column:
    return F.coalesce(F.lower(text).contains(wanted.lower()), F.lit(False))


def preview(text: Column, width: int = 75) -> Column:
    shown = F.coalesce(text, F.lit(""))
    return F.when(
        F.char_length(shown) > width, F.concat(F.substring(shown, 1, width), F.lit("..."))
    ).otherwise(shown)


def joined(names: Column, separator: str = ", ") -> Column:
    return F.array_join(names, separator)


def or_default(value: Column, default) -> Column:
    """The value, or ``default`` when it is null or empty text."""
    return F.coalesce(F.when(value.cast("string") != "", value), F.lit(default))


def money(amount: Column) -> Column:
    """``$ 1.234.567``"""
    return F.concat(F.lit("$ "), F.replace(F.format_number(amount, 0), F.lit(","), F.lit(".")))


def two_decimals(value: Column) -> Column:
    return F.format_string("%.2f", value.cast("double"))


def message_key(message_id: Column, sub_id: Column, expected: Column) -> Column:
    """``12:0/3``: message 12, part 0 of 3."""
    return F.format_string("%s:%s/%s", message_id, sub_id, expected)


def modulo_bucket(key: Column, buckets: int) -> Column:
    """Bucket number from 1 to ``buckets``."""
    return F.pmod(key, F.lit(buckets)) + 1


def fresh_id() -> Column:
    """A random UUID per row, for new tenants and results."""
    return F.uuid()
