"""Tolerant text -> value casts.  Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n\f\v")) == ""


def to_long(text: Column) -> Column:
    return text.try_cast("bigint")


def to_double(text: Column) -> Column:
    """Number parse without the JVM's trailing type letters (``1.0d``)."""
    # Empty text would cost an exception, and the pattern is tried only where it may fit.
    lettered = F.lit(False)
    for letter in "dDfF":
        lettered = lettered | text.contains(letter)
    typed = lettered & text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when((text != "") & ~typed, text.try_cast("double"))


def to_flag(text: Column) -> Column:
    return F.coalesce(text == "True", F.lit(False))


def to_date(text: Column) -> Column:
    """``2000-01-05`` and ``2000-1-5`` alike; anything else is null."""
    return F.try_to_date(text, "y-M-d")


def release_year(text: Column) -> Column:
    return F.year(to_date(text))


def epoch_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
