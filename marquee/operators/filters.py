"""Predicates on countries, years, text and money, and routing by them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import casts, text

COUNTRIES = "production_countries"


def country_names(column: str = COUNTRIES) -> Column:
    return text.names_of(F.col(column))


def in_country(country: str) -> Column:
    """Exact, case-sensitive country name."""
    return text.has_name(country_names(), country)


def in_one_country() -> Column:
    return F.coalesce(F.size(country_names()) == 1, F.lit(False))


def in_all_countries(countries) -> Column:
    test = F.lit(True)
    for country in countries:
        test = test & in_country(country)
    return test


def released_after(year: int, inclusive: bool = False) -> Column:
    """Released after ``year``; ``inclusive`` counts the year itself."""
    released = casts.release_year(F.col("release_date"))
    return F.coalesce(released >= year if inclusive else released > year, F.lit(False))


def released_between(low: int, high: int, include_high: bool = True) -> Column:
    released = casts.release_year(F.col("release_date"))
    below = released <= high if include_high else released < high
    return F.coalesce((released >= low) & below, F.lit(False))


def mentions(column: Column, wanted: str) -> Column:
    """Case-insensitive substring test; null text does not match."""
    return text.contains_ignoring_case(column, wanted)


def mentions_country(wanted: str) -> Column:
    """Looser country test: a substring, ignoring case, of any of the names."""
    return F.coalesce(
        F.exists(country_names(), lambda name: mentions(name, wanted)), F.lit(False))


def non_zero(*columns: str) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & F.coalesce(F.col(name) != 0, F.lit(False))
    return test


def route(df: DataFrame, routes: Mapping[str, Column], column: str = "route") -> DataFrame:
    """One output row per matching route; a row may take several or none.

    A single pass over the input; write it with ``partitionBy(column)`` or filter
    on the column to get each branch.
    """
    tags = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in routes.items()]))
    return df.withColumn(column, F.explode(tags))


def branches(df: DataFrame, routes: Mapping[str, Column]) -> dict[str, DataFrame]:
    """The same routes as separate frames; hand in a materialised ``df``."""
    return {name: df.filter(test) for name, test in routes.items()}


def production_routes(country: str, partner: str) -> dict[str, Column]:
    return {
        "country": in_country(country),
        "solo": in_one_country(),
        "coproduction": in_all_countries([country, partner]),
    }
