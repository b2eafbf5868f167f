"""Required-field cleaning and projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions.text import filled_names


def require(df: DataFrame, required, keep=None) -> DataFrame:
    """Rows whose ``required`` columns are all non-null, cut down to ``keep``."""
    return df.na.drop(subset=list(required)).select(*(keep or required))


def clean_movies(movies: DataFrame, required=S.MOVIE_REQUIRED, by=()) -> DataFrame:
    """``by`` names tenant columns to keep in front, here and below."""
    return require(movies, required, (*by, *required))


def clean_ratings(ratings: DataFrame, by=()) -> DataFrame:
    return require(ratings, S.RATING_REQUIRED, (*by, *S.RATING_REQUIRED)).select(
        *by, F.col("movieId").alias("movie_id"), "rating")


def clean_credits(credits: DataFrame, by=()) -> DataFrame:
    """Cast members become their names; nameless ones are left out."""
    return require(credits, S.CREDIT_REQUIRED, (*by, *S.CREDIT_REQUIRED)).select(
        *by, "id", filled_names(F.col("cast")).alias("cast"))


# Columns the single-machine variant of the analysis asks for.
NOTEBOOK_MOVIE_REQUIRED = (
    "id", "title", "genres", "release_date", "overview",
    "production_countries", "spoken_languages", "budget", "revenue",
)
NOTEBOOK_RATING_REQUIRED = ("movieId", "rating", "timestamp")


def empty_to_null(df: DataFrame, columns) -> DataFrame:
    """Empty text counts as missing in the single-machine variant."""
    return df.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in columns})


def decode_counts(decoded: DataFrame, name: str) -> DataFrame:
    """Accepted and rejected row counts of a decode run with ``keep_rejects``."""
    good = F.size("problems") == 0
    return decoded.agg(
        F.lit(name).alias("record"),
        F.count_if(good).alias("accepted"),
        F.count_if(~good).alias("rejected"),
    )


def observe_counts(df: DataFrame, observation, accepted: Column | None = None) -> DataFrame:
    """Count rows as a side effect of whatever action runs next."""
    test = F.lit(True) if accepted is None else accepted
    return df.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.count_if(test).alias("accepted"))
