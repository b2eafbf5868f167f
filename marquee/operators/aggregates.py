"""Grouped sums, means, extremes and counts.

Every aggregate has a map-side partial, so a key that holds a large share of the
rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import casts, text
from marquee.functions.sentiment import sentiment, with_feeling

def budget_by_country(movies: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Budget per country of the first listed name; nameless rows are skipped."""
    named = movies.withColumn("country", text.first_name(F.col("production_countries")))
    return named.filter(F.coalesce("country", F.lit("")) != "").groupBy(*by, "country").agg(
        F.sum("budget").alias("total"))


def rating_totals(ratings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum and count per film id, before any join: one row per film and task is
    all that gets shuffled, however the ratings are spread."""
    return ratings.groupBy(*by, "movie_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count"))


def mean_ratings(ratings: DataFrame, movies: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean rating of the given films; films without ratings take no part."""
    totals = rating_totals(ratings, by).withColumnRenamed("movie_id", "id")
    keys = [*by, "id"]
    return movies.select(*keys, "original_title").join(totals, keys).select(
        *keys, "original_title", "rating_count",
        (F.col("rating_sum").cast("double") / F.col("rating_count")).alias("rating"))


def rating_extremes(means: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Highest and lowest mean as ``(kind, title, rating)`` rows; the smaller id
    wins ties.  No input, no rows."""
    best = F.max(F.struct("rating", (-F.col("id")).alias("k"), "original_title")).alias("highest")
    worst = F.min(F.struct("rating", F.col("id").alias("k"), "original_title")).alias("lowest")
    picked = means.groupBy(*by).agg(best, worst).filter("highest IS NOT NULL")

    def side(name: str) -> Column:
        return F.struct(F.lit(name).alias("kind"), F.col(f"{name}.original_title").alias("title"),
                        F.col(f"{name}.rating").alias("rating"))

    return picked.select(
        *by, F.inline(F.array(side("highest"), side("lowest"))))


def appearances(credits: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How often each actor name occurs; every occurrence counts."""
    return credits.select(*by, F.explode("cast").alias("name")).groupBy(*by, "name").agg(
        F.count("*").alias("count"))


def sentiment_rates(movies: DataFrame, lexicon=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean revenue/budget of films with positive and with negative overviews in
    one row, 0 for an empty class."""
    rated = classified_rates(movies, lexicon, by)

    def mean(label: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("sentiment") == label, F.col("rate"))), F.lit(0.0))

    return rated.groupBy(*by).agg(
        mean("positive").alias("average_positive_rate"),
        mean("negative").alias("average_negative_rate"))


def classified_rates(movies: DataFrame, lexicon=None, by: tuple[str, ...] = ()) -> DataFrame:
    """``sentiment, rate`` of films with a positive budget, neutral ones left out.

    The budget test comes first, so the text of films it drops is never scored.
    """
    label = sentiment(F.col("overview"), lexicon) if lexicon else sentiment(F.col("overview"))
    rated = movies.filter("budget > 0").withColumn(
        "rate", casts.ratio(F.col("revenue"), F.col("budget")))
    return with_feeling(rated, label).select(*by, "sentiment", "rate")


def genres_by_title(movies: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Genre names per title; of films with one title the largest id counts."""
    latest = F.max(F.struct("id", text.filled_names(F.col("genres")).alias("genres")))
    return movies.groupBy(*by, "original_title").agg(latest.alias("_m")).select(
        *by, F.col("original_title").alias("title"), F.col("_m.genres").alias("genres"))


def merge_totals(partials: DataFrame, keys, sums) -> DataFrame:
    """Add up stored partial states key by key."""
    return partials.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])


def merge_lists(partials: DataFrame, *more: DataFrame) -> DataFrame:
    """List-valued partial states are merged by putting their rows together."""
    for other in more:
        partials = partials.unionByName(other)
    return partials


def distinct_count(df: DataFrame, column: str, label: str) -> DataFrame:
    """Exact number of distinct non-null values."""
    return df.agg(F.lit(label).alias("field"), F.count_distinct(column).alias("distinct_values"))
