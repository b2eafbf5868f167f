"""The five film questions over cleaned films, ratings and credits.

``by`` names leading tenant columns (usually ``("client_id",)``): every key, top-k
and join is then per tenant.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import aggregates, filters, joins, ranking
from marquee.session import materialize


@dataclass(frozen=True)
class Rules:
    """Constants of the questions.  ``NOTEBOOK`` holds the looser variant."""

    country: str = "Argentina"
    partner: str = "Spain"
    after: int = 2000
    after_inclusive: bool = False
    decade: tuple[int, int] = (2000, 2009)
    countries: int = 5
    actors: int = 10
    loose_country: bool = False
    skip_zero_revenue: bool = False
    lexicon: Mapping[str, float] | None = None

    def country_test(self, name: str):
        return filters.mentions_country(name) if self.loose_country else filters.in_country(name)


ENGINE = Rules()
NOTEBOOK = Rules(after_inclusive=True, loose_country=True, skip_zero_revenue=True)

By = Sequence[str]


def recent_films(movies: DataFrame, rules: Rules = ENGINE, by: By = ()) -> DataFrame:
    """The country's films after the year, one per id: the join side of Q3 and Q4."""
    kept = movies.filter(
        rules.country_test(rules.country)
        & filters.released_after(rules.after, rules.after_inclusive))
    return joins.unique_by_key(kept.select(*by, "id", "original_title"), [*by, "id"])


def q1(movies: DataFrame, rules: Rules = ENGINE, by: By = ()) -> DataFrame:
    """Co-productions of the decade: ``title, genres``."""
    kept = movies.filter(
        rules.country_test(rules.country) & rules.country_test(rules.partner)
        & filters.released_between(*rules.decade))
    return aggregates.genres_by_title(kept, by)


def q2(movies: DataFrame, rules: Rules = ENGINE, by: By = ()) -> DataFrame:
    """Countries that spent most on films of their own: ``country, total``."""
    totals = aggregates.budget_by_country(movies.filter(filters.in_one_country()), by)
    if by:
        return ranking.top_k_by(
            totals, rules.countries, by, F.desc("total"), F.asc("country"))
    return ranking.top_budgets(totals, rules.countries)


def q3(recent: DataFrame, ratings: DataFrame, by: By = ()) -> DataFrame:
    """Best and worst rated of ``recent_films``: ``kind, title, rating``."""
    return aggregates.rating_extremes(aggregates.mean_ratings(ratings, recent, by), by)


def q4(recent: DataFrame, credits: DataFrame, rules: Rules = ENGINE, by: By = ()) -> DataFrame:
    """Busiest actors of ``recent_films``: ``name, count``."""
    counts = aggregates.appearances(joins.join_credits(credits, recent, by), by)
    if by:
        return ranking.top_k_by(counts, rules.actors, by, F.desc("count"), F.asc("name"))
    return ranking.top_actors(counts, rules.actors)


def q5(movies: DataFrame, rules: Rules = ENGINE, by: By = ()) -> DataFrame:
    """Mean revenue/budget by overview sentiment, one row."""
    if rules.skip_zero_revenue:
        movies = movies.filter(filters.non_zero("budget", "revenue"))
    return aggregates.sentiment_rates(movies, rules.lexicon, by)


def all_queries(movies: DataFrame, ratings: DataFrame, credits: DataFrame | Callable[[DataFrame], DataFrame],
                rules: Rules = ENGINE, by: By = ()) -> dict[str, DataFrame]:
    """All five over shared inputs.

    ``credits`` may be a function of the ids of the films that they are joined to, for a
    reader that can spare itself the decoding of others.

    The cleaned films feed four consumers and the selected films two joins, so
    both are written once; the selected films then have a known size, and Spark
    sends them to the ratings and credits instead of shuffling those.
    """
    films = materialize(movies, "films")
    recent = materialize(recent_films(films, rules, by), "recent-films")
    return {
        "Q1": q1(films, rules, by),
        "Q2": q2(films, rules, by),
        "Q3": q3(recent, ratings, by),
        "Q4": q4(recent, credits(recent.select("id")) if callable(credits) else credits, rules, by),
        "Q5": q5(films, rules, by),
    }


def envelopes(answers: Mapping[str, DataFrame], client_id: str | None = None) -> DataFrame:
    """``(client_id, query_id, results)`` documents for ``sources.results``.

    The client is ``client_id``, or else the answers' own column of that name, which
    answers ``by=("client_id",)`` have.  Top-k, extremes and rates are one document
    per client each.  Q1 may be long, so it is one document per title and never
    gathered in one place.
    """
    pair = F.array(F.col("country"), F.col("total").cast("string"))
    side = F.struct("title", "rating")
    bodies = {  # query: (one document for all rows, content)
        "Q1": (False, F.to_json(F.create_map("title", "genres"))),
        # ranked again, as a gathered list keeps no order of its own
        "Q2": (True, F.to_json(F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("k"), "country", pair.alias("v")))),
            lambda e: e["v"]))),
        "Q3": (True, F.to_json(F.map_from_entries(F.collect_list(F.struct("kind", side))))),
        "Q4": (True, F.to_json(F.struct(F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("k"), "name", "count"))),
            lambda e: F.struct(e["name"].alias("name"), e["count"].alias("count"))).alias("actors")))),
        "Q5": (False, F.to_json(F.struct("average_positive_rate", "average_negative_rate"))),
    }
    parts = []
    for query, answer in answers.items():
        if client_id is not None:
            answer = answer.withColumn("client_id", F.lit(client_id))
        gathered, body = bodies[query]
        if not gathered:
            rows = answer.select("client_id", body.alias("results"))
        elif client_id is None:
            rows = answer.groupBy("client_id").agg(body.alias("results"))
        else:  # an answer without rows is an empty document, not none
            rows = answer.agg(body.alias("results")).withColumn("client_id", F.lit(client_id))
        parts.append(rows.select("client_id", F.lit(query).alias("query_id"), "results"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
