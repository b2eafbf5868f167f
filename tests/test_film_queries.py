"""The five questions from raw files to written answers."""

import pytest
from film_files import ARGENTINA, SPAIN, credits_line, member, movie, write_lines, write_movies
from pyspark.sql import functions as F

from marquee.operators import clean, compare
from marquee.plans import film_queries as film
from marquee.sources import films, results

CHILE = "{'iso_3166_1': 'CL', 'name': 'Chile'}"
WORDS = {"great": 0.8, "sad": -0.5}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    movies = write_movies(folder / "movies.csv", [
        movie(id="1", original_title="Both", production_countries=f"[{ARGENTINA}, {SPAIN}]",
              release_date="2003-02-01", overview="great"),
        movie(id="2", original_title="Solo", release_date="2001-01-01", budget="300", overview="sad",
              revenue="30"),
        movie(id="3", original_title="Early", release_date="2000-12-31", budget="50",
              overview="sad great great"),
        movie(id="4", original_title="Chilean", production_countries=f"[{CHILE}]", budget="70"),
        movie(id="5", original_title="Both", production_countries=f"[{SPAIN}, {ARGENTINA}]",
              release_date="2009-12-31", genres="[]", budget="0", overview="great"),
        movie(id="5", original_title="Both", production_countries=f"[{SPAIN}, {ARGENTINA}]",
              release_date="2009-12-31", genres="[]", budget="0", overview="great"),
        movie(id="6", original_title="Late", release_date="2010-01-01", budget=""),
    ])
    ratings = write_lines(folder / "ratings.csv", "userId,movieId,rating,timestamp", [
        "1,1,4.0,1", "2,1,5.0,1", "1,2,4.5,1", "1,3,1.0,1", "1,5,2.0,1", "3,99,1.0,1"])
    credits = write_lines(folder / "credits.csv", "cast,crew,id", [
        credits_line([member("Ana"), member("Bob"), member("Ana")], [], 1),
        credits_line([member("Bob"), member("")], [], 2),
        credits_line([member("Bob")], [], 2),
        credits_line([member("Zoe")], [], 3),
        credits_line([], [], 5)])
    return (
        clean.clean_movies(films.read_movies(spark, movies)),
        clean.clean_ratings(films.read_ratings(spark, ratings)),
        clean.clean_credits(films.read_credits(spark, credits)))


def test_five_answers(inputs):
    answers = film.all_queries(*inputs, film.Rules(lexicon=WORDS))
    rows = {q: [tuple(r) for r in df.collect()] for q, df in answers.items()}
    assert rows["Q1"] == [("Both", [])]
    assert rows["Q2"] == [("Argentina", 350), ("Chile", 70)]
    assert sorted(rows["Q3"]) == [("highest", "Both", 4.5), ("lowest", "Both", 2.0)]
    assert rows["Q4"] == [("Bob", 3), ("Ana", 2)]
    assert rows["Q5"] == [(pytest.approx((2.5 + 5.0 + 250 / 70) / 3), 0.1)]


def test_notebook_rules(inputs):
    movies, ratings, credits = inputs
    rules = film.NOTEBOOK
    recent = film.recent_films(movies, rules)
    assert sorted(r.id for r in recent.collect()) == [1, 2, 3, 5]
    assert sorted(r.name for r in film.q4(recent, credits, rules).collect()) == ["Ana", "Bob", "Zoe"]


def test_notebook_cleaning(spark, tmp_path):
    path = write_movies(tmp_path / "m.csv", [
        movie(id="1", spoken_languages="[{'iso_639_1': 'es', 'name': 'Spanish'}]"),
        movie(id="2", overview=""), movie(id="3", title="")])
    raw = films.read_movies(spark, path)
    kept = clean.require(
        clean.empty_to_null(raw, ["title", "overview", "release_date"]), clean.NOTEBOOK_MOVIE_REQUIRED)
    assert [r.id for r in kept.collect()] == [1]
    assert kept.columns == list(clean.NOTEBOOK_MOVIE_REQUIRED)


def test_tenants_do_not_mix(inputs):
    def two(df):
        return df.withColumn("client_id", F.explode(F.array(F.lit("x"), F.lit("y"))))
    single = film.all_queries(*inputs, film.Rules(lexicon=WORDS))
    double = film.all_queries(*map(two, inputs), film.Rules(lexicon=WORDS), by=("client_id",))
    for query, df in single.items():
        want = sorted(map(str, (tuple(r) for r in df.collect())))
        for client in "xy":
            mine = double[query].filter(F.col("client_id") == client).drop("client_id")
            assert sorted(map(str, (tuple(r) for r in mine.select(df.columns).collect()))) == want


def test_answers_written_and_compared(spark, inputs, tmp_path):
    answers = film.all_queries(*inputs, film.Rules(lexicon=WORDS))
    documents = film.envelopes(answers, "client-1")
    results.write_results(documents, str(tmp_path / "out"))
    stored = results.read_results(spark, str(tmp_path / "out"))
    assert {r.client_id for r in stored.collect()} == {"client-1"}
    assert sorted(r.query_id for r in stored.collect()) == ["Q1", "Q2", "Q3", "Q4", "Q5"]
    assert compare.compare_answers(stored, documents).count() == 0
    nothing = film.all_queries(*[df.limit(0) for df in inputs])
    empty = film.envelopes(nothing, "client-2")
    assert {r.query_id for r in compare.compare_answers(stored, empty).collect()} == {
        "Q1", "Q2", "Q3", "Q4", "Q5"}
