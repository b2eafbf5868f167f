"""Filters, joins, aggregates, ranks, duplicates and texts on hand-made rows."""

import random
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marquee.functions import casts, json_text, sentiment, text
from marquee.operators import aggregates, clean, dedup, filters, joins, ranking
from marquee.session import materialize, shared_dir

FILM = ("id long, original_title string, release_date string, budget long, revenue double, "
        "production_countries array<struct<iso_3166_1:string,name:string>>, "
        "genres array<struct<id:long,name:string>>, overview string")


def films(spark, *rows):
    full = []
    for i, row in enumerate(rows, 1):
        base = {"id": i, "original_title": f"T{i}", "release_date": "2005-01-01", "budget": 10,
                "revenue": 20.0, "countries": ["Argentina"], "genres": ["Drama"], "overview": ""}
        base.update(row)
        full.append((base["id"], base["original_title"], base["release_date"], base["budget"],
                     base["revenue"], [("", c) for c in base["countries"]],
                     [(0, g) for g in base["genres"]], base["overview"]))
    return spark.createDataFrame(full, FILM)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_country_filters(spark):
    df = films(spark, {"countries": ["Argentina"]}, {"countries": ["Argentina", "Spain"]},
               {"countries": []}, {"countries": ["argentina"]}, {"countries": [None, "Spain"]})
    assert ids(df.filter(filters.in_country("Argentina"))) == [1, 2]
    assert ids(df.filter(filters.in_one_country())) == [1, 4]
    assert ids(df.filter(filters.in_all_countries(["Argentina", "Spain"]))) == [2]
    assert ids(df.filter(filters.mentions_country("argentina"))) == [1, 2, 4]
    # Null names make membership false, never null: the negation keeps the row.
    assert ids(df.filter(~filters.in_country("Argentina"))) == [3, 4, 5]


def test_year_filters(spark):
    dates = ["2000-12-31", "2001-01-01", "2000-1-5", "2009-12-31", "2010-01-01", "1", "", None]
    df = films(spark, *[{"release_date": d} for d in dates])
    assert ids(df.filter(filters.released_after(2000))) == [2, 4, 5]
    assert ids(df.filter(filters.released_after(2000, inclusive=True))) == [1, 2, 3, 4, 5]
    assert ids(df.filter(filters.released_between(2000, 2009))) == [1, 2, 3, 4]
    assert ids(df.filter(filters.released_between(2000, 2010, include_high=False))) == [1, 2, 3, 4]


def test_routes(spark):
    df = films(spark, {"countries": ["Argentina"]}, {"countries": ["Argentina", "Spain"]},
               {"countries": ["Chile", "Peru"]})
    routed = filters.route(df, filters.production_routes("Argentina", "Spain"))
    assert sorted((r.id, r.route) for r in routed.collect()) == [
        (1, "country"), (1, "solo"), (2, "coproduction"), (2, "country")]
    split = filters.branches(df, filters.production_routes("Argentina", "Spain"))
    assert {name: ids(part) for name, part in split.items()} == {
        "country": [1, 2], "solo": [1], "coproduction": [2]}


def test_cleaning_of_credits(spark):
    df = spark.createDataFrame(
        [(1, []), (2, [("a",), ("",), (None,), ("a",)]), (3, None), (None, [("a",)])],
        "id long, cast array<struct<name:string>>")
    assert sorted((r.id, r.cast) for r in clean.clean_credits(df).collect()) == [
        (1, []), (2, ["a", "a"])]


def test_unique_by_key(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (1, "b", 2), (2, "c", 1)], "id long, title string, seq int")
    assert sorted(tuple(r) for r in joins.unique_by_key(df, ["id"], "seq").collect()) == [
        (1, "b", 2), (2, "c", 1)]


def test_range_bucket(spark):
    df = spark.createDataFrame([(k,) for k in (0, 9, 10, 15, 20, 99)], "id long")
    bucket = joins.range_bucket(F.col("id"), [(0, 9, 1), (10, 19, 2), (5, 15, 3)], 4)
    assert [r.b for r in df.orderBy("id").select(bucket.alias("b")).collect()] == [1, 1, 2, 2, 1, 4]


def test_one_film_with_most_ratings(spark):
    """A film holding most rows: exact means, and only partial sums are shuffled."""
    ratings = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("movie_id"),
        (F.col("id") % 5).cast("double").alias("rating"))
    movies = spark.createDataFrame([(i, f"T{i}") for i in range(40)], "id long, original_title string")
    got = {r.id: (r.rating_count, r.rating) for r in aggregates.mean_ratings(ratings, movies).collect()}
    want = {}
    for i in range(30_000):
        key = 7 if i % 3 > 0 else i % 50
        want.setdefault(key, []).append(i % 5)
    assert got == {k: (len(v), pytest.approx(sum(v) / len(v))) for k, v in want.items() if k < 40}
    plan = aggregates.rating_totals(ratings)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_join_shapes(spark):
    movies = spark.createDataFrame([(1, "A"), (2, "B")], "id long, original_title string")
    ratings = spark.createDataFrame([(1, 4.0), (1, 5.0), (3, 1.0)], "movie_id long, rating double")
    credits = spark.createDataFrame(
        [(1, ["x"]), (1, ["x"]), (2, []), (3, ["y"])], "id long, cast array<string>")
    assert sorted(tuple(r) for r in joins.join_ratings(ratings, movies).collect()) == [
        (1, "A", 4.0), (1, "A", 5.0)]
    assert sorted((r.id, r.cast) for r in joins.join_credits(credits, movies).collect()) == [
        (1, ["x"]), (1, ["x"]), (2, [])]
    twice = movies.unionByName(movies)
    assert joins.join_credits_inner(credits, twice, unique=False).count() == 6
    assert joins.join_credits_inner(credits, twice).count() == 3
    empty = movies.filter("id < 0")
    assert joins.join_ratings(ratings, empty).count() == joins.join_credits(credits, empty).count() == 0


def test_materialized_side_is_broadcast(spark):
    movies = materialize(spark.createDataFrame([(1, "A")], "id long, original_title string"), "side")
    credits = spark.range(0, 10).select("id", F.array(F.lit("x")).alias("cast"))
    plan = joins.join_credits(credits, movies)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_extremes(spark):
    means = spark.createDataFrame(
        [(3, "c", 4.0), (1, "a", 4.0), (2, "b", 2.0), (5, "e", 2.0)],
        "id long, original_title string, rating double")
    assert sorted(tuple(r) for r in aggregates.rating_extremes(means).collect()) == [
        ("highest", "a", 4.0), ("lowest", "b", 2.0)]
    assert aggregates.rating_extremes(means.filter("id < 0")).count() == 0


def test_rates_by_sentiment(spark):
    words = {"good": 0.1, "fine": 0.11, "bad": -0.1, "awful": -0.2}
    df = films(
        spark, {"overview": "fine", "revenue": 30.0}, {"overview": "good", "revenue": 1000.0},
        {"overview": "Awful!", "revenue": 0.0}, {"overview": "bad", "revenue": 1000.0},
        {"overview": "  "}, {"overview": "fine", "budget": 0}, {"overview": "fine", "revenue": 10.0})
    row = aggregates.sentiment_rates(df, words).collect()[0]
    assert (row.average_positive_rate, row.average_negative_rate) == (2.0, 0.0)
    assert aggregates.sentiment_rates(df.filter("id < 0"), words).collect()[0][0] == 0.0


def test_polarity_forms_agree(spark):
    rng = random.Random(3)
    vocabulary = [*sentiment.DEFAULT_LEXICON, "film", "house", "river"]
    texts = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))).title()) for i in range(60)]
    df = spark.createDataFrame([*texts, (99, None)], "id long, overview string")
    lexicon = spark.createDataFrame(
        list(sentiment.DEFAULT_LEXICON.items()), "word string, polarity double")
    inline = {r.id: r.p for r in df.select("id", sentiment.polarity(F.col("overview")).alias("p")).collect()}
    by_table = {r.id: r.polarity for r in
                sentiment.polarity_by_table(df, "id", "overview", lexicon).collect()}
    assert inline == pytest.approx(by_table, abs=1e-6)
    for i, words in texts:
        hits = [sentiment.DEFAULT_LEXICON[w] for w in re.findall("[a-z]+", words.lower())
                if w in sentiment.DEFAULT_LEXICON]
        assert inline[i] == pytest.approx(sum(hits) / len(hits) if hits else 0.0, abs=1e-6)


def test_lexicon_of_any_size_and_any_letters(spark):
    lexicon = {f"w{i}": 0.1 for i in range(6000)} | {"naïve": 0.9, "don't": -0.5, "edge": 0.1000004}
    df = spark.createDataFrame([(1, "Naïve w17"), (2, "DON'T"), (3, "edge"), (4, "w5999"), (5, " \t")], "id int, t string")
    got = df.select("id", sentiment.polarity(F.col("t"), lexicon).alias("p"),
                    sentiment.sentiment(F.col("t"), lexicon).alias("c")).collect()
    assert [r.p for r in got] == pytest.approx([0.5, -0.5, 0.1000004, 0.1, 0.0])
    assert [r.c for r in got] == ["positive", "negative", "positive", "neutral", "neutral"]
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    by_table = sentiment.polarity_by_table(df, "id", "t", table).orderBy("id").collect()
    assert [r.polarity for r in by_table] == pytest.approx([r.p for r in got])


def test_model_scorer(spark):
    score = sentiment.model_scorer(
        lambda: lambda texts: ["POSITIVE" if "good" in t else "NEGATIVE" for t in texts])
    df = spark.createDataFrame([("a good one",), ("no",), (None,)], "t string")
    assert [r.s for r in df.select(score("t").alias("s")).collect()] == [
        "POSITIVE", "NEGATIVE", "NEGATIVE"]


def test_genres_by_title_last_wins(spark):
    df = films(spark, {"original_title": "Same", "genres": ["Old"]},
               {"original_title": "Same", "genres": ["New", "", None]}, {"genres": []})
    assert sorted((r.title, r.genres) for r in aggregates.genres_by_title(df).collect()) == [
        ("Same", ["New"]), ("T3", [])]


def test_budget_by_country_skips_nameless(spark):
    df = films(spark, {"countries": [""]}, {"countries": [None]}, {"countries": []},
               {"countries": ["Peru"], "budget": 5}, {"countries": ["Peru"], "budget": 6})
    assert [tuple(r) for r in aggregates.budget_by_country(df).collect()] == [("Peru", 11)]


def test_merge(spark):
    parts = spark.createDataFrame([("a", 1, 2), ("a", 3, 4), ("b", 5, 6)], "k string, s long, n long")
    assert sorted(tuple(r) for r in aggregates.merge_totals(parts, ["k"], ["s", "n"]).collect()) == [
        ("a", 4, 6), ("b", 5, 6)]
    assert aggregates.merge_lists(parts, parts).count() == 6


def test_number_rows_over_many_partitions(spark):
    values = [f"t{i:05d}" for i in range(5_000)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "title string").repartition(7)
    numbered = ranking.number_rows(df, F.asc("title")).collect()
    assert {r.title: r.position for r in numbered} == {v: i for i, v in enumerate(sorted(values), 1)}
    assert ranking.number_rows(df.filter("title = ''"), F.asc("title")).count() == 0


@pytest.mark.parametrize("percent, kept", [
    (20, 200), (0.05, 0), (33.37, 334), (100, 1003), (0, 1003), (101, 1003), (None, 1003)])
def test_head_percent(spark, percent, kept):
    df = spark.range(1003).select((F.col("id") * 3).alias("k")).repartition(5)
    rows = sorted(r.k for r in ranking.head_percent(df, percent, "k").collect())
    assert rows == [i * 3 for i in range(kept)]


def test_head_percents_by_name(spark):
    tables = {"a": spark.range(10), "b": spark.range(10)}
    cut = ranking.head_percents(tables, {"a": 50}, {"a": "id", "b": "id"})
    assert {name: df.count() for name, df in cut.items()} == {"a": 5, "b": 10}


def test_top_k_by_cuts_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = ranking.top_k_by(df, 2, ["g"], F.desc("id"))
    assert sorted((r.g, r.id) for r in top.collect()) == [
        (0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_duplicates(spark):
    rows = spark.createDataFrame(
        [("c1", "q", 1, 5), ("c1", "q", 1, 5), ("c2", "q", 1, 6), ("c1", "r", 1, 7)],
        "client_id string, queue string, message_id long, v int")
    assert dedup.dedup_messages(rows).count() == 3
    assert sorted(r.v for r in dedup.first_by(rows, ["queue"], "v").collect()) == [5, 7]
    answers = spark.createDataFrame(
        [("Q1", '{"a":1,"b":[1,2]}'), ("Q1", '{"b": [1, 2], "a": 1}'), ("Q1", '{"a":2}'), ("Q2", '{"a":2}')],
        "query_id string, results string")
    assert dedup.dedup_results(answers).count() == 3
    markers = spark.createDataFrame([("c", "q", 1), ("c", "q", 1)], "client_id string, queue string, node_id int")
    assert dedup.distinct_markers(markers).count() == 1


def test_scalar_functions(spark):
    def value(column):
        return spark.range(1).select(column.alias("v")).collect()[0].v

    assert value(text.money(F.lit(51939622921))) == "$ 51.939.622.921"
    assert value(text.two_decimals(F.lit(3.8731))) == "3.87"
    assert value(text.preview(F.lit("x" * 80))) == "x" * 75 + "..."
    assert value(text.preview(F.lit("short"))) == "short"
    assert value(text.or_default(F.lit(""), "Unknown")) == "Unknown"
    assert value(text.message_key(F.lit(12), F.lit(0), F.lit(3))) == "12:0/3"
    assert value(text.modulo_bucket(F.lit(10), 4)) == 3
    assert value(text.joined(F.array(F.lit("a"), F.lit("b")))) == "a, b"
    assert len(value(text.fresh_id())) == 36
    assert value(casts.to_long(F.lit("5.5"))) is None and value(casts.to_long(F.lit(" 7 "))) == 7
    assert value(casts.to_double(F.lit("1.0d"))) is None and value(casts.to_double(F.lit("1e3"))) == 1000.0
    assert value(casts.ratio(F.lit(1), F.lit(0))) is None
    assert str(value(casts.epoch_timestamp(F.lit(0)).cast("string"))) == "1970-01-01 00:00:00"
    assert value(casts.blank(F.lit(" \t\n"))) is True
    assert value(json_text.repair_json(F.lit('{"a": [1, 2,], "b": {"c": 1'))) == '{"a": [1, 2], "b": {"c": 1}}'
    assert value(json_text.canonical_json(F.lit('{"b": 1, "a": [2]}'))) == '{"a":[2],"b":1}'


def test_json_check_is_strict(spark):
    texts = ['{"a": 1}', "[1]", '"x"', "null", " 1 ", "", "{'a': 1}", '{"a": 1} x', '"a": 1', "1, 2",
             '1, "b": 2', "1] , [2", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.orderBy("i").select(json_text.is_json(F.col("t")).alias("v")).collect()]
    assert got == [True] * 5 + [False] * 8


def test_observation(spark):
    seen = Observation("decode")
    clean.observe_counts(spark.range(10), seen, F.col("id") < 4).collect()
    assert seen.get == {"rows": 10, "accepted": 4}


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) and (named is None or shared_dir(spark) == named)
