"""Queries that go through files: raw files to the five answers, and round trips.

Each writes files of the reference formats from the given tables and reads them back, so
that readers, writers and decoding run on data that grows with the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions import json_text, sentiment
from marquee.operators import aggregates, clean, compare, quality, ranking
from marquee.plans import bindings as b
from marquee.plans import film_queries as film
from marquee.plans import table_views as views
from marquee.plans.table_views import table
from marquee.session import materialize, scratch_path
from marquee.sources import batches, films, results


# --- raw files to answers -------------------------------------------------------------

def _credit_lines(spark, sf_dir) -> DataFrame:
    """Line items as lines of the credits file: three members each, the last one nameless
    for large parts; quotes are doubled as CSV has it."""
    credits = views.credits(spark, sf_dir).select("id", "cast")
    before = "{'cast_id': 1, 'character': \"O'Brien\", 'credit_id': 'c', 'gender': None, 'id': 9, 'name': '"
    member = F.transform("cast", lambda m: F.concat(
        F.lit(before), F.coalesce(m["name"], F.lit("null")), F.lit("', 'order': 0, 'profile_path': None}")))
    listed = F.concat(F.lit("["), F.array_join(member, ", "), F.lit("]"))
    quoted = F.concat(F.lit('"'), F.replace(listed, F.lit('"'), F.lit('""')), F.lit('"'))
    return credits.select(F.concat(quoted, F.lit(",[],"), F.col("id").cast("string")).alias("value"))


def _raw_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The three raw files, as folders of packed part files."""
    paths = {name: scratch_path(spark, f"{name}-csv") for name in ("movies", "credits", "ratings")}
    # the bindings' raw films reject a genre; here all are to be kept
    movies = b.raw_movies(spark, sf_dir).withColumn("popularity", F.lit("1.5"))
    films.write_csv(movies, paths["movies"], quote_all=True, **films.PACKED)
    _credit_lines(spark, sf_dir).write.options(**films.PACKED).text(paths["credits"])
    ratings = views.ratings(spark, sf_dir).select(
        "userId", "movieId", "rating", F.lit(1425941529).alias("timestamp"))
    films.write_csv(ratings, paths["ratings"], **films.PACKED)
    return paths


def _five(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    paths = _raw_files(spark, sf_dir)
    return film.all_queries(
        clean.clean_movies(films.read_movies(spark, paths["movies"])),
        clean.clean_ratings(films.read_ratings(spark, paths["ratings"])),
        lambda recent: clean.clean_credits(films.read_credits(spark, paths["credits"], of=recent)), b.RULES)


def all_five_from_files(spark, sf_dir):
    """All answers from the raw files in one run, as ``query_id, item, value``."""
    def rows(query: str, item: Column, value: Column) -> DataFrame:
        return answers[query].select(F.lit(query).alias("query_id"), item.alias("item"), value.cast("string").alias("value"))

    answers = _five(spark, sf_dir)
    rated = F.concat_ws("|", "title", F.round("rating", 6).cast("decimal(20,6)").cast("string"))
    rates = [F.struct(F.lit(c).alias("item"), F.round(c, 6).cast("decimal(20,6)").alias("value"))
             for c in ("average_positive_rate", "average_negative_rate")]
    last = answers["Q5"].select(F.lit("Q5").alias("query_id"), F.inline(F.array(*rates)))
    return (rows("Q1", F.col("title"), b.piped(F.col("genres")))
            .unionByName(rows("Q2", F.col("country"), F.col("total")))
            .unionByName(rows("Q3", F.col("kind"), rated))
            .unionByName(rows("Q4", F.col("name"), F.col("count")))
            .unionByName(last.withColumn("value", F.col("value").cast("string"))))


def compare_five_answers(spark, sf_dir):
    """Answers of four clients against the expected ones: the same, within the tolerance,
    wrong in three answers, and with gaps in two."""
    answers = {query: materialize(answer, query) for query, answer in _five(spark, sf_dir).items()}
    titles = answers["Q1"].select("title")
    first = titles.agg(F.min("title").alias("title"))
    clients = {
        "same": {},
        "close": {"Q3": answers["Q3"].withColumn("rating", F.col("rating") + 1e-6),
                  "Q5": answers["Q5"].withColumn("average_positive_rate", F.col("average_positive_rate") - 1e-6)},
        "wrong": {"Q2": answers["Q2"].withColumn("total", F.col("total") + 1),
                  "Q4": answers["Q4"].withColumn("count", F.col("count") + 1),
                  "Q5": answers["Q5"].withColumn("average_positive_rate", F.col("average_positive_rate") + 0.01)},
        "gaps": {"Q1": answers["Q1"].join(first, "title", "left_anti"), "Q3": None},
    }
    obtained = None
    for name, changes in clients.items():
        own = {q: a for q, a in {**answers, **changes}.items() if a is not None}
        rows = film.envelopes(own, name)
        obtained = rows if obtained is None else obtained.unionByName(rows)
    return compare.compare_answers(film.envelopes(answers, "expected"), obtained)


# --- round trips ----------------------------------------------------------------------

def batches_round_trip(spark, sf_dir):
    """Events as ratings in stored batches of a client, written and read again."""
    ratings = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("client_id"), (F.col("event_id") % 10).alias("current_batch"),
        F.struct(F.col("user_id").alias("userId"), F.col("event_id").alias("movieId"), F.col("value").alias("rating"),
                 F.unix_timestamp("ts").alias("timestamp")).alias("r"))
    stored = ratings.groupBy("client_id", "current_batch").agg(F.collect_list("r").alias("processed_data")).select(
        F.lit(7).cast("long").alias("message_id"), F.lit(S.MESSAGE_CODE["ratings"]).cast("long").alias("message_code"),
        "client_id", "current_batch", (F.col("current_batch") == 9).alias("is_last_batch"), "processed_data")
    path = scratch_path(spark, "batches")
    batches.write_batches(stored, path)
    good = batches.read_batch_lines(spark, path, "ratings").filter("verdict = 'ok'")
    return batches.records(good).select("client_id", "current_batch", "userId", "movieId", "rating", "timestamp")


def results_round_trip(spark, sf_dir):
    """The tenants' answers as answer files, written and read again."""
    path = scratch_path(spark, "results")
    results.write_results(b.envelopes_by_tenant(spark, sf_dir), path)
    return results.read_results(spark, path).select(
        "client_id", "query_id", json_text.canonical_json(F.col("results")).alias("results"))


def quarantine_round_trip(spark, sf_dir):
    """Bodies written to a good and a bad folder by their verdict, and read from both."""
    events = table(spark, sf_dir, "events")
    body = F.when(F.col("event_type") == "error", F.substring_index("props", "}", 1)).otherwise(F.col("props"))
    checked = quality.quarantine(events.select("event_id", body.alias("body")), "body", ["k"], min_bytes=5)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    quality.write_split(checked, good, bad)
    columns = "event_id long, body string"
    return spark.read.schema(columns).json(good).withColumn("verdict", F.lit("ok")).unionByName(
        spark.read.schema(f"{columns}, verdict string").json(bad))


def _longest_word(texts: list[str]) -> list[str]:
    """A stand-in for a model: the longest lower-case ASCII word, the first in order of equals."""
    return [min(re.findall("[a-z]+", text), key=lambda w: (-len(w), w), default="") for text in texts]


def model_scores(spark, sf_dir):
    """Labels of a batch model, loaded once a task, for whole texts."""
    score = sentiment.model_scorer(lambda: _longest_word)
    return table(spark, sf_dir, "documents").select("doc_id", score("text").alias("label"))


def head_of_files(spark, sf_dir):
    """The first fifth of the orders and the first half of the parts; suppliers stay whole."""
    keys = {"orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
    tables = {name: table(spark, sf_dir, name) for name in keys}
    heads = ranking.head_percents(tables, {"orders": 20, "part": 50}, keys)
    rows = [heads[name].select(F.lit(name).alias("name"), F.col(key).alias("key")) for name, key in keys.items()]
    return aggregates.merge_lists(*rows)


def read_documents(spark, sf_dir):
    """Texts full of quotes and braces as pretty-printed JSON documents one after another,
    with an object inside each, read from files that are split anywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(
        F.lit('{"x" }'), F.coalesce("text", F.lit(""))).alias("text"))
    body = F.to_json(F.struct("doc_id", F.struct("lang", "text").alias("inner")), {"pretty": "true"})
    path = scratch_path(spark, "documents")
    docs.select(body.alias("value")).write.option("lineSep", " ").text(path)
    found = results.read_documents(spark, path)
    field = lambda name: F.get_json_object("document", name)
    return found.select(
        field("$.doc_id").cast("long").alias("doc_id"), field("$.inner.lang").alias("lang"),
        F.char_length(field("$.inner.text")).cast("long").alias("n_chars"), F.md5(field("$.inner.text")).alias("digest"))


FILES = {
    "all_five_from_files": all_five_from_files,
    "compare_five_answers": compare_five_answers,
    "batches_round_trip": batches_round_trip,
    "results_round_trip": results_round_trip,
    "quarantine_round_trip": quarantine_round_trip,
    "model_scores": model_scores,
    "head_of_files": head_of_files,
    "read_documents": read_documents,
}
