"""Streams give what the batch functions give, also after a restart."""

import pytest
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions import sentiment
from marquee.operators import clean, dedup, filters, joins
from marquee.session import materialize
from marquee.streaming import jobs


def write(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def run(spark, stream, tmp_path, name="sink"):
    jobs.run_to_files(stream, str(tmp_path / name), str(tmp_path / f"{name}-state"))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_redelivered_messages(spark, tmp_path):
    sent = spark.range(40).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("client_id"), F.lit("q").alias("queue"),
        (F.col("id") % 20).alias("message_id"), F.timestamp_seconds(F.col("id") * 60 + 10**9).alias("at"))
    for _ in range(3):
        write(sent, tmp_path / "in")
    stream = jobs.open_stream(spark, str(tmp_path / "in"), sent.schema, files_per_batch=1)
    single = run(spark, jobs.dedup_stream(stream), tmp_path)
    keys = ["client_id", "queue", "message_id"]
    assert sorted(map(tuple, single.select(keys).collect())) == sorted(
        map(tuple, dedup.dedup_messages(sent).select(keys).collect()))


def test_late_first_delivery_comes_through(spark, tmp_path):
    for day, number in ((10, 1), (11, 2), (1, 3), (10, 1), (2, 4)):
        write(spark.createDataFrame([("c", "q", number, day)], "client_id string, queue string, message_id int, day int")
              .withColumn("at", F.make_date(F.lit(2024), F.lit(1), F.col("day")).cast("timestamp")), tmp_path / "in")
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = jobs.open_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
    single = run(spark, jobs.dedup_stream(stream), tmp_path)
    assert sorted(r.message_id for r in single.collect()) == [1, 2, 3, 4]
    split = run(spark, jobs.dedup_stream(stream, ["client_id", "day"]), tmp_path, "split")
    assert sorted(r.day for r in split.collect()) == [1, 2, 10, 11]


MARKERS = "client_id string, queue string, node_id int"


def test_completion_is_announced_once(spark, tmp_path):
    def mark(*rows):
        write(spark.createDataFrame(list(rows), MARKERS), tmp_path / "in")

    def announced():
        stream = jobs.open_stream(
            spark, str(tmp_path / "in"), spark.createDataFrame([], MARKERS).schema, files_per_batch=1)
        done = run(spark, jobs.completions(stream, ["a", "b"], 2), tmp_path)
        return sorted(r.client_id for r in done.collect())

    mark(("x", "a", 1), ("x", "a", 1), ("x", "b", 1), ("x", "other", 1), ("x", "other", 2))
    assert announced() == []
    mark(("x", "a", 2), ("x", "b", 2), ("y", "a", 1))
    assert announced() == ["x"]
    mark(("x", "a", 1), ("x", "b", 2), ("y", "a", 2), ("y", "b", 7), ("y", "b", 8))
    assert announced() == ["x", "y"]
    batch = jobs.complete_clients(spark.read.parquet(str(tmp_path / "in")), ["a", "b"], 2)
    assert sorted(r.client_id for r in batch.collect()) == ["x", "y"]


def test_running_totals_survive_restart(spark, tmp_path):
    schema = "country string, budget long"
    for rows in ([("AR", 1), ("ES", 2)], [("AR", 10)], [("CL", 5), ("AR", 100)]):
        write(spark.createDataFrame(rows, schema), tmp_path / "in")
        stream = jobs.open_stream(
            spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        totals = stream.groupBy("country").agg(F.sum("budget").alias("total"))
        jobs.run_updates(totals, str(tmp_path / "out"), str(tmp_path / "state"))
    now = jobs.latest(spark, str(tmp_path / "out"), ["country"])
    assert sorted(map(tuple, now.collect())) == [("AR", 111), ("CL", 5), ("ES", 2)]


def test_join_with_films_that_are_there(spark, tmp_path):
    films = materialize(spark.createDataFrame([(1, "A"), (2, "B")], "id long, original_title string"))
    ratings = spark.createDataFrame([(1, 4.0), (3, 1.0), (1, 5.0)], "movie_id long, rating double")
    write(ratings, tmp_path / "in")
    stream = jobs.open_stream(spark, str(tmp_path / "in"), ratings.schema)
    joined = run(spark, joins.join_ratings(stream, films), tmp_path)
    assert sorted(map(tuple, joined.collect())) == sorted(
        map(tuple, joins.join_ratings(ratings, films).collect()))
    credits = spark.createDataFrame([(1, ["x"]), (3, ["y"])], "id long, cast array<string>")
    write(credits, tmp_path / "credits")
    stream = jobs.open_stream(spark, str(tmp_path / "credits"), credits.schema)
    kept = run(spark, joins.join_credits(stream, films), tmp_path, "semi")
    assert [tuple(r) for r in kept.collect()] == [(1, ["x"])]


def test_stages_take_streams(spark, tmp_path):
    rows = [(1, "T", "2005-01-01", 10, 5.0, [("", "Argentina")], [], "a great film"),
            (2, "U", "2005-01-01", None, 5.0, [("", "Argentina")], [], "a bad film"),
            (3, "V", "1999-01-01", 10, 5.0, [("", "Chile")], [], "")]
    films = spark.createDataFrame(rows, S.CLEAN_MOVIE)
    write(films, tmp_path / "in")

    def stages(df):
        return (
            clean.clean_movies(df)
            .filter(filters.released_after(1990))
            .select("id", sentiment.sentiment(F.col("overview")).alias("sentiment"),
                    filters.in_country("Argentina").alias("home")))

    stream = stages(jobs.open_stream(spark, str(tmp_path / "in"), films.schema))
    got = sorted(map(tuple, run(spark, stream, tmp_path).collect()))
    assert got == sorted(map(tuple, stages(films).collect())) == [
        (1, "positive", True), (3, "neutral", False)]


@pytest.mark.parametrize("again", [False, True])
def test_sink_batches_are_overwritten_on_replay(spark, tmp_path, again):
    """Without its state the same input is delivered again as batch 0."""
    rows = spark.createDataFrame([("AR", 1)], "country string, budget long")
    write(rows, tmp_path / "in")
    for state in ["s1", "s2"][:1 + again]:
        stream = jobs.open_stream(spark, str(tmp_path / "in"), rows.schema)
        jobs.run_updates(stream, str(tmp_path / "out"), str(tmp_path / state))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
