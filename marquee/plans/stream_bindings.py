"""Streaming operators bound to the given tables, read as file streams.

Each runs to the end of the available input and returns what its sink holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import clean, filters, joins
from marquee.plans import table_views as views
from marquee.plans import film_queries as film
from marquee.plans.bindings import BY, EVENT_TYPES, HOME, RULES, piped
from marquee.plans.table_views import table
from marquee.session import materialize, scratch_path
from marquee.streaming import jobs, snapshots, stateful


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return jobs.open_stream(spark, sf_dir, schema, pattern=f"{name}.parquet")


def _through_files(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    sink = scratch_path(spark, label)
    jobs.run_to_files(stream, sink, scratch_path(spark, f"{label}-state"))
    return spark.read.schema(stream.schema).parquet(sink)


def stream_dedup(spark, sf_dir):
    """Three deliveries, latest third first, each with all that came before once
    more, and a restart after each."""
    messages = views.messages(table(spark, sf_dir, "events")).withColumn(
        "third", F.pmod(F.dayofyear("sent_at"), F.lit(3)))
    inbox, sink, state = (scratch_path(spark, n) for n in ("messages", "dedup", "dedup-state"))
    third = F.coalesce(F.col("third"), F.lit(0))
    for least in (2, 1, 0):
        messages.filter(third >= least).drop("third").write.mode("append").parquet(inbox)
        stream = jobs.open_stream(spark, inbox, messages.drop("third").schema)
        single = jobs.dedup_stream(stream).select("client_id", "queue", "message_id", "value")
        jobs.run_to_files(single, sink, state)
    return spark.read.parquet(sink)


def stream_complete(spark, sf_dir):
    """Every event is the end marker of the node named by its type; a user is
    complete after all five."""
    markers = _stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("client_id"),
        F.lit("events").alias("queue"), F.col("event_type").alias("node_id"))
    nodes = len(EVENT_TYPES) - 1
    return _through_files(spark, jobs.completions(markers, ["events"], nodes), "complete")


def stream_partial_restart(spark, sf_dir):
    """Running totals per user over two deliveries with a restart in between; the
    second run goes on from the saved state.  The sink holds the current rows, compacted."""
    events = table(spark, sf_dir, "events").select(
        "user_id", F.col("value").cast("decimal(12,2)").alias("value"), "event_type")
    first = F.coalesce(F.col("event_type").isin("click", "view"), F.lit(False))
    inbox = scratch_path(spark, "inbox")
    sink, state = scratch_path(spark, "totals"), scratch_path(spark, "totals-state")
    for delivery in (events.filter(first), events.filter(~first)):
        delivery.select("user_id", "value").write.mode("append").parquet(inbox)
        totals = jobs.open_stream(
            spark, inbox, events.select("user_id", "value").schema, files_per_batch=1
        ).groupBy("user_id").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
        snapshots.run_snapshots(totals, sink, state, ["user_id"])
    return snapshots.current(spark, sink, totals.schema, ["user_id"]).select(
        "user_id", F.col("total").cast("double").alias("total"), "n")


def stream_semi_join(spark, sf_dir):
    """Credits arriving as a stream against films that are already there."""
    credits = _stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_partkey", "l_linenumber")
    films = clean.clean_movies(views.movies(spark, sf_dir, overview=False, genres=False))
    # Written once: each micro-batch reads the selected films, not what they come from.
    home = materialize(films.filter(filters.in_country(HOME)).select("id"), "home-films")
    return _through_files(spark, joins.join_credits(credits, home), "semi")


def stream_clean(spark, sf_dir):
    ratings = clean.clean_ratings(views.rating_rows(_stream(spark, sf_dir, "events")))
    return _through_files(
        spark, ratings.select("movie_id", F.col("rating").cast("double")), "clean")


def _deliver(spark, parts, inbox: str):
    """Tables appended to a folder of files one after the other; gives back after each."""
    for part in parts:
        part.write.mode("append").parquet(inbox)
        yield jobs.open_stream(spark, inbox, part.schema)


def stream_dedup_ttl(spark, sf_dir):
    """The deliveries of ``stream_dedup``, with keys that are forgotten an hour after their
    last delivery: a late first delivery still comes through, and no repeat does."""
    messages = views.messages(table(spark, sf_dir, "events"))
    third = F.coalesce(F.pmod(F.dayofyear("sent_at"), F.lit(3)), F.lit(0))
    inbox, sink, state = (scratch_path(spark, n) for n in ("messages", "dedup", "dedup-state"))
    with stateful.rocksdb(spark):
        for stream in _deliver(spark, (messages.filter(third >= least) for least in (2, 1, 0)), inbox):
            single = stateful.dedup_within(stream, span_ms=3_600_000)
            jobs.run_once(single.select("client_id", "queue", "message_id", "value"), sink, state)
    return spark.read.parquet(sink)


#: Nodes that send a client's rows in turn, and the client whose last end marker is lost.
NODES, UNFINISHED = 3, "5-LOW"


def _ends(spark, node: int, clients: DataFrame) -> DataFrame:
    """The node's end marker for each client, but for one client's last."""
    marks = clients.select("client_id", F.lit(str(node)).alias("node"))
    return marks.filter((F.col("client_id") != UNFINISHED) | (F.col("node") != str(NODES - 1)))


def _answered(spark, rows: DataFrame, question, most: int) -> DataFrame:
    """Rows of three nodes, delivered one node at a time, each with a restart and followed by
    the node's end markers; ``question`` turns the stream into records."""
    rows = materialize(rows.withColumn("_node", F.pmod("id", F.lit(NODES))), "deliveries")
    clients = materialize(rows.select("client_id").distinct(), "clients")
    records, ends, sink, state = (scratch_path(spark, n) for n in ("records", "ends", "answers", "answers-state"))
    parts = [rows.filter(F.col("_node") == node).drop("_node") for node in range(NODES)]
    with stateful.rocksdb(spark):
        for stream, marks in zip(_deliver(spark, parts, records),
                                 _deliver(spark, [_ends(spark, n, clients) for n in range(NODES)], ends)):
            totals = stateful.totals_on_completion(question(stream), marks, NODES, most)
            jobs.run_to_files(totals, sink, state)
    return stateful.largest(spark.read.schema(totals.schema).parquet(sink), most)


def stream_q2_by_client(spark, sf_dir):
    """Countries that spent most on films of their own, per client, when its films are in."""
    def question(films: DataFrame) -> DataFrame:
        return films.filter(filters.in_one_country()).select(
            "client_id", filters.country_names()[0].alias("item"), F.col("budget").alias("amount"))

    films = clean.clean_movies(views.movies(spark, sf_dir, overview=False, genres=False), by=BY)
    return _answered(spark, films, question, RULES.countries).select(
        "client_id", F.col("item").alias("country"), "total")


def stream_q4_by_client(spark, sf_dir):
    """Busiest actors of the country's recent films, per client, when its credits are in."""
    films = clean.clean_movies(views.movies(spark, sf_dir, overview=False, genres=False), by=BY)
    recent = materialize(film.recent_films(films, RULES, BY), "recent-films")

    def question(credits: DataFrame) -> DataFrame:
        cast = joins.join_credits(credits, recent, BY).select("client_id", F.explode("cast").alias("item"))
        return cast.filter("item <> ''").withColumn("amount", F.lit(1))

    credits = clean.clean_credits(views.credits(spark, sf_dir), by=BY)
    return _answered(spark, credits, question, RULES.actors).select(
        "client_id", F.col("item").alias("name"), F.col("n").alias("count"))


def stream_join_barrier(spark, sf_dir):
    """Credits that arrive before the films: they wait until both parts of the films have ended."""
    credits = materialize(clean.clean_credits(views.credits(spark, sf_dir)), "credits")
    films = clean.clean_movies(views.movies(spark, sf_dir, overview=False, genres=False))
    home = materialize(films.filter(filters.in_country(HOME)).select("id"), "home-films")
    second = F.pmod("id", F.lit(2)) == 1
    nothing = home.limit(0)
    marks = spark.createDataFrame([("0",), ("1",)], "node string")
    parts = [  # credits, films, end markers of each delivery
        (credits.filter(~second), nothing, marks.limit(0)),
        (credits.limit(0), home.filter(second), marks.filter("node = '0'")),
        (credits.filter(second), home.filter(~second), marks.filter("node = '1'"))]
    boxes = [scratch_path(spark, n) for n in ("probe", "build", "ends")]
    sink, state = scratch_path(spark, "joined"), scratch_path(spark, "joined-state")
    with stateful.rocksdb(spark):
        for probe, build, ends in zip(*[_deliver(spark, [p[k] for p in parts], box) for k, box in enumerate(boxes)]):
            joined = stateful.join_behind_barrier(probe, build, ends, nodes=2)
            jobs.run_to_files(joined, sink, state)
    return spark.read.schema(joined.schema).parquet(sink).select("id", piped(F.col("cast")).alias("cast_names"))


STREAMS = {
    "stream_dedup_ttl": stream_dedup_ttl,
    "stream_q2_by_client": stream_q2_by_client,
    "stream_q4_by_client": stream_q4_by_client,
    "stream_join_barrier": stream_join_barrier,
    "stream_dedup": stream_dedup,
    "stream_complete": stream_complete,
    "stream_partial_restart": stream_partial_restart,
    "stream_semi_join": stream_semi_join,
    "stream_clean": stream_clean,
}
