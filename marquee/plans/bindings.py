"""Every operator bound to the given tables: name -> (spark, sf_dir) -> DataFrame.

All of them read their whole tables.  Nested results are shown as joined text and
doubles are rounded, so that they can be compared with a second engine.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions import casts, json_text, sentiment, text
from marquee.operators import (
    aggregates, clean, compare, dedup, filters, joins, quality, ranking,
)
from marquee.plans import film_queries as film
from marquee.plans import table_views as views
from marquee.plans.table_views import PRIORITIES, table
from marquee.session import many_tasks, scratch_path
from marquee.sources.films import decode_credits, decode_movies, read_movies, read_ratings, write_csv

HOME, PARTNER = "NATION_18", "NATION_3"

# The texts are invented and hold hardly any word of feeling, so common words carry the score.
LEXICON = {"the": 0.5, "of": -0.6, "is": 0.9, "was": -0.8, "with": 0.3}

#: The tenant columns of the ``..._by_tenant`` questions.
BY = ("client_id",)

RULES = film.Rules(country=HOME, partner=PARTNER, lexicon=LEXICON)

RANGES = ((0, 586, 1), (587, 1345, 2), (1346, 2611, 3), (2612, 4466, 4), (4467, 20000, 5))
BUCKETS = 8

HEAD_PERCENT = 20


def piped(names: Column) -> Column:
    return F.array_join(names, "|", "")


def _films(spark, sf_dir, overview=False, genres=False) -> DataFrame:
    return views.movies(spark, sf_dir, overview, genres)


def _clean(spark, sf_dir, overview=False, genres=False, by=()) -> DataFrame:
    return clean.clean_movies(_films(spark, sf_dir, overview, genres), by=by)


def _ratings(spark, sf_dir, by=()) -> DataFrame:
    return clean.clean_ratings(views.ratings(spark, sf_dir), by)


def _credits(spark, sf_dir, by=()) -> DataFrame:
    return clean.clean_credits(views.credits(spark, sf_dir), by)


def _shown(films: DataFrame) -> DataFrame:
    return films.select("id", "original_title", "release_date",
                        piped(filters.country_names()).alias("countries"))


# --- decoding and cleaning -------------------------------------------------

def _literal(entries: Column, key: str) -> Column:
    """Nested names written the way the raw files hold them."""
    items = F.transform(entries, lambda e, i: F.concat(
        F.lit("{'" + key + "': "), (i + 1).cast("string"), F.lit(", 'name': '"), e["name"],
        F.lit("', 'note': None}")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def raw_movies(spark, sf_dir) -> DataFrame:
    """Films as the all-text rows of the raw file; every film whose first genre is
    ECONOMY lacks its popularity and must be rejected."""
    films = _films(spark, sf_dir, overview=True, genres=True)
    filled = {
        "adult": F.lit("False"), "budget": F.col("budget").cast("string"),
        "genres": _literal(F.col("genres"), "id"), "id": F.col("id").cast("string"),
        "original_title": F.col("original_title"), "title": F.col("original_title"),
        "overview": F.col("overview"), "release_date": F.col("release_date"),
        "popularity": F.when(text.first_name(F.col("genres")) == "ECONOMY", "").otherwise("1.5"),
        "production_countries": _literal(F.col("production_countries"), "iso_3166_1"),
        "revenue": F.col("revenue").cast("string"), "vote_average": F.lit("7.0"),
        "vote_count": F.lit("10"), "video": F.lit("True"),
        "belongs_to_collection": F.lit(
            r"{'id': 7, 'name': 'Caf\xe9', 'poster_path': None, 'backdrop_path': None}"),
    }
    return films.select(*[filled.get(c, F.lit("")).alias(c) for c in S.MOVIE.names])


def decode_movies_(spark, sf_dir):
    decoded = decode_movies(raw_movies(spark, sf_dir))
    return decoded.select(
        "id", "budget", "revenue", "release_date",
        piped(text.names_of(F.col("genres"))).alias("genres"),
        piped(filters.country_names()).alias("countries"),
        F.col("belongs_to_collection.name").alias("collection"), "video",
        F.char_length("overview").cast("bigint").alias("overview_chars"))


def read_movies_multiline(spark, sf_dir):
    """Films written to CSV files, whose overviews hold line breaks, quotes and commas, and
    read from them again."""
    path = scratch_path(spark, "films-csv")
    write_csv(raw_movies(spark, sf_dir), path, quote_all=True)
    return read_movies(spark, path).select(
        "id", "budget", "revenue", "release_date",
        piped(text.names_of(F.col("genres"))).alias("genres"),
        F.regexp_count("overview", F.lit("\n")).cast("bigint").alias("line_breaks"),
        F.char_length("overview").cast("bigint").alias("overview_chars"))


def decode_counts(spark, sf_dir):
    return clean.decode_counts(decode_movies(raw_movies(spark, sf_dir), keep_rejects=True), "movies")


def decode_credits_(spark, sf_dir):
    """Line items as raw credits lines: the cast holds the part's name, a member
    with a wrong key set (left out) and the brand in doubled quotes."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    member = ("{'cast_id': %s, 'character': 'O\\'Brien', 'credit_id': 'c', 'gender': None, "
              "'id': 1, 'name': %s, 'order': 0, 'profile_path': None}")
    cast = F.format_string(
        '"[' + member + ", {'name': 'no one'}, " + member + ']",[],%s',
        "l_linenumber", F.concat(F.lit("'"), F.col("p_name"), F.lit("'")),
        "l_linenumber", F.concat(F.lit('""'), F.col("p_brand"), F.lit('""')), "l_orderkey")
    # Dealt out while rows are short: decoding is the work, and joined rows fill only a few tasks.
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).repartition(many_tasks(spark))
    return decode_credits(joined.select(cast.alias("value"))).select(
        "id", piped(text.names_of(F.col("cast"))).alias("cast_names"),
        F.get("cast", F.lit(0))["cast_id"].alias("cast_id"),
        F.get("cast", F.lit(0))["character"].alias("role"),
        F.size("crew").cast("bigint").alias("crew_size"))


def decode_counts_by_file(spark, sf_dir):
    """Accepted and rejected rows of credits, of which some lack the id, and of ratings, of
    which some are no number."""
    lines = table(spark, sf_dir, "lineitem")
    credits = lines.select(F.when(F.col("l_orderkey") % 9 == 0, "[],[],").otherwise(
        F.concat(F.lit("[],[],"), F.col("l_orderkey").cast("string"))).alias("value"))
    path = scratch_path(spark, "ratings-csv")
    write_csv(table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"), F.col("event_id").alias("movieId"),
        F.when(F.col("event_id") % 9 == 0, "bad").otherwise(F.col("value").cast("string")).alias("rating"),
        F.lit("1425941529").alias("timestamp")), path)
    return clean.decode_counts(decode_credits(credits, keep_rejects=True), "credits").unionByName(
        clean.decode_counts(read_ratings(spark, path, keep_rejects=True), "ratings"))


def display_forms(spark, sf_dir):
    """Previews, defaults, joined names, money, message keys and times, of parts."""
    parts, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    return parts.select(
        "p_partkey", text.preview(F.repeat(F.concat("p_name", F.lit(" ")), F.col("p_size") % 9), 40).alias("preview"),
        text.or_default(F.when(F.col("p_size") > 25, F.col("p_type")), "none").alias("kind"),
        text.joined(F.split("p_name", " "), "; ").alias("names"), text.money(key * 1234).alias("price"),
        text.message_key(key, F.col("p_size"), F.lit(3)).alias("message"),
        F.date_format(casts.epoch_timestamp(key * 1000), "yyyy-MM-dd HH:mm:ss").alias("at"))


def clean_movies(spark, sf_dir):
    return clean.clean_movies(_films(spark, sf_dir, overview=True, genres=True)).select(
        "id", "original_title", "release_date", "budget", "revenue",
        piped(filters.country_names()).alias("countries"),
        piped(text.names_of(F.col("genres"))).alias("genres"), "overview")


def clean_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir).select("movie_id", F.col("rating").cast("double"))


def clean_credits(spark, sf_dir):
    return _credits(spark, sf_dir).select("id", piped(F.col("cast")).alias("cast_names"))


# --- filters and routes ----------------------------------------------------

def _filtered(test):
    return lambda spark, sf_dir: _shown(_clean(spark, sf_dir).filter(test()))


def filter_text_contains(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(filters.mentions(F.col("text"), "WITH")).select("doc_id", "lang", "source")


def filter_nonzero(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter(filters.non_zero("l_discount", "l_tax")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")


def route_categories(spark, sf_dir):
    routed = filters.route(_clean(spark, sf_dir), filters.production_routes(HOME, PARTNER))
    return routed.select("id", "route")


def route_sentiment(spark, sf_dir):
    label = sentiment.sentiment(F.col("text"), LEXICON)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentiment.with_feeling(docs, label).select("doc_id", "sentiment")


#: As with the lexicon, common words stand for modifiers and negations.
MODIFIERS, NEGATIONS = {"and": 1.5, "to": 0.6, "der": 1.25}, ("in", "la", "a")


def polarity_rules(spark, sf_dir):
    """Polarity with modifiers and negations in front of the words of feeling."""
    score = sentiment.polarity_with_rules(F.col("text"), LEXICON, MODIFIERS, NEGATIONS)
    return table(spark, sf_dir, "documents").select("doc_id", score.alias("polarity"))


def score_documents(spark, sf_dir):
    """The same polarity with the lexicon as a table of any size."""
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    scores = sentiment.polarity_by_table(table(spark, sf_dir, "documents"), "doc_id", "text", lexicon)
    return scores.select("doc_id", (F.round("polarity", 6) + 0.0).alias("polarity"))


def score_big_lexicon(spark, sf_dir):
    """A lexicon of many thousand words: the documents' words of even length, with a
    tenth of the length as polarity."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select(F.explode(sentiment.tokens(F.col("text"))).alias("word")).distinct()
    lexicon = words.filter(F.char_length("word") % 2 == 0).select(
        "word", (F.char_length("word") / 10.0).cast("double").alias("polarity"))
    scores = sentiment.polarity_by_table(docs, "doc_id", "text", lexicon)
    return scores.select("doc_id", (F.round("polarity", 6) + 0.0).alias("polarity"))


# --- joins -----------------------------------------------------------------

def join_ratings(spark, sf_dir):
    return joins.join_ratings(_ratings(spark, sf_dir), _clean(spark, sf_dir)).withColumn(
        "rating", F.col("rating").cast("double"))


def join_credits_semi(spark, sf_dir):
    home = _clean(spark, sf_dir).filter(filters.in_country(HOME))
    return joins.join_credits(_credits(spark, sf_dir), home).select(
        "id", piped(F.col("cast")).alias("cast_names"))


def join_credits_inner(spark, sf_dir):
    home = _clean(spark, sf_dir).filter(filters.in_country(HOME))
    return joins.join_credits_inner(_credits(spark, sf_dir), home).select(
        "id", "original_title", piped(F.col("cast")).alias("cast_names"))


def dedup_build_side(spark, sf_dir):
    """Line items as repeated film rows of an order; the last line wins."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_linenumber",
        F.concat(F.lit("Part#"), F.col("l_partkey")).alias("original_title"))
    return joins.unique_by_key(rows, ["id"], order="l_linenumber")


def range_join(spark, sf_dir):
    """Line items to the dearest of the orders whose numbers up to 40 on cover theirs, which
    overlap; every seventh order covers nothing."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0")
    ranges = orders.select(
        F.col("o_orderkey").alias("low"), (F.col("o_orderkey") + F.col("o_custkey") % 40).alias("high"),
        (-F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("priority"),
        F.col("o_orderkey").alias("covered_by"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return joins.range_join(lines, ranges, "l_orderkey", value="covered_by")


def range_bucket(spark, sf_dir):
    bucket = joins.range_bucket(F.col("o_orderkey"), RANGES, BUCKETS)
    return table(spark, sf_dir, "orders").select("o_orderkey", bucket.alias("bucket"))


# --- aggregates, ranks, duplicates -----------------------------------------

def agg_avg_rating(spark, sf_dir):
    means = aggregates.mean_ratings(_ratings(spark, sf_dir), _clean(spark, sf_dir))
    return means.withColumn("rating", F.round("rating", 6))


def distinct_counts(spark, sf_dir):
    counts = [
        aggregates.distinct_count(table(spark, sf_dir, "orders"), "o_orderkey", "movies.id"),
        aggregates.distinct_count(views.ratings(spark, sf_dir), "movieId", "ratings.movieId"),
        aggregates.distinct_count(table(spark, sf_dir, "lineitem"), "l_orderkey", "credits.id"),
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def merge_partials(spark, sf_dir):
    """Sums stored per part and supplier, merged per supplier."""
    stored = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("rating_sum"),
        F.count("*").alias("rating_count"))
    return aggregates.merge_totals(stored, ["l_suppkey"], ["rating_sum", "rating_count"]).select(
        "l_suppkey", F.col("rating_sum").cast("double").alias("rating_sum"), "rating_count")


def head_percent(spark, sf_dir):
    return ranking.head_percent(
        table(spark, sf_dir, "orders"), HEAD_PERCENT, "o_orderkey").select(
        "o_orderkey", "o_totalprice")


def rank_titles(spark, sf_dir):
    titles = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("title"))
    return ranking.number_rows(titles, F.asc("title"))


def rank_actors(spark, sf_dir):
    counts = aggregates.appearances(_credits(spark, sf_dir))
    return ranking.number_few(counts, RULES.actors, F.desc("count"), F.asc("name")).select(
        F.col("position").cast("bigint").alias("position"), "name", "count")


def rank_spenders(spark, sf_dir):
    totals = aggregates.budget_by_country(_clean(spark, sf_dir).filter(filters.in_one_country()))
    return ranking.number_few(
        totals, RULES.countries, F.desc("total"), F.asc("country")).select(
        F.col("position").cast("bigint").alias("position"), "country",
        text.money(F.col("total")).alias("amount"))


def dedup_messages(spark, sf_dir):
    return dedup.dedup_messages(views.messages(table(spark, sf_dir, "events"))).select(
        "client_id", "queue", "message_id", "value")


def distinct_markers(spark, sf_dir):
    """Each event as an end marker of its type's node for its user; most come many times."""
    markers = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client_id"), F.lit("events").alias("queue"), F.col("event_type").alias("node_id"),
        "event_id")
    return dedup.distinct_markers(markers)


def dedup_results(spark, sf_dir):
    """Answers sent twice, the second time with other white space."""
    sent = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("query_id"), F.col("props").alias("results"))
    again = sent.withColumn("results", F.replace("results", F.lit(":"), F.lit(" :  ")))
    return dedup.dedup_results(sent.unionByName(again)).select(
        "query_id", json_text.canonical_json(F.col("results")).alias("results"))


# --- questions -------------------------------------------------------------

def q1_coproduction_genres(spark, sf_dir):
    return film.q1(_clean(spark, sf_dir, genres=True), RULES).select(
        "title", piped(F.col("genres")).alias("genres"))


def q2_top_solo(spark, sf_dir):
    return film.q2(_clean(spark, sf_dir), RULES)


def q2_by_tenant(spark, sf_dir):
    return film.q2(_clean(spark, sf_dir, by=BY), RULES, by=BY)


def q1_by_tenant(spark, sf_dir):
    return film.q1(_clean(spark, sf_dir, genres=True, by=BY), RULES, BY).select(
        *BY, "title", piped(F.col("genres")).alias("genres"))


def q3_by_tenant(spark, sf_dir):
    recent = film.recent_films(_clean(spark, sf_dir, by=BY), RULES, BY)
    return film.q3(recent, _ratings(spark, sf_dir, BY), BY).withColumn("rating", F.round("rating", 6))


def q4_by_tenant(spark, sf_dir):
    recent = film.recent_films(_clean(spark, sf_dir, by=BY), RULES, BY)
    return film.q4(recent, _credits(spark, sf_dir, BY), RULES, BY)


def q5_by_tenant(spark, sf_dir):
    rates = film.q5(_clean(spark, sf_dir, overview=True, by=BY), RULES, BY)
    return rates.select(*BY, *[F.round(c, 6).alias(c) for c in rates.columns if c not in BY])


def envelopes_by_tenant(spark, sf_dir):
    """Answers to Q2 and Q4 as one document per tenant."""
    films = _clean(spark, sf_dir, by=BY)
    recent = film.recent_films(films, RULES, BY)
    answers = {"Q2": film.q2(films, RULES, BY), "Q4": film.q4(recent, _credits(spark, sf_dir, BY), RULES, BY)}
    return film.envelopes(answers)


# The looser variant of the questions: country as a substring, the year itself, zero revenue out.
LOOSE = dataclasses.replace(film.NOTEBOOK, country="nation_1", partner=PARTNER, lexicon=LEXICON)


def notebook_q1(spark, sf_dir):
    return film.q1(_clean(spark, sf_dir, genres=True), LOOSE).select("title", piped(F.col("genres")).alias("genres"))


def notebook_q3(spark, sf_dir):
    recent = film.recent_films(_clean(spark, sf_dir), LOOSE)
    return film.q3(recent, _ratings(spark, sf_dir)).withColumn("rating", F.round("rating", 6))


def notebook_q4(spark, sf_dir):
    return film.q4(film.recent_films(_clean(spark, sf_dir), LOOSE), _credits(spark, sf_dir), LOOSE)


def notebook_q5(spark, sf_dir):
    rates = film.q5(_clean(spark, sf_dir, overview=True), LOOSE)
    return rates.select(*[F.round(c, 6).alias(c) for c in rates.columns])


def q3_rating_extremes(spark, sf_dir):
    recent = film.recent_films(_clean(spark, sf_dir), RULES)
    return film.q3(recent, _ratings(spark, sf_dir)).withColumn("rating", F.round("rating", 6))


def q4_top_actors(spark, sf_dir):
    recent = film.recent_films(_clean(spark, sf_dir), RULES)
    return film.q4(recent, _credits(spark, sf_dir), RULES)


def q5_sentiment_rates(spark, sf_dir):
    rates = film.q5(_clean(spark, sf_dir, overview=True), RULES)
    return rates.select(*[F.round(c, 6).alias(c) for c in rates.columns])


# --- comparison and quality ------------------------------------------------

def _orders_per_customer(spark, sf_dir, done: bool) -> DataFrame:
    """Finished (status F) or all other orders."""
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    orders = table(spark, sf_dir, "orders").filter(finished if done else ~finished)
    return orders.groupBy(F.col("o_custkey").alias("name")).agg(F.count("*").alias("count"))


def diff_rows(spark, sf_dir):
    diff = compare.diff_rows(_orders_per_customer(spark, sf_dir, True),
                             _orders_per_customer(spark, sf_dir, False), ["name"])
    return diff.select("name", F.col("expected.count").alias("expected"),
                       F.col("obtained.count").alias("obtained"), "status")


def diff_actors(spark, sf_dir):
    """The busiest actors as two answers have them: over all credits, and over those of
    every other line of an order."""
    recent = film.recent_films(_clean(spark, sf_dir), RULES)
    credits = views.credits(spark, sf_dir)
    some = credits.where(F.col("client_id").isin("1-URGENT", "3-MEDIUM", "5-LOW"))
    sides = [film.envelopes({"Q4": film.q4(recent, clean.clean_credits(c), RULES)}, "any") for c in (credits, some)]
    want, got = (compare.actor_rows(side.drop("client_id")) for side in sides)
    return compare.diff_rows(want, got, ["name"]).select(
        "name", F.col("expected.count").alias("expected"), F.col("obtained.count").alias("obtained"), "status")


def _customer_names(spark, sf_dir, done: bool) -> DataFrame:
    return _orders_per_customer(spark, sf_dir, done).select("name")


def set_missing(spark, sf_dir):
    return compare.missing_names(
        _customer_names(spark, sf_dir, True), _customer_names(spark, sf_dir, False))


def set_common(spark, sf_dir):
    return compare.common_names(
        _customer_names(spark, sf_dir, True), _customer_names(spark, sf_dir, False))


def missing_queries(spark, sf_dir):
    answers = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("client_id"), F.col("o_orderpriority").alias("query_id"))
    return compare.missing_queries(answers, PRIORITIES)


def normalize_results(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("name"),
        F.split("p_name", " ").alias("words"), (F.col("p_retailprice") / 7).alias("price"))
    return compare.normalize(rows).withColumn("words", piped(F.col("words")))


# The event types, standing in for query ids; "refund" never occurs.
EVENT_TYPES = ("click", "error", "purchase", "refund", "signup", "view")


def compare_runs(spark, sf_dir):
    """Per event type the largest ``k`` is expected; each user's own largest ``k``
    is what was obtained."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", k.alias("k"))
    expected = events.groupBy(F.col("event_type").alias("query_id")).agg(
        F.format_string('{ "k" : %s }', F.max("k")).alias("results"))
    obtained = events.groupBy(
        F.col("user_id").alias("client_id"), F.col("event_type").alias("query_id")).agg(
        F.format_string('{"k":%s}', F.max("k")).alias("results"))
    return compare.compare_answers(expected, obtained, EVENT_TYPES)


def json_required_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return quality.with_missing_keys(events, "props", ["k", "client_id"]).select(
        "event_id", piped(F.col("missing")).alias("missing"))


def quarantine_split(spark, sf_dir):
    """Bodies under nine bytes are too small, those of errors are cut short, those
    of views lack the key."""
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "error", F.substring_index(props, "}", 1))
        .when(kind == "view", F.replace(props, F.lit('"k"'), F.lit('"n"')))
        .otherwise(props)
    )
    events = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return quality.quarantine(events, "body", ["k"], min_bytes=9).select("event_id", "verdict")


def inspect_json(spark, sf_dir):
    """Bodies of errors lack the closing brace, those of views have a comma too many."""
    kind, props = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "error", F.substring_index(props, "}", 1))
        .when(kind == "view", F.replace(props, F.lit("}"), F.lit(",}")))
        .when(kind == "click", F.lit("{k")).otherwise(props)
    )
    report = quality.inspect(table(spark, sf_dir, "events").select("event_id", body.alias("raw")))
    return report.select(
        "event_id", F.col("bytes").cast("bigint").alias("bytes"), "readable", "valid_json",
        "repaired", F.col("structure.kind").alias("kind"),
        piped(F.col("structure.keys")).alias("keys"), F.size("issues").cast("bigint").alias("issues"),
        F.col("structure.schema").alias("schema"), F.col("fault.position").alias("fault_at"),
        F.col("fault.line").alias("fault_line"))


def profile_table(spark, sf_dir):
    return quality.profile(table(spark, sf_dir, "lineitem")).select("field", "rows", "non_null")


BATCH = {
    "decode_movies": decode_movies_,
    "decode_credits": decode_credits_,
    "read_movies_multiline": read_movies_multiline,
    "decode_counts": decode_counts,
    "decode_counts_by_file": decode_counts_by_file,
    "display_forms": display_forms,
    "clean_movies": clean_movies,
    "clean_ratings": clean_ratings,
    "clean_credits": clean_credits,
    "filter_country": _filtered(lambda: filters.in_country(HOME)),
    "filter_solo_country": _filtered(filters.in_one_country),
    "filter_coproduction": _filtered(lambda: filters.in_all_countries([HOME, PARTNER])),
    "filter_year_after": _filtered(lambda: filters.released_after(2000)),
    "filter_year_range": _filtered(lambda: filters.released_between(2000, 2009)),
    "filter_text_contains": filter_text_contains,
    "filter_nonzero": filter_nonzero,
    "route_categories": route_categories,
    "route_sentiment": route_sentiment,
    "polarity_rules": polarity_rules,
    "score_documents": score_documents,
    "score_big_lexicon": score_big_lexicon,
    "join_ratings": join_ratings,
    "join_credits_semi": join_credits_semi,
    "join_credits_inner": join_credits_inner,
    "dedup_build_side": dedup_build_side,
    "range_join": range_join,
    "range_bucket": range_bucket,
    "agg_avg_rating": agg_avg_rating,
    "distinct_counts": distinct_counts,
    "merge_partials": merge_partials,
    "head_percent": head_percent,
    "rank_titles": rank_titles,
    "rank_actors": rank_actors,
    "rank_spenders": rank_spenders,
    "dedup_messages": dedup_messages,
    "dedup_results": dedup_results,
    "distinct_markers": distinct_markers,
    "diff_actors": diff_actors,
    "q1_coproduction_genres": q1_coproduction_genres,
    "q2_top_solo": q2_top_solo,
    "q1_by_tenant": q1_by_tenant,
    "q2_by_tenant": q2_by_tenant,
    "q3_by_tenant": q3_by_tenant,
    "q4_by_tenant": q4_by_tenant,
    "q5_by_tenant": q5_by_tenant,
    "envelopes_by_tenant": envelopes_by_tenant,
    "notebook_q1": notebook_q1,
    "notebook_q3": notebook_q3,
    "notebook_q4": notebook_q4,
    "notebook_q5": notebook_q5,
    "q3_rating_extremes": q3_rating_extremes,
    "q4_top_actors": q4_top_actors,
    "q5_sentiment_rates": q5_sentiment_rates,
    "diff_rows": diff_rows,
    "set_missing": set_missing,
    "set_common": set_common,
    "missing_queries": missing_queries,
    "normalize_results": normalize_results,
    "compare_runs": compare_runs,
    "json_required_keys": json_required_keys,
    "quarantine_split": quarantine_split,
    "inspect_json": inspect_json,
    "profile_table": profile_table,
}
