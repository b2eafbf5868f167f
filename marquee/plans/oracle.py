"""The same answers in SQL over the same tables, for a second engine."""

from __future__ import annotations

from marquee.plans.bindings import (
    BUCKETS, EVENT_TYPES, HEAD_PERCENT, HOME, LEXICON, LOOSE, MODIFIERS, NEGATIONS, PARTNER, PRIORITIES,
    RANGES,
)
from marquee.plans.table_views import EVENTS_PER_FILM

MOVIES = """
movies_v AS (
  SELECT o_orderkey AS id, 'Order#' || o_orderkey AS original_title,
         strftime(o_orderdate, '%Y-%m-%d') AS release_date,
         year(o_orderdate) AS released,
         list_sort(list(DISTINCT n_name)) AS countries,
         list_sort(list(DISTINCT p_type)) AS genres,
         CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS budget,
         o_totalprice AS revenue, o_orderpriority AS client_id,
         coalesce((SELECT max(text) FROM documents WHERE doc_id = o_orderkey), '') AS overview
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    JOIN part ON p_partkey = l_partkey
  GROUP BY o_orderkey, o_orderdate, o_totalprice, o_orderpriority)"""

def _tenant(number: str) -> str:
    return f"list_extract({list(PRIORITIES)}, CAST({number} % {len(PRIORITIES)} AS INTEGER) + 1)"


RATINGS = f"""
ratings_v AS (
  SELECT user_id, event_id // {EVENTS_PER_FILM} AS movie_id,
         CAST(value AS DECIMAL(12,2)) AS rating, {_tenant('user_id')} AS client_id
  FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND value IS NOT NULL)"""

CREDITS = f"""
credits_v AS (
  SELECT l_orderkey AS id, {_tenant('l_linenumber')} AS client_id,
         list_filter([p_name, p_brand, CASE WHEN p_size <= 25 THEN p_type ELSE '' END],
                     lambda x: coalesce(x, '') <> '') AS names
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

_IN_HOME = f"list_contains(countries, '{HOME}')"
_IN_BOTH = f"{_IN_HOME} AND list_contains(countries, '{PARTNER}')"
_SHOWN = "id, original_title, release_date, array_to_string(countries, '|') AS countries"


def _films(sql: str, *more: str) -> str:
    return f"WITH {', '.join([MOVIES, *more])} {sql}"


def _filtered(test: str) -> str:
    return _films(f"SELECT {_SHOWN} FROM movies_v WHERE {test}")


_LEXICON = "lex(word, polarity) AS (VALUES {})".format(
    ", ".join(f"('{w}', CAST({p} AS DOUBLE))" for w, p in LEXICON.items()))


WORD = r"[\p{L}\p{N}]+(?:''[\p{L}\p{N}]+)*"
_TOTAL = " + ".join(f"CAST({v} AS DOUBLE) * count(*) FILTER (polarity = CAST({v} AS DOUBLE))"
                    for v in sorted(set(LEXICON.values())))


def _scores(source: str, key: str, text: str) -> str:
    return f"""{_LEXICON},
tokens AS (SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '{WORD}')) AS word
           FROM {source}),
scores AS (SELECT k, ({_TOTAL}) / count(*) AS polarity FROM tokens JOIN lex USING (word) GROUP BY k)"""


_CLASS = ("CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' "
          "ELSE 'neutral' END")
_RECENT = f"recent AS (SELECT * FROM movies_v WHERE {_IN_HOME} AND released > 2000)"
_MEANS = """means AS (
  SELECT id, original_title, CAST(sum(rating) AS DOUBLE) / count(*) AS rating
  FROM recent JOIN ratings_v ON movie_id = id GROUP BY id, original_title)"""
_TENANT_MEANS = """tenant_means AS (
  SELECT r.client_id, id, original_title, CAST(sum(rating) AS DOUBLE) / count(*) AS rating
  FROM recent r JOIN ratings_v v ON movie_id = id AND v.client_id = r.client_id GROUP BY ALL)"""
_TENANT_ACTORS = """tenant_actors AS (
  SELECT client_id, name, "count" FROM (
    SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY "count" DESC, name) AS rn FROM (
      SELECT client_id, name, count(*) AS "count" FROM (
        SELECT c.client_id, unnest(names) AS name
        FROM credits_v c JOIN recent r ON c.id = r.id AND c.client_id = r.client_id) GROUP BY ALL))
  WHERE rn <= 10)"""
_LOOSE_HOME = f"len(list_filter(countries, lambda x: contains(lower(x), '{LOOSE.country.lower()}'))) > 0"
_LOOSE_PARTNER = f"len(list_filter(countries, lambda x: contains(lower(x), '{LOOSE.partner.lower()}'))) > 0"
_LOOSE_RECENT = f"recent AS (SELECT * FROM movies_v WHERE {_LOOSE_HOME} AND released >= 2000)"
_SOLO = """totals AS (
  SELECT countries[1] AS country, CAST(sum(budget) AS BIGINT) AS total
  FROM movies_v WHERE len(countries) = 1 GROUP BY ALL)"""


_DONE, _OPEN = "o_orderstatus IS NOT DISTINCT FROM 'F'", "o_orderstatus IS DISTINCT FROM 'F'"


def _per_customer(test: str) -> str:
    return f"(SELECT o_custkey AS name, count(*) AS n FROM orders WHERE {test} GROUP BY o_custkey)"


_MESSAGES = """messages AS (
  SELECT CAST(user_id AS VARCHAR) AS client_id, event_type AS queue, event_id AS message_id, value
  FROM events)"""

SQL = {
    "decode_movies": _films("""
SELECT id, budget, revenue, release_date, array_to_string(genres, '|') AS genres,
       array_to_string(countries, '|') AS countries, 'Café' AS collection, true AS video,
       CAST(length(overview) AS BIGINT) AS overview_chars
FROM movies_v WHERE genres[1] <> 'ECONOMY'"""),
    "read_movies_multiline": _films("""
SELECT id, budget, revenue, release_date, array_to_string(genres, '|') AS genres,
       CAST(length(overview) - length(replace(overview, chr(10), '')) AS BIGINT) AS line_breaks,
       CAST(length(overview) AS BIGINT) AS overview_chars
FROM movies_v WHERE genres[1] <> 'ECONOMY'"""),
    "decode_counts": _films("""
SELECT 'movies' AS record, count(*) FILTER (genres[1] <> 'ECONOMY') AS accepted,
       count(*) FILTER (genres[1] = 'ECONOMY') AS rejected FROM movies_v"""),
    "decode_credits": """
SELECT l_orderkey AS id, p_name || '|' || p_brand AS cast_names,
       CAST(l_linenumber AS BIGINT) AS cast_id, 'O''Brien' AS role, CAST(0 AS BIGINT) AS crew_size
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "clean_movies": _films("""
SELECT id, original_title, release_date, budget, revenue,
       array_to_string(countries, '|') AS countries, array_to_string(genres, '|') AS genres, overview
FROM movies_v"""),
    "clean_ratings": f"WITH {RATINGS} SELECT movie_id, CAST(rating AS DOUBLE) AS rating FROM ratings_v",
    "clean_credits": f"WITH {CREDITS} SELECT id, array_to_string(names, '|') AS cast_names FROM credits_v",
    "filter_country": _filtered(_IN_HOME),
    "filter_solo_country": _filtered("len(countries) = 1"),
    "filter_coproduction": _filtered(_IN_BOTH),
    "filter_year_after": _filtered("released > 2000"),
    "filter_year_range": _filtered("released BETWEEN 2000 AND 2009"),
    "filter_text_contains":
        "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'with')",
    "filter_nonzero": """
SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
WHERE l_discount <> 0 AND l_tax <> 0""",
    "route_categories": _films(f"""
SELECT id, 'country' AS route FROM movies_v WHERE {_IN_HOME}
UNION ALL SELECT id, 'solo' FROM movies_v WHERE len(countries) = 1
UNION ALL SELECT id, 'coproduction' FROM movies_v WHERE {_IN_BOTH}"""),
    "route_sentiment": f"""
WITH {_scores('documents', 'doc_id', 'text')}
SELECT k AS doc_id, {_CLASS} AS sentiment FROM scores WHERE {_CLASS} <> 'neutral'""",
    "score_documents": f"""
WITH {_scores('documents', 'doc_id', 'text')}
SELECT DISTINCT doc_id, round(coalesce(polarity, 0.0), 6) + 0.0 AS polarity
FROM documents LEFT JOIN scores ON k = doc_id""",
    "score_big_lexicon": f"""
WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD}')) AS word FROM documents),
scores AS (SELECT doc_id, sum(length(word)) / (10.0 * count(*)) AS polarity FROM tokens
           WHERE length(word) % 2 = 0 GROUP BY doc_id)
SELECT DISTINCT doc_id, round(CAST(coalesce(polarity, 0.0) AS DOUBLE), 6) + 0.0 AS polarity
FROM documents LEFT JOIN scores USING (doc_id)""",
    "join_ratings": _films("""
SELECT id, original_title, CAST(rating AS DOUBLE) AS rating
FROM ratings_v JOIN movies_v ON id = movie_id""", RATINGS),
    "join_credits_semi": _films(f"""
SELECT id, array_to_string(names, '|') AS cast_names FROM credits_v
WHERE id IN (SELECT id FROM movies_v WHERE {_IN_HOME})""", CREDITS),
    "join_credits_inner": _films(f"""
SELECT id, original_title, array_to_string(names, '|') AS cast_names
FROM credits_v JOIN movies_v USING (id) WHERE {_IN_HOME}""", CREDITS),
    "dedup_build_side": """
SELECT id, l_linenumber, original_title FROM (
  SELECT l_orderkey AS id, l_linenumber, 'Part#' || l_partkey AS original_title,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber DESC, 'Part#' || l_partkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
    "range_bucket": f"""
WITH ranges(low, high, bucket) AS (VALUES {', '.join(str(r) for r in RANGES)})
SELECT o_orderkey, CAST(coalesce(bucket, o_orderkey % {BUCKETS} + 1) AS BIGINT) AS bucket
FROM orders LEFT JOIN ranges ON o_orderkey BETWEEN low AND high""",
    "agg_avg_rating": _films("""
SELECT id, original_title, count(*) AS rating_count,
       round(CAST(sum(rating) AS DOUBLE) / count(*), 6) AS rating
FROM ratings_v JOIN movies_v ON id = movie_id GROUP BY id, original_title""", RATINGS),
    "distinct_counts": f"""
SELECT 'movies.id' AS field, count(DISTINCT o_orderkey) AS distinct_values FROM orders
UNION ALL SELECT 'ratings.movieId', count(DISTINCT event_id // {EVENTS_PER_FILM}) FROM events
UNION ALL SELECT 'credits.id', count(DISTINCT l_orderkey) FROM lineitem""",
    "merge_partials": """
SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS rating_sum,
       count(*) AS rating_count FROM lineitem GROUP BY l_suppkey""",
    "head_percent": f"""
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
WHERE rn <= floor(n * ({HEAD_PERCENT} / 100))""",
    "rank_titles": """
SELECT title, row_number() OVER (ORDER BY title) AS position
FROM (SELECT 'Order#' || o_orderkey AS title FROM orders)""",
    "rank_actors": f"""
WITH {CREDITS}, counts AS (
  SELECT name, count(*) AS "count" FROM (SELECT unnest(names) AS name FROM credits_v) GROUP BY name)
SELECT row_number() OVER (ORDER BY "count" DESC, name) AS position, name, "count" FROM counts
ORDER BY position LIMIT 10""",
    "rank_spenders": _films("""
SELECT row_number() OVER (ORDER BY total DESC, country) AS position, country,
       '$ ' || replace(format('{:,}', total), ',', '.') AS amount
FROM totals ORDER BY position LIMIT 5""", _SOLO),
    "dedup_messages": f"WITH {_MESSAGES} SELECT * FROM messages",
    "dedup_results":
        "SELECT DISTINCT event_type AS query_id, replace(props, ' ', '') AS results FROM events",
    "q1_coproduction_genres": _films(f"""
SELECT original_title AS title, array_to_string(genres, '|') AS genres FROM movies_v
WHERE {_IN_BOTH} AND released BETWEEN 2000 AND 2009"""),
    "q2_top_solo": _films("""
SELECT country, total FROM totals ORDER BY total DESC, country LIMIT 5""", _SOLO),
    "q1_by_tenant": _films(f"""
SELECT client_id, original_title AS title, array_to_string(genres, '|') AS genres FROM movies_v
WHERE {_IN_BOTH} AND released BETWEEN 2000 AND 2009"""),
    "q3_by_tenant": _films("""
SELECT client_id, kind, title, round(rating, 6) AS rating FROM (
  SELECT client_id, 'highest' AS kind, original_title AS title, rating,
         row_number() OVER (PARTITION BY client_id ORDER BY rating DESC, id) AS rn FROM tenant_means
  UNION ALL
  SELECT client_id, 'lowest', original_title, rating,
         row_number() OVER (PARTITION BY client_id ORDER BY rating, id) FROM tenant_means)
WHERE rn = 1""", RATINGS, _RECENT, _TENANT_MEANS),
    "q4_by_tenant": _films("SELECT * FROM tenant_actors", CREDITS, _RECENT, _TENANT_ACTORS),
    "q5_by_tenant": _films(f"""
SELECT client_id,
       round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'positive'), 0), 6)
         AS average_positive_rate,
       round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'negative'), 0), 6)
         AS average_negative_rate
FROM movies_v JOIN scores ON k = id WHERE budget > 0 AND {_CLASS} <> 'neutral' GROUP BY client_id""",
        _scores("movies_v", "id", "overview")),
    "envelopes_by_tenant": _films("""
SELECT client_id, 'Q2' AS query_id,
       '[' || string_agg('["' || country || '","' || total || '"]', ',' ORDER BY total DESC, country) || ']' AS results
FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY total DESC, country) AS rn FROM (
    SELECT client_id, countries[1] AS country, CAST(sum(budget) AS BIGINT) AS total
    FROM movies_v WHERE len(countries) = 1 GROUP BY ALL))
WHERE rn <= 5 GROUP BY client_id
UNION ALL
SELECT client_id, 'Q4', '{"actors":[' || string_agg('{"name":"' || name || '","count":' || "count" || '}', ','
         ORDER BY "count" DESC, name) || ']}'
FROM tenant_actors GROUP BY client_id""", CREDITS, _RECENT, _TENANT_ACTORS),
    "notebook_q1": _films(f"""
SELECT original_title AS title, array_to_string(genres, '|') AS genres FROM movies_v
WHERE {_LOOSE_HOME} AND {_LOOSE_PARTNER} AND released BETWEEN 2000 AND 2009"""),
    "notebook_q3": _films("""
(SELECT 'highest' AS kind, original_title AS title, round(rating, 6) AS rating
 FROM means ORDER BY means.rating DESC, id LIMIT 1)
UNION ALL
(SELECT 'lowest', original_title, round(rating, 6)
 FROM means ORDER BY means.rating, id LIMIT 1)""", RATINGS, _LOOSE_RECENT, _MEANS),
    "notebook_q4": _films("""
SELECT name, count(*) AS "count" FROM (
  SELECT unnest(names) AS name FROM credits_v WHERE id IN (SELECT id FROM recent))
GROUP BY name ORDER BY "count" DESC, name LIMIT 10""", CREDITS, _LOOSE_RECENT),
    "notebook_q5": _films(f"""
SELECT round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'positive'), 0), 6)
         AS average_positive_rate,
       round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'negative'), 0), 6)
         AS average_negative_rate
FROM movies_v JOIN scores ON k = id WHERE budget <> 0 AND revenue <> 0 AND budget > 0""",
        _scores("movies_v", "id", "overview")),
    "q2_by_tenant": _films("""
SELECT client_id, country, total FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY total DESC, country) AS rn FROM (
    SELECT client_id, countries[1] AS country, CAST(sum(budget) AS BIGINT) AS total
    FROM movies_v WHERE len(countries) = 1 GROUP BY ALL))
WHERE rn <= 5"""),
    "q3_rating_extremes": _films("""
(SELECT 'highest' AS kind, original_title AS title, round(rating, 6) AS rating
 FROM means ORDER BY means.rating DESC, id LIMIT 1)
UNION ALL
(SELECT 'lowest', original_title, round(rating, 6)
 FROM means ORDER BY means.rating, id LIMIT 1)""", RATINGS, _RECENT, _MEANS),
    "q4_top_actors": _films("""
SELECT name, count(*) AS "count" FROM (
  SELECT unnest(names) AS name FROM credits_v WHERE id IN (SELECT id FROM recent))
GROUP BY name ORDER BY "count" DESC, name LIMIT 10""", CREDITS, _RECENT),
    "q5_sentiment_rates": _films(f"""
SELECT round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'positive'), 0), 6)
         AS average_positive_rate,
       round(coalesce(avg(revenue / budget) FILTER ({_CLASS} = 'negative'), 0), 6)
         AS average_negative_rate
FROM movies_v JOIN scores ON k = id WHERE budget > 0""",
        _scores("movies_v", "id", "overview")),
    "diff_rows": f"""
SELECT coalesce(e.name, o.name) AS name, e.n AS expected, o.n AS obtained,
       CASE WHEN o.name IS NULL THEN 'missing' WHEN e.name IS NULL THEN 'extra'
            ELSE 'changed' END AS status
FROM {_per_customer(_DONE)} e FULL OUTER JOIN {_per_customer(_OPEN)} o ON e.name = o.name
WHERE e.n IS DISTINCT FROM o.n""",
    "set_missing": f"""
SELECT o_custkey AS name FROM orders WHERE {_DONE} EXCEPT SELECT o_custkey FROM orders WHERE {_OPEN}""",
    "set_common": f"""
SELECT o_custkey AS name FROM orders WHERE {_DONE} INTERSECT SELECT o_custkey FROM orders WHERE {_OPEN}""",
    "missing_queries": f"""
SELECT client_id, query_id
FROM (SELECT DISTINCT o_custkey AS client_id FROM orders),
     (VALUES {', '.join(f"('{p}')" for p in PRIORITIES)}) ids(query_id)
EXCEPT SELECT o_custkey, o_orderpriority FROM orders""",
    "normalize_results": """
SELECT p_partkey, trim(p_name) AS name,
       array_to_string(list_sort(string_split(p_name, ' ')), '|') AS words,
       round_even(p_retailprice / 7, 4) AS price FROM part""",
    "compare_runs": f"""
WITH e AS (SELECT user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
want AS (SELECT event_type, max(k) AS k FROM e GROUP BY event_type),
got AS (SELECT user_id, event_type, max(k) AS k FROM e GROUP BY ALL)
SELECT user_id AS client_id, got.event_type AS query_id, 'anomalous' AS status
FROM got JOIN want USING (event_type) WHERE got.k <> want.k
UNION ALL
SELECT user_id, query_id, 'missing' FROM (
  SELECT user_id, query_id FROM (SELECT DISTINCT user_id FROM e),
    (VALUES {', '.join(f"('{t}')" for t in EVENT_TYPES)}) ids(query_id)
  EXCEPT SELECT user_id, event_type FROM e)""",
    "json_required_keys": """
SELECT event_id, array_to_string(list_filter(['k', 'client_id'],
         lambda x: NOT list_contains(json_keys(props), x)), '|') AS missing FROM events""",
    "quarantine_split": """
SELECT event_id, CASE WHEN event_type = 'error' AND length(props) - 1 < 9 THEN 'too_small'
       WHEN length(props) < 9 THEN 'too_small' WHEN event_type = 'error' THEN 'invalid_json'
       WHEN event_type = 'view' THEN 'missing_keys' ELSE 'ok' END AS verdict
FROM events""",
    "inspect_json": """
SELECT event_id,
       CAST(CASE event_type WHEN 'error' THEN length(props) - 1 WHEN 'view' THEN length(props) + 1
            WHEN 'click' THEN 2 ELSE length(props) END AS BIGINT) AS bytes,
       true AS readable, event_type <> 'click' AS valid_json,
       event_type IN ('error', 'view') AS repaired,
       CASE WHEN event_type <> 'click' THEN 'object' END AS kind,
       CASE WHEN event_type <> 'click' THEN 'k' END AS keys,
       CASE WHEN event_type <> 'click' THEN CAST(5 AS BIGINT) END AS issues,
       CASE WHEN event_type <> 'click' THEN 'OBJECT<k: BIGINT>' END AS schema,
       CAST(CASE event_type WHEN 'error' THEN length(props) - 1 WHEN 'view' THEN length(props) - 1
            WHEN 'click' THEN 1 END AS BIGINT) AS fault_at,
       CAST(CASE WHEN event_type IN ('error', 'view', 'click') THEN 1 END AS BIGINT) AS fault_line
FROM events""",
    "profile_table": "\nUNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS rows, count({c}) AS non_null FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate")),
    "stream_dedup": f"WITH {_MESSAGES} SELECT * FROM messages",
    "stream_complete": f"""
SELECT CAST(user_id AS VARCHAR) AS client_id FROM events
GROUP BY user_id HAVING count(DISTINCT event_type) >= {len(EVENT_TYPES) - 1}""",
    "stream_partial_restart": """
SELECT user_id, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total, count(*) AS n
FROM events GROUP BY user_id""",
    "stream_semi_join": _films(f"""
SELECT l_orderkey AS id, l_partkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT id FROM movies_v WHERE {_IN_HOME})"""),
    "stream_clean": f"WITH {RATINGS} SELECT movie_id, CAST(rating AS DOUBLE) AS rating FROM ratings_v",
}

# Streams that answer what a batch query answers; one client's films or credits never end.
SQL |= {
    "stream_dedup_ttl": SQL["stream_dedup"],
    "stream_q2_by_client": f"SELECT * FROM ({SQL['q2_by_tenant']}) WHERE client_id <> '5-LOW'",
    "stream_q4_by_client": f"SELECT * FROM ({SQL['q4_by_tenant']}) WHERE client_id <> '5-LOW'",
    "stream_join_barrier": SQL["join_credits_semi"],
}

# Each scored word looks back to the last word that ends the wait of modifiers and of negations.
SQL["polarity_rules"] = rf"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+(?:''[\p{{L}}\p{{N}}]+)*') AS w
        FROM documents)),
lexicon(word, value) AS (VALUES {', '.join(f"('{w}', {v}::DOUBLE)" for w, v in LEXICON.items())}),
modifiers(word, factor) AS (VALUES {', '.join(f"('{w}', {v}::DOUBLE)" for w, v in MODIFIERS.items())}),
kinds AS (
  SELECT doc_id, pos, value, factor, length(replace(word, '''', '')) AS size,
         CASE WHEN factor IS NOT NULL THEN 'm'
              WHEN word IN ({', '.join(f"'{w}'" for w in NEGATIONS)}) OR word LIKE '%n''t' THEN 'n'
              WHEN value IS NOT NULL THEN 's' ELSE 'o' END AS kind
  FROM words LEFT JOIN lexicon USING (word) LEFT JOIN modifiers USING (word)),
marked AS (
  SELECT *, max(pos) FILTER (kind = 'm') OVER earlier AS mod_at,
         last_value(CASE WHEN kind = 'm' THEN factor END IGNORE NULLS) OVER earlier AS mod,
         coalesce(max(pos) FILTER (kind = 's' OR kind = 'o' AND size > 2) OVER earlier, 0) AS mod_end,
         count(*) FILTER (kind = 's' OR kind = 'o' AND size > 1) OVER earlier AS part
  FROM kinds
  WINDOW earlier AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
denied AS (
  SELECT *, min(pos) FILTER (kind = 'n') OVER (PARTITION BY doc_id, part ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS denied_at
  FROM marked),
scored AS (
  SELECT doc_id, denied_at,
         value * CASE WHEN mod_at IS NULL OR mod_at <= mod_end THEN 1.0::DOUBLE
                      WHEN denied_at < mod_at THEN 1.0::DOUBLE / mod ELSE mod END AS v
  FROM denied WHERE kind = 's')
SELECT d.doc_id, coalesce(p, 0.0::DOUBLE) AS polarity
FROM documents d LEFT JOIN (
  SELECT doc_id, CAST(sum(CAST(round(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, v))
           * CASE WHEN denied_at IS NULL THEN 1.0::DOUBLE ELSE -0.5::DOUBLE END * 1000000) AS BIGINT)) AS DOUBLE)
         / (count(*) * 1000000) AS p
  FROM scored GROUP BY doc_id) USING (doc_id)"""

SQL["range_join"] = """
WITH ranges AS (
  SELECT o_orderkey AS low, o_orderkey + o_custkey % 40 AS high, -CAST(round(o_totalprice * 100) AS BIGINT) AS priority
  FROM orders WHERE o_orderkey % 7 <> 0),
found AS (
  SELECT k, low AS covered_by, row_number() OVER (PARTITION BY k ORDER BY priority, low, high) AS r
  FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem) JOIN ranges ON k >= low AND k <= high)
SELECT l_orderkey, l_linenumber, covered_by
FROM lineitem LEFT JOIN (SELECT * FROM found WHERE r = 1) ON k = l_orderkey"""

# Through files: what the batch queries answer from the tables.
SQL["all_five_from_files"] = f"""
SELECT 'Q1' AS query_id, title AS item, genres AS value FROM ({SQL['q1_coproduction_genres']})
UNION ALL SELECT 'Q2', country, CAST(total AS VARCHAR) FROM ({SQL['q2_top_solo']})
UNION ALL SELECT 'Q3', kind, title || '|' || CAST(CAST(rating AS DECIMAL(20,6)) AS VARCHAR)
FROM ({SQL['q3_rating_extremes']})
UNION ALL SELECT 'Q4', name, CAST("count" AS VARCHAR) FROM ({SQL['q4_top_actors']})
UNION ALL SELECT 'Q5', 'average_positive_rate', CAST(CAST(average_positive_rate AS DECIMAL(20,6)) AS VARCHAR)
FROM ({SQL['q5_sentiment_rates']})
UNION ALL SELECT 'Q5', 'average_negative_rate', CAST(CAST(average_negative_rate AS DECIMAL(20,6)) AS VARCHAR)
FROM ({SQL['q5_sentiment_rates']})"""

SQL["compare_five_answers"] = f"""
WITH titles AS (SELECT count(DISTINCT title) AS n FROM ({SQL['q1_coproduction_genres']}))
SELECT 'wrong' AS client_id, unnest(['Q2', 'Q4', 'Q5']) AS query_id, 'anomalous' AS status
UNION ALL SELECT 'gaps', 'Q3', 'missing'
UNION ALL SELECT 'gaps', 'Q1', CASE WHEN n < 2 THEN 'missing' ELSE 'anomalous' END FROM titles
UNION ALL SELECT unnest(['same', 'close', 'wrong']), 'Q1', 'missing' FROM titles WHERE n = 0"""

SQL["batches_round_trip"] = """
SELECT CAST(user_id AS VARCHAR) AS client_id, event_id % 10 AS current_batch, user_id AS "userId",
       event_id AS "movieId", value AS rating, epoch_us(ts) // 1000000 AS "timestamp"
FROM events"""

# JSON keys in order
SQL["results_round_trip"] = rf"""
SELECT client_id, query_id, regexp_replace(
  results, '\{{"name":"([^"]*)","count":([0-9]+)\}}', '{{"count":\2,"name":"\1"}}', 'g') AS results
FROM ({SQL['envelopes_by_tenant']})"""

SQL["read_documents"] = """
SELECT doc_id, lang, CAST(length('{"x" }' || coalesce(text, '')) AS BIGINT) AS n_chars,
       md5('{"x" }' || coalesce(text, '')) AS digest
FROM documents"""

SQL["decode_counts_by_file"] = """
SELECT 'credits' AS record, count(*) FILTER (l_orderkey % 9 <> 0) AS accepted,
       count(*) FILTER (l_orderkey % 9 = 0) AS rejected FROM lineitem
UNION ALL
SELECT 'ratings', count(*) FILTER (event_id % 9 <> 0), count(*) FILTER (event_id % 9 = 0) FROM events"""

SQL["display_forms"] = """
WITH p AS (SELECT *, repeat(p_name || ' ', p_size % 9) AS long FROM part)
SELECT p_partkey, CASE WHEN length(long) > 40 THEN substr(long, 1, 40) || '...' ELSE long END AS preview,
       CASE WHEN p_size > 25 AND p_type <> '' THEN p_type ELSE 'none' END AS kind,
       replace(p_name, ' ', '; ') AS names, '$ ' || replace(format('{:,}', p_partkey * 1234), ',', '.') AS price,
       p_partkey || ':' || p_size || '/3' AS message,
       strftime(to_timestamp(p_partkey * 1000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS at
FROM p"""

SQL["distinct_markers"] = """
SELECT DISTINCT user_id AS client_id, 'events' AS queue, event_type AS node_id FROM events"""

_BUSIEST = """SELECT name, count(*) AS "count" FROM (
    SELECT unnest(names) AS name FROM credits_v WHERE id IN (SELECT id FROM recent) AND {test})
  GROUP BY name ORDER BY "count" DESC, name LIMIT 10"""
SQL["diff_actors"] = _films(f"""
SELECT coalesce(a.name, b.name) AS name, a."count" AS expected, b."count" AS obtained,
       CASE WHEN b.name IS NULL THEN 'missing' WHEN a.name IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM ({_BUSIEST.format(test='true')}) a
FULL JOIN ({_BUSIEST.format(test="client_id IN ('1-URGENT', '3-MEDIUM', '5-LOW')")}) b ON a.name = b.name
WHERE a."count" IS DISTINCT FROM b."count" """, CREDITS, _RECENT)

SQL["quarantine_round_trip"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) ELSE props END AS body,
       CASE WHEN event_type = 'error' THEN 'invalid_json' ELSE 'ok' END AS verdict
FROM events"""

SQL["model_scores"] = """
SELECT doc_id, coalesce(list_sort(list_transform(list_distinct(regexp_extract_all(coalesce(text, ''), '[a-z]+')),
         lambda w: {'less': -length(w), 'w': w}))[1].w, '') AS label
FROM documents"""

SQL["head_of_files"] = """
SELECT 'orders' AS name, o_orderkey AS key FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
WHERE n <= (SELECT count(*) FROM orders) // 5
UNION ALL SELECT 'part', p_partkey FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS n FROM part)
WHERE n <= (SELECT count(*) FROM part) // 2
UNION ALL SELECT 'supplier', s_suppkey FROM supplier"""
