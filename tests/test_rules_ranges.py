"""Polarity in context, and joins against tables of ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marquee.functions import sentiment
from marquee.operators import joins

LEXICON = {"good": 0.7, "bad": -0.7, "fine": 0.4, "superb": 0.9}


def _scores(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    score = sentiment.polarity_with_rules(F.col("t"), LEXICON, **options)
    return [r["p"] for r in df.select("i", score.alias("p")).orderBy("i").collect()]


@pytest.mark.parametrize("text, want", [
    ("good", 0.7), ("very good", 0.91), ("not good", -0.35), ("not very good", round(-0.5 * 0.7 / 1.3, 6)),
    ("very not good", -0.455), ("really is a good", 0.91), ("really was good", 0.7), ("not a good", -0.35),
    ("not the good", 0.7), ("extremely superb", 1.0), ("extremely bad", -1.0), ("slightly very good", 0.91),
    ("isn't good", -0.35), ("not good bad", 0.5 * (-0.35 - 0.7)), ("GOOD, Bad!", 0.0), ("very", 0.0), ("not", 0.0),
    ("not not good", -0.35), ("good very", 0.7), ("not very is good", 0.91), ("no one here", 0.0), ("", 0.0), (None, 0.0),
])
def test_words_in_context(spark, text, want):
    assert _scores(spark, [text]) == [pytest.approx(want, abs=1e-6)]


def test_rules_are_parameters(spark):
    texts = ["muy good", "nada good", "very good", "not good"]
    got = _scores(spark, texts, modifiers={"muy": 0.5}, negations=["nada"], denied=-1.0)
    assert got == [0.35, -0.7, 0.7, 0.7]
    assert _scores(spark, ["very good", "not good", "don't good"], modifiers={}, negations=[]) == [0.7, 0.7, -0.35]
    empty = spark.createDataFrame([("good",)], "t string")
    assert empty.select(sentiment.polarity_with_rules(F.col("t"), {}).alias("p")).first()["p"] == 0.0


def test_rules_need_no_shuffle_and_one_split(spark):
    docs = spark.createDataFrame([("very good",)], "t string")
    scored = docs.select(sentiment.polarity_with_rules(F.col("t"), LEXICON).alias("p"))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


# --- ranges -------------------------------------------------------------------------------

def _ranges(spark, rows):
    return spark.createDataFrame(rows, "low long, high long, priority long, bucket string")


def _plain(key, ranges):
    hits = [(p, low, high, b) for low, high, p, b in ranges
            if key is not None and low is not None and high is not None and low <= key <= high]
    return min(hits)[3] if hits else None


@pytest.mark.parametrize("span", [3, 40, 10**12])
def test_ranges_against_plain(spark, span):
    rng = random.Random(span)
    ranges = []
    for k in range(400):
        low = rng.randrange(-span, span)
        ranges.append((low, low + rng.choice([0, 1, 2, 5, span // 7, span, -1]), rng.randrange(6), f"b{k}"))
    ranges += [(None, 5, 0, "x"), (5, None, 0, "y"), (-(10**18), 10**18, 9, "all")]
    keys = [rng.randrange(-2 * span, 2 * span) for _ in range(300)] + [None, 10**18, 10**18 + 1, -(10**18)]
    keys += [x for low, high, _, _ in ranges[:50] for x in (low, high, high + 1, low - 1)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, bucket int").withColumnRenamed("bucket", "i")
    got = {r["i"]: r["bucket"] for r in joins.range_join(rows, _ranges(spark, ranges), "k").collect()}
    assert got == {i: _plain(k, ranges) for i, k in enumerate(keys)}


def test_no_ranges_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "old", 0), (None, "old", 0)], "k int, bucket string, low int")
    none = joins.range_join(rows, _ranges(spark, []), "k")
    assert none.columns == ["k", "low", "bucket"] and {r["bucket"] for r in none.collect()} == {None}
    got = joins.range_join(rows, _ranges(spark, [(0, 9, None, "a"), (1, 1, None, "b")]), "k").collect()
    assert sorted((r["k"] or 0, r["bucket"]) for r in got) == [(0, None), (1, "a")]


def test_join_is_on_equal_values_only(spark):
    ranges = spark.range(10_000).select(
        F.col("id").alias("low"), (F.col("id") + 7).alias("high"), F.col("id").alias("priority"),
        F.col("id").cast("string").alias("bucket"))
    rows = spark.range(50_000).select((F.col("id") % 11_000).alias("k"))
    joined = joins.range_join(rows, ranges, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r["k"]: r["bucket"] for r in joined.distinct().collect()}
    assert got == {k: (str(max(0, k - 7)) if k < 10_007 else None) for k in range(11_000)}
