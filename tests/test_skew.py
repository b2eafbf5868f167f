"""A film with a third of all rows, joined without broadcast."""

import pytest
from pyspark.sql import functions as F

from marquee.operators import joins

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_hot_film_is_split_and_whole(no_broadcast):
    spark, n = no_broadcast, 120_000
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000)
    text = F.sha2(F.col("id").cast("string"), 256)
    rows = spark.range(0, n, 1, 8).select(key.alias("id"), F.array(text).alias("cast"))
    films = spark.range(0, 500).select("id", F.lit("T").alias("original_title"))
    want = sum(1 for i in range(n) if (5 if i % 3 == 0 else i % 1000) < 500)

    kept = joins.join_credits(rows, films)
    assert len(kept.collect()) == want
    assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()

    ratings = rows.select(F.col("id").alias("movie_id"), F.lit(1.0).alias("rating"), "cast")
    joined = joins.join_ratings(ratings, films)
    assert len(joined.collect()) == want
