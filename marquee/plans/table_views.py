"""The order tables seen as film data.

An order is a film: the nations of its suppliers are its countries, the part
types its genres, the sum of its line prices its budget, its total its revenue,
the document with its key its overview.  Events are ratings, line items credits.

Line items are reduced to one row per order before orders and documents are
joined, so the wide columns are never multiplied by line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_PER_FILM = 4

# The order priorities, standing in for tenants and for query ids.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def tenant_of(number: Column) -> Column:
    """Tenants in turn: a film's ratings and credits come from all of them."""
    place = F.pmod(number, F.lit(len(PRIORITIES))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(p) for p in PRIORITIES]), place)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def movies(spark: SparkSession, sf_dir: str, overview: bool = True, genres: bool = True) -> DataFrame:
    """Film rows.  Queries that never read the overview or the genres can leave
    out the join that provides them (the column is then empty)."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    # One dimension at a time: Spark then knows the size of each smaller side.
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    totals = [
        F.array_sort(F.collect_set("n_name")).alias("nations"),
        F.expr("(sum(cents) + 50) div 100").alias("budget")]
    if genres:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        totals.append(F.array_sort(F.collect_set("p_type")).alias("types"))
    films = lines.groupBy("l_orderkey").agg(*totals)
    if not genres:
        films = films.withColumn("types", F.array().cast("array<string>"))

    orders = table(spark, sf_dir, "orders")
    joined = orders.join(films, F.col("o_orderkey") == F.col("l_orderkey"))
    if overview:
        texts = table(spark, sf_dir, "documents").groupBy("doc_id").agg(F.max("text").alias("text"))
        joined = joined.join(texts, F.col("o_orderkey") == F.col("doc_id"), "left")
    else:
        joined = joined.withColumn("text", F.lit(None).cast("string"))

    def named(column: str):
        return F.transform(F.col(column), lambda name: F.struct(name.alias("name")))

    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Order#"), F.col("o_orderkey")).alias("original_title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        "budget",
        F.col("o_totalprice").alias("revenue"),
        named("nations").alias("production_countries"),
        named("types").alias("genres"),
        F.coalesce("text", F.lit("")).alias("overview"),
        F.col("o_orderpriority").alias("client_id"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating_rows(table(spark, sf_dir, "events"))


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One credits row per line item; its cast is the part's name and brand and,
    for small parts, its type (otherwise a nameless member)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    third = F.when(F.col("p_size") <= 25, F.col("p_type")).otherwise(F.lit(""))
    members = F.array(*[F.struct(c.alias("name")) for c in (F.col("p_name"), F.col("p_brand"), third)])
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("id"), members.alias("cast"), tenant_of(F.col("l_linenumber")).alias("client_id"))


def messages(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as queue messages of one client per user, each
    delivered twice."""
    return events.select(
        F.col("user_id").cast("string").alias("client_id"),
        F.col("event_type").alias("queue"),
        F.col("event_id").alias("message_id"),
        F.col("ts").cast("timestamp").alias("sent_at"), "value", "props",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")).drop("delivery")


def rating_rows(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as ratings."""
    return events.select(
        F.col("user_id").alias("userId"),
        F.expr(f"event_id div {EVENTS_PER_FILM}").alias("movieId"),
        F.col("value").cast("decimal(12,2)").alias("rating"),
        tenant_of(F.col("user_id")).alias("client_id"))
