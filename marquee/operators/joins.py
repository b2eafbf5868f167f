"""Joins of ratings and credits with the selected films, and key bucketing.

No broadcast is forced.  Spark broadcasts the film side when its size is known to
be under ``autoBroadcastJoinThreshold`` (``session.materialize`` makes the size
exact) and otherwise shuffles, where AQE splits a film that holds a large share
of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import modulo_bucket
from marquee.session import materialize


def unique_by_key(df: DataFrame, keys: Sequence[str] = ("id",), order: str | None = None) -> DataFrame:
    """One row per key: the last by ``order``, ties broken by the other columns.

    An aggregate, not a window, so copies of a frequent key collapse before the
    shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = F.struct(*([F.col(order).alias("_o")] if order else []), *others)
    return df.groupBy(*keys).agg(F.max(ranked).alias("_r")).select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def join_ratings(ratings: DataFrame, movies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ratings of the given films (unique by id): ``id, original_title, rating``."""
    keys = [*by, "id"]
    return ratings.withColumnRenamed("movie_id", "id").join(
        movies.select(*keys, "original_title"), keys, "inner"
    ).select(*keys, "original_title", "rating")


def join_credits(credits: DataFrame, movies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Credits of the given films, unchanged; repeated credits rows stay."""
    keys = [*by, "id"]
    return credits.join(movies.select(*keys), keys, "left_semi")


def join_credits_inner(credits: DataFrame, movies: DataFrame, by: Sequence[str] = (),
                       unique: bool = True) -> DataFrame:
    """Like ``join_credits`` with the title added.  Films are made unique by id
    first; without ``unique`` a film listed twice doubles its credits."""
    keys = [*by, "id"]
    titles = movies.select(*keys, "original_title")
    titles = unique_by_key(titles, keys) if unique else titles
    return credits.join(titles, keys, "inner").select(*keys, "original_title", "cast")


#: Bits of a filter over keys, which is broadcast as rows of 64 bits each: a million at most.
_FILTER_BITS = 1 << 26


def without_most_others(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` with all whose (whole-number) key is among the one column of ``keys``, and few others.

    For work on rows that is to be done before they are joined.  A Bloom filter of one hash:
    each key sets one bit.  It has a fixed size, whatever the number of keys, so it is sent to
    the rows; with very many keys it lets more others pass.  Rows with a null key go.
    """
    def hashed(column: Column) -> Column:
        return F.xxhash64(column.cast("bigint"))

    def word(h: Column) -> Column:
        return F.shiftrightunsigned(h, 6).bitwiseAND(_FILTER_BITS // 64 - 1)

    def bit(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))

    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).where("_key IS NOT NULL")
    filled = wanted.groupBy(word(hashed(F.col("_key"))).alias("_word")).agg(
        F.bit_or(bit(hashed(F.col("_key")))).alias("_bits"))
    at = hashed(F.col(key))
    return rows.where(F.col(key).isNotNull()).join(
        F.broadcast(filled), (word(at) == F.col("_word")) & (F.col("_bits").bitwiseAND(bit(at)) != 0), "left_semi")


def range_bucket(key: Column, ranges: Sequence[tuple[int, int, int]], buckets: int) -> Column:
    """Bucket of the first ``(low, high, bucket)`` range that holds the key, else
    ``key % buckets + 1``.  The range list is part of the plan: no join at all."""
    found = F.lit(None).cast("bigint")
    for low, high, bucket in reversed(list(ranges)):
        found = F.when(key.between(low, high), F.lit(bucket).cast("bigint")).otherwise(found)
    return F.coalesce(found, modulo_bucket(key, buckets).cast("bigint"))


#: Keys and bounds lie within this distance of 0.
_REACH = 1 << 61


def _cover(ranges: DataFrame, low: str, high: str) -> Column:
    """The dyadic blocks (level, block) whose union is the range; a block of level l holds the
    keys with the same bits above the lowest l.  At most two a level."""
    def blocks(level: Column) -> Column:
        shift = lambda c: F.call_function("shiftright", c, level)
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        first, after = shift(F.col(low) + size - 1), shift(F.col(high) + 1)
        rest = first + F.pmod(first, F.lit(2))
        odd = lambda c: F.pmod(c, F.lit(2)) == 1
        return F.array(
            F.when(odd(first) & (first < after), F.struct(level.alias("level"), first.alias("block"))),
            F.when(odd(after) & (rest < after), F.struct(level.alias("level"), (after - 1).alias("block"))))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), blocks)))


def range_join(rows: DataFrame, ranges: DataFrame, key: str, value: str = "bucket", low: str = "low",
               high: str = "high", priority: str = "priority") -> DataFrame:
    """``rows`` with ``value`` of the range that holds the key, null if none does.

    Of several ranges the one with the smallest ``priority`` counts (ties: low, high, value).
    Ranges may be any number, of any length, and overlap.  Each is cut into at most two
    aligned blocks of each power of two, and each distinct key looks up the blocks that hold
    it, one of each size in use, so the join is on equal values: Spark sends the blocks along
    if they are few and shuffles both sides otherwise.  Only distinct keys are looked up;
    the answers are then joined to the rows by key, where Spark splits a hot one.

    Null keys, and ranges with a null bound or none between their bounds, match nothing.
    Keys and bounds are whole numbers within 2^61 of 0.
    """
    held = ranges.where(f"{low} <= {high} AND {low} > -{_REACH} AND {high} < {_REACH}").select(
        F.col(low).cast("bigint").alias("_low"), F.col(high).cast("bigint").alias("_high"),
        F.col(priority).alias("_priority"), F.col(value).alias("_value"))
    blocks = materialize(
        held.withColumn("_block", F.explode(_cover(held, "_low", "_high")))
        .groupBy("_block.level", "_block.block")
        .agg(F.min(F.struct("_priority", "_low", "_high", "_value")).alias("_best")), "blocks")
    levels = sorted(r["level"] for r in blocks.select("level").distinct().collect())  # 62 at most
    column = F.col(key).cast("bigint")
    keys = rows.where(column.isNotNull()).select(column.alias("_key")).distinct()
    asked = keys.select("_key", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")).alias("level"))
    asked = asked.withColumn("block", F.call_function("shiftright", F.col("_key"), F.col("level")))
    answers = asked.join(blocks, ["level", "block"]).groupBy("_key").agg(
        F.min("_best").alias("_best")).select("_key", F.col("_best._value").alias("_value"))
    kept = [c for c in rows.columns if c != value]
    return rows.join(answers, column == F.col("_key"), "left").select(
        *[rows[c] for c in kept], F.col("_value").alias(value))
