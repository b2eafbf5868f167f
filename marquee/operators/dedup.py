"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.json_text import canonical_json

MESSAGE_KEYS = ("client_id", "queue", "message_id")


def dedup_messages(messages: DataFrame, keys=MESSAGE_KEYS) -> DataFrame:
    """One row per message; redelivered copies carry the same content.

    Add ``sub_id`` and ``expected`` to the keys for messages that were split.
    """
    return messages.dropDuplicates(list(keys))


def first_by(df: DataFrame, keys, order: str) -> DataFrame:
    """One row per key, the first by ``order``; copies collapse before the shuffle."""
    others = [c for c in df.columns if c not in (*keys, order)]
    first = df.groupBy(*keys).agg(F.min(F.struct(order, *others)).alias("_f"))
    return first.select(*[
        F.col(c) if c in keys else F.col(f"_f.{c}").alias(c) for c in df.columns])


def dedup_results(results: DataFrame, by=("query_id",), body: str = "results") -> DataFrame:
    """One row per query and content, the content compared as key-sorted JSON."""
    digest = F.sha2(F.coalesce(canonical_json(F.col(body)), F.col(body)), 256)
    return results.withColumn("_digest", digest).dropDuplicates([*by, "_digest"]).drop("_digest")


def distinct_markers(markers: DataFrame) -> DataFrame:
    """End markers count once per client, queue and node."""
    return markers.select("client_id", "queue", "node_id").distinct()
