"""Duplicate removal, completeness, running totals and sinks on streams.

Cleaning, filters, routing, sentiment and joins with static films need no stream
version: the batch functions take streaming frames as they are.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marquee.operators.dedup import MESSAGE_KEYS
from marquee.operators.joins import unique_by_key


def open_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet",
                files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """Stream over the files of a folder, old and new."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def dedup_stream(messages: DataFrame, keys: Sequence[str] = MESSAGE_KEYS) -> DataFrame:
    """One row per message, whatever its time: an unseen key always comes through.

    Every key is remembered for ever (the keys only, not the rows), as a watermark would
    take a late first delivery for a repeat; ``stateful.dedup_within`` forgets keys.
    """
    return messages.dropDuplicates(list(keys))


_DONE = T.StructType([T.StructField("client_id", T.StringType())])
_SEEN = T.StructType([
    T.StructField("seen", T.ArrayType(T.StringType())), T.StructField("done", T.BooleanType())])


def completions(markers: DataFrame, queues: Sequence[str], nodes: int,
                forget_after_ms: int | None = None) -> DataFrame:
    """``client_id`` once, when every queue has end markers of ``nodes`` distinct
    nodes.  ``markers`` has ``client_id, queue, node_id``; repeats are ignored.

    The state of a client is its seen markers, at most queues times nodes.  With
    ``forget_after_ms`` it is dropped when nothing more has come for that long; such
    a stream has no end, so give it a processing-time trigger, not ``availableNow``.
    """
    wanted = list(queues)

    def track(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, done = (set(state.get[0]), state.get[1]) if state.exists else (set(), False)
        for chunk in chunks:
            marks = chunk[["queue", "node_id"]].drop_duplicates()
            seen.update(
                f"{wanted.index(queue)}:{node}" for queue, node in marks.itertuples(index=False))
        complete = all(
            sum(mark.startswith(f"{i}:") for mark in seen) >= nodes for i in range(len(wanted)))
        state.update((sorted(seen), done or complete))
        if forget_after_ms:
            state.setTimeoutDuration(forget_after_ms)
        if complete and not done:
            yield pd.DataFrame({"client_id": [key[0]]})

    def drop_repeats(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield chunk.drop_duplicates()

    known = markers.filter(F.col("queue").isin(wanted)).select(
        F.col("client_id").cast("string"), "queue", F.col("node_id").cast("string"))
    # Repeats go before the shuffle, so a client with very many markers stays light.
    known = known.mapInPandas(drop_repeats, known.schema)
    timeout = (
        GroupStateTimeout.ProcessingTimeTimeout if forget_after_ms else GroupStateTimeout.NoTimeout)
    return known.groupBy("client_id").applyInPandasWithState(
        track, _DONE, _SEEN, "append", timeout)


def complete_clients(markers: DataFrame, queues: Sequence[str], nodes: int) -> DataFrame:
    """The same answer over a finished table of markers."""
    per_queue = (
        markers.filter(F.col("queue").isin(list(queues)))
        .groupBy("client_id", "queue").agg(F.count_distinct("node_id").alias("n"))
        .filter(F.col("n") >= nodes)
    )
    return per_queue.groupBy("client_id").agg(F.count("*").alias("q")).filter(
        F.col("q") == len(set(queues))).select("client_id")


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available into an append-only parquet table and stop."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available, keeping each micro-batch's changed rows in a
    folder of its own.  A replayed batch overwrites its folder.  All history stays;
    ``snapshots.run_snapshots`` keeps a compacted table of current rows instead."""

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    query = (
        stream.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current row per key of what ``run_updates`` left."""
    updates = spark.read.parquet(path)
    return unique_by_key(updates, keys, order="batch_id").drop("batch_id")


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Like ``run_to_files`` in one batch, for streams that have no end of their own
    because they keep time."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(once=True).start(path)
    )
    query.awaitTermination()
    return query
