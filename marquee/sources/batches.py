"""JSON message bodies and stored message batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.functions.json_text import is_json, missing_keys


def decode_bodies(messages: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """One row per record of a JSON body that is an object or a list of objects.

    Bodies of any other shape, and list items that are not objects, give none.
    The other columns travel along.
    """
    others = [c for c in messages.columns if c != body]
    items = F.from_json(F.col(body), T.ArrayType(T.StringType()))
    items = F.when(F.ltrim(body).startswith("{"), F.array(F.col(body))).otherwise(items)
    opened = messages.select(*others, F.explode(items).alias("_item"))
    objects = opened.filter(F.ltrim("_item").startswith("{") & is_json(F.col("_item")))
    return objects.select(*others, F.from_json("_item", schema).alias("_r")).select(*others, "_r.*")


def encode_bodies(records: DataFrame, keys: list[str], chunk: int = 1000,
                  body: str = "body") -> DataFrame:
    """Records -> JSON list bodies of at most ``chunk`` records for each key.

    Chunks form inside the partition a record already sits in, so no key, however
    frequent, is gathered in one place.
    """
    fields = [c for c in records.columns if c not in keys]
    numbered = records.withColumn("_row", F.monotonically_increasing_id())
    slot = F.struct(F.shiftright("_row", 33).alias("part"),
                    F.floor(F.col("_row").bitwiseAND((1 << 33) - 1) / chunk).alias("slot"))
    return (
        numbered.groupBy(*keys, slot.alias("_slot"))
        .agg(F.to_json(F.collect_list(F.struct(*fields))).alias(body))
        .drop("_slot")
    )


def write_batches(batches: DataFrame, path: str) -> None:
    """Append batches as JSON; the commit protocol makes each file appear whole."""
    batches.write.mode("append").json(path)


def read_batches(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Stored batches of one kind with typed records; others are not touched."""
    return read_checked_batches(spark, path, kind).filter("verdict = 'ok'").drop("verdict", "raw")


def read_checked_batches(spark: SparkSession, path: str, kind: str,
                         min_bytes: int = 10) -> DataFrame:
    """Every stored document with a verdict (see ``batch_verdict``) and its text.

    Accepts one JSON document per file, pretty-printed or not; a stored batch is
    at most about a megabyte.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True).load(path)
        .filter(~F.col("path").rlike(r"/\.tmp_[^/]*$|/corrupted/"))
    )
    documents = files.select("path", F.try_validate_utf8(F.col("content").cast("string")).alias("raw"))
    return type_batches(documents, kind, min_bytes)


def read_batch_lines(spark: SparkSession, path: str, kind: str, min_bytes: int = 10) -> DataFrame:
    """Batches as ``write_batches`` leaves them: one JSON document per line."""
    lines = spark.read.text(path)
    documents = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return type_batches(documents, kind, min_bytes)


def batch_verdict(raw: Column, min_bytes: int = 10, required=S.BATCH_REQUIRED) -> Column:
    """ok, unreadable, too_small, invalid_json or missing_keys."""
    return (
        F.when(raw.isNull(), "unreadable")
        .when(F.octet_length(raw) < min_bytes, "too_small")
        .when(~is_json(raw), "invalid_json")
        .when(F.size(missing_keys(raw, required)) > 0, "missing_keys")
        .otherwise("ok")
    )


def type_batches(documents: DataFrame, kind: str, min_bytes: int = 10) -> DataFrame:
    """``(path, raw)`` documents -> typed batches plus ``verdict`` and ``raw``."""
    code = S.MESSAGE_CODE[kind]
    typed = documents.withColumn("verdict", batch_verdict(F.col("raw"), min_bytes)).withColumn(
        "_b", F.from_json("raw", S.stored_batch(kind)))
    wanted = (F.col("verdict") != "ok") | (F.col("_b.message_code") == code)
    return typed.filter(F.coalesce(wanted, F.lit(True))).select("path", "_b.*", "verdict", "raw")


def records(batches: DataFrame) -> DataFrame:
    """The records inside typed batches, with the batch headers."""
    return batches.select(
        "client_id", "message_id", "current_batch", F.explode("processed_data").alias("_r")
    ).select("client_id", "message_id", "current_batch", "_r.*")
