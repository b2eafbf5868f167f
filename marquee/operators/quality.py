"""Record checks, quarantine, inspection and table profiles."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.functions.json_text import missing_keys, repair_json
from marquee.sources.batches import batch_verdict


def with_missing_keys(df: DataFrame, body: str, required) -> DataFrame:
    return df.withColumn("missing", missing_keys(F.col(body), required))


def quarantine(df: DataFrame, body: str, required=S.BATCH_REQUIRED,
               min_bytes: int = 10) -> DataFrame:
    """Adds ``verdict``; ``ok`` rows go on, the others are set aside."""
    return df.withColumn("verdict", batch_verdict(F.col(body), min_bytes, required))


def write_split(checked: DataFrame, good_path: str, bad_path: str) -> None:
    """Two appends from one checked table, so nothing is lost in between."""
    checked.filter("verdict = 'ok'").drop("verdict").write.mode("append").json(good_path)
    checked.filter("verdict <> 'ok'").write.mode("append").partitionBy("verdict").json(bad_path)


def _kind(value: Column) -> Column:
    """object, array, string, number, boolean or null of a variant."""
    schema = F.schema_of_variant(value)
    return (F.when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array")
            .when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
            .when(schema == "VOID", "null").when(schema.isNotNull(), "number"))


def _fields(value: Column) -> Column:
    return F.when(_kind(value) == "object", value.cast("map<string,variant>"))


def _items(value: Column) -> Column:
    return F.when(_kind(value) == "array", value.cast("array<variant>"))


def batch_issues(value: Column) -> Column:
    """What keeps a JSON object (a variant) from being a message batch; empty if nothing."""
    fields = _fields(value)
    wanted = F.array(*[F.lit(key) for key in S.BATCH_REQUIRED])
    absent = F.transform(F.array_except(wanted, F.map_keys(fields)), lambda key: F.concat(F.lit("missing "), key))
    payload = F.try_element_at(fields, F.lit("processed_data"))
    kind = F.when(payload.isNotNull(), _kind(payload))
    odd = F.exists(_items(payload), lambda item: _kind(item) != "object")
    return F.array_compact(F.concat(absent, F.array(
        F.when(kind != "array", F.lit("processed_data is not a list")),
        F.when((kind == "array") & odd, F.lit("processed_data holds something that is not a record")))))


def json_structure(value: Column, sample: int = 5) -> Column:
    """Kind, keys, length, kinds of the first items and the nested schema of a variant."""
    items = _items(value)
    return F.struct(
        _kind(value).alias("kind"), F.map_keys(_fields(value)).alias("keys"), F.size(items).alias("length"),
        F.transform(F.slice(items, 1, sample), F.schema_of_variant).alias("item_types"),
        F.schema_of_variant(value).alias("schema"))


_FAULT = T.StructType([T.StructField("error", T.StringType()), *[
    T.StructField(name, T.LongType()) for name in ("position", "line", "column")]])


def _first_fault(text: str | None) -> dict | None:
    if text is None:
        return None
    try:
        json.loads(text)
    except json.JSONDecodeError as found:
        return {"error": found.msg, "position": found.pos, "line": found.lineno, "column": found.colno}
    except (RecursionError, ValueError) as found:
        return {"error": str(found), "position": None, "line": None, "column": None}
    return {"error": "not JSON by the stricter reader", "position": None, "line": None, "column": None}


def fault(text: Column) -> Column:
    """Where a text stops being JSON and why (position from 0, line and column from 1); null
    for a null text.  Give it only the texts that are known to be faulty."""
    @F.arrow_udf(_FAULT)
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([_first_fault(t) for t in texts.to_pylist()], pa.struct(
            [("error", pa.string()), ("position", pa.int64()), ("line", pa.int64()), ("column", pa.int64())]))

    return find(text)


def _parsed(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds variant ``name``, null unless the text is one JSON value and nothing after it.

    Parsers stop at the end of the first value, so the text is read as a field of an object
    that ends with a field of our own.  Coming out of a generator, it is parsed once,
    however often it is used.
    """
    wrapped = F.concat(F.lit('{"_text":'), text, F.lit(',"_end_of_text":0}'))
    df = df.withColumn("_wrapped", F.explode(F.array(F.try_parse_json(wrapped))))
    fields = F.col("_wrapped").cast("map<string,variant>")
    whole = F.array_sort(F.map_keys(fields)) == F.array(F.lit("_end_of_text"), F.lit("_text"))
    return df.withColumn(name, F.when(whole, F.try_element_at(fields, F.lit("_text")))).drop("_wrapped")


def inspect(documents: DataFrame, body: str = "raw") -> DataFrame:
    """Per document: size, readability, validity, repair outcome, structure, batch issues and,
    for text that isn't JSON as it stands, the first fault.

    ``documents`` needs a text column, null where unreadable.  Each text is parsed once, and
    once more as repaired if it needs that; only faulty texts meet Python.
    """
    others = [c for c in documents.columns if c != body]
    rows = documents.select(*others, F.col(body).alias("_raw"))
    rows = _parsed(rows, F.col("_raw"), "_value")
    broken = F.when(F.col("_value").isNull(), F.col("_raw"))
    rows = _parsed(rows, repair_json(broken), "_again")
    rows = rows.withColumn("_text", F.explode(F.array(F.coalesce("_value", "_again"))))
    value = F.col("_text")
    return rows.select(
        *others, F.octet_length("_raw").alias("bytes"), F.col("_raw").isNotNull().alias("readable"),
        value.isNotNull().alias("valid_json"), F.col("_again").isNotNull().alias("repaired"),
        json_structure(value).alias("structure"),
        F.when(_kind(value) == "object", batch_issues(value)).alias("issues"),
        fault(broken).alias("fault"))


def inspect_folder(spark: SparkSession, path: str) -> DataFrame:
    """``inspect`` for every JSON file below ``path``, quarantined ones included."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True).load(path)
    )
    return inspect(files.select(
        "path", F.col("length").alias("file_size"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("raw")))


def profile(df: DataFrame) -> DataFrame:
    """Row count, non-null count and type of every column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.col("_rows").alias("rows"), F.col(f.name).alias("non_null"))
            for f in df.schema]
    return counts.select(F.inline(F.array(*rows)))


def random_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` random rows."""
    return df.orderBy(F.rand(seed)).limit(n)
