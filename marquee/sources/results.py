"""Answer files: one JSON document per query and client."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources import records

# Fixed value: answer files are called <prefix><client id>.txt.
FILE_PREFIX = "resultados_"


def write_results(results: DataFrame, path: str) -> None:
    """``(client_id, query_id, results)`` rows, ``results`` being JSON text,
    appended as JSON documents under one folder per client and query."""
    document = F.to_json(F.struct("query_id", F.try_parse_json("results").alias("results")))
    documents = results.select(
        "client_id", F.col("query_id").alias("query"), document.alias("value"))
    documents.write.mode("append").partitionBy("client_id", "query").text(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_results`` left: one document per line, so files split freely."""
    return spark.read.text(path).select(
        F.col("client_id").cast("string").alias("client_id"),
        F.get_json_object("value", "$.query_id").alias("query_id"),
        F.get_json_object("value", "$.results").alias("results"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, document)``: every JSON object of files that hold several, one
    after another, pretty-printed or not; files are split over all tasks."""
    return records.json_objects(spark, path)


def read_reference_results(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, results)`` with results as JSON text; documents without a
    query id are left out."""
    return _answers(read_documents(spark, path)).select("query_id", "results")


def read_client_results(spark: SparkSession, path: str, prefix: str = FILE_PREFIX) -> DataFrame:
    """``(client_id, query_id, results)``; the client is taken from the file name."""
    name = F.url_decode(F.regexp_extract("path", r"([^/]+)$", 1))
    client = F.regexp_replace(F.regexp_replace(name, r"\.txt$", ""), prefix, "")
    return _answers(read_documents(spark, path)).select(
        client.alias("client_id"), "query_id", "results")


def _answers(documents: DataFrame) -> DataFrame:
    return documents.select(
        "path",
        F.get_json_object("document", "$.query_id").alias("query_id"),
        F.get_json_object("document", "$.results").alias("results"),
    ).filter("query_id IS NOT NULL")
