"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs is all that the stage before kept,
reread from Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontaminate, langid, linededup, mixing, simhash
from marquee.session import materialize


#: Texts sent to Python at a time; long ones would make batches of Spark's usual size large.
TEXTS_AT_ONCE = 1000


def _bounded(stage):
    """The stage in a session that sends few texts at a time to Python.  The setting stays, as
    a stage's rows are computed when its result is written."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        spark.conf.set(name, str(min(TEXTS_AT_ONCE, int(spark.conf.get(name)))))
        return stage(spark, docs, sf_dir)

    return run_stage


@_bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those without a letter or a clear answer go."""
    return langid.keep_known(docs, least=0.5)


@_bounded
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 50 words or more; texts that were only copies go."""
    return linededup.drop_repeats(docs, min_words=50)


@_bounded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return simhash.drop_near(docs, shingle=4, bits=4)


@_bounded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_bounded
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` (how often) and ``taken`` (words)."""
    return mixing.mix(docs).where("copies > 0")


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("source_mix", source_mix)]

#: SQL has no trained network and no XXH64, so the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
