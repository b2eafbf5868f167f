"""Each operator applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import (
    bpe, chat, decontaminate, divergence, html_text, imatch, langid, linededup, mixing, oracle, periodic,
    secret_scan, simhash, toxicity)
from marquee.llm.common import NOT_SPACE, table, whole_text


#: Vocabulary files of public tokenizers, the same folder on every executor.
VOCABULARIES = "/opt/tokenizers"
_HARD_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-7, 0, "user", _HARD_TEXT), (-7, 1, "assistant", _HARD_TEXT)], rows.schema)
    return chat.read_back(chat.format_conversations(
        rows.unionByName(hard), f"{VOCABULARIES}/byte_bpe_50k.tiktoken"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, f"{VOCABULARIES}/byte_bpe_50k.tiktoken")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secrets")).alias("spans"), count("random").alias("n_random"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.with_lines(docs)
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped", "text")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.rate(docs, model).select("doc_id", "severity", "grade", "toxic")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "language.lang_pred", "language.score")


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, vocabulary, pattern)
    return both.select("doc_id", bpe.n_ids(F.col("ids")).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by the CRC-32 of the id, repeats some words from a place on.

    The rest is as it was; a null id is not among the tenth.
    """
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", F.floor(number / 10).alias("g"),
                       F.coalesce(number % 10 == 0, F.lit(False)).alias("planted"), whole_text().alias("text"))
    docs = docs.withColumn("words", F.when(
        F.col("planted"), F.regexp_extract_all("text", F.lit(NOT_SPACE), F.lit(0))))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    word = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", F.when(
        i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return docs.select("doc_id", F.when(F.col("planted") & (F.col("n") > 0), F.array_join(word, " "))
                       .otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = periodic.with_runs(docs).withColumn("best", periodic.longest(F.col("runs")))
    start, length, period = (F.col("best").getField(c) for c in ("start", "length", "period"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.call_function("div", length * 1000, period).alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_chat_format, op2_source_mix, op3_fingerprints, op4_benchmark_decontamination, op5_secret_scan,
    op6_line_dedup, op7_html_text, op8_toxicity, op9_simhash_dedup, op10_language_id, op11_bpe_round_trip,
    op12_source_divergence, op13_periodic_runs)}
SQL = dict(oracle.SQL)
