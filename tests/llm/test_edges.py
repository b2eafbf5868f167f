"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import (
    chat, common, decontaminate, html_text, imatch, langid, linededup, mixing, secret_scan, simhash, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"wort{i % 997}" for i in range(60_000))
VOCABULARY = "/opt/tokenizers/byte_bpe_50k"


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that operators must not stumble over."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, LONG, "en", "a", len(LONG)),
            (4, LONG, "en", None, len(LONG)), (None, "one two three four five", "en", "b", 23),
            (5, "one two three four five", "en", "b", 23), (5, "one two three four five", "en", "b", 23),
            (6, "\n\n \n", "de", "", 4), (7, "é😀 \\ ### </turn>", "fr", "b", 16)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five"), (None, "x y")],
                                 "item_id long, text string")


def extra(df, *names):
    """The table with further columns that an operator might want for itself."""
    return df.withColumns({n: F.lit(1) for n in names})


def test_simhash(odd, none):
    rows = simhash.near_groups(extra(odd, "fp", "root", "first", "node", "component_id")).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["component_id"] == by_id[4]["component_id"] == 3
    assert by_id[1]["fp"] == by_id[2]["fp"] == by_id[6]["fp"] == 0
    assert {r["component_id"] for r in rows if r["fp"] == by_id[5]["fp"]} == {5}
    assert simhash.near_groups(none).count() == 0
    kept = simhash.drop_near(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 7]
    assert simhash.drop_near(none).count() == 0


def test_near_dedup_keeps_unlike_texts(spark):
    """A row goes only for a near copy that stays, whatever ids rows share."""
    texts = {k: " ".join(f"{k}{i * i % 97}" for i in range(300)) for k in "abcdef"}
    near = texts["a"].replace("a0 ", "a0 more ", 1)
    rows = [(None, texts["a"]), (None, texts["b"]), (None, texts["c"]), (3, texts["d"]), (5, texts["d"] + " x"),
            (5, texts["e"]), (None, texts["e"]), (9, near), (9, near), (9, texts["f"]), (9, texts["f"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in simhash.drop_near(docs).collect()))
    assert kept == sorted([(9, near), (0, texts["b"]), (0, texts["c"]), (3, texts["d"]), (5, texts["e"]),
                           (9, texts["f"])])


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_keep_decided_by_a_full_or_an_empty_filter(spark, monkeypatch, bits):
    monkeypatch.setattr(common, "_FILTER_BITS", bits)
    rows = spark.range(500).select(F.col("id").alias("key"), F.lit("x").alias("row"))
    rows = rows.unionByName(rows.where("key % 5 = 0"))
    decided = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("keep", F.col("key") % 3 == 0)
    got = sorted(r["key"] for r in common.keep_decided(rows, "key", decided).collect())
    assert got == [k for k in range(500) if k % 3 == 0]
    assert common.keep_decided(rows, "key", decided.withColumn("keep", F.lit(True))).count() == 500



def test_language(odd, none):
    model = langid.fit(odd.where(~langid.held_out()))
    rows = {r["doc_id"]: r["language"] for r in langid.predict(odd, model).collect()}
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[6]["lang_pred"] == "und"
    assert rows[3] == rows[4] and 0 <= rows[3]["score"] <= 1
    assert langid.fit(none).languages == []
    assert langid.predict(odd, langid.fit(none)).where("language.lang_pred <> 'und'").count() == 0
    assert langid.predict(none, model).count() == 0 and langid.keep_known(none).count() == 0
    assert langid.keep_known(extra(odd, "language", "_n")).columns == [*odd.columns, "language", "_n"]


def test_lines(odd, none, spark):
    rows = linededup.with_lines(extra(odd, "h", "doc", "pos"), min_words=5).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["dropped"] == [] and by_id[4]["dropped"] == [0] and by_id[4]["text"] == ""
    # the null id comes first; both rows of id 5 are one later copy
    assert by_id[None]["dropped"] == [] and by_id[5]["dropped"] == [0]
    assert by_id[1]["text"] is None and by_id[1]["n_lines"] == 0 and by_id[6]["text"] == "\n\n \n"
    assert linededup.with_lines(none).count() == 0
    kept = linededup.drop_repeats(odd, min_words=5)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, None, 6, 7}
    cut = spark.createDataFrame([(1, "a b\nc d", None, None, 7), (2, "x\na b\nc d", None, None, 9)], SCHEMA)
    assert [(r["text"], r["n_chars"]) for r in linededup.drop_repeats(cut, min_words=4).orderBy("doc_id").collect()] \
        == [("a b\nc d", 7), ("x", 1)]


def test_decontamination(odd, none, benchmark, spark):
    rows = decontaminate.with_hits(extra(odd, "hits", "item_id"), benchmark).collect()
    assert {r["doc_id"] for r in rows if r["hits"]} == {None, 5}
    assert all(r["hits"][0]["item_id"] == 3 and r["hits"][0]["similarity"] == 1 for r in rows if r["hits"])
    kept = decontaminate.drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 6, 7}
    assert decontaminate.drop_contaminated(odd, benchmark.limit(0)).count() == odd.count()
    assert decontaminate.drop_contaminated(none, benchmark).count() == 0


def test_mix(odd, none):
    rows = mixing.mix(extra(odd, "size", "epochs", "key")).collect()
    assert len(rows) == odd.count() and {r["taken"] % max(1, r["size"]) for r in rows} == {0}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    twice = [r["taken"] for r in rows if r["doc_id"] == 5]
    assert twice[0] == twice[1]
    again = mixing.mix(odd).select("doc_id", "taken").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixing.mix(odd).select("doc_id", "taken").collect())
    assert mixing.mix(none).count() == 0
    assert {r["target"] for r in mixing.mix(odd.where("doc_id in (2, 6)")).collect()} == {0.0}


def test_fingerprints(odd, none):
    rows = imatch.fingerprints(extra(odd, "k1", "term", "n")).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"]
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["n_chars"] == 0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert imatch.fingerprints(none).count() == 0
    assert imatch.fingerprints(odd.where("doc_id = 7")).first()["n_chars"] == 16


def test_secrets(odd, none):
    rows = secret_scan.scan(extra(odd, "secrets", "kind"), f"{VOCABULARY}.tiktoken").collect()
    assert len(rows) == odd.count() and not any(r["secrets"] for r in rows)
    assert secret_scan.scan(none, f"{VOCABULARY}.tiktoken").count() == 0


def test_toxicity(odd, none, spark):
    labels = spark.createDataFrame([(1, 0, 1), (3, 1, 0), (3, 1, 1), (None, 1, 1), (99, 0, None)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.rate(extra(odd, "severity", "_rated"), model).collect()
    assert len(rows) == odd.count() and all(r["severity"] >= 0 and not r["toxic"] for r in rows)
    assert toxicity.fit(none, labels.limit(0)) == toxicity.Model()
    assert toxicity.rate(none, model).count() == 0


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string"
    rows = spark.createDataFrame(
        [(1, None, None, None, "x"), (1, 0, "assistant", "", "x"), (1, 0, "assistant", "", "x"),
         (None, 1, "user: \n\\", "é😀" + "#" * 7 + "\\", "x"), (None, 1, "assistant", LONG, "x")], schema)
    out = {r["conv_id"]: r for r in chat.format_conversations(rows, f"{VOCABULARY}.json").collect()}
    assert chat.parse(out[1]["formatted"]) == [("", ""), ("assistant", ""), ("assistant", "")]
    assert chat.parse(out[None]["formatted"]) == [("assistant", LONG), ("user: \n\\", "é😀" + "#" * 7 + "\\")]
    spans = out[None]["loss_spans"]
    assert "".join(out[None]["formatted"][s["start"]:s["stop"]] for s in spans) == LONG
    assert chat.format_conversations(rows.limit(0), f"{VOCABULARY}.json").count() == 0


def test_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (3, "u", "<p>" + LONG), (4, "u", "<<p <a href='>x</a>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    out = html_text.extract(pages).collect()
    assert len(out) == len(rows) and {r["text"] for r in out if r["page_id"] in (1, 2)} == {""}
    assert [r["text"] for r in out if r["page_id"] == 3] == [LONG]
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages(spark, odd, none, benchmark, tmp_path, stage):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, none):
        out = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(out.columns)
        assert out.count() <= docs.count()
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
