"""Comparison of an expected and an obtained set of rows or answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions.json_text import canonical_json, normalized


def diff_rows(expected: DataFrame, obtained: DataFrame, keys) -> DataFrame:
    """Keys whose rows differ: ``missing``, ``extra`` or ``changed``, with both
    versions of the other columns as structs.

    One aggregate per key over both sides, so nothing is joined and a hot key is one
    row per task.  A key may have several rows; they are compared as a bag, by count
    and hash sum, and the largest row is shown.  Null keys are equal.
    """
    values = [c for c in expected.columns if c not in keys]
    body = F.struct(*values)
    both = expected.select(*keys, body.alias("_v"), F.lit(True).alias("_want")).unionByName(
        obtained.select(*keys, body.alias("_v"), F.lit(False).alias("_want")))
    digest = F.xxhash64("_v").cast("decimal(38,0)")

    def side(test: Column, name: str) -> list[Column]:
        return [F.max(F.when(test, F.col("_v"))).alias(name), F.count_if(test).alias(f"_n_{name}"),
                F.sum(F.when(test, digest)).alias(f"_h_{name}")]

    want = F.col("_want")
    found = both.groupBy(*keys).agg(*side(want, "expected"), *side(~want, "obtained"))
    status = (
        F.when(F.col("_n_obtained") == 0, "missing").when(F.col("_n_expected") == 0, "extra")
        .when((F.col("_n_expected") != F.col("_n_obtained")) | (F.col("_h_expected") != F.col("_h_obtained")),
              "changed"))
    return found.select(*keys, "expected", "obtained", status.alias("status")).filter("status IS NOT NULL")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    test = F.lit(True)
    for x, y in zip(a.columns, b.columns):
        test = test & a[x].eqNullSafe(b[y])
    return test


def missing_names(expected: DataFrame, obtained: DataFrame) -> DataFrame:
    """Distinct rows of ``expected`` that ``obtained`` lacks; repeats go before the join."""
    left, right = expected.distinct(), obtained.toDF(*[f"_{c}" for c in obtained.columns]).distinct()
    return left.join(right, _same_row(left, right), "left_anti")


def common_names(expected: DataFrame, obtained: DataFrame) -> DataFrame:
    left, right = expected.distinct(), obtained.toDF(*[f"_{c}" for c in obtained.columns]).distinct()
    return left.join(right, _same_row(left, right), "left_semi")


def missing_queries(answers: DataFrame, query_ids: Sequence[str] = tuple(S.ANSWER)) -> DataFrame:
    """``(client_id, query_id)`` for every expected query a client did not answer.

    The short list of query ids is part of the plan and is unfolded per client, and
    only ids on it are gathered.
    """
    known = F.when(F.col("query_id").isin(list(query_ids)), F.col("query_id"))
    seen = answers.groupBy("client_id").agg(F.collect_set(known).alias("seen"))
    wanted = F.array(*[F.lit(query) for query in query_ids])
    return seen.select("client_id", F.explode(F.array_except(wanted, "seen")).alias("query_id"))


def normalize(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every column in order-insensitive, trimmed, rounded form."""
    return df.select(*[
        normalized(F.col(f.name), f.dataType, digits).alias(f.name) for f in df.schema])


def answer_rows(answers: DataFrame) -> DataFrame:
    """JSON answers opened to ``(..., query_id, key, text, number)`` rows; an empty
    answer is one row with a null key.  What is a number is compared as one."""
    results = F.col("results")
    answer = {q: F.from_json(results, t) for q, t in S.ANSWER.items()}

    def row(key: Column, text: Column | None = None, number: Column | None = None) -> Column:
        return F.struct(
            F.trim(key).alias("key"), (F.lit(None) if text is None else text).cast("string").alias("text"),
            (F.lit(None) if number is None else number.try_cast("double")).cast("double").alias("number"))

    def side(name: str) -> list[Column]:
        best = answer["Q3"][name]
        return [F.when(best.isNotNull(), row(F.lit(f"{name} title"), F.trim(best["title"]))),
                F.when(best.isNotNull(), row(F.lit(f"{name} rating"), number=best["rating"]))]

    titles = normalized(answer["Q1"], S.ANSWER["Q1"])
    rows = {
        "Q1": F.transform(F.map_entries(titles), lambda e: row(e["key"], F.to_json(F.struct(e["value"].alias("v"))))),
        "Q2": F.transform(answer["Q2"], lambda e: row(e[0], number=e[1])),
        "Q3": F.array_compact(F.array(*side("highest"), *side("lowest"))),
        "Q4": F.transform(answer["Q4"]["actors"], lambda e: row(e["name"], number=e["count"])),
        "Q5": F.array(*[row(F.lit(f), number=answer["Q5"][f]) for f in S.ANSWER["Q5"].names]),
    }
    opened = F.array(row(F.lit("answer"), F.coalesce(canonical_json(results), results)))
    for query, entries in rows.items():
        opened = F.when(F.col("query_id") == query, entries).otherwise(opened)
    others = [c for c in answers.columns if c != "results"]
    return answers.select(*others, F.inline_outer(opened))


def compare_answers(expected: DataFrame, obtained: DataFrame,
                    query_ids: Sequence[str] = tuple(S.ANSWER), tolerance: float = 5e-5) -> DataFrame:
    """``(client_id, query_id, status)`` for answers that are ``anomalous``,
    ``missing`` or ``unknown`` (not among the expected ones).

    Answers are matched row by row on query and key and then counted per client,
    so expected rows are never multiplied by clients.  Numbers may differ by the
    ``tolerance``, wherever they lie: nothing is rounded first, so there are no
    cells with two close numbers on either side of an edge.
    """
    want = answer_rows(expected.select("query_id", "results")).select(
        "query_id", "key", F.col("text").alias("_text"), F.col("number").alias("_number"))
    got = answer_rows(obtained.select("client_id", "query_id", "results"))
    sizes = want.groupBy("query_id").agg(F.count("key").alias("wanted"))
    close = F.col("_number").eqNullSafe(F.col("number")) | (
        F.abs(F.col("_number") - F.col("number")) <= tolerance)
    same = (F.col("_text").isNotNull() | F.col("_number").isNotNull()) & F.col("_text").eqNullSafe(
        F.col("text")) & F.coalesce(close, F.lit(False))
    counted = got.join(want, ["query_id", "key"], "left").groupBy("client_id", "query_id").agg(
        F.count("key").alias("found"), F.count_if(same).alias("matched"))
    judged = counted.join(sizes, "query_id", "left").select(
        "client_id", "query_id",
        F.when(F.col("wanted").isNull(), "unknown")
        .when((F.col("matched") < F.col("wanted")) | (F.col("found") > F.col("matched")),
              "anomalous").alias("status"))
    absent = missing_queries(obtained, query_ids).withColumn("status", F.lit("missing"))
    return judged.filter("status IS NOT NULL").unionByName(absent)


def actor_rows(answers: DataFrame) -> DataFrame:
    """Top-actor answers opened to ``(..., name, count)`` rows for ``diff_rows``."""
    others = [c for c in answers.columns if c not in ("query_id", "results")]
    opened = answers.filter("query_id = 'Q4'").select(
        *others, F.inline(F.from_json("results", S.ANSWER["Q4"])["actors"]))
    return opened.select(*others, F.trim("name").alias("name"), "count")
