"""Top-k, row numbering and head trims."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import shared_dir


# Spark's default for spark.sql.optimizer.windowGroupLimitThreshold.
_GROUP_LIMIT = 1000


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows: each task keeps its own best ``k`` before the merge.
    ``order`` should end in a unique column."""
    return df.orderBy(*order).limit(k)


def top_k_by(df: DataFrame, k: int, by: Sequence[str], *order: Column) -> DataFrame:
    """The first ``k`` rows of each group.  The rank test lets Spark cut every group
    to ``k`` rows per task before the shuffle, for ``k`` up to its group limit; beyond
    that, parts of a group are cut first, so a hot group is not sorted in one task."""
    if k > _GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(64))
        cut = Window.partitionBy(*by, "_part").orderBy(*order)
        df = (df.withColumn("_part", part).withColumn("_rank", F.row_number().over(cut))
              .filter(F.col("_rank") <= k).drop("_rank", "_part"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def top_budgets(totals: DataFrame, k: int = 5) -> DataFrame:
    return top_k(totals, k, F.desc("total"), F.asc("country"))


def top_actors(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, k, F.desc("count"), F.asc("name"))


def number_few(df: DataFrame, k: int, *order: Column, column: str = "position") -> DataFrame:
    """Top ``k`` with positions from 1.  Only these ``k`` rows meet in one task."""
    return top_k(df, k, *order).withColumn(
        column, F.row_number().over(Window.orderBy(*order)))


def number_rows(df: DataFrame, *order: Column, column: str = "position") -> DataFrame:
    """Positions from 1 over a table of any size.

    Runs a job: the rows are range-sorted and checkpointed, which fixes their
    partitions; the rows of each partition are then numbered behind the total
    of the partitions before it.  No task sees more than its own range.  Rows with
    equal keys are told apart by their other columns and, if these agree too, by
    where they were read, so a key with very many rows spreads over ranges.
    """
    shared_dir(df.sparkSession)
    tied = df.withColumns({"_tie": F.xxhash64(*df.columns), "_read": F.monotonically_increasing_id()})
    fixed = tied.orderBy(*order, "_tie", "_read").drop("_tie", "_read").checkpoint()
    placed = fixed.withColumns({
        "_part": F.spark_partition_id(),
        "_row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
    })
    # One row per partition: as many as the sort has tasks, whatever the data size.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size")).collect()
    before, offsets = 0, []
    for part, size in sorted((row["_part"], row["_size"]) for row in sizes):
        offsets.append((part, before))
        before += size
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _start bigint")
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn(column, F.col("_start") + F.col("_row") + 1).drop(
        "_part", "_row", "_start")


def head_percent(df: DataFrame, percent: float | None, key: str) -> DataFrame:
    """The first ``int(rows * percent / 100)`` rows by the unique, non-null column ``key``.

    Percentages outside (0, 100] and None leave the table whole.  Only the key
    column is sorted; the rows themselves are filtered against the cut-off key,
    a predicate that reaches the file scan.
    """
    if percent is None or not 0 < percent <= 100:
        return df
    keys = number_rows(df.select(key), F.asc(key), column="_n")
    wanted = math.floor(keys.count() * (percent / 100))
    cut = keys.filter(F.col("_n") == wanted).select(key).head()
    return df.limit(0) if cut is None else df.filter(F.col(key) <= F.lit(cut[0]))


def head_percents(tables: dict[str, DataFrame], percents: dict[str, float],
                  keys: dict[str, str]) -> dict[str, DataFrame]:
    """``head_percent`` for several named tables; unnamed ones stay whole."""
    return {
        name: head_percent(df, percents.get(name), keys[name]) if name in percents else df
        for name, df in tables.items()
    }
