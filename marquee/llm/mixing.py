"""Mixing sources to target weights by weighted sampling without replacement.

Each source has a target in words.  While the target holds a whole source, all its
documents are taken (complete epochs); the rest is a fraction of an epoch, drawn by
Efraimidis and Spirakis: a document's key is an exponential variate divided by its
quality weight, documents are sorted by key within their source, and a prefix of
that order is taken whose words come nearest to the rest.

The order is never made in one piece.  Keys fall into up to 4,097 bins, whose sizes
are summed before they are shuffled; the prefix sum over bins finds the bin in which
a source's budget ends, and only the documents of that bin are sorted.  What comes
out is one cut per source, so a source with a third of all rows is no larger than
any other.  The variates come from a hash of id and text: reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import as_row, whole_text, word_count
from marquee.session import materialize

BINS = 4_096
#: Weights by whose keys the bins are spread.
SPREAD = tuple(2.0 ** -k for k in range(7))
SHARES = (5, 2, 1)


def quality_weight(text: Column) -> Column:
    """Share of letters and white space in the text, 0.05 at least."""
    kept = F.char_length(F.regexp_replace(text, "[^\\p{L} \\t-\\r]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(kept / F.nullif(F.char_length(text), F.lit(0)), F.lit(0.0)))


def exponential_key(seed: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of a hash."""
    bits = F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("long")
    return -F.ln((bits + 0.5) / F.lit(float(1 << 52))) / weight


def targets(sizes: DataFrame, total_share: float = 1.5, most: float = 2.0,
            shares: tuple[int, ...] = SHARES) -> DataFrame:
    """(source, source_size) -> the same with ``target`` in words.

    Sources by code point, null last, have the weights ``shares``, repeating, and
    divide ``total_share`` of all words; none gets more than ``most`` times its own
    words, and what is above goes to the others by weight.  Sorted by the level at
    which they are full, the full sources are a prefix, so one pass of prefix sums
    over one row per source gives the level of the others.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(s).cast("double") for s in shares]),
                          ((F.row_number().over(place) - 1) % len(shares) + 1).cast("int"))
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    full = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * total_share
              - (F.sum("_cap").over(full) - F.col("_cap")))
             / (F.sum("_w").over(everything) - (F.sum("_w").over(full) - F.col("_w"))))
    rows = rows.withColumn("_level", level).withColumn("_full", F.col("_level") > F.col("_cap") / F.col("_w"))
    shared = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return (rows.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(shared * F.col("_w")))
            .select("source", "source_size", "target"))


def plan(measured: DataFrame, **options) -> DataFrame:
    """Per source: source_size, target, ``epochs`` and the cut (``cut_bin``, ``cut_key``)."""
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = materialize(targets(sizes, **options).withColumn("epochs", whole.cast("int")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")), "goals")
    by_bin = measured.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    goal = goals.select(F.col("source").alias("_source"), "rest")
    ends = (by_bin.withColumn("after", F.sum("words").over(upto))
            .join(goal, F.col("source").eqNullSafe(F.col("_source")))
            .where("after - words < rest and rest <= after")
            .select("_source", "rest", F.col("bin").alias("cut_bin"),
                    (F.col("after") - F.col("words")).alias("before")))
    ends = materialize(ends, "ends")
    inside = (measured.join(ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("cut_bin")))
              .groupBy("_source", "rest", "before", "key").agg(F.sum("size").alias("words")))
    by_key = Window.partitionBy("_source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (inside.withColumn("after", F.col("before") + F.sum("words").over(by_key))
            # the last document is taken if that comes nearer to the budget
            .where("2 * after - words <= 2 * rest")
            .groupBy("_source").agg(F.max("key").alias("cut_key")))
    marks = ends.select("_source", "cut_bin").join(
        cuts.withColumnRenamed("_source", "_cut_source"),
        F.col("_source").eqNullSafe(F.col("_cut_source")), "left").select("_source", "cut_bin", "cut_key")
    return materialize(goals.join(marks, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "epochs", "cut_bin", "cut_key"), "mix")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", weight: Column | None = None) -> DataFrame:
    """The rows of ``docs`` with source, size (words), key and bin."""
    text = whole_text(text_col)
    seed = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text)
    key = exponential_key(seed, quality_weight(text) if weight is None else weight)
    rows = as_row(docs, source=F.col(source_col), size=word_count(text), key=key)
    # Keys of weight w lie evenly under 1 - exp(-w * key); the mean over such curves, which rises
    # with the key, leaves no bin more than a few even shares, whatever the weights are.
    share = reduce(lambda a, b: a + b, [1 - F.exp(F.col("key") * -w) for w in SPREAD]) / len(SPREAD)
    return rows.withColumn("bin", F.floor(share * BINS).cast("int"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, **options) -> DataFrame:
    """``docs`` with size, source_size, target (words of the source), ``copies`` and ``taken``.

    Null texts and texts without words have size 0 and are taken as often as the
    rest of their source, with 0 words.  A null source is a source of its own.
    Ties in key stay together; repeated rows share a key and are taken alike.  An
    empty table gives an empty mix.  Columns named like the added ones are replaced.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    measured = measure(docs, id_col, text_col, source_col, weight)
    ends = plan(materialize(measured.drop("row"), "sizes"), **options).withColumnRenamed("source", "of")
    more = F.coalesce((F.col("bin") < F.col("cut_bin"))
                      | ((F.col("bin") == F.col("cut_bin")) & (F.col("key") <= F.col("cut_key"))), F.lit(False))
    copies = F.col("epochs") + more.cast("int")
    return measured.join(ends, F.col("source").eqNullSafe(F.col("of"))).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in added],
        "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
