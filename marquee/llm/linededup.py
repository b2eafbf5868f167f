"""Repeated runs of lines: later copies are deleted.

A document is the sequence of its lines that hold a word; a line's id is a 128-bit
hash of the trimmed line.  Suffixes of these sequences are ranked by prefix doubling:
the rank of a suffix for its first 2^k lines follows from the pair of ranks of its
two halves of 2^(k-1) lines, each of which is one class of the level before.  The
rank of a class is the place of its first member, so ranks say both which suffixes
agree and which copy came first.  A class with two members or more is an interval of
suffixes with a common prefix of 2^k lines or more; suffixes that are alone leave
the work, so a level holds only lines within repeated runs.

A run of n lines is named by the ranks of the two (overlapping) runs of 2^k lines,
2^k <= n < 2^(k+1), at its head and tail, which gives the common-prefix intervals at
any depth.  A repeated run of ``min_words`` words or more is the union of shortest
windows of that many words, counted from a line on or up to a line, and is repeated
if and only if these are.  So windows are named, grouped by name, and those that are
not the first of their name are deleted; overlapping windows merge into the maximal
runs.  Ranks only serve to compare suffixes, so classes are kept and no sorted
suffix list is written.

Everything is DataFrame work.  A line with a third of all rows is counted before the
shuffle, and is joined to the counts in plain joins, which Spark splits where skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import NOT_SPACE, as_row, marked, numbered, whole_text
from marquee.session import discard, materialize

#: Lines per document are numbered in 28 bits, documents in 35.
_LINE_BITS = 28
_BLANK = " \t\n\x0b\f\r"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, h (document), pos (place among all lines), idx (among lines with words), words, id1, id2."""
    line = F.filter(
        F.transform(F.split(whole_text(text_col), "\n"),
                    lambda x, i: F.struct(i.alias("pos"), F.trim(x, F.lit(_BLANK)).alias("line"))),
        lambda x: x["line"] != "")
    return (docs.select(F.col(id_col).alias("doc"), F.xxhash64(whole_text(text_col)).alias("h"),
                        F.posexplode(line).alias("idx", "at"))
            .select("doc", "h", "at.pos", "idx",
                    F.regexp_count("at.line", F.lit(NOT_SPACE)).alias("words"),
                    F.xxhash64("at.line").alias("id1"), F.xxhash64(F.lit("line"), "at.line").alias("id2")))


def repeated_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc, h, drop): the places of the lines to delete, for documents that have any.

    The first copy is the one in the smallest (id, text hash), then the earliest
    line; a null id comes first.  Rows with equal id and text are one document.
    """
    lines = materialize(_lines(docs, id_col, text_col).distinct(), "lines")
    # Counts are written, so that the joins read plain shuffles, which Spark splits where skewed.
    twice = materialize(lines.groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    some = materialize(lines.join(twice.drop("n"), ["id1", "id2"]), "repeated")
    discard(lines, twice)
    order = numbered(some.select("doc", "h").distinct(),
                     [F.col("doc").asc_nulls_first(), F.col("h")])
    order = order.select(F.col("doc").alias("_doc"), F.col("h").alias("_h"), "ord")
    whole = some
    some = (some.join(order, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h")))
            .withColumn("at", F.shiftleft("ord", _LINE_BITS) + F.col("idx")))
    some = materialize(some.select("doc", "h", "pos", "ord", "at", "words", "id1", "id2"), "placed")
    discard(whole)

    windows = materialize(_windows(some, min_words), "windows")
    longest = windows.agg(F.max("length")).first()[0] or 0
    levels = [_ranked(some.select("at", F.col("id1").alias("one"), F.col("id2").alias("two")))]
    while 2 ** len(levels) <= longest:
        half, step = levels[-1], 2 ** (len(levels) - 1)
        tail = half.select((F.col("at") - step).alias("at"), F.col("rank").alias("two"))
        levels.append(_ranked(half.select("at", F.col("rank").alias("one")).join(tail, "at")))

    named = [_named(windows, k, level) for k, level in enumerate(levels)]
    if not named:
        named = [windows.select("at", "length", F.col("at").alias("one"), F.col("at").alias("two"))]
    runs = named[0]
    for more in named[1:]:
        runs = runs.unionByName(more)
    runs = materialize(runs, "runs")
    discard(windows, *levels)
    first = materialize(runs.groupBy("length", "one", "two").agg(
        F.min("at").alias("first"), F.max("at").alias("last")).where("first < last"), "first")
    later = runs.join(first, ["length", "one", "two"]).where("at > first")
    gone = later.select(F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("at")).distinct()
    drops = materialize(some.join(gone, "at").groupBy("doc", "h").agg(F.collect_set("pos").alias("drop")), "drops")
    discard(runs, first, some)
    return drops


def _ranked(pairs: DataFrame) -> DataFrame:
    """(at, rank) of the places whose pair occurs twice or more; rank is the first such place."""
    pairs = materialize(pairs, "pairs")
    classes = materialize(pairs.groupBy("one", "two").agg(
        F.min("at").alias("rank"), F.max("at").alias("last")).where("rank < last").drop("last"), "classes")
    ranks = materialize(pairs.join(classes, ["one", "two"]).select("at", "rank"), "ranks")
    discard(pairs, classes)
    return ranks


def _windows(some: DataFrame, min_words: int) -> DataFrame:
    """(at, length): shortest windows of ``min_words`` words from each line on and up to each line.

    Only neighbouring repeated lines form windows.  Partitions are documents, whose
    lines come from one row.
    """
    doc = Window.partitionBy("ord").orderBy("at")
    island = Window.partitionBy("ord", "island")
    upto = island.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (some.select("ord", "at", "words")
            .withColumn("island", F.col("at") - F.row_number().over(doc))
            .withColumn("end", F.sum("words").over(upto))
            .withColumn("begin", F.col("end") - F.col("words")))
    ahead = island.orderBy("begin").rangeBetween(0, min_words - 1)
    back = island.orderBy("end").rangeBetween(-(min_words - 1), 0)
    sized = (rows.withColumn("n", F.count(F.lit(1)).over(ahead)).withColumn("reach", F.max("end").over(ahead))
             .withColumn("m", F.count(F.lit(1)).over(back)).withColumn("from", F.min("begin").over(back)))
    both = F.array(
        F.when(F.col("reach") - F.col("begin") >= min_words, F.struct("at", F.col("n").alias("length"))),
        F.when(F.col("end") - F.col("from") >= min_words,
               F.struct((F.col("at") - F.col("m") + 1).alias("at"), F.col("m").alias("length"))))
    return sized.select(F.explode(both).alias("w")).where("w is not null").select("w.at", "w.length").distinct()


def _named(windows: DataFrame, k: int, ranks: DataFrame) -> DataFrame:
    """Windows of 2^k to 2^(k+1) - 1 lines with the ranks of their head and tail."""
    mine = windows.where((F.col("length") >= 2 ** k) & (F.col("length") < 2 ** (k + 1)))
    head = ranks.select("at", F.col("rank").alias("one"))
    tail = ranks.select(F.col("at").alias("tail"), F.col("rank").alias("two"))
    return (mine.join(head, "at").withColumn("tail", F.col("at") + F.col("length") - 2 ** k)
            .join(tail, "tail").select("at", "length", "one", "two"))


def with_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with the text without later copies, ``n_lines`` and ``dropped`` (places, sorted).

    Null and empty texts have no lines and stay as they are, as do lines without a
    word.  Repeated rows (equal id and text) are one document and get one answer.
    An empty table stays empty.
    """
    drops = repeated_lines(docs, min_words, id_col, text_col)
    rows = as_row(docs, id=F.col(id_col), key=F.xxhash64(whole_text(text_col)))
    # Only rows that may have a line to drop are shuffled to the places of these lines.
    rows = marked(rows, "hit", F.xxhash64("id", "key"), drops, F.xxhash64("doc", "h"))
    hits = rows.where("hit").join(drops, F.col("id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("h")), "left")
    joined = hits.select("row", "drop").unionByName(
        rows.where("NOT hit").select("row", F.lit(None).cast("array<int>").alias("drop")))
    old = F.col("row").getField(text_col)
    lines = F.split(old, "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop")),
                       lambda i: F.get(lines, i))
    text = F.when(F.col("drop").isNull(), old).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[(text if c == text_col else F.col("row").getField(c)).alias(c)
          for c in docs.columns if c not in ("n_lines", "dropped")],
        F.when(old.isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(F.sort_array("drop"), F.array().cast("array<int>")).alias("dropped"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without later copies of runs; a text of which no line is left goes.

    Columns are those of ``docs``; ``n_chars``, if there, follows the text.
    """
    rows = as_row(docs, doc_id=F.col(id_col), text=F.col(text_col))
    out = with_lines(rows, **options)
    emptied = (F.size("dropped") > 0) & (F.trim("text", F.lit(_BLANK)) == "")
    length = F.char_length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    new = {text_col: F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("dropped") > 0, length).otherwise(F.col("row").getField("n_chars"))
    return out.where(~F.coalesce(emptied, F.lit(False))).select(*[
        (new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])
