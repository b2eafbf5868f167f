"""Records that span lines, read in parallel from files that Spark splits anywhere.

A quoted text may hold line breaks, so whether a line begins a record depends on all
quotes before it.  Only their number's parity counts, and parities add up: each split of a
file counts its lines with an odd number of quotes, a running sum over the splits (one row
each) gives the count before each split, and within a split a count that is carried from
row to row gives the count before each line.  A line after an even count begins a record;
one with an even number of quotes after an even count is a record.  Only the other lines
are shuffled, to be joined with those of the same record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.json_text import is_json

_PLACE = ("_file", "_block")


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """Lines with the file and split they are in, and whether their quotes are odd in number."""
    text = spark.read.text(path)
    # Lengths in bytes are known; characters would be counted, twice a line and pass.
    quotes = (F.octet_length("value") - F.octet_length(F.replace("value", F.lit(quote), F.lit("")))) / len(quote.encode())
    return text.select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        (quotes % 2 == 1).alias("_odd"))


def _running(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Odd lines and lines before each line of its split.  The rows of a split come in order;
    a file goes by a hash of its path, as only the next split has to be told apart."""
    place, odd_before, lines_before = None, 0, 0
    for files, blocks, odd in batches:
        places = np.column_stack([files.to_numpy(), blocks.to_numpy()])
        flags = np.asarray(odd.to_numpy(zero_copy_only=False), np.int64)
        if not len(flags):
            yield pa.array([], pa.struct([("odd", pa.int64()), ("line", pa.int64())]))
            continue
        first_new = place is None or bool((places[0] != place).any())
        new = np.concatenate([[first_new], (places[1:] != places[:-1]).any(axis=1)])
        at = np.arange(len(flags))
        first = np.maximum.accumulate(np.where(new, at, -1))  # of the line's split; -1: carried on
        before = np.concatenate([[0], np.cumsum(flags)])
        odds = np.where(first < 0, odd_before + before[:-1], before[:-1] - before[first])
        lines = np.where(first < 0, lines_before + at, at - first)
        place = places[-1]
        odd_before, lines_before = int(odds[-1] + flags[-1]), int(lines[-1] + 1)
        yield pa.StructArray.from_arrays([pa.array(odds), pa.array(lines)], ["odd", "line"])


def quoted_records(spark: SparkSession, path: str, quote: str = '"', header: bool = True) -> DataFrame:
    """``value``: one row per record of the files; blank lines outside records are left out.

    Line breaks of any kind within a record become ``\\n``.  With ``header`` the first line of
    each file is left out.  A quote that is never closed makes one record of what follows up
    to the next quote (or the end of the file), as it would for any reader; a record must fit
    one row.  The order of records isn't kept.
    """
    lines = _lines(spark, path, quote)
    splits = lines.groupBy(*_PLACE).agg(F.sum(F.col("_odd").cast("long")).alias("_odds"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(*_PLACE, F.coalesce(F.sum("_odds").over(earlier), F.lit(0)).alias("_earlier"))
    # Not to be moved: the count goes through the rows of a split as they are read.
    running = F.arrow_udf(_running, "struct<odd:long,line:long>").asNondeterministic()
    counted = lines.withColumn("_at", running(F.xxhash64("_file"), "_block", "_odd"))
    if header:
        counted = counted.where((F.col("_block") > 0) | (F.col("_at.line") > 0))
    before = F.col("_earlier") + F.col("_at.odd")
    # One row a split: sent to the lines, as the lines would otherwise be shuffled to it.
    counted = counted.join(F.broadcast(splits), list(_PLACE)).select(
        "value", *_PLACE, "_odd", before.alias("_before"), F.col("_at.line").alias("_line"))
    alone = (F.col("_before") % 2 == 0) & ~F.col("_odd")
    place = F.struct("_block", "_line", "value")
    joined = (counted.where(~alone).groupBy("_file", F.floor(F.col("_before") / 2).alias("_record"))
              .agg(F.sort_array(F.collect_list(place)).alias("_parts"))
              .select(F.array_join(F.transform("_parts", lambda part: part["value"]), "\n").alias("value")))
    return counted.where(alone & (F.trim("value") != "")).select("value").unionByName(joined)


# --- JSON objects one after another -----------------------------------------------------

_STRUCTURE = re.compile(r'\\.|["{]', re.DOTALL)
_SIDES = ("out", "in")  # a split begins outside a string, or within one
_RUN = T.StructType([T.StructField("line", T.LongType()), *[
    T.StructField(f"{name}_{side}", T.LongType()) for side in _SIDES
    for name in ("inside", "before", "after", "low", "count")]])


def _scan(piece: str, inside: bool) -> tuple[int, bool]:
    """Braces opened by a piece, less the one that ends it, and whether it ends within a string."""
    opened = 0
    for token in _STRUCTURE.findall(piece):
        if token == '"':
            inside = not inside
        elif token == "{" and not inside:
            opened += 1
    return opened - (not inside), inside


def _walk(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """For each piece, and for both ways its split may begin: whether it ends within a string,
    the depth before and after it (counted from the split's begin), and the least depth so
    far with how often a piece ended at it."""
    place, line, runs = None, 0, []
    for files, blocks, pieces in batches:
        columns: list[list[int]] = [[] for _ in _RUN.names]
        for file, block, piece in zip(files.to_pylist(), blocks.to_pylist(), pieces.to_pylist()):
            if (file, block) != place:
                place, line = (file, block), 0
                runs = [[inside, 0, 0, 0] for inside in (False, True)]
            columns[0].append(line)
            for k, run in enumerate(runs):
                inside, depth, low, count = run
                change, inside = _scan(piece, inside)
                for column, number in zip(columns[1 + 5 * k:], (int(inside), depth, depth + change, low, count)):
                    column.append(number)
                depth += change
                low, count = (depth, 1) if depth < low else (low, count + (depth == low))
                run[:] = inside, depth, low, count
            line += 1
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], _RUN.names)


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """``(path, document)``: the text of every JSON object that isn't part of another one.

    Objects may stand one after another, be elements of lists, be printed over many lines or
    all on one; what is between them is left out, as is one that is cut off by the end of its
    file.  Quotes outside objects must pair up.

    Files are read in pieces that end with a closing brace, so they are split anywhere and no
    task holds a file.  Whether a brace counts hangs on strings begun earlier, and which object
    it belongs to on the depth: both are followed through each split for a begin outside and
    within a string, the splits of a file (one row each) are then folded in order, and pieces
    of one object are joined.  An object without others inside is one piece and isn't shuffled.
    """
    pieces = spark.read.option("recursiveFileLookup", True).text(path, lineSep="}").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_block"))
    walk = F.arrow_udf(_walk, _RUN).asNondeterministic()
    pieces = pieces.withColumn("_at", walk(*_PLACE, "value"))

    last = F.max_by("_at", "_at.line")
    splits = pieces.groupBy(*_PLACE).agg(
        last.alias("_last"), F.sum(F.octet_length("value") + F.lit(1)).cast("long").alias("_bytes"),
        F.max("_size").alias("_size"))

    def ended(state: Column, split: Column) -> Column:
        """State (inside, depth, objects) behind a split, from that before it."""
        def way(side: str) -> Column:
            at = {name: split["_last"][f"{name}_{side}"] for name in ("inside", "after", "low", "count")}
            low = F.least(at["low"], at["after"])
            count = F.when(at["after"] < at["low"], 1).otherwise(at["count"] + (at["after"] == at["low"]).cast("long"))
            return F.struct(at["inside"].alias("inside"), (state["depth"] + at["after"]).alias("depth"),
                            (state["objects"] + F.when(low == -state["depth"], count).otherwise(0)).alias("objects"))

        return F.when(state["inside"] == 1, way("in")).otherwise(way("out"))

    zero = F.lit(0).cast("long")
    begin = F.struct(*[zero.alias(name) for name in ("inside", "depth", "objects")])
    files = splits.groupBy("_file").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_last"))).alias("_splits"),
        (F.sum("_bytes") == F.max("_size")).alias("_whole"))
    places = F.aggregate(
        "_splits", F.struct(begin.alias("state"), F.array().cast(
            "array<struct<block:long,state:struct<inside:long,depth:long,objects:long>>>").alias("found")),
        lambda so_far, split: F.struct(
            ended(so_far["state"], split).alias("state"),
            F.array_append(so_far["found"], F.struct(split["_block"].alias("block"), so_far["state"].alias("state")))
            .alias("found")),
        lambda so_far: so_far["found"])
    begins = files.select(
        "_file", "_whole", F.element_at("_splits", -1)["_block"].alias("_final"),
        F.element_at("_splits", -1)["_last"]["line"].alias("_final_line"), F.explode(places).alias("_begin")
    ).select("*", F.col("_begin.block").alias("_block"), F.col("_begin.state").alias("_state")).drop("_begin")

    placed = pieces.join(begins, list(_PLACE))
    within = F.col("_state.inside") == 1
    at = {name: F.when(within, F.col(f"_at.{name}_in")).otherwise(F.col(f"_at.{name}_out"))
          for name in ("before", "after", "low", "count")}
    depth = F.col("_state.depth")
    unfinished = ~F.col("_whole") & (F.col("_block") == F.col("_final")) & (F.col("_at.line") == F.col("_final_line"))
    placed = placed.select(
        "_file", "_block", F.col("_at.line").alias("_line"),
        F.when(unfinished, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("value"),
        (depth + at["before"]).alias("_before"), (depth + at["after"]).alias("_after"),
        (F.col("_state.objects") + F.when(at["low"] == -depth, at["count"]).otherwise(0)).alias("_object"))
    # A piece outside all objects that opens none ends below the depth it began at.
    placed = placed.where("_before > 0 OR _after >= 0")
    alone = (F.col("_before") == 0) & (F.col("_after") == 0)
    joined = placed.where(~alone).groupBy("_file", "_object").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_line", "value"))).alias("_parts")).select(
        "_file", F.array_join(F.transform("_parts", lambda part: part["value"]), "").alias("value"))
    found = placed.where(alone).select("_file", "value").unionByName(joined)
    document = F.regexp_replace("value", r"^[^{]*", "")
    return found.select(F.col("_file").alias("path"), document.alias("document")).where(is_json(F.col("document")))
