"""Near-duplicate documents by SimHash and multi-index hashing.

A fingerprint has 64 bits.  It is cut into segments; two fingerprints that differ
in at most ``bits`` bits are within ``bits // segments`` bits in some segment, so it
is enough to look up, for each segment, the small Hamming ball around its value in
a table of segment values, and to verify the whole distance of what is found.  The
more fingerprints there are, the fewer and wider the segments.

Only distinct fingerprints are compared, so a group of exact copies is one row.
Buckets of more than ``fan_out`` fingerprints (large groups of near copies) are not
paired.  Their fingerprints take an exact route of linear size: two fingerprints
are within ``bits`` bits if and only if some 64-bit centre lies within ``bits // 2``
bits of one and the rest of the other, so each is linked to the smallest
fingerprint at the centres around it.  A centre has at most one ball of members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import as_row, keep_decided, whole_text
from marquee.session import materialize

SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 4) -> int:
    """SimHash of one text as a signed 64-bit number; 0 if it has no word.

    A-Z are lower-cased, words are split at ASCII white space, and every shingle
    counts as often as it occurs.  A bit is 1 if over half the hashes have it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(stops[:-1] + 1).tolist()][: len(words) - width + 1]
    stops = stops[width - 1:].tolist()
    digest, seed, ones = xxhash.xxh64_intdigest, SEED, np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def ball(width: int, radius: int) -> list[int]:
    """All masks over ``width`` bits with at most ``radius`` bits set, as signed numbers."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _segment(fp: Column, start: int, width: int) -> Column:
    shifted = F.shiftrightunsigned(fp, start)
    return shifted.bitwiseAND((1 << width) - 1) if width < 64 else shifted


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def segments_for(count: int, bits: int = 4, fan_out: int = 64) -> int:
    """The most segments at which so many fingerprints, if spread evenly, fill a bucket at most
    half; narrow segments have small balls, wide ones small buckets."""
    for segments in range(bits - 1, 1, -1):
        if count <= (fan_out // 2) << (64 // segments):
            return segments
    return 1 if bits < 2 else 2


def link(prints: DataFrame, bits: int = 4, segments: int = 3, fan_out: int = 64) -> DataFrame:
    """Links (a, b), a > b, between the distinct fingerprints in column ``fp``.

    Every two fingerprints within ``bits`` bits are linked directly or, in large
    buckets, through others that are each within ``bits`` bits of the next.
    """
    radius, edges = bits // segments, np.linspace(0, 64, segments + 1).astype(int).tolist()
    fp = F.col("fp")

    def keyed(radius: int) -> DataFrame:
        """A row for each segment and value within ``radius`` bits of the segment's own."""
        return reduce(DataFrame.unionByName, [
            prints.select("fp", F.explode(_longs(ball(stop - start, radius))).alias("mask")).select(
                "fp", F.lit(seg).alias("seg"),
                _segment(fp, start, stop - start).bitwiseXOR(F.col("mask")).alias("key"))
            for seg, (start, stop) in enumerate(zip(edges, edges[1:]))])

    # Spark takes an exploded table to be as small as before: merged, it can't be broadcast.
    index, probes = keyed(0).hint("merge"), keyed(radius).hint("merge")
    sizes = index.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    filled = (index.join(sizes.where(F.col("n") <= fan_out), ["seg", "key"])
              .select("seg", "key", fp.alias("other"))
              .unionByName(sizes.where(F.col("n") > fan_out)
                           .select("seg", "key", F.lit(None).cast("long").alias("other"))))
    met = probes.join(filled, ["seg", "key"]).where(
        F.col("other").isNull() | ((fp > F.col("other")) & (distance(fp, F.col("other")) <= bits)))
    # A large bucket says so in one row without a partner.
    met = materialize(met.select("fp", "other").distinct(), "met")
    crowded = met.where(F.col("other").isNull()).select("fp")
    pairs = met.where(F.col("other").isNotNull()).select(fp.alias("a"), F.col("other").alias("b"))
    return pairs.unionByName(_by_centre(crowded, bits)).distinct()


def _by_centre(prints: DataFrame, bits: int) -> DataFrame:
    near, far = bits // 2, bits - bits // 2
    around = prints.select("fp", F.explode(_longs(ball(64, far))).alias("mask"))
    at = Window.partitionBy("centre")
    first = F.min(F.when(F.bit_count("mask") <= near, F.col("fp"))).over(at)
    return (around.select("fp", "mask", F.col("fp").bitwiseXOR(F.col("mask")).alias("centre"))
            .withColumn("first", first).where("first <> fp")
            .select(F.greatest("fp", "first").alias("a"), F.least("fp", "first").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node with an edge and the smallest node it reaches.

    ``edges`` are (a, b) with a > b.  Large-star and small-star steps alternate
    until nothing changes; each step is written to the shared folder, so lineage
    stays short, and hubs are aggregated before they are joined.
    """
    state, before = materialize(edges.select("a", "b"), "edges"), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = mark
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = (both.where("b > a").join(least, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        wide = materialize(wide, "large-star")
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        state = materialize(
            wide.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")


def near_groups(docs: DataFrame, shingle: int = 4, bits: int = 4, segments: int | None = None,
                fan_out: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (long), ``root`` (the smallest
    fingerprint of its group) and ``component_id`` (the smallest id of its group).

    Null and empty texts have fingerprint 0 and are linked like any other; null ids
    don't count as the smallest unless a group has no other; repeated rows each get
    a row; an empty table gives no rows; other columns are not read.  Without ``segments``
    their number follows from that of the fingerprints; the result is the same for any.
    """
    prints = materialize(docs.select(
        F.col(id_col), fingerprint_column(whole_text(text_col), shingle).alias("fp")), "prints")
    by_print = materialize(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "by-print")
    segments = segments or segments_for(by_print.count(), bits, fan_out)
    roots = components(link(by_print.select("fp"), bits, segments, fan_out))
    grouped = materialize(by_print.join(roots, by_print["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select(id_col, "fp", "root", "component_id")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, columns unchanged.

    That is the row with the smallest id, of equal ids the smallest hash of the text, then
    of the whole row; a row without an id stays only in a group that has none with one.  So
    a row goes only for a near copy that stays, whatever ids it shares with other rows, and
    of repeated rows one stays.  Texts are not shuffled, but for those that
    ``common.keep_decided`` is unsure about.
    """
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                   F.xxhash64(whole_text(text_col)).alias("text"), F.xxhash64(*docs.columns).alias("row"))
    groups = near_groups(docs.select(key.alias("key"), F.col(text_col).alias("text")), id_col="key", **options)
    decided = materialize(groups.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component_id").alias("first")), "decided")
    rows = as_row(docs, key=key)
    kept = keep_decided(rows, "key", decided.select("key", "n", (F.col("key") == F.col("first")).alias("keep")))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
