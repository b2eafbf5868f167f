r"""How far the sources of a language differ in the terms they use.

Terms are runs of letters (A-Z, lower-cased, a-z, and everything beyond ASCII).  They are
found and counted on the bytes of the texts, in slices of some megabytes.  Within a slice
terms are dealt to buckets by length.  Terms of up to 16 bytes are packed into one or two
unsigned 64-bit words, first byte highest, and sorted by radix: a stable counting pass for
each 16 bits that a bucket's terms can fill.  Longer terms go to a bucket for each length and
are sorted as bytes.  Equal neighbours are one run, which gives the occurrences of a term and,
as sorting keeps the order of documents, the documents that hold it.

Spark sums the runs of all slices.  Each group (language, source) then gives a term the
part ``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))`` in whole numbers, where V terms
of the language are kept and the group has N occurrences of them.  Two sources differ by the
sum over all kept terms of the difference of their parts; for that, terms are dealt to
buckets of bounded size, of which each adds up a matrix over the language's sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import arrow_rows, discard, materialize

#: Bytes of text counted at a time (a longer text is one slice).
_SLICE = 4 << 20
#: Texts sent to Python at a time.
_ROWS = 1000
#: Rows (term, source) of a bucket, on average, and numbers of its matrix at a time.
_BUCKET_ROWS, _CELLS = 100_000, 1 << 21
#: What a term's letters become; 0 for bytes that part terms.
_LETTER = np.zeros(256, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
#: Masks that keep the first 0 to 8 bytes of a word.
_FIRST = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], np.uint64)
_COUNTS = "lang string, source string, term string, n long, docs long"


# --- counting in slices -----------------------------------------------------------------

def _radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by the keys, the first of which counts most; 16-bit keys sort by radix."""
    order = np.argsort(keys[-1], kind="stable")
    for key in reversed(keys[:-1]):
        order = order[np.argsort(key[order], kind="stable")]
    return order


def _runs(changes: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, length and number of different rows of each run of equal sorted keys."""
    new = np.ones(len(rows), bool)
    new[1:] = changes[0][1:] != changes[0][:-1]
    for key in changes[1:]:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    new[1:] |= rows[1:] != rows[:-1]
    return first, np.diff(first, append=len(rows)), np.add.reduceat(new, first, dtype=np.int64)


def _flat(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and lengths of terms that are padded with zeros (no term has a zero byte)."""
    held = cells != 0
    return cells[held], held.sum(axis=1)


def count_slice(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """Yields (group, term bytes, term lengths, occurrences, documents) of the runs in some texts.

    ``data`` are the bytes of all texts, ``offsets`` where each begins and the last ends,
    ``group`` a number for each.
    """
    letters = np.zeros(len(data) + 16, np.uint8)
    letters[:len(data)] = _LETTER[data]
    inside = letters[:len(data) + 1] != 0
    before = np.concatenate([[False], inside[:-1]])
    before[offsets] = False  # terms end with their text
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]])
    after[offsets[1:] - 1] = False
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    rows = np.searchsorted(offsets, starts, "right") - 1
    word_at = np.ndarray((len(data) + 9,), ">u8", letters, strides=(1,))

    halves = np.minimum((lengths + 1) // 2, 9)  # how many 16-bit digits a term fills; 9 for long ones
    for digits in range(1, 9):
        mine = np.flatnonzero(halves == digits)
        if not len(mine):
            continue
        at, size, row = starts[mine], lengths[mine], rows[mine]
        words = [word_at[at].astype(np.uint64) & _FIRST[np.minimum(size, 8)]]
        if digits > 4:
            words.append(word_at[at + 8].astype(np.uint64) & _FIRST[size - 8])
        keys = [(words[d // 4] >> np.uint64(48 - 16 * (d % 4))).astype(np.uint16) for d in range(digits)]
        order = _radix_order([group[row], *keys])
        words, row = [w[order] for w in words], row[order]
        first, n, docs = _runs([group[row], *words], row)
        cells = np.column_stack([w[first].astype(">u8").view(np.uint8).reshape(-1, 8) for w in words])
        yield group[row[first]], *_flat(cells), n, docs
    for size in np.unique(lengths[halves == 9]).tolist():
        mine = np.flatnonzero(lengths == size)
        cells = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(letters, size)[starts[mine]])
        terms = cells.view(f"S{size}").ravel()
        row = rows[mine]
        order = _radix_order([group[row], terms])
        terms, row = terms[order], row[order]
        first, n, docs = _runs([group[row], terms], row)
        yield group[row[first]], *_flat(cells[order[first]]), n, docs


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of some megabytes, one row at least."""
    first = 0
    while first + 1 < len(offsets):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _SLICE, "right")) - 1)
        yield first, last
        first = last


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
        texts = batch.column(2).cast(pa.large_binary())
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(buffers[2] or b"", np.uint8)
        many = len(sources.dictionary)
        group = langs.indices.to_numpy().astype(np.int64) * many + sources.indices.to_numpy()
        used, group = np.unique(group, return_inverse=True)
        group = group.astype(np.uint16 if len(used) <= 1 << 16 else np.int64)
        lang_of, source_of = pa.array(used // many), pa.array(used % many)
        for first, last in _slices(offsets):
            own = offsets[first:last + 1]
            for code, flat, sizes, n, docs in count_slice(
                    data[own[0]:own[-1]], own - own[0], group[first:last]):
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                at = pa.array(code.astype(np.int64))
                yield pa.RecordBatch.from_arrays([
                    langs.dictionary.take(lang_of.take(at)), sources.dictionary.take(source_of.take(at)),
                    pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(flat)),
                    pa.array(n.astype(np.int64)), pa.array(docs)], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term.

    Each row is a document; nulls are read as empty strings; documents without a term
    give no row; an empty table gives none.
    """
    read = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return docs.select(*read).mapInArrow(_count_batches, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- parts and differences --------------------------------------------------------------

def part(n: Column, total: Column, kept: Column, scale: int, prior: int) -> Column:
    """``1 + floor(scale * (n + prior) / (total + prior * kept))``, exactly."""
    def whole(number: Column) -> Column:
        return number.cast("decimal(18,0)")

    return F.lit(1) + F.call_function(
        "div", whole(F.lit(scale)) * whole(n + prior), whole(total + prior * kept))


def audit(docs: DataFrame, least_docs: int = 30, scale: int = 1_000_000_000, prior: int = 5,
          ranks: int = 50, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) for each group (lang, source).

    ``part`` "pair": ``item`` is another source of the language, ``value`` the sum over the
    language's kept terms of the difference of the two sources' parts (0 without kept
    terms); all of them are ranked.  ``part`` "term": ``item`` is a term that the group has
    and whose part there exceeds the language's, ``value`` by how much; the first ``ranks``
    only.  A language keeps the terms of at least ``least_docs`` of its documents.  Ranks
    follow falling value, then the item's bytes.

    Null columns are read as ''; repeated rows are documents of their own; a group without
    terms takes part with counts of 0; the only source of a language has no pairs; an
    empty table gives no rows; other columns are not read.
    """
    with arrow_rows(docs.sparkSession, _ROWS):
        counts = materialize(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    kept = materialize(
        counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    own = materialize(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"),
                      "own-terms")
    discard(counts)
    per_lang = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    per_group = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                           for c, name in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    groups = materialize(
        groups.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
        .na.fill(0, ["total", "kept", "lang_total"]), "groups")
    here = part(F.col("n"), F.col("total"), F.col("kept"), scale, prior)
    there = part(F.col("lang_n"), F.col("lang_total"), F.col("kept"), scale, prior)
    parts = materialize(own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", here.alias("p"), (here - there).alias("value")), "parts")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (parts.where("value > 0").select("lang", "source", F.lit("term").alias("part"),
                                             F.col("term").alias("item"), "value")
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks))
    pairs = (_pairs(parts.select("lang", "source", "term", "p"), groups, scale, prior)
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(terms)


def _pairs(parts: DataFrame, groups: DataFrame, scale: int, prior: int) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways.

    Terms are dealt by hash to as many buckets as their rows need, so a task adds up some
    100,000 rows whatever the language's share; each bucket knows all sources.
    """
    buckets = max(1, parts.count() // _BUCKET_ROWS)
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    least = part(F.lit(0), F.col("total"), F.col("kept"), scale, prior)
    sources = groups.where("kept > 0").select(
        "lang", "source", least.alias("least"), F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    sums = (dealt.groupBy("lang", "bucket").cogroup(sources.groupBy("lang", F.col("bucket").cast("long")))
            .applyInArrow(_pair_sums, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    names = groups.select("lang", "source")
    every = names.join(names.withColumnRenamed("source", "item"), "lang").where("source <> item")
    return every.join(sums, ["lang", "source", "item"], "left").na.fill(0, ["value"])


def _pair_sums(rows: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of differences over the terms of one bucket."""
    names, least = sources["source"].combine_chunks(), sources["least"].to_numpy()
    many, sums = len(names), np.zeros((len(names), len(names)), np.int64)
    column = pc.index_in(rows["source"], names).to_numpy()
    term = rows["term"].combine_chunks().dictionary_encode()
    terms, term = len(term.dictionary), term.indices.to_numpy()
    order = np.argsort(term, kind="stable")
    term, column, p = term[order], column[order], rows["p"].to_numpy()[order]
    for first in range(0, terms, step := max(1, _CELLS // max(1, many))):
        size = min(step, terms - first)
        a, b = np.searchsorted(term, [first, first + size])
        cells = np.repeat(least[:, None], size, axis=1)
        cells[column[a:b], term[a:b] - first] = p[a:b]
        for k in range(many):
            sums[k] += np.abs(cells - cells[k]).sum(axis=1)
    one, other = np.nonzero(~np.eye(many, dtype=bool))
    if not terms:
        one = other = one[:0]
    lang = sources["lang"].combine_chunks() if many else pa.array([], pa.string())
    return pa.table({"lang": lang.take(pa.array(one * 0)), "source": names.take(pa.array(one)),
                     "item": names.take(pa.array(other)), "value": sums[one, other]})
