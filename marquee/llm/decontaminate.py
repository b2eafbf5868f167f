"""Benchmark passages in documents: item-sized windows, SimHash, exact check.

For each size that benchmark items have, a window of that many words slides over a
text.  A window is fingerprinted (SimHash of its word shingles), looked up among the
items of that size by multi-index hashing, and the items found are compared with it
exactly: the weighted Jaccard similarity of the two bags of shingles, in which a
shingle weighs as often as it occurs.

Multi-index: 64 bits are four blocks; two fingerprints within ``RADIUS`` bits agree
up to ``RADIUS // 4`` bits in some block.  The table of a block lists each item under
every value of its ball, so one look-up per block finds all of them.  Windows without
any shingle of any item of their size have similarity 0 and aren't fingerprinted;
every other window is.

Words are runs of letters and digits in lower case.  All work on a text is numpy over
its bytes, one batch of texts at a time; no text is shuffled for it.  Tasks hold the items
they look for.  A benchmark of more than ``ITEMS_PER_BLOCK`` items or ``BYTES_PER_BLOCK``
bytes is dealt to blocks by hash, of about that size each; every block is a pass of its own
over the texts, whose finds are written before the next one starts, so neither the driver nor
a task holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import as_row, marked, whole_text
from marquee.llm.simhash import ball
from marquee.session import discard, materialize

SHINGLE = 5
SIMILARITY = 0.8
#: Similarity 0.8 is about 10 differing bits in the mean, with a deviation of 3.
RADIUS = 19
BLOCKS = 4
ITEMS_PER_BLOCK, BYTES_PER_BLOCK = 2000, 4 << 20
#: Bytes of texts scanned at once: arrays of eight bytes for each are held, beside one another.
_CHUNK = 1 << 18
_HIT = "array<struct<item_id:bigint,start_word:int,n_words:int,distance:int,similarity:double>>"

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(SHINGLE)]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of lower-case UTF-8 bytes."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _IS_WORD[codes]
    turns = np.diff(inside)
    starts, stops = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    size = 1 << max(10, int(len(codes)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE[codes] * up[: len(codes)], out=total[1:])
    return _mix((total[stops] - total[starts]) * down[starts]), starts


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    count = max(0, len(words) - width + 1)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out += words[k:k + count] * _STEP[k]
    return _mix(out)


def prints_of(shingles: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash of the windows [start, start + count) over ``shingles``."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=ones[1:])
    set_bits = 2 * (ones[starts + counts] - ones[starts]) > counts[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0]


def similarity(a: np.ndarray, b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of a bag of shingles and a counted bag."""
    values, counts = np.unique(a, return_counts=True)
    at = np.searchsorted(b[0], values)
    at[at == len(b[0])] = 0
    same = b[0][at] == values
    shared = np.minimum(counts[same], b[1][at[same]]).sum()
    return float(shared / (len(a) + b[1].sum() - shared))


class Items:
    """Search tables of one block of the benchmark."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.sizes, self.bags, prints = [], [], [], []
        by_width: dict[int, list] = {}
        for item_id, text in rows:
            words, _ = word_hashes(text.lower().encode("utf-8", "replace"))
            if not len(words):
                continue
            width = min(SHINGLE, len(words))
            shingles = shingle_hashes(words, width)
            by_width.setdefault(width, []).append((len(self.ids), np.unique(shingles)))
            self.ids.append(item_id)
            self.sizes.append(len(words))
            self.bags.append(np.unique(shingles, return_counts=True))
            prints.append(prints_of(shingles, np.array([0]), np.array([len(shingles)]))[0])
        self.prints = np.array(prints, np.uint64)
        self.size_of = np.array(self.sizes, np.int64)
        self.widths = {}
        for width, owned in by_width.items():
            # distinct (shingle, size of an item that has it)
            pairs = np.unique(np.concatenate([np.stack([s, np.full(len(s), self.sizes[i], np.uint64)], 1)
                                              for i, s in owned]), axis=0)
            values, first, many = np.unique(pairs[:, 0], return_index=True, return_counts=True)
            seen = np.zeros(1 << 22, bool)
            seen[values >> np.uint64(42)] = True
            self.widths[width] = (seen, values, first, many, pairs[:, 1].astype(np.int64))
        self.tables = [self._table(b) for b in range(BLOCKS)]

    def _block(self, prints: np.ndarray, block: int) -> np.ndarray:
        return (prints >> np.uint64(16 * block)) & np.uint64(0xFFFF)

    def _table(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        near = np.array(ball(16, RADIUS // BLOCKS), np.uint64)
        keys = (self._block(self.prints, block)[:, None] ^ near[None]).ravel().astype(np.int64)
        order = np.argsort(keys, kind="stable")
        owners = np.repeat(np.arange(len(self.prints), dtype=np.int32), len(near))[order]
        return np.searchsorted(keys[order], np.arange(65537)), owners

    def candidates(self, prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(window, item, distance) of all items within the radius of a window of their size."""
        found = []
        for block, (first, owners) in enumerate(self.tables):
            key = self._block(prints, block).astype(np.int64)
            many = first[key + 1] - first[key]
            window = np.repeat(np.arange(len(prints)), many)
            at = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[key], many)
            item = owners[at]
            fits = self.size_of[item] == sizes[window]
            window, item = window[fits], item[fits]
            apart = np.bitwise_count(prints[window] ^ self.prints[item])
            near = apart <= RADIUS
            found.append(np.stack([window[near], item[near], apart[near]], 1))
        rows = np.unique(np.concatenate(found), axis=0)
        return rows[:, 0], rows[:, 1], rows[:, 2]

    def scan(self, texts: list[str]) -> list[list[tuple]]:
        """Hits of each text, by item."""
        best: list[dict] = [{} for _ in texts]
        chunk, size, first = [], 0, 0
        for i, text in enumerate(texts):
            data = text.lower().encode("utf-8", "replace")
            chunk.append(data)
            size += len(data) + 1
            if size >= _CHUNK or i + 1 == len(texts):
                self._scan_chunk(chunk, first, best)
                chunk, size, first = [], 0, i + 1
        return [[(self.ids[item], *hit) for item, hit in sorted(found.items())] for found in best]

    def _scan_chunk(self, chunk: list[bytes], first: int, best: list[dict]) -> None:
        words, at = word_hashes(b" ".join(chunk))
        edges = np.cumsum([0, *[len(c) + 1 for c in chunk]])
        bound = np.searchsorted(at, edges)  # words before each text
        for width, (seen, values, begin, many, sizes) in self.widths.items():
            shingles = shingle_hashes(words, width)
            hits = np.flatnonzero(seen[shingles >> np.uint64(42)])
            if not len(hits):
                continue
            place = np.searchsorted(values, shingles[hits])
            place[place == len(values)] = 0
            real = values[place] == shingles[hits]
            hits, place = hits[real], place[real]
            text = np.searchsorted(bound, hits, "right") - 1
            whole = hits + width <= bound[text + 1]  # not over the end of a text
            hits, place, text = hits[whole], place[whole], text[whole]
            pair = np.repeat(np.arange(len(hits)), many[place])
            size = sizes[np.arange(len(pair)) - np.repeat(np.cumsum(many[place]) - many[place], many[place])
                         + np.repeat(begin[place], many[place])]
            hits, text = hits[pair], text[pair]
            for length in np.unique(size):
                chosen = size == length
                self._windows(shingles, bound, hits[chosen], text[chosen], int(length), width, first, best)

    def _windows(self, shingles, bound, hits, text, length, width, first, best) -> None:
        """All windows of one size that hold one of the hits."""
        head = bound[text]
        last = np.maximum(bound[text + 1] - length, head)  # the last start
        low = np.minimum(np.maximum(hits - length + width, head), last)
        high = np.minimum(hits, last)
        new = np.r_[True, (low[1:] > high[:-1] + 1) | (text[1:] != text[:-1])]
        low, text = low[new], text[new]
        high = high[np.r_[np.flatnonzero(new)[1:] - 1, len(high) - 1]]
        for a, b, t in zip(low.tolist(), high.tolist(), text.tolist()):
            starts = np.arange(a, b + 1)
            counts = np.minimum(starts + length, bound[t + 1]) - starts - width + 1
            part = shingles[a:b + int(counts[-1])]
            prints = prints_of(part, starts - a, counts)
            window, item, apart = self.candidates(prints, np.full(len(prints), length))
            found = best[first + t]
            for k in np.argsort(apart, kind="stable").tolist():
                w, i = int(window[k]), int(item[k])
                if found.get(i, (0, 0, 0, -1.0))[3] == 1.0:
                    continue
                s = starts[w] - a
                alike = similarity(part[s:s + counts[w]], self.bags[i])
                if alike >= SIMILARITY and alike > found.get(i, (0, 0, 0, -1.0))[3]:
                    found[i] = (int(starts[w] - bound[t]), int(counts[w] + width - 1), int(apart[k]), alike)


@lru_cache(maxsize=1)
def _tables(rows: tuple) -> Items:
    return Items(list(rows))


def _scan_column(text: Column, rows: tuple) -> Column:
    @F.pandas_udf(_HIT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = _tables(rows)  # kept by the worker from task to task
        names = ("item_id", "start_word", "n_words", "distance", "similarity")
        for texts in batches:
            yield pd.Series([[dict(zip(names, hit)) for hit in hits]
                             for hits in items.scan(list(texts))], dtype=object)

    return scan.asNondeterministic()(text)  # Spark then runs it once, also below an explode


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with array ``hits``: for each item found, its best window.

    A hit has item_id, start_word and n_words (place in the text), distance (of the
    fingerprints) and similarity (0.8 or more).  Null and empty texts and items have
    none.  An item of fewer than five words is one shingle.  In a text shorter than
    an item the window is the whole text.  Equal rows get equal hits; a column named
    ``hits`` is replaced.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-total["n"] // ITEMS_PER_BLOCK), -(-(total["bytes"] or 0) // BYTES_PER_BLOCK))
    text = whole_text(text_col)

    def block(number: int) -> tuple:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        return tuple(sorted(((r[0], r[1]) for r in rows), key=str))

    if blocks <= 1:
        return docs.withColumn("hits", _scan_column(text, block(0)) if blocks else F.array().cast(_HIT))
    keys = {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("text"), text)}
    parts = [materialize(docs.select(*[c.alias(k) for k, c in keys.items()], _scan_column(text, block(k)).alias("hits"))
                         .where(F.size("hits") > 0).dropDuplicates(["h1", "h2"]), "hits") for k in range(blocks)]
    found = materialize(reduce(DataFrame.unionByName, parts).groupBy("h1", "h2").agg(
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits")), "all-hits")
    discard(*parts)
    rows = marked(as_row(docs, **keys), "maybe", F.col("h1"), found, F.col("h1"))
    some = rows.where("maybe").join(found, ["h1", "h2"], "left")
    none = F.array().cast(_HIT)
    both = some.select("row", F.coalesce("hits", none).alias("hits")).unionByName(
        rows.where("NOT maybe").select("row", none.alias("hits")))
    return both.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "hits"], "hits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents in which no benchmark item was found, columns unchanged."""
    rows = as_row(docs, text=F.col(text_col))
    return with_hits(rows, benchmark).where(F.size("hits") == 0).select("row.*")
