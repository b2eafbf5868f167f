"""Periodic runs of words: stretches that repeat themselves at a fixed distance.

A run with smallest period q has at least ``LEAST_PERIODS`` periods and can't be
extended on either side.  Runs are looked for at dyadic scales: at scale B (a power of
two) those with B <= q < 2B.  Such a run is at least 4B long, so it holds a whole block
of B words that starts at a multiple of B, and that block occurs again q words on.  For
each block, the sums of squared differences to all places at distance B to 2B - 1 are
one convolution, done for many blocks at once by a number-theoretic transform, exactly;
a sum of zero is an occurrence without a mismatch.  Its distance is a seed: the stretch
in which words so far apart are equal is followed to both sides and compared word by
word, which gives the run.

Two exact tests keep the work small.  A block of which a word is missing from the window
can't occur in it, so it needs no transform.  A block whose whole surroundings lie within
a run already found occurs at multiples of that run's period only, so it can't seed
another one.

Documents of a batch are laid end to end with a word of its own between them, which
equals nothing, so many short texts cost no more than one long one.  Nothing is
shuffled; a task holds some words of a batch, or one text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marquee.llm.common import whole_text

LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Primes c * 2^k + 1 below 2^31, k = 27, 26, 25, each with a primitive root.
#: Transforms have up to 2^25 numbers, so a text may have 2^26 words.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Texts laid end to end until they hold so many words; numbers transformed at a time.
_WORDS_AT_ONCE, _CELLS = 1 << 18, 1 << 19
#: Words of a block that are looked up in its window before the transform.
_LOOK_UPS = 12

RUNS = T.ArrayType(T.StructType([
    T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))


# --- number-theoretic transform ---------------------------------------------------------

@lru_cache(maxsize=64)
def _roots(size: int, prime: int, root: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Powers of the primitive root of unity for each step of a transform, widest first."""
    unit = pow(root, (prime - 1) // size, prime)
    if inverse:
        unit = pow(unit, prime - 2, prime)
    powers, have = np.ones(max(1, size // 2), np.uint64), 1
    while have < len(powers):
        more = min(have, len(powers) - have)
        powers[have:have + more] = powers[:more] * np.uint64(pow(unit, have, prime)) % np.uint64(prime)
        have += more
    steps, stride = [], 1
    while stride < size:
        steps.append(np.ascontiguousarray(powers[::stride]))
        stride *= 2
    return tuple(steps)


def _forward(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The transform of each row; values come out in bit-reversed order."""
    total, size = rows.shape
    p, width = np.uint64(prime), size
    for powers in _roots(size, prime, root, False):
        halves = rows.reshape(total, size // width, 2, width // 2)
        low, high = halves[:, :, 0], halves[:, :, 1]
        out = np.empty_like(halves)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder((low + (p - high)) * powers, p, out=out[:, :, 1])
        rows, width = out.reshape(total, size), width // 2
    return rows


def _backward(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """From bit-reversed transforms to the rows in order."""
    total, size = rows.shape
    p, width = np.uint64(prime), 2
    for powers in reversed(_roots(size, prime, root, True)):
        halves = rows.reshape(total, size // width, 2, width // 2)
        low, high = halves[:, :, 0], halves[:, :, 1] * powers % p
        out = np.empty_like(halves)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder(low + (p - high), p, out=out[:, :, 1])
        rows, width = out.reshape(total, size), width * 2
    return rows * np.uint64(pow(size, prime - 2, prime)) % p


def zero_distances(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row, at which of the B shifts the block of B numbers equals its window.

    ``windows`` have 2B - 1 numbers.  The sum over the block of (x - y)^2 is the sum of
    x^2, plus a sliding sum of y^2, less twice a convolution.  As many primes are used as
    the largest possible sum needs, so that all residues are zero only if the sum is.
    """
    rows, width = blocks.shape
    most = int(max(blocks.max(initial=0), windows.max(initial=0)))
    same, bound = np.ones((rows, width), bool), 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        x, y = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
        padded = np.zeros((2, rows, 2 * width), np.uint64)
        padded[0, :, :width], padded[1, :, :2 * width - 1] = x[:, ::-1], y
        product = _forward(padded[0], prime, root) * _forward(padded[1], prime, root) % p
        cross = _backward(product, prime, root)[:, width - 1:2 * width - 1]
        squares = np.zeros((rows, 2 * width), np.uint64)
        np.cumsum(y * y % p, axis=1, out=squares[:, 1:])
        sums = (x * x % p).sum(axis=1, keepdims=True) + squares[:, width:] - squares[:, :width]
        same &= (sums + 2 * (p - cross)) % p == 0
        bound *= prime
        if bound > width * most * most:
            break
    return same


# --- runs -------------------------------------------------------------------------------

def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading numbers are equal; looks further ahead in doubling steps."""
    size, at, step = min(len(a), len(b)), 0, 64
    a, b = a[:size], b[:size]
    while at < size:
        odd = np.flatnonzero(a[at:at + step] != b[at:at + step])
        if len(odd):
            return at + int(odd[0])
        at, step = at + step, step * 2
    return size


def _next_same(words: np.ndarray) -> np.ndarray:
    """How far on the same number comes next; far beyond the end if it doesn't."""
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    out = np.full(len(words), 2 * len(words) + 1, np.int64)
    out[order[:-1][again]] = np.diff(order)[again]
    return out


def find_runs(words: np.ndarray, most: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a sequence of numbers from 0, by start, then
    period.  ``most`` may bound the length of a run."""
    size = len(words)
    most = size if most is None else most
    runs: dict[tuple[int, int], int] = {}
    reach = np.zeros(size, np.int64)  # the greatest end of the runs found so far that hold a place
    gap, least = _next_same(words), int(words.max(initial=0)) + 1
    width = 1
    while LEAST_PERIODS * width <= most:
        # Beyond the end stands a number that no word has.
        ahead = np.concatenate([words, np.full(3 * width, least, words.dtype)])
        seeds = sorted(_seeds(words, ahead, gap, width, reach))
        last_distance, covered = 0, 0
        for distance, at in seeds:
            if distance != last_distance:
                last_distance, covered = distance, 0
            if at + width + distance <= covered:
                continue  # lies in the stretch that the seed before led to
            right = at + width + _agree(words[at + width:], words[at + width + distance:])
            left = at - _agree(words[:at][::-1], words[distance:at + distance][::-1])
            covered = right + distance
            if covered - left >= max(LEAST_WORDS, LEAST_PERIODS * distance):
                # A multiple of a smaller period leads to the same stretch.
                if runs.setdefault((left, covered), distance) == distance:
                    np.maximum(reach[left:covered], covered, out=reach[left:covered])
        width *= 2
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def _seeds(words: np.ndarray, ahead: np.ndarray, gap: np.ndarray, width: int,
           reach: np.ndarray) -> Iterator[tuple[int, int]]:
    """(distance, block start) of all blocks of ``width`` words that occur again
    ``width`` to 2 * width - 1 words on, but for those within a known run."""
    total, looks = len(words) // width, min(width, _LOOK_UPS)
    recurs = (gap[:total * width].reshape(total, width) < 2 * width).all(axis=1)
    every = np.flatnonzero(recurs) * width
    every = every[reach[every] < np.minimum(every + 3 * width - 1, len(words))]
    step = max(1, _CELLS // (2 * width))
    for first in range(0, len(every), step):
        starts = every[first:first + step]
        for k in range(looks):
            at = starts + k * width // looks
            window = np.lib.stride_tricks.sliding_window_view(ahead, width)[at + width]
            starts = starts[(window == words[at][:, None]).any(axis=1)]
        if not len(starts):
            continue
        blocks = words[starts[:, None] + np.arange(width)]
        windows = ahead[starts[:, None] + width + np.arange(2 * width - 1)]
        row, shift = np.nonzero(zero_distances(blocks, windows))
        yield from zip((shift + width).tolist(), starts[row].tolist())


def _batches(texts: Iterator[str]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        held.append(text.encode("utf-8", "surrogatepass").split())
        size += len(held[-1])
        if size >= _WORDS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, found in all texts laid end to end."""
    number = defaultdict(count(len(texts)).__next__)
    parts, begins, at = [], [], 0
    for k, text in enumerate(texts):
        begins.append(at)
        parts.append(np.fromiter(map(number.__getitem__, text), np.int32, len(text)))
        parts.append(np.array([k], np.int32))  # equals no word and no other text's end
        at += len(text) + 1
    found = find_runs(np.concatenate(parts), max(map(len, texts)))
    text_of = np.searchsorted(begins, [run[0] for run in found], "right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, length, period), k in zip(found, text_of.tolist()):
        out[k].append((start - begins[k], length, period))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that any run holds after its first period."""
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period:start + length] = True
        words = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


_FOUND = T.StructType([T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs",
              collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) in words, by start, then
    period, and ``collapsed``, the words that remain, joined by one space.

    Words are split at ASCII white space and numbered from 0.  Null and empty texts have
    no words, no runs and an empty ``collapsed``; runs may overlap; equal texts get equal
    runs; repeated rows each get a row; an empty table stays empty; columns of the two
    names are replaced and no other is touched.
    """
    @F.pandas_udf(_FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            runs, collapsed = [], []
            for held in _batches(texts):
                for words, found in zip(held, _runs_of(held)):
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    collapsed.append(_collapsed(words, found))
            yield pd.DataFrame({"runs": pd.Series(runs, dtype=object),
                                "collapsed": pd.Series(collapsed, dtype=object)})

    names = [c for c in docs.columns if c not in (runs_col, collapsed_col)]
    found = docs.select(*[docs[c] for c in names], find(whole_text(text_col)).alias(runs_col))
    return found.select(*names, F.col(runs_col)["runs"].alias(runs_col),
                        F.col(runs_col)["collapsed"].alias(collapsed_col))


def longest(runs: Column) -> Column:
    """The run of greatest length; ties go to the smallest start, then period; null without any."""
    first = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    best = F.array_min(first)
    return F.when(best.isNotNull(), F.struct(
        best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period")))


def listed(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
