r"""Byte-level BPE: whole texts to token ids and back.

A text is split by the vocabulary's pattern, and the bytes of each piece are merged on
their own.  A piece that is a token takes its id; otherwise the neighbouring pair of
least rank, the leftmost of equals, is merged again and again.

The pairs wait in a rank queue: a bucket of places for each rank, and above the buckets
a hierarchy of bitmaps, each word of which tells which words (or buckets) below it hold
anything.  Find-first-set from the top leads to the least rank in two steps, whatever
the length of the piece.  Places are nodes of a linked list; a merge changes the pairs on
both sides, whose old entries stay in their buckets and are skipped when they come up; the
queue is done when no pair is left that could merge.  A piece of n bytes thus takes time in
proportion to n, but for the order of places within one bucket, so very long pieces (a text
without a space) are no trouble.

Ids are kept packed, as unsigned 32-bit integers, least byte first.  Nothing is
shuffled; a task holds one Arrow batch and a bounded memory of short pieces.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import whole_text

#: Pieces that a worker remembers in each of two generations, and their greatest length.
REMEMBERED, SHORT = 1 << 19, 48
#: Pieces handled at a time, so that a long text is not held as a list of all of them.
_AT_ONCE = 1 << 16
#: Rows of an Arrow batch turned into Python objects at a time.
_ROWS_AT_ONCE = 256


def _compact(numbers) -> array:
    return array("q", numbers)


class RankQueue:
    """Places by rank; ``pop`` gives the least rank and, of its places, the leftmost.

    Two levels of words, wide enough (2^shift bits) that their square covers all ranks: bit b
    of word w says that bucket (w << shift) + b holds places, bit w of ``top`` that word w
    isn't empty.  Words and buckets exist only while they hold something.
    """

    __slots__ = ("shift", "rest", "buckets", "words", "top")

    def __init__(self, shift: int):
        self.shift, self.rest = shift, (1 << shift) - 1
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, place: int) -> None:
        if rank in self.buckets:
            heappush(self.buckets[rank], place)
            return
        self.buckets[rank] = [place]
        word = rank >> self.shift
        if word in self.words:
            self.words[word] |= 1 << (rank & self.rest)
        else:
            self.words[word] = 1 << (rank & self.rest)
            self.top |= 1 << word

    def pop(self) -> tuple[int, int]:
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.words[word]
        rank = (word << self.shift) + (bits & -bits).bit_length() - 1
        places = self.buckets[rank]
        if len(places) > 1:
            return rank, heappop(places)
        del self.buckets[rank]
        bits &= bits - 1
        if bits:
            self.words[word] = bits
        else:
            del self.words[word]
            self.top = top & (top - 1)
        return rank, places[0]


class Codec:
    """One vocabulary, ``ranks`` from token bytes to id, and the pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.shift = max(3, -(-max(ranks.values(), default=0).bit_length() // 2))
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.plain, self.exact, self.odd = _splitters(pattern)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece.  Of ties in rank the leftmost pair is merged first."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        rank_of, longest, size = ranks.get, self.longest, len(piece)
        queue = RankQueue(self.shift)
        push, pop = queue.push, queue.pop
        numbers = list if size <= SHORT else _compact
        after = numbers(range(1, size + 2))
        before = numbers(range(-1, size))
        # The rank of a node and the next; -1 where they don't merge.
        pair = numbers([rank_of(piece[at:at + 2], -1) for at in range(size - 1)] + [-1, -1])
        left_over = 0  # pairs that can still merge
        for at, rank in enumerate(pair):
            if rank >= 0:
                push(rank, at)
                left_over += 1
        while left_over:
            rank, at = pop()
            if pair[at] != rank:  # stale: a neighbour has merged since
                continue
            left_over -= 1
            gone = after[at]
            end = after[at] = after[gone]
            new = -1
            if end < size:
                before[end] = at
                if pair[gone] >= 0:
                    left_over -= 1
                stop = after[end]
                if stop - at <= longest:
                    new = rank_of(piece[at:stop], -1)
                    if new >= 0:
                        push(new, at)
                        left_over += 1
                pair[gone] = -1
            pair[at] = new
            left = before[at]
            if left >= 0:
                if pair[left] >= 0:
                    left_over -= 1
                new = rank_of(piece[left:end], -1) if end - left <= longest else -1
                if new >= 0:
                    push(new, left)
                    left_over += 1
                pair[left] = new
        out, at = [], 0
        while at < size:
            stop = after[at]
            out.append(ranks[piece[at:stop]])
            at = stop
        return out

    def packed(self, piece: str) -> bytes:
        """The packed ids of a piece; short ones are remembered, the least recently met go first."""
        out = self.older.get(piece)
        if out is None:
            ids = array("I", self.merge(piece.encode("utf-8", "surrogatepass")))
            if sys.byteorder == "big":
                ids.byteswap()
            out = ids.tobytes()
        if len(piece) <= SHORT:
            if len(self.recent) >= REMEMBERED:
                self.older, self.recent = self.recent, {}
            self.recent[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text; the empty text has none."""
        split = self.exact if self._is_odd(text) else self.plain
        out = []
        if len(text) <= _AT_ONCE:
            return self._joined(split.findall(text))
        pieces = (match[0] for match in split.finditer(text))
        while part := list(islice(pieces, _AT_ONCE)):
            out.append(self._joined(part))
        return b"".join(out)

    def _is_odd(self, text: str) -> bool:
        """Whether the text has a character on which the two patterns differ (none is in Latin-1)."""
        try:
            text.encode("latin-1")
            return False
        except UnicodeEncodeError:
            return self.odd.search(text) is not None

    def _joined(self, pieces: list[str]) -> bytes:
        known = self.recent.get
        return b"".join([known(piece) or self.packed(piece) for piece in pieces])

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; an id outside the vocabulary is an error."""
        ids = np.frombuffer(packed, "<u4")
        return b"".join([
            b"".join(map(self.tokens.__getitem__, ids[at:at + _AT_ONCE].tolist()))
            for at in range(0, len(ids), _AT_ONCE)])


def _class_text(codes: list[int]) -> str:
    """Code points as ranges of a character class."""
    parts, at = [], 0
    while at < len(codes):
        stop = at
        while stop + 1 < len(codes) and codes[stop + 1] == codes[stop] + 1:
            stop += 1
        parts.append(f"\\U{codes[at]:08x}-\\U{codes[stop]:08x}")
        at = stop + 1
    return "".join(parts)


@lru_cache(maxsize=2)
def _splitters(pattern: str):
    r"""The pattern as it stands; the pattern with the letters and numbers that the
    tokenizer's own regular expressions know; and a class of the characters on which the
    two differ, as their Unicode versions do.  Texts without such a character take the first.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    exact, odd = pattern, set()
    for name in (r"\p{L}", r"\p{N}"):
        if name not in pattern:
            continue
        own = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(own.encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        less, more = sorted(map(ord, ours - theirs)), sorted(map(ord, theirs - ours))
        odd |= {*less, *more}
        known = f"[{name}--[{_class_text(less)}]]" if less else name
        exact = exact.replace(name, f"[{known}||[{_class_text(more)}]]" if more else known)
    if odd and min(odd) <= 0xFF:
        raise ValueError("the pattern's classes differ within Latin-1")
    never = "(?!)"
    return (regex.compile(pattern), regex.compile("(?V1)" + exact),
            re.compile(f"[{_class_text(sorted(odd))}]" if odd else never))


@lru_cache(maxsize=2)
def codec(vocabulary: str, pattern: str) -> Codec:
    """The codec of a rank file (a line for each token: base64 of its bytes, its id)."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def _column(type_: str, convert) -> Callable[[Column], Column]:
    """A column function that turns Arrow values one by one, some rows at a time."""
    @F.arrow_udf(type_)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one, kind = convert()
        for batch in batches:
            parts = [pa.array([one(value) for value in batch.slice(at, _ROWS_AT_ONCE).to_pylist()], kind)
                     for at in range(0, len(batch), _ROWS_AT_ONCE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``, the packed token ids of each whole text.

    ``vocabulary`` is the path of a rank file that every executor sees.  Null and empty
    texts have no ids (an empty binary); equal texts get equal ids; repeated rows each get
    a row; an empty table stays empty; a column of the name ``ids_col`` is replaced and no
    other is touched.  Special tokens in a text are ordinary characters.
    """
    run = _column("binary", lambda: (codec(vocabulary, pattern).encode, pa.binary()))
    return docs.withColumn(ids_col, run(whole_text(text_col)))


def decode(tokens: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``tokens`` with ``bytes_col``, the bytes that packed ids stand for; null ids give none."""
    run = _column("binary", lambda: (codec(vocabulary, pattern).decode, pa.binary()))
    return tokens.withColumn(bytes_col, run(F.coalesce(F.col(ids_col), F.lit(b""))))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
               ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its ids, with one transfer of the texts to Python."""
    def both():
        of = codec(vocabulary, pattern)

        def one(text: str) -> dict[str, bytes]:
            ids = of.encode(text)
            return {"ids": ids, "decoded": of.decode(ids)}

        return one, pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

    run = _column("struct<ids:binary,decoded:binary>", both)
    names = [c for c in docs.columns if c not in (ids_col, bytes_col)]
    out = docs.select(*[docs[c] for c in names], run(whole_text(text_col)).alias(ids_col))
    return out.select(*names, F.col(ids_col)["ids"].alias(ids_col), F.col(ids_col)["decoded"].alias(bytes_col))


def n_ids(packed: Column) -> Column:
    """How many ids a packed column holds."""
    return F.floor(F.octet_length(packed) / 4).cast("long")


def unpack(packed: Column) -> Column:
    """Packed ids as an array of longs; null stays null."""
    @F.arrow_udf("array<long>")
    def numbers(batch: pa.Array) -> pa.Array:
        return pa.array([None if p is None else np.frombuffer(p, "<u4") for p in batch.to_pylist()],
                        pa.list_(pa.int64()))

    return numbers(packed)
