r"""Secrets in texts: known shapes, and strings that a tokenizer finds hard.

Three shapes are matched everywhere: assignments to password-like names, access
keys, and long hexadecimal strings.  Beside them, strings of the base64 alphabet (also in
its form for URLs) are tested for token efficiency: ordinary words and names cost few tokens
for their length, random strings many.  A string with few characters per token under a
byte-pair vocabulary is reported, unless it is a known digest or identifier
(hexadecimal of a digest's length, UUID, number, date) or lies within a shape match.

The ratio decides for all of them.  Letters of one case and no digit also make words, foreign
and invented ones among them, so they have to be longer and the ratio lower.  Not tested are
shorter strings and other symbols, at which a string ends.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "random")
#: Least length and most characters per token of a random string; the same for letters of
#: one case (a first capital apart) without a digit.
LEAST_CHARS, MOST_CHARS_PER_TOKEN = 12, 2.2
LEAST_LETTERS, MOST_LETTERS_PER_TOKEN = 16, 1.9
#: How the vocabulary splits text before byte pairs are merged (fixed by the vocabulary).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_STRING = regex.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}(?![A-Za-z0-9+/_-])" % LEAST_CHARS)
#: MD5 and SHA digests in either case, UUIDs, and numbers with separators.
_KNOWN = re.compile(
    r"(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9/_+=-]+)")


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


_ONE_CASE = re.compile(r"[^A-Za-z0-9]*(?:[A-Za-z](?:[^A-Za-z0-9]*[a-z])*|[A-Z](?:[^A-Za-z0-9]*[A-Z])*)[^A-Za-z0-9]*")


def _is_random(string: str, encoder) -> bool:
    """Whether the string has few characters per token for its kind."""
    least, most = LEAST_CHARS, MOST_CHARS_PER_TOKEN
    if _ONE_CASE.fullmatch(string):
        least, most = LEAST_LETTERS, MOST_LETTERS_PER_TOKEN
    return len(string) >= least and len(string) <= most * len(encoder.encode_ordinary(string))


def _base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the three shapes, in order of start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    # A run is matched whole, so shorter runs need no match to be dropped.
    found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _random_spans(text: str, base: list[tuple[int, int, int]], encoder) -> list[tuple[int, int, int]]:
    found = []
    for m in _STRING.finditer(text):
        string = m[0]
        if _KNOWN.fullmatch(string) or any(a < m.end() and m.start() < b for _, a, b in base):
            continue
        if _is_random(string, encoder):
            found.append((3, m.start(), m.end()))
    return found


def scan(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with array ``secrets`` of (kind, start, stop), by start, then kind.

    Positions are code points, stop exclusive.  Null and empty texts have none;
    whole texts are read; equal texts get equal spans; nothing is shuffled.
    """
    @F.pandas_udf("array<struct<kind:string,start:int,stop:int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(vocabulary)
        for texts in batches:
            out = []
            for text in texts:
                base = _base_spans(text)
                spans = sorted(base + _random_spans(text, base, encoder), key=lambda s: (s[1], s[0]))
                out.append([{"kind": KINDS[k], "start": a, "stop": b} for k, a, b in spans])
            yield pd.Series(out, dtype=object)

    return docs.withColumn("secrets", find(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def joined(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
