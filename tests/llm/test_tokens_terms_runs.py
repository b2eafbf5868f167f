"""Byte-pair codes, source divergence and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marquee.llm import bindings, bpe, divergence, periodic

VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string"
LONG = "".join(random.Random(3).choice("abcdefgh") for _ in range(200_000))
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, LONG, "en", "a"), (4, LONG, "en", None),
       (None, "one two one two one two one two", "", "b"), (5, "x", "de", "b"), (5, "x", "de", "b"),
       (6, " \n\t ", "de", ""), (7, "é😀\x00՘֋ ẞß</turn>", "fr", "b")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


# --- byte-pair codes ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=bpe.codec(VOCABULARY, PATTERN).ranks,
                             special_tokens={})


def _ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("ab ") | st.text("abcdeé😀 \n1'՘֋\U00011de0", min_size=20))
def test_codes_are_the_librarys(plain, text):
    codec = bpe.codec(VOCABULARY, PATTERN)
    packed = codec.encode(text)
    assert _ids(packed) == plain.encode_ordinary(text)
    assert codec.decode(packed) == text.encode()


def test_every_character_is_split_as_the_library_does(plain):
    codec = bpe.codec(VOCABULARY, PATTERN)
    for first in range(0, 0x110000, 4096):
        text = "".join(f"a{chr(c)}1" for c in range(first, first + 4096) if not 0xD800 <= c < 0xE000)
        assert _ids(codec.encode(text)) == plain.encode_ordinary(text)


@pytest.mark.parametrize("text", [LONG, "a" * 300_000, "ab" * 100_000, "é" * 50_000])
def test_very_long_pieces(plain, text):
    assert _ids(bpe.codec(VOCABULARY, PATTERN).encode(text)) == plain.encode_ordinary(text)


def test_rank_queue_gives_least_rank_then_leftmost():
    rng, queue, held = random.Random(1), bpe.RankQueue(8), []
    for _ in range(5000):
        if held and rng.random() < 0.45:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            entry = (rng.randrange(50_000) if rng.random() < 0.5 else rng.randrange(3), rng.randrange(10**6))
            queue.push(*entry)
            held.append(entry)
    assert [queue.pop() for _ in held] == sorted(held) and not (queue.top or queue.words or queue.buckets)


def test_pieces_forgotten_and_met_again(plain, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 4)
    codec = bpe.Codec(bpe.codec(VOCABULARY, PATTERN).ranks, PATTERN)
    text = " ".join(f"wort{i % 13}x" for i in range(500))
    assert _ids(codec.encode(text)) == plain.encode_ordinary(text)
    assert len(codec.recent) <= 5 and len(codec.older) <= 5


def test_codes_of_odd_rows(odd, plain):
    named = odd.withColumns({"ids": F.lit(1), "decoded": F.lit(2)})
    both = bpe.decode(bpe.encode(named, VOCABULARY, PATTERN), VOCABULARY, PATTERN)
    assert set(both.columns) == set(named.columns)
    rows = both.withColumn("numbers", bpe.unpack(F.col("ids"))).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r["numbers"] == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    again = bpe.round_trip(named, VOCABULARY, PATTERN)
    assert sorted(map(str, again.select(both.columns).collect())) == sorted(map(str, both.collect()))
    assert bpe.encode(odd.limit(0), VOCABULARY, PATTERN).count() == 0
    assert bpe.round_trip(odd.limit(0), VOCABULARY, PATTERN).count() == 0


def test_codes_query(spark, tiny, plain):
    want = {}
    for r in spark.read.parquet(f"{tiny}/documents.parquet").collect():
        ids = plain.encode_ordinary(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                             hashlib.sha256((r["text"] or "").encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in bindings.op11_bpe_round_trip(spark, tiny).collect()}
    assert got == want


# --- source divergence --------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text: str | None) -> list[str]:
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in _TERM.findall(text or "")]


def _plain_audit(rows, least, ranks, scale=1_000_000_000, prior=5):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        key = lang or "", source or ""
        groups.add(key)
        counts[key].update(_terms(text))
        held[key[0]].update(set(_terms(text)))
    out = []
    kept = {lang: sorted(t for t, n in held[lang].items() if n >= least) for lang, _ in groups}

    def parts(count, terms):
        total = sum(count[t] for t in terms)
        return {t: 1 + scale * (count[t] + prior) // (total + prior * len(terms)) for t in terms}

    for lang, source in groups:
        terms = kept[lang]
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())
        p, q = parts(counts[lang, source], terms), parts(whole, terms)
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            o = parts(counts[lang, other], terms)
            pairs.append((other, sum(abs(p[t] - o[t]) for t in terms)))
        more = [(t, p[t] - q[t]) for t in terms if counts[lang, source][t] and p[t] > q[t]]
        for name, items, most in (("pair", pairs, len(pairs)), ("term", more, ranks)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, name, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


@pytest.mark.parametrize("alphabet", ["abAB -", "aéßĀ😀1.", "abcdefghijklmnop"])
def test_terms_of_a_slice(alphabet):
    rng = random.Random(len(alphabet))
    texts = ["".join(rng.choice(alphabet) * rng.choice([1, 1, 2, 9]) for _ in range(rng.randrange(40)))
             for _ in range(300)] + ["", alphabet, LONG[:70], LONG[:70], "Z" * 16, "z" * 17]
    group = np.array([rng.randrange(3) for _ in texts], np.uint16)
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    n, docs = Counter(), Counter()
    for text, g in zip(texts, group.tolist()):
        n.update((g, t) for t in _terms(text))
        docs.update({(g, t) for t in _terms(text)})
    got_n, got_docs = {}, {}
    for code, flat, sizes, many, held in divergence.count_slice(
            np.frombuffer(b"".join(data), np.uint8), offsets, group):
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for k, g in enumerate(code.tolist()):
            term = flat[ends[k]:ends[k + 1]].tobytes().decode()
            assert (g, term) not in got_n
            got_n[g, term], got_docs[g, term] = many[k], held[k]
    assert got_n == n and got_docs == docs


def test_divergence_against_plain(spark, odd, monkeypatch):
    rng = random.Random(7)
    words = [f"w{'x' * k}{chr(97 + k)}" for k in range(20)] + ["é", "Éa", "ß", "A" * 40]
    rows = [(" ".join(rng.choices(words, range(1, 25), k=rng.randrange(30))),
             rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "b", None])) for _ in range(400)]
    rows += [("alone", "xx", "only"), (None, "yy", "a"), ("", "yy", "b")] + [r[1:] for r in ODD]
    monkeypatch.setattr(divergence, "_BUCKET_ROWS", 20)
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    extra = docs.withColumns({c: F.lit("?") for c in ("term", "n", "p", "value", "rank", "item", "bucket")})
    got = divergence.audit(extra.repartition(5), least_docs=5, ranks=7).collect()
    assert sorted(map(tuple, got)) == _plain_audit(rows, 5, 7)
    assert divergence.audit(odd.limit(0)).count() == 0


# --- periodic runs ------------------------------------------------------------------------

def _plain_runs(words):
    found, size = {}, len(words)
    for q in range(1, size // 4 + 1):
        i = 0
        while i + q < size:
            j = i
            while j + q < size and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


_UNIT = st.lists(st.sampled_from("abcdef"), min_size=1, max_size=12)
_REPEATS = st.lists(st.tuples(_UNIT, st.integers(1, 9)).map(lambda x: x[0] * x[1]), max_size=4).map(
    lambda parts: [w for part in parts for w in part])


@settings(max_examples=300, deadline=None)
@given(st.lists(_REPEATS | st.lists(st.sampled_from("ab"), max_size=60), min_size=1, max_size=4))
def test_runs_against_plain(texts):
    assert periodic._runs_of([[w.encode() for w in t] for t in texts]) == [_plain_runs(t) for t in texts]


@pytest.mark.parametrize("period", [1, 7, 63, 64, 65, 500, 2047])
def test_long_periods(period):
    rng = random.Random(period)
    unit = [str(rng.randrange(10**6)) for _ in range(period)]
    words = ["x", "y", *unit * 4, *unit[:period // 3], "z", "z"]
    found = periodic._runs_of([[w.encode() for w in words]])[0]
    if period == 1:
        assert found == []  # four words are too few
    else:
        assert found == [(2, 4 * period + period // 3, period)]


def test_transform_finds_all_occurrences():
    rng = np.random.default_rng(2)
    for width in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, 2, (50, width)), rng.integers(0, 2, (50, 2 * width - 1))
        blocks[::2], windows[::2] = 10**9, 10**9  # larger than one prime can tell
        windows[::4, width // 2] -= 2013265921 // 2013265921
        got = periodic.zero_distances(blocks, windows)
        want = np.array([[(b == w[s:s + width]).all() for s in range(width)] for b, w in zip(blocks, windows)])
        assert (got == want).all()


def test_runs_take_time_in_proportion():
    for words in (["a"] * 300_000, ["a", "b"] * 150_000, [str(i % 60_000) for i in range(300_000)]):
        assert len(periodic._runs_of([[w.encode() for w in words]])[0]) == 1


def test_runs_of_odd_rows(odd):
    named = odd.withColumns({"runs": F.lit(1), "collapsed": F.lit(2), "found": F.lit(3)})
    rows = periodic.with_runs(named).collect()
    assert len(rows) == len(ODD) and set(rows[0].asDict()) == set(named.columns)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["runs"] == by_id[2]["runs"] == by_id[6]["runs"] == []
    assert by_id[1]["collapsed"] == by_id[6]["collapsed"] == "" and by_id[3]["collapsed"] == LONG
    assert [tuple(r) for r in by_id[None]["runs"]] == [(0, 8, 2)] and by_id[None]["collapsed"] == "one two"
    assert periodic.with_runs(odd.limit(0)).count() == 0


def test_runs_query(spark, tiny, small):
    for folder in (tiny, small):
        got = {r["doc_id"]: r for r in bindings.op13_periodic_runs(spark, folder).collect()}
        with_run = 0
        for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
            words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
            n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
            g = h // 10
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            elif n > 400:
                continue  # too slow by the plain way
            runs = _plain_runs(words) if n <= 2000 else None
            if runs is None:
                continue
            gone = {i for s, size, q in runs for i in range(s + q, s + size)}
            best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
            lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
            kept = " ".join(w for i, w in enumerate(words) if i not in gone)
            exponent = 1000 * best[1] // best[2] if runs else None
            row = got[r["doc_id"]]
            assert tuple(row)[1:] == (
                len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(kept.encode()).hexdigest())
            with_run += bool(runs)
        assert with_run > 5
