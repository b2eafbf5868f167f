r"""Chat formatting with loss masks that are aligned by character offsets.

A conversation is rendered whole::

    ### role: text</turn>
    ### role: text</turn>

Role and text are escaped so that neither a header nor ``</turn>`` can occur in them:
``\`` becomes ``\\``, a ``#`` before two more becomes ``\#``, ``</turn>`` becomes
``\</turn>``, and in roles line ends and colons get a ``\`` too.  Taking the character
after each ``\`` literally gives the original back, so rendering is reversible.

The rendered text is encoded once, with the code-point offsets of each token.  Turn
spans are known from rendering and sorted; for each span a binary search in the
sorted token offsets gives the tokens that meet it, and the meeting parts are the
loss spans.  A token over the edge of a turn is masked in, but only its part within
the turn counts, so the text under the mask is exactly the assistants' text.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marquee.llm.secret_scan import SPLIT

LEARNED_ROLE = "assistant"
_CONTROL = re.compile(r"\\|#(?=##)|</turn>")
_ROLE_CONTROL = re.compile(r"\\|#(?=##)|</turn>|[:\n]")
_ESCAPED = re.compile(r"\\(.)", re.S)
#: A header, its text and the end of the turn; an escape and what it escapes go together.
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.S)
_SCHEMA = ("formatted string, token_ids array<int>, loss_mask array<boolean>, "
           "loss_spans array<struct<start:int,stop:int>>")


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], learned: str = LEARNED_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the sorted spans of the learned role's texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role, _ROLE_CONTROL)}: ", escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}</turn>\n")
        at += len(parts[-1])
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens meet a span, and the parts of the text that are under the mask.

    ``offsets`` are [n, 2], sorted; tokens that share a code point overlap.
    """
    chosen, pieces = np.zeros(len(offsets), bool), []
    starts, stops = offsets[:, 0], offsets[:, 1]
    for a, b in spans:
        low = int(np.searchsorted(stops, a, "right"))
        high = int(np.searchsorted(starts, b, "left"))
        if a < b and low < high:
            chosen[low:high] = True
            # where a token begins behind all before it, a part ends
            reach = np.maximum.accumulate(stops[low:high])
            gaps = np.flatnonzero(starts[low + 1:high] > reach[:-1])
            first = np.maximum(starts[low:high][np.concatenate([[0], gaps + 1])], a)
            last = np.minimum(reach[np.concatenate([gaps, [high - low - 1]])], b)
            pieces += [(s, t) for s, t in zip(first.tolist(), last.tolist()) if s < t]
    return chosen, pieces


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings are ordinary text here
    return tokenizer


@lru_cache(maxsize=2)
def _ranked(path: str):
    """The encoder of a rank file, and the length in bytes of each token."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), sizes


def encoded(texts: list[str], vocabulary: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and code-point offsets [n, 2] of the tokens of each text.

    With a rank file the offsets are running sums of the tokens' lengths in bytes, turned into
    code points where the text has others than ASCII; a token that holds part of a code point
    spans it.  Other files go through their own tokenizer.
    """
    if not vocabulary.endswith(".tiktoken"):
        codes = _tokenizer(vocabulary).encode_batch(texts, add_special_tokens=False)
        return [(np.array(c.ids, np.int64), np.array(c.offsets, np.int64).reshape(-1, 2)) for c in codes]
    encoder, sizes = _ranked(vocabulary)
    out = []
    for text in texts:
        ids = encoder.encode_to_numpy(text, disallowed_special=())
        stops = np.cumsum(sizes[ids])
        starts = stops - sizes[ids]
        data = text.encode("utf-8")
        if len(data) != len(text):
            point = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # code points up to a byte
            starts, stops = point[starts] - 1, point[stops - 1]
        out.append((ids.astype(np.int64), np.stack([starts, stops], axis=1)))
    return out


def format_conversations(rows: DataFrame, vocabulary: str, learned: str = LEARNED_ROLE) -> DataFrame:
    """One row per conv_id: turns (as read), formatted, token_ids, loss_mask, loss_spans.

    Rows go by turn, then role, then text, nulls first; repeated rows are turns of
    their own.  Null text and null role are empty; rows with a null conv_id are one
    conversation; an empty table gives none; further columns are not read.  A
    conversation is rendered as a whole, so one must fit a row.
    """
    turns = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("turns")))

    @F.pandas_udf(_SCHEMA)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for conversations in batches:
            for at in range(0, len(conversations), 64):  # small pieces, handed on at once
                out = []
                made = [render([(t["role"], t["text"]) for t in c], learned)
                        for c in conversations.iloc[at:at + 64]]
                codes = encoded([formatted for formatted, _ in made], vocabulary)
                for (formatted, spans), (ids, offsets) in zip(made, codes):
                    chosen, pieces = mask(offsets, spans)
                    out.append((formatted, ids, chosen, [{"start": a, "stop": b} for a, b in pieces]))
                yield pd.DataFrame(out, columns=["formatted", "token_ids", "loss_mask", "loss_spans"])

    # not deterministic: Spark then runs it once for all its fields
    return turns.withColumn("made", encode.asNondeterministic()("turns")).select("conv_id", "turns", "made.*")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text and its loss spans say, without the source rows."""
    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                  "formatted_chars long, n_tokens long, n_loss_tokens long")
    def digests(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, spans, masks in batches:
            out = []
            for text, pieces, chosen in zip(texts, spans, masks):
                turns = parse(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                learned = unescape("".join(text[p["start"]:p["stop"]] for p in pieces))
                out.append((len(turns), _sha(whole), len(learned), _sha(learned), len(text),
                            len(chosen), int(np.sum(chosen))))
            yield pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                             "formatted_chars", "n_tokens", "n_loss_tokens"])

    return formatted.select("conv_id", digests.asNondeterministic()("formatted", "loss_spans", "loss_mask").alias("d")).select(
        "conv_id", "d.*")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
