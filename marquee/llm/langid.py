"""Language identification with a small byte convolutional network.

The network reads fixed-length windows of UTF-8 bytes: filters of several widths
slide over the one-hot bytes, the best place of each filter is kept (max pooling
with ReLU), and a softmax layer turns these into language probabilities.  It is
trained in numpy on a bounded sample of labelled windows.  A text is cut into
windows from its first to its last byte and the windows' log-probabilities are
averaged, so every part of a text counts, however long it is.

A filter over neighbouring bytes is a sum of table look-ups; the tables of byte
pairs are computed once from the weights, which makes scoring a few gathers a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import as_row
from marquee.operators import ranking
from marquee.session import materialize

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
UNKNOWN = "und"
#: Labelled documents used per language at most, and windows of each.
DOCS_PER_LANGUAGE = 600
WINDOWS_PER_DOC = 3
_LETTER = regex.compile(r"\p{L}")
_BATCH = 512
#: Windows of which all places are held at a time.
_AT_ONCE = 64


@dataclass
class Model:
    languages: list[str]
    filters: dict[int, np.ndarray]  # width -> [width, 256, FILTERS]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    pairs: dict | None = None

    def tables(self) -> dict:
        if self.pairs is None:
            # 256 * first byte + second byte -> what two neighbouring taps give together
            self.pairs = {w: [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(65536, -1)
                              if j + 1 < w else f[j] for j in range(0, w, 2)]
                          for w, f in self.filters.items()}
        return self.pairs

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Windows of bytes [n, WINDOW + a margin of zeros] -> best value of each filter."""
        parts = [self._best(windows[at:at + _AT_ONCE]) for at in range(0, max(1, len(windows)), _AT_ONCE)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def _best(self, windows: np.ndarray) -> np.ndarray:
        pair = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        out = []
        for w, tables in self.tables().items():
            last = windows.shape[1] - w + 1
            total = tables[0][pair[:, :last]]
            for k, table in enumerate(tables[1:], 1):
                source = pair if 2 * k + 1 < w else windows
                total = total + table[source[:, 2 * k:2 * k + last]]
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        scores = self.pooled(windows) @ self.weights + self.offset
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def cut(data: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    count = max(1, -(-len(data) // window))
    out = np.zeros(count * window, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, window)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 12,
          rate: float = 0.004, seed: int = 7) -> Model:
    """Adam on the cross-entropy; gradients flow through the pooled places only."""
    rng, classes = np.random.default_rng(seed), len(languages)
    params = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    size = FILTERS * len(WIDTHS)
    params |= {"bias": np.zeros(size, np.float32), "offset": np.zeros(classes, np.float32),
               "weights": rng.normal(0, 0.2, (size, classes)).astype(np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 64):
            chosen = order[at:at + 64]
            x, y = windows[chosen], labels[chosen]
            places, best = {}, []
            for w in WIDTHS:
                last = x.shape[1] - w + 1
                total = sum(params[w][j][x[:, j:j + last]] for j in range(w))
                places[w] = total.argmax(axis=1)
                best.append(np.take_along_axis(total, places[w][:, None], 1)[:, 0])
            raw = np.concatenate(best, axis=1) + params["bias"]
            hidden = np.maximum(raw, 0)
            scores = hidden @ params["weights"] + params["offset"]
            scores -= scores.max(axis=1, keepdims=True)
            p = np.exp(scores)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ params["weights"].T) * (raw > 0)
            grads = {"weights": hidden.T @ p, "offset": p.sum(axis=0), "bias": back.sum(axis=0)}
            rows, filters = np.arange(len(y))[:, None], np.arange(FILTERS)[None]
            for n, w in enumerate(WIDTHS):
                grads[w] = np.zeros_like(params[w])
                for j in range(w):
                    np.add.at(grads[w][j], (x[rows, places[w] + j], filters),
                              back[:, n * FILTERS:(n + 1) * FILTERS])
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(languages, {w: params[w] for w in WIDTHS}, params["bias"],
                 params["weights"], params["offset"])


def sample_windows(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE) -> list:
    """(lang, window bytes) of at most ``per_language`` documents of each language.

    Documents are ordered by a hash of id and text and the first are taken, so the choice
    doesn't hang on their order, nor on how many share an id, have none, or are repeated:
    equal documents count once.  Each gives up to WINDOWS_PER_DOC windows from places
    spread over it.
    """
    known = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                            F.xxhash64(F.lit("sample"), id_col, text_col).alias("h"))
    known = known.where("lang is not null and text is not null")
    # Most rows are left out by what the first can be expected to lie below; one row per language.
    counts = materialize(known.groupBy(F.col("lang").alias("of")).agg(
        F.approx_count_distinct("h").alias("n")), "languages")
    share = F.pmod(F.col("h"), F.lit(1_000_000)) / 1e6
    likely = known.join(counts, F.col("of") == F.col("lang")).where(
        share < F.lit(4.0 * per_language) / F.col("n")).withColumn("share", share)
    size = F.char_length("text")
    starts = F.array(*[(size * k / WINDOWS_PER_DOC).cast("int") for k in range(WINDOWS_PER_DOC)])
    pieces = F.transform(starts, lambda s: F.substring(F.col("text"), s + 1, F.lit(WINDOW)))
    likely = likely.groupBy("lang", "share", "h").agg(F.first(pieces).alias("pieces"))
    chosen = ranking.top_k_by(likely, per_language, ["lang"], F.asc("share"), F.asc("h"))
    windows = chosen.select("lang", F.explode("pieces").alias("piece"))
    rows = windows.where(F.length("piece") > 0).distinct().collect()
    return sorted((r["lang"], r["piece"].encode("utf-8")[:WINDOW]) for r in rows)


def fit(labelled: DataFrame, **options) -> Model:
    """A model trained on a bounded sample; a model without languages if no row is labelled."""
    sample = sample_windows(labelled, **options)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], {}, np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    windows = np.concatenate([cut(piece) for _, piece in sample])
    labels = np.array([languages.index(lang) for lang, _ in sample])
    return train(windows, labels, languages)


def scorer(model: Model):
    """Texts -> (language, probability) of each, batch by batch over all their windows."""
    def score(texts: list) -> tuple[list, list]:
        names, values = [UNKNOWN] * len(texts), [0.0] * len(texts)
        pending: list = []
        sums, counts = np.zeros((len(texts), max(1, len(model.languages)))), np.zeros(len(texts))

        def flush() -> None:
            if pending:
                owners = np.concatenate([np.full(len(w), i) for i, w in pending])
                got = model.log_probabilities(np.concatenate([w for _, w in pending]))
                np.add.at(sums, owners, got)
                np.add.at(counts, owners, 1)
                pending.clear()

        held = 0
        for i, text in enumerate(texts):
            if text is None or not model.languages or not _LETTER.search(text):
                continue
            windows = cut(text.encode("utf-8", "replace"))
            for at in range(0, len(windows), _BATCH):
                part = windows[at:at + _BATCH]
                pending.append((i, part))
                held += len(part)
                if held >= _BATCH:
                    flush()
                    held = 0
        flush()
        for i in np.flatnonzero(counts):
            mean = sums[i] / counts[i]
            p = np.exp(mean - mean.max())
            p /= p.sum()
            names[i], values[i] = model.languages[int(p.argmax())], float(p.max())
        return names, values

    return score


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with struct column ``language``: lang_pred and score.  It replaces one of that name.

    Null texts and texts without a letter get ``und`` with score 0, as does every
    text if the model has learned no language.  Equal texts get equal answers.
    """
    @F.pandas_udf("struct<lang_pred string, score double>")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer(model)
        for texts in batches:
            names, values = score([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": names, "score": values})

    # not deterministic: Spark then runs it once for all its fields
    return docs.withColumn("language", answer.asNondeterministic()(F.col(text_col).cast("string")))


def held_out(id_col: str = "doc_id"):
    """Documents that no model may learn from: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_known(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents in a language the model knows: not ``und`` and a score of ``least`` or more."""
    model = fit(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    if not model.languages:
        return docs.where(F.col(text_col).rlike("\\p{L}"))
    return (predict(as_row(docs, text=F.col(text_col)), model)
            .where((F.col("language.lang_pred") != UNKNOWN) & (F.col("language.score") >= least))
            .select("row.*"))
