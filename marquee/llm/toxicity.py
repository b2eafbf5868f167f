"""Severity of toxic language by cumulative-link ordinal regression.

A document's features are the words it contains and their first four and five
letters, so that inflected forms meet.  Grades are ordered: P(grade > k) =
sigmoid(w.x - t_k) with one weight vector for all thresholds and t_1 < t_2 < ...  The
expected severity is the sum of these probabilities.

Labels say only whether a document is toxic.  Toxic documents are graded by how many
different words strongly tied to the label they contain: 1 below the median of the
toxic sample, 2 from there on; grade 0 is not toxic.

The model is fitted on a bounded sample: at most about ``SAMPLE`` labelled documents
of either label, chosen by a hash of the id, and the ``FEATURES`` features that tell
the labels apart best.  Scoring reads every whole text and shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import as_row
from marquee.operators import ranking
from marquee.session import materialize

SAMPLE = 4000
FEATURES = 1000
LEAST_CHI2 = 12.0
GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    """Words, and their heads of four and five letters, marked by a hyphen."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:4] + "-" for w in words if len(w) > 4} | {w[:5] + "-" for w in words if len(w) > 5}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def above(self, text: str) -> list[float]:
        """P(grade > k) for k = 0, 1, ..."""
        get, total = self.weights.get, 0.0
        for name in features(text):
            total += get(name, 0.0)
        return [1 / (1 + np.exp(np.clip(t - total, -60, 60))) for t in self.thresholds]


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, size: int, levels: int = GRADES,
                steps: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by Adam on the ordinal log-likelihood.

    ``rows`` are the feature numbers of each document, with value 1.
    """
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate([np.array(r, np.int64) for r in rows]) if len(owner) else np.zeros(0, np.int64)
    # the first threshold and the logs of the steps to the next ones
    params = np.r_[np.zeros(size), 1.0, np.zeros(levels - 2)]
    first, second = np.zeros_like(params), np.zeros_like(params)
    low, high = grades - 1, grades  # the thresholds around a grade
    for step in range(1, steps + 1):
        w, free = params[:size], params[size:]
        cuts = np.cumsum(np.r_[free[0], np.exp(free[1:])])
        edges = np.r_[cuts, np.inf]  # index -1 is read as the one below grade 0
        x = np.bincount(owner, w[column], len(rows)) if len(owner) else np.zeros(len(rows))
        upper = np.where(high < len(cuts), _sigmoid(edges[np.minimum(high, len(cuts))] - x), 1.0)
        lower = np.where(low >= 0, _sigmoid(cuts[np.maximum(low, 0)] - x), 0.0)
        chance = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        dx = du - dl  # of the negative log-likelihood, by x
        dcut = np.zeros(len(cuts))
        np.add.at(dcut, high[high < len(cuts)], -du[high < len(cuts)])
        np.add.at(dcut, low[low >= 0], dl[low >= 0])
        grad = np.r_[np.bincount(column, dx[owner], size) / len(rows) + ridge * w,
                     dcut.sum() / len(rows),
                     [dcut[k:].sum() * np.exp(free[k]) / len(rows) for k in range(1, len(cuts))]]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        params = params - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return params[:size], np.cumsum(np.r_[params[size], np.exp(params[size + 1:])])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, id_col: str = "doc_id",
           text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(toxic, names) of at most ``size`` documents of either label.

    A document with several labels is toxic if one says so; null labels and ids don't count.
    Documents that share an id have its label; they are ordered by a hash of id and text and
    the first are taken, equal ones once.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("_toxic"))
    counts = known.groupBy(F.col("_toxic").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "_id"), F.lit(1_000_000)) / 1e6
    # two rows, then about 2 * size short ones
    chosen = known.join(F.broadcast(counts), F.col("_toxic") == F.col("_of")).where(
        place < F.lit(float(size)) / F.col("_n")).select("_id", "_toxic")

    @F.pandas_udf("array<string>")
    def names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted(features(t)) for t in texts], dtype=object)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select(
        "id", F.col("_toxic").alias("toxic"), names("text").alias("names"),
        F.xxhash64(F.lit("toxicity"), "id", "text").alias("_h")).dropDuplicates(["id", "_h"])
    return ranking.top_k_by(found, size, ["toxic"], F.asc("_h"), F.asc("id")).drop("_h")


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, **columns) -> Model:
    """A model; one that scores 0 everywhere if there are not documents of both labels."""
    rows = materialize(sample(docs, labels, size, **columns), "toxicity")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return Model()
    bad, good = totals[True], totals[False]
    counted = rows.select("toxic", F.explode("names").alias("name")).groupBy("name").agg(
        F.sum(F.col("toxic").cast("long")).alias("p"), F.sum((~F.col("toxic")).cast("long")).alias("q"))
    p, q, n = F.col("p"), F.col("q"), bad + good
    gap = (p * good - q * bad).cast("double")
    chi2 = n * gap * gap / (F.lit(float(bad)) * good * (p + q) * (n - p - q))
    best = (counted.where((p + q < n) & (p + q >= 3)).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
            .orderBy(F.col("chi2").desc(), "name").limit(FEATURES).collect())  # a short list by definition
    number = {r["name"]: i for i, r in enumerate(best)}
    if not number:
        return Model()
    wanted = F.array(*[F.lit(name) for name in number])
    kept = rows.select("id", "toxic", F.array_intersect("names", wanted).alias("names")).collect()
    kept.sort(key=lambda r: (r["id"], r["toxic"], r["names"]))
    x = [[number[name] for name in r["names"]] for r in kept]
    strong = {number[r["name"]] for r in best
              if (r["p"] + 0.5) / bad > 20 * (r["q"] + 0.5) / good and not r["name"].endswith("-")}
    many = np.array([len(strong.intersection(row)) for row in x])
    toxic = np.array([r["toxic"] for r in kept])
    grades = np.where(toxic, 1 + (many >= max(1.0, float(np.median(many[toxic])))), 0)
    weights, cuts = fit_ordinal(x, grades, len(number))
    return Model({name: float(weights[i]) for name, i in number.items()}, cuts.tolist())


def rate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade, 0 to 2), ``grade`` (the likeliest, of
    equal chances the lowest) and ``toxic`` (P(grade > 0) >= 0.5).

    Null and empty texts are rated like a text without any known word; equal texts
    get equal rates; columns of these names are replaced.
    """
    @F.pandas_udf("severity double, grade int, toxic boolean")
    def rated(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                above = model.above(text)
                chances = -np.diff([1.0, *above, 0.0])
                out.append((float(sum(above)), int(np.argmax(chances)), bool(above and above[0] >= 0.5)))
            yield pd.DataFrame(out, columns=["severity", "grade", "toxic"])

    # not deterministic: Spark then runs it once for all its fields
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    made = as_row(docs, rated=rated.asNondeterministic()(text))
    return made.select(*[F.col("row").getField(c).alias(c) for c in docs.columns
                         if c not in ("severity", "grade", "toxic")], "rated.*")
