"""Lexicon polarity of a text and the three sentiment classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import casts
from marquee.session import materialize

# Thresholds are strict: a polarity of exactly 0.1 or -0.1 is neutral.
POSITIVE_ABOVE = 0.1
NEGATIVE_BELOW = -0.1

# A small general-purpose word list; pass your own for anything serious.
DEFAULT_LEXICON = {
    "good": 0.7, "great": 0.8, "excellent": 1.0, "best": 1.0, "beautiful": 0.85,
    "love": 0.5, "loved": 0.7, "happy": 0.8, "wonderful": 1.0, "funny": 0.25,
    "perfect": 1.0, "brilliant": 0.9, "charming": 0.7, "exciting": 0.3,
    "fun": 0.3, "hope": 0.3, "joy": 0.8, "magical": 0.5, "success": 0.3,
    "successful": 0.75, "sweet": 0.35, "young": 0.1, "new": 0.15, "win": 0.8,
    "bad": -0.7, "worst": -1.0, "terrible": -1.0, "awful": -1.0, "horrible": -1.0,
    "hate": -0.8, "sad": -0.5, "evil": -1.0, "violent": -0.8, "cruel": -1.0,
    "dead": -0.2, "dark": -0.15, "dangerous": -0.6, "poor": -0.4, "boring": -1.0,
    "brutal": -0.9, "angry": -0.5, "fear": -0.4, "lost": -0.3, "tragic": -0.75,
}

#: A word: letters and digits, with apostrophes inside.
WORD = "[\\p{L}\\p{N}]+(?:'[\\p{L}\\p{N}]+)*"


def tokens(text: Column) -> Column:
    """Lower-case words; none for a missing or blank text."""
    return F.regexp_extract_all(
        F.lower(F.when(casts.blank(text), "").otherwise(text)), F.lit(WORD), F.lit(0))


def polarity(text: Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> Column:
    """Mean polarity of the lexicon words in ``text``, 0 when there is none.

    Needs no shuffle and no key.  Words are split once, and a hashed set of all words
    spares unknown ones the rest.  Words of one polarity form one set, whose hits are
    counted; the sum goes by polarity, so it doesn't hang on the order of the words.
    """
    by_value: dict[float, list[str]] = {}
    for word in sorted(lexicon):
        by_value.setdefault(float(lexicon[word]), []).append(word)
    if not by_value:
        return F.lit(0.0)
    known = F.filter(tokens(text), lambda token: token.isin(sorted(lexicon)))

    def mean(hits: Column) -> Column:
        total = F.lit(0.0)
        for value in sorted(by_value):
            words = by_value[value]
            total = total + F.lit(value) * F.size(F.filter(hits, lambda token: token.isin(words)))
        return F.when(F.size(hits) > 0, total / F.size(hits)).otherwise(F.lit(0.0))

    # As the one item of an array the hits are found once, not once per polarity.
    return F.transform(F.array(known), mean)[0]


#: Words that strengthen or weaken the next word of feeling, and by how much.
DEFAULT_MODIFIERS = {
    "absolutely": 1.5, "almost": 0.8, "completely": 1.4, "deeply": 1.3, "extremely": 1.6, "fairly": 0.9,
    "incredibly": 1.5, "slightly": 0.5, "quite": 1.1, "rather": 0.9, "really": 1.3, "so": 1.2,
    "somewhat": 0.7, "too": 1.1, "totally": 1.4, "truly": 1.3, "very": 1.3,
}
#: Words that turn the next word of feeling round, as do words in n't.
DEFAULT_NEGATIONS = ("no", "not", "never", "nor", "without")
#: What is left of a polarity that is turned round.
DENIED = -0.5
_MICRO = 1_000_000


def polarity_with_rules(text: Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON,
                        modifiers: Mapping[str, float] = DEFAULT_MODIFIERS,
                        negations: Sequence[str] = DEFAULT_NEGATIONS, denied: float = DENIED) -> Column:
    """Mean polarity of the lexicon words in ``text``, each as its context changes it.

    The words are folded once, from left to right.  A modifier waits for the next lexicon
    word, whose polarity it multiplies (kept within -1 to 1); of several the last counts.  A
    negation turns it round and leaves the share ``denied``; it also turns a modifier that
    follows it into its reverse, so "not very good" is less bad than "not good".  Both wait
    across short words: modifiers across words of two letters, negations across one; any
    longer word that is in no table ends the wait, as does a lexicon word.  A word in several
    tables counts as a modifier first, then as a negation.

    Summed in millionths, so the result is exact; 0 for a text without a lexicon word.  Needs
    no shuffle; a text is split into words once.
    """
    by_value: dict[float, list[str]] = {}
    for word in sorted(lexicon):
        by_value.setdefault(float(lexicon[word]), []).append(word)
    by_factor: dict[float, list[str]] = {}
    for word in sorted(modifiers):
        by_factor.setdefault(float(modifiers[word]), []).append(word)
    if not by_value:
        return F.lit(0.0)

    def looked_up(token: Column, table: dict[float, list[str]]) -> Column:
        found = F.lit(None).cast("double")
        for value, words in table.items():
            found = F.when(token.isin(words), F.lit(value)).otherwise(found)
        return found

    def classified(token: Column) -> Column:
        denial = token.endswith("n't") | (token.isin(list(negations)) if negations else F.lit(False))
        return F.struct(looked_up(token, by_factor).alias("factor"), denial.alias("denies"),
                        looked_up(token, by_value).alias("value"),
                        F.char_length(F.replace(token, F.lit("'"), F.lit(""))).alias("size"))

    def step(state: Column, word: Column) -> Column:
        modifies = word["factor"].isNotNull()
        denies = ~modifies & word["denies"]
        scores = ~modifies & ~denies & word["value"].isNotNull()
        other = ~modifies & ~denies & ~scores
        reverse = state["denied"] & state["early"]
        strength = F.when(reverse, F.lit(1.0) / state["factor"]).otherwise(state["factor"])
        value = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), word["value"] * strength))
        value = F.when(state["denied"], value * denied).otherwise(value)
        keeps_denial = denies | (state["denied"] & (modifies | (other & (word["size"] <= 1))))
        return F.struct(
            (state["sum"] + F.when(scores, F.round(value * _MICRO).cast("long")).otherwise(0)).alias("sum"),
            (state["hits"] + scores.cast("long")).alias("hits"),
            F.when(modifies, word["factor"]).when(denies | (other & (word["size"] <= 2)), state["factor"])
            .otherwise(F.lit(1.0)).alias("factor"),
            keeps_denial.alias("denied"),
            # whether the denial was there before the modifier that waits
            F.when(modifies, state["denied"]).otherwise(state["early"] & keeps_denial & state["denied"]).alias("early"))

    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("hits"),
                     F.lit(1.0).alias("factor"), F.lit(False).alias("denied"), F.lit(False).alias("early"))

    def mean(words: Column) -> Column:
        folded = F.aggregate(F.transform(words, classified), start, step,
                             lambda state: F.struct(state["sum"], state["hits"]))
        return F.transform(F.array(folded), lambda f: F.when(
            f["hits"] > 0, f["sum"] / (f["hits"] * _MICRO)).otherwise(F.lit(0.0)))[0]

    felt = lambda words: F.exists(words, lambda token: token.isin(sorted(lexicon)))
    # As the one item of an array the words are found once; texts without feeling aren't folded.
    return F.transform(F.array(tokens(text)), lambda words: F.when(felt(words), mean(words)).otherwise(F.lit(0.0)))[0]


def _counted(words: Column) -> Column:
    """Each distinct word with its number in an array of one word or more: runs of the sorted words."""
    def runs(ordered: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                          lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return F.transform(F.array(begins), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(ordered, i).alias("word"),
            (F.coalesce(F.get(at, k + 1), F.size(ordered)) - i).alias("n"))))[0]

    # As the one item of an array the words are sorted, and the runs found, once.
    return F.transform(F.array(F.sort_array(words)), runs)[0]


def polarity_by_table(texts: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """``(key, polarity)`` for a lexicon of any size, given as ``(word, polarity)``.

    One row per key: texts that share a key, a null one too, are scored as one text.

    The lexicon is written first, so its size is known: Spark sends it to the texts
    where it is small, and only the hits, summed per task, are shuffled.  The texts
    are read once; an entry that no lexicon has keeps each text in the result.  Words
    are counted per text first, so that a frequent one comes once a text to the join.
    """
    own = F.concat(F.lit("\0"), F.xxhash64(key).cast("string"))
    words = F.array_append(tokens(F.col(text)), own)
    spread = texts.select(key, F.inline(_counted(words)))
    known = materialize(lexicon.select("word", "polarity").dropDuplicates(["word"]), "lexicon")
    # Hits and each text's own entry are all that goes on; other words end here.
    hits = spread.join(known, "word", "left").filter(
        F.col("polarity").isNotNull() | F.col("word").startswith("\0"))
    number = F.sum(F.when(F.col("polarity").isNotNull(), F.col("n")))
    return hits.groupBy(key).agg(
        F.coalesce(F.sum(F.col("polarity") * F.col("n")) / number, F.lit(0.0)).alias("polarity"))


def sentiment_class(score: Column) -> Column:
    """positive, negative or neutral; a missing score is neutral."""
    def label(p: Column) -> Column:
        return (F.when(p > POSITIVE_ABOVE, "positive").when(p < NEGATIVE_BELOW, "negative")
                .otherwise("neutral"))
    # As the one item of an array the score is computed once, not once per test.
    return F.transform(F.array(score), label)[0]


def sentiment(text: Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> Column:
    """Class of a text; blank and missing texts are neutral."""
    return sentiment_class(polarity(text, lexicon))


def with_feeling(df: DataFrame, label: Column, column: str = "sentiment") -> DataFrame:
    """Adds the class and drops neutral rows.  Unfolding a list of at most one
    class, unlike a filter, keeps Spark from scoring each text twice."""
    felt = F.filter(F.array(label), lambda name: name != "neutral")
    return df.withColumn(column, F.explode(felt))


def model_scorer(load: Callable[[], Callable[[list[str]], list[str]]]):
    """A row scorer for any batch model: ``load`` runs once per Python worker task
    and returns a function from texts to labels."""

    @F.pandas_udf("string")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield pd.Series(model(texts.fillna("").tolist()), index=texts.index, dtype=object)

    return score
