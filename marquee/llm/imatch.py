"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band: neither
stock words nor one-off strings.  It is dealt at random into ``SUBSETS`` sub-lexicons.
For each of these, a document's distinct terms in it are sorted and hashed; the
fingerprint is the list of these 16-bit hashes, 0 where a document has no term.  Two
fingerprints are alike to the degree in which the sub-lexicons that either uses agree.

A term within the band occurs in at least one of ``1 / RAREST`` documents, so the
lexicon has at most ``1 / RAREST`` times the mean number of distinct terms per
document, however many documents there are.  That bound is what lets it be broadcast;
beyond ``BROADCAST_TERMS`` it is joined like any table.

Everything is DataFrame work.  Terms are 64-bit hashes of lower-case runs of letters
and digits.  The whole texts are shuffled once, by document; each document's head
travels to the document before it, and terms are looked up and gathered where the
text lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import numbered, whole_text
from marquee.session import materialize

SUBSETS = 128
#: The band: terms in this share of all documents (idf from ln 50 to ln 500).
RAREST, COMMONEST = 1 / 500, 1 / 50
BROADCAST_TERMS = 1_000_000
#: Texts with at most so many terms use all of them if none is in the band.
FEW_TERMS = 32
_LOW = (1 << 48) - 1


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def subset_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("lexicon"), term), F.lit(SUBSETS))


def lexicon(texts: DataFrame, count: int, text_col: str = "text") -> DataFrame:
    """(term): hashes of the terms within the band, as a written table."""
    seen = texts.select(F.explode(terms(whole_text(text_col))).alias("term"))
    counted = seen.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.where((F.col("n") >= count * RAREST) & (F.col("n") <= count * COMMONEST))
                       .select("term"), "lexicon")


def fingerprint(codes: Column, whole: Column) -> Column:
    """One 16-bit hash per sub-lexicon from sorted codes (subset, term), as 2 * SUBSETS bytes.

    Without codes, the first four places hold the hash of all sorted terms.  Codes are
    split by groups of sub-lexicons first, then within each group.
    """
    def place(part: Column, subset: Column) -> Column:
        mine = F.filter(part, lambda c: F.shiftright(c, 48) == subset)
        return F.when(F.size(mine) == 0, F.lit("0000")).otherwise(
            F.lpad(F.hex(F.pmod(F.xxhash64(mine), F.lit(65_535)) + 1), 4, "0"))

    def group(all_codes: Column, number: Column) -> Column:
        part = F.array(F.filter(all_codes, lambda c: F.shiftright(c, 48 + 3) == number))
        return F.array_join(F.transform(part, lambda p: F.array_join(F.transform(
            F.sequence(number * 8, number * 8 + 7), lambda subset: place(p, subset)), "")), "")

    # arrays of one element make Spark compute an inner value once
    listed = F.array_join(F.transform(F.array(codes), lambda c: F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(SUBSETS // 8 - 1)), lambda number: group(c, number)), "")), "")
    alone = F.rpad(F.lpad(F.hex(whole), 16, "0"), 4 * SUBSETS, "0")
    return F.unhex(F.when(F.size(codes) == 0, alone).otherwise(listed))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the sub-lexicons that either fingerprint uses; 0 to 1."""
    def piece(of: Column, i: Column) -> Column:
        return F.substring(of, 2 * i + 1, F.lit(2))

    none = F.lit(b"\0\0")
    every = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    used = F.size(F.filter(every, lambda i: (piece(a, i) != none) | (piece(b, i) != none)))
    same = F.size(F.filter(every, lambda i: (piece(a, i) != none) & (piece(a, i) == piece(b, i))))
    return F.when(a == b, 1.0).otherwise(F.coalesce(same / F.nullif(used, F.lit(0)), F.lit(0.0)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(id_col, text).alias("k1"),
                       F.xxhash64(F.lit("key"), id_col, text).alias("k2"))


def _neighbours(keyed: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct document with the keys of the next (by descending id) and the one before."""
    slim = keyed.groupBy("k1", "k2").agg(
        F.first("doc_id").alias("doc_id"), F.first(F.char_length("text")).alias("n"),
        F.count(F.lit(1)).alias("times"))
    placed = materialize(numbered(slim, [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")]), "placed")
    count = placed.count()
    ahead = placed.select((F.pmod(F.col("ord") - 1, F.lit(max(1, count)))).alias("ord"),
                          F.col("k1").alias("n1"), F.col("k2").alias("n2"))
    behind = placed.select((F.pmod(F.col("ord") + 1, F.lit(max(1, count)))).alias("ord"),
                           F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("n").alias("p_chars"))
    return materialize(placed.join(ahead, "ord").join(behind, "ord").drop("ord"), "neighbours"), count


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """Distinct documents with their next one's key and the edited text; how many there are.

    Edited: the last third of the code points (rounded down) gives way to as many
    from the head of the next document by descending id, after the last the first.
    """
    keyed = _keyed(docs, id_col, text_col)
    near, count = _neighbours(keyed)
    # Both uses of ``placed`` need the same columns of the texts, so these are shuffled once.
    placed = keyed.drop("doc_id").join(near, ["k1", "k2"])
    third = F.floor(F.col("n") / 3).cast("int")
    heads = placed.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                          F.substring("text", F.lit(1), F.floor(F.col("p_chars") / 3).cast("int")).alias("head"))
    pairs = placed.join(heads, ["k1", "k2"])
    return pairs.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n").cast("int") - third), F.col("head"))), count


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (hex), near_edited and near_next.

    Null texts are empty; texts without terms share one fingerprint; documents with
    one id go by a hash of their texts; rows with equal id and text are one document
    and get equal rows; an empty table gives none; further columns are not read.
    """
    pairs, count = edited_pairs(docs, id_col, text_col)
    words = lexicon(docs, count, text_col)
    mark = F.lit(-1).cast("long")  # so that documents without a term in the band stay
    listed = words.withColumn("kept", F.lit(True))
    if words.count() <= BROADCAST_TERMS:
        listed = F.broadcast(listed)
    carried = ("k1", "k2", "doc_id", "n", "times", "n1", "n2", "sha")
    bodies = pairs.withColumn("sha", F.unhex(F.sha2("edited", 256))).select(
        *carried, F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("of")),
                                    F.struct(F.lit(1).alias("which"), F.col("edited").alias("of")))).alias("body"))
    # Each step is a projection of its own: what stands beside an explode is made for every row it gives.
    bodies = bodies.select(*carried, "body.which", terms(F.col("body.of")).alias("terms"))
    bodies = bodies.select(*carried, "which", F.xxhash64(F.sort_array("terms")).alias("whole"),
                           (F.size("terms") <= FEW_TERMS).alias("few"), F.concat(F.array(mark), "terms").alias("terms"))
    rows = bodies.select(*carried, "which", "whole", "few", F.explode("terms").alias("term"))
    found = rows.join(listed, "term", "left").where(
        F.col("kept") | F.col("few") | (F.col("term") == mark))
    code = F.shiftleft(subset_of(F.col("term")), 48).bitwiseOR(F.col("term").bitwiseAND(F.lit(_LOW)))
    real = F.col("term") != mark
    lists = [F.collect_list(F.when(real & F.coalesce("kept", F.lit(False)) & (F.col("which") == w), code)).alias(f"in{w}")
             for w in (0, 1)]
    spare = [F.collect_list(F.when(real & F.col("few") & (F.col("which") == w), code)).alias(f"all{w}")
             for w in (0, 1)]
    wholes = [F.max(F.when(F.col("which") == w, F.col("whole"))).alias(f"whole{w}") for w in (0, 1)]
    same = [F.first(c).alias(c) for c in carried[2:]]
    grouped = found.groupBy("k1", "k2").agg(*same, *lists, *spare, *wholes)

    def printed(w: int) -> Column:
        codes = F.sort_array(F.when(F.size(f"in{w}") > 0, F.col(f"in{w}")).otherwise(F.col(f"all{w}")))
        return F.transform(F.array(codes), lambda c: fingerprint(c, F.col(f"whole{w}")))[0]

    made = materialize(grouped.select(*carried, printed(0).alias("own"), printed(1).alias("edit")), "prints")
    ahead = made.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("own").alias("next"))
    hexed = lambda c: F.lower(F.hex(c))
    return (made.join(ahead, ["n1", "n2"]).withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
            .select("doc_id", F.col("n").cast("long").alias("n_chars"), hexed("sha").alias("edited_sha256"),
                    hexed("own").alias("fingerprint"), hexed("edit").alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("edit")).alias("near_edited"),
                    likeness(F.col("own"), F.col("next")).alias("near_next")))
