"""Helpers that several operators share: stable row numbers and repeated ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.session import materialize

#: White space of the word contracts: space and the control characters 9 to 13.
SPACE = "[ \\t-\\r]"
NOT_SPACE = "[^ \\t-\\r]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null taken as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_count(text, F.lit(NOT_SPACE)).cast("long")


def as_row(df: DataFrame, **needed: Column) -> DataFrame:
    """The whole row in column ``row``, beside what is ``needed`` of it, so that no name can clash."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"),
                     *[c.alias(name) for name, c in needed.items()])


def numbered(keys: DataFrame, order: list[Column], name: str = "ord") -> DataFrame:
    """``keys`` with 0, 1, 2, ... in the given order, as a written table.

    A range sort deals the rows out; the number is the place within its
    partition plus the rows before it, which are one row per partition.  The
    sorted table is written first, so a lost executor can't deal it anew.
    """
    dealt = (keys.repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("_id", F.monotonically_increasing_id()))
    dealt = materialize(dealt.select(
        "*", F.shiftright("_id", 33).cast("int").alias("_part"),
        F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row")).drop("_id"), "numbered")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select("_part", (F.sum("_rows").over(_by_part()) - F.col("_rows")).alias("_before"))
    return (dealt.join(F.broadcast(before), "_part")  # one row per partition
            .withColumn(name, F.col("_row") + F.col("_before"))
            .drop("_part", "_row", "_before"))


def _by_part():
    from pyspark.sql import Window

    return Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)


#: Bits of a filter over keys, and so the most rows (of 64 bits each) it is broadcast as.
_FILTER_BITS = 1 << 22


def marked(rows: DataFrame, name: str, key_hash: Column, keys: DataFrame, hashed: Column) -> DataFrame:
    """``rows`` with boolean ``name``: false only if the row's key isn't among ``keys``.

    A Bloom filter of one hash: each key sets the bit that its 64-bit hash points to.  The
    filter has a fixed size, whatever the number of keys, so it can be broadcast; with very
    many keys it tells less, and more rows take whatever way the marked ones take.
    """
    def word(h: Column) -> Column:
        return F.shiftrightunsigned(h, 6).bitwiseAND(_FILTER_BITS // 64 - 1)

    def bit(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))

    filled = keys.groupBy(word(hashed).alias("_word")).agg(F.bit_or(bit(hashed)).alias("_bits"))
    return (rows.withColumn("_at", key_hash)
            .join(F.broadcast(filled), word(F.col("_at")) == F.col("_word"), "left")
            .withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(bit(F.col("_at"))) != 0, F.lit(False)))
            .drop("_at", "_word", "_bits"))


def keep_decided(rows: DataFrame, key: str, decided: DataFrame) -> DataFrame:
    """``rows`` (with a column ``key``) of which ``decided`` (key, keep, n) says to keep the key.

    Of ``n`` rows with one key one stays.  Whole rows are shuffled only where they have to be:
    a row that a filter over the unwanted keys lets pass is kept as it stands; one that
    doesn't pass, and isn't found in a filter over those wanted keys that don't pass either,
    goes; only the few rows in both filters are joined to the decisions.
    """
    hashed = F.xxhash64(key)
    unwanted = decided.where(~F.col("keep") | (F.col("n") > 1)).select(key)
    unsure = marked(decided.where("keep"), "_hit", hashed, unwanted, hashed).where("_hit").select(key)
    unsure = materialize(unsure, "unsure")
    rows = marked(marked(rows, "_out", hashed, unwanted, hashed), "_in", hashed, unsure, hashed)
    wanted = decided.where("keep").select(F.col(key).alias("_key"))
    few = rows.where("_out AND _in")
    few = few.join(wanted, few[key] == wanted["_key"], "left_semi").dropDuplicates([key])
    return rows.where("NOT _out").unionByName(few).drop("_out", "_in")
