"""Films, credits and ratings CSV files -> typed records.

A record with any unusable field is left out.  ``keep_rejects=True`` returns all
rows with a ``problems`` array instead (empty for good rows), which is what the
decode counters and the quarantine split work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.functions import casts, literals
from marquee.operators import joins
from marquee.sources import records

_CORRUPT = "_corrupt_record"


#: How the films file quotes: a quote within a quoted text is doubled.
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"}


def read_movies(spark: SparkSession, path: str, keep_rejects: bool = False,
                keep_multiline: bool = True) -> DataFrame:
    """Decoded films; the files are split over all tasks, wherever their lines break.

    Without ``keep_multiline`` a record whose quoted text holds a line break is dropped,
    and the scan is Spark's own.
    """
    if keep_multiline:
        line = F.from_csv("value", S.RAW_MOVIE.simpleString()[len("struct<"):-1].replace(":", " "), _CSV)
        raw = records.quoted_records(spark, path).select(F.explode(F.array(line)).alias("row")).select("row.*")
    else:
        raw = spark.read.schema(S.RAW_MOVIE).option("header", True).options(**_CSV).csv(path)
    return decode_movies(raw, keep_rejects)


def decode_movies(raw: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """All-text film rows -> ``MOVIE`` rows.  Empty text stays empty, not null."""
    text = {name: F.coalesce(F.col(name), F.lit("")) for name in S.MOVIE.names}

    parsed = literals.with_literals(
        raw.select(*[value.alias(name) for name, value in text.items()]),
        lists=list(_LISTS), dicts=["belongs_to_collection"])
    collection = F.when(
        F.size("_belongs_to_collection") == 1, F.col("_belongs_to_collection")[0])
    column = {name: F.col(name) for name in S.MOVIE.names}
    number = {
        name: (casts.to_long if S.MOVIE[name].dataType == S.LONG else casts.to_double)(column[name])
        for name in _NUMBERS
    }

    problems: dict[str, Column] = {}
    for name, needed in _NUMBERS.items():
        bad = number[name].isNull()
        problems[name] = bad if needed else (column[name] != "") & bad
    problems["belongs_to_collection"] = (column["belongs_to_collection"] != "") & ~F.coalesce(
        literals.has_keys(collection, S.COLLECTION.names)
        & casts.to_long(collection["id"]).isNotNull(), F.lit(False))
    for name, entry in _LISTS.items():
        problems[name] = ~F.coalesce(F.forall(F.col(f"_{name}"), _entry_check(entry)), F.lit(False))

    def value(field: T.StructField) -> Column:
        name = field.name
        if name in number:
            return number[name]
        if name in _LISTS:
            return F.transform(
                F.col(f"_{name}"), lambda entry: literals.entry_struct(entry, _LISTS[name]))
        if name == "belongs_to_collection":
            return F.when(collection.isNotNull(),
                          literals.entry_struct(collection, S.COLLECTION))
        if field.dataType == S.FLAG:
            return casts.to_flag(column[name])
        return column[name]

    found = F.array_compact(F.array(*[
        F.when(bad, F.lit(name)) for name, bad in problems.items()]))
    decoded = parsed.select(
        *[value(field).alias(field.name) for field in S.MOVIE], found.alias("problems"))
    return _finish(decoded, keep_rejects)


# Number fields; True where empty text is a fault too.
_NUMBERS = {
    "budget": False, "id": True, "popularity": True, "revenue": False,
    "runtime": False, "vote_average": True, "vote_count": True,
}
_LISTS = {
    "genres": S.GENRE, "production_companies": S.COMPANY,
    "production_countries": S.COUNTRY, "spoken_languages": S.LANGUAGE,
}


def _entry_check(schema: T.StructType):
    def check(entry: Column) -> Column:
        ok = literals.has_keys(entry, schema.names)
        if schema == S.GENRE:
            ok = ok & casts.to_long(entry["id"]).isNotNull()
        return ok
    return check


def _finish(decoded: DataFrame, keep_rejects: bool, parsed: bool = True) -> DataFrame:
    """Without rejects, unless they are asked for.

    Whether a row is good shows only when it has been ``parsed``.  Spark would move the test
    below that work and do the work twice; a row that comes out of a generator stays whole.
    """
    if keep_rejects:
        return decoded
    good = F.size("problems") == 0
    if not parsed:
        return decoded.filter(good).drop("problems")
    row = decoded.select(F.explode(F.array(F.struct(*decoded.columns))).alias("row")).select("row.*")
    return row.filter(good).drop("problems")


def _credit_fields(line: Column) -> Column:
    """Cast, crew and id of a credits line, as text; Spark's CSV rules undo the quoting."""
    return F.from_csv(line, "cast string, crew string, id string, more string", {
        **_CSV, "ignoreTrailingWhiteSpace": "true"})


def read_credits(spark: SparkSession, path: str, keep_rejects: bool = False,
                 of: DataFrame | None = None) -> DataFrame:
    """Decoded credits.  Records are lines, so files split freely; the header and
    every line of another form are left out."""
    return decode_credits(spark.read.text(path), keep_rejects, of)


def decode_credits(lines: DataFrame, keep_rejects: bool = False, of: DataFrame | None = None) -> DataFrame:
    """``of`` holds the ids of the films whose credits are wanted: most lines of other films are
    then left out once their id is read, before their lists are; a join with those films
    is still to be made.  It has no effect on ``keep_rejects``."""
    line = F.trim(F.col("value"), F.lit(" \t\r\n\f\v"))
    fields = lines.filter(line != "").select(F.explode(F.array(_credit_fields(line))).alias("fields"))
    text = {name: F.col("fields").getField(name) for name in ("cast", "crew", "id", "more")}

    def listed(field: Column) -> Column:
        return F.startswith(field, F.lit("[")) & F.endswith(field, F.lit("]"))

    fits = F.coalesce(listed(text["cast"]) & listed(text["crew"]) & text["id"].rlike("^[0-9]+$")
                      & text["more"].isNull(), F.lit(False))
    if keep_rejects:
        split = fields.select(
            F.when(fits, casts.to_long(text["id"])).alias("id"),
            *[F.when(fits, text[name]).alias(name) for name in ("cast", "crew")])
    else:  # a line without a fitting id is a reject whatever its lists hold
        split = fields.where(fits).select(
            casts.to_long(text["id"]).alias("id"), text["cast"].alias("cast"), text["crew"].alias("crew"))
        split = split.where("id IS NOT NULL")
        if of is not None:
            split = joins.without_most_others(split, "id", of)
    split = literals.with_literals(split, objects=["cast", "crew"])

    def members(name: str, schema: T.StructType) -> Column:
        fitting = F.filter(
            F.col(name), lambda entry: literals.has_exact_keys(entry, schema.names))
        return F.transform(fitting, lambda entry: literals.entry_struct(entry, schema))

    bad = F.col("id").isNull()
    decoded = split.select(
        members("_cast", S.CAST_MEMBER).alias("cast"),
        members("_crew", S.CREW_MEMBER).alias("crew"),
        "id",
        F.array_compact(F.array(F.when(bad, F.lit("line")))).alias("problems"),
    )
    return _finish(decoded, keep_rejects)


def read_ratings(spark: SparkSession, path: str, keep_rejects: bool = False,
                 strict: bool = False) -> DataFrame:
    """Decoded ratings: exactly four fields, all numbers.

    Asking for the corrupt-record column makes Spark check every field of every
    line even when a query needs only some.  ``strict`` fails the job instead.
    """
    options = spark.read.option("header", True)
    if strict:
        return options.schema(S.RATING).option("mode", "FAILFAST").csv(path)
    schema = T.StructType([*S.RATING.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = options.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    complete = F.col(_CORRUPT).isNull()
    for name in S.RATING.names:
        complete = complete & F.col(name).isNotNull()
    decoded = rows.select(
        *S.RATING.names,
        F.array_compact(F.array(F.when(~complete, F.lit("line")))).alias("problems"))
    return _finish(decoded, keep_rejects, parsed=False)


#: Files for later steps of a job: packed, as texts repeat, and so short that each is read by
#: one task, as packed files can't be split.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def write_csv(df: DataFrame, path: str, quote_all: bool = False, **options) -> None:
    """Flat rows as CSV with a header and doubled quotes; ``quote_all`` keeps outer blanks."""
    writer = df.write.option("header", True).option("escape", '"').option("emptyValue", "").options(**options)
    if quote_all:
        writer = writer.options(quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.csv(path)
