"""Record schemas.  Every source is read with one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


LONG, DOUBLE, TEXT, FLAG = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()

COLLECTION = _struct(id=LONG, name=TEXT, poster_path=TEXT, backdrop_path=TEXT)
GENRE = _struct(id=LONG, name=TEXT)
COMPANY = _struct(name=TEXT, id=LONG)
COUNTRY = _struct(iso_3166_1=TEXT, name=TEXT)
LANGUAGE = _struct(iso_639_1=TEXT, name=TEXT)

# The fields of a cast and of a crew entry.
CAST_MEMBER = _struct(
    cast_id=LONG, character=TEXT, credit_id=TEXT, gender=LONG,
    id=LONG, name=TEXT, order=LONG, profile_path=TEXT,
)
CREW_MEMBER = _struct(
    credit_id=TEXT, department=TEXT, gender=LONG, id=LONG,
    job=TEXT, name=TEXT, profile_path=TEXT,
)

# Column order of the films CSV file; it is positional, so the order is fixed.
MOVIE = _struct(
    adult=FLAG, belongs_to_collection=COLLECTION, budget=LONG,
    genres=T.ArrayType(GENRE), homepage=TEXT, id=LONG, imdb_id=TEXT,
    original_language=TEXT, original_title=TEXT, overview=TEXT,
    popularity=DOUBLE, poster_path=TEXT,
    production_companies=T.ArrayType(COMPANY),
    production_countries=T.ArrayType(COUNTRY),
    release_date=TEXT, revenue=DOUBLE, runtime=DOUBLE,
    spoken_languages=T.ArrayType(LANGUAGE),
    status=TEXT, tagline=TEXT, title=TEXT, video=FLAG,
    vote_average=DOUBLE, vote_count=DOUBLE,
)
CREDIT = _struct(cast=T.ArrayType(CAST_MEMBER), crew=T.ArrayType(CREW_MEMBER), id=LONG)
RATING = _struct(userId=LONG, movieId=LONG, rating=DOUBLE, timestamp=LONG)

RAW_MOVIE = T.StructType([T.StructField(name, TEXT) for name in MOVIE.names])

# Fields that a cleaned record must have.
MOVIE_REQUIRED = (
    "id", "original_title", "release_date", "budget",
    "revenue", "production_countries", "genres", "overview",
)
RATING_REQUIRED = ("userId", "movieId", "rating")
CREDIT_REQUIRED = ("id", "cast")

CLEAN_MOVIE = T.StructType([MOVIE[name] for name in MOVIE_REQUIRED])
CLEAN_RATING = _struct(movie_id=LONG, rating=DOUBLE)
CLEAN_CREDIT = _struct(id=LONG, cast=T.ArrayType(TEXT))

# Fixed values.  Stored message batches: the code says which record type the payload holds.
MESSAGE_CODE = {"movies": 1, "credits": 2, "ratings": 3}
RECORD = {"movies": MOVIE, "credits": CREDIT, "ratings": RATING}
BATCH_REQUIRED = ("message_id", "message_code", "client_id", "current_batch", "is_last_batch")


def stored_batch(kind: str) -> T.StructType:
    return _struct(
        message_id=LONG, message_code=LONG, client_id=TEXT, current_batch=LONG,
        is_last_batch=FLAG, processed_data=T.ArrayType(RECORD[kind]),
    )


# Answer payloads by query id.
PERSON_COUNT = _struct(name=TEXT, count=LONG)
TITLE_RATING = _struct(title=TEXT, rating=DOUBLE)
ANSWER = {
    "Q1": T.MapType(TEXT, T.ArrayType(TEXT)),
    "Q2": T.ArrayType(T.ArrayType(TEXT)),
    "Q3": _struct(highest=TITLE_RATING, lowest=TITLE_RATING),
    "Q4": _struct(actors=T.ArrayType(PERSON_COUNT)),
    "Q5": _struct(average_positive_rate=DOUBLE, average_negative_rate=DOUBLE),
}
