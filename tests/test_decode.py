"""Dirty-data rules of the raw files."""

import ast

from film_files import (
    ARGENTINA, SPAIN, credits_line, member, movie, write_lines, write_movies,
)
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.functions import literals
from marquee.operators import clean
from marquee.sources import films


def kept_ids(spark, tmp_path, rows, **options):
    path = write_movies(tmp_path / "movies.csv", rows)
    return sorted(r.id for r in films.read_movies(spark, path, **options).select("id").collect())


def test_good_row_has_all_types(spark, tmp_path):
    path = write_movies(tmp_path / "m.csv", [movie(
        belongs_to_collection="{'id': 7, 'name': 'Saga', 'poster_path': None, 'backdrop_path': '/b.jpg'}",
        production_companies="[{'name': \"O'Hara\", 'id': 3}]", video="True", runtime="114.0")])
    df = films.read_movies(spark, path)
    assert [f.name for f in df.schema] == S.MOVIE.names
    row = df.collect()[0]
    assert (row.id, row.budget, row.revenue, row.runtime) == (1, 100, 250.0, 114.0)
    assert [g.asDict() for g in row.genres] == [
        {"id": 35, "name": "Comedy"}, {"id": 18, "name": "Drama"}]
    assert row.belongs_to_collection.id == 7 and row.belongs_to_collection.poster_path is None
    assert row.production_companies[0].name == "O'Hara"
    assert row.video is True and row.adult is False and row.homepage == ""


def test_rows_dropped_and_kept(spark, tmp_path):
    rows = [
        movie(id="1"),
        movie(id="2", overview="", release_date=""),
        movie(id="3", budget="", revenue=""),
        movie(id="4", budget="/abc.jpg"),
        movie(id="1997-08-20"),
        movie(id="6", popularity=""),
        movie(id="7", production_countries="False"),
        ["True", "", "5", "", "", "8", "", "", "short", ""],
        movie(id="9", genres="[{'id': 1}]"),
        movie(id="10", genres="[{'id': 'x', 'name': 'a'}]"),
        movie(id="11", genres="{'id': 1, 'name': 'a'}"),
        movie(id="12", belongs_to_collection="{'id': 1}"),
        movie(id="13", genres="[", production_countries="[]"),
        movie(id=" 14 ", overview='say "hi", all'),
        movie(id="15", genres="({'id': 1.0, 'name': 'tuple'},)"),
        movie(id="16", belongs_to_collection="12"),
        movie(id="17", vote_count="x"),
        movie(id="18", genres="[{'id': null, 'name': 'a'}]"),
    ]
    assert kept_ids(spark, tmp_path, rows) == [1, 2, 3, 14, 15]


def test_empty_money_passes_decode_but_not_cleaning(spark, tmp_path):
    path = write_movies(tmp_path / "m.csv", [
        movie(id="1", overview="", release_date=""), movie(id="2", budget=""), movie(id="3", revenue="")])
    cleaned = clean.clean_movies(films.read_movies(spark, path))
    assert [r.id for r in cleaned.collect()] == [1]
    assert cleaned.columns == list(S.MOVIE_REQUIRED)


def test_line_break_in_text(spark, tmp_path):
    rows = [movie(id="1"), movie(id="2", overview="two\nlines"), movie(id="3")]
    assert kept_ids(spark, tmp_path, rows, keep_multiline=False) == [1, 3]
    assert kept_ids(spark, tmp_path, rows) == [1, 2, 3]


def test_reject_reasons_and_counts(spark, tmp_path):
    path = write_movies(tmp_path / "m.csv", [
        movie(id="1"), movie(id="x", popularity=""), movie(id="3", genres="nonsense")])
    df = films.read_movies(spark, path, keep_rejects=True)
    assert sorted(tuple(r.problems) for r in df.collect()) == [
        (), ("genres",), ("id", "popularity")]
    assert clean.decode_counts(df, "movies").collect()[0].asDict() == {
        "record": "movies", "accepted": 1, "rejected": 2}


def parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r._t for r in literals.with_literals(df, lists=["t"]).orderBy("i").collect()]


def test_literal_texts(spark):
    assert parse(spark, [
        r"[{'name': 'it\'s', 'id': 1}]", r"[{'name': 'caf\xe9 \\x41', 'id': None}]",
        "[{'name': \"x': None, y\"}]", "[{'name': 'a: None, b', 'k': None}]",
        "", "[]", "False", "[{'a': 'b'", "[{'a': 1.5, 'b': True}]", "[{'n': '\\N{BULLET}'}]",
        "[ {'a':1} , ]", "[{'a': 'tab\there'}]", "[1, 2]",
    ]) == [
        [{"name": "it's", "id": "1"}], [{"name": "café \\x41", "id": None}],
        [{"name": "x': None, y"}], [{"name": "a: None, b", "k": None}],
        [], [], None, None, [{"a": "1.5", "b": "True"}], [{"n": "\u2022"}],
        [{"a": "1"}], [{"a": "tab\there"}], None,
    ]


_text = st.lists(st.sampled_from(
    list("abN ':\"\\,{}[]é\u20ac\t\n\x07") + ["None", ": None", "': None", "\": None"]),
    max_size=8).map("".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.generate])
@given(st.lists(st.lists(st.dictionaries(
    _text, st.one_of(_text, st.none(), st.integers(-10**17, 10**17)), max_size=3), max_size=3),
    min_size=60, max_size=120))
def test_any_printed_list_is_read_back(spark, values):
    texts = [repr(value) for value in values]
    assert [ast.literal_eval(t) for t in texts] == values
    wanted = [
        [{k: None if v is None else str(v) for k, v in d.items()} for d in value] for value in values]
    assert parse(spark, texts) == wanted


def test_credits(spark, tmp_path):
    lines = [
        credits_line([member("Ricardo Darín"), member("O'Brien"), member('The "Kid"')], [], 5),
        credits_line([], [], 6),
        "not a credits line",
        credits_line([member("Good"), "{'name': 'no other keys'}", member("Last", gender=2), "{broken"], [], 7),
        credits_line([member("x")], [], "abc"),
        credits_line([member("Caf\x81é")], [repr({
            "credit_id": "k", "department": "D", "gender": 1, "id": 4, "job": "J",
            "name": "Boss", "profile_path": None})], 8),
    ]
    path = write_lines(tmp_path / "credits.csv", "cast,crew,id", lines)
    rows = {r.id: r for r in films.read_credits(spark, path).collect()}
    names = {i: [c.name for c in r.cast] for i, r in rows.items()}
    assert names == {5: ["Ricardo Darín", "O'Brien", 'The "Kid"'], 6: [],
                     7: ["Good", "Last"], 8: ["Caf\x81é"]}
    assert rows[8].crew[0].name == "Boss" and rows[5].cast[0].gender is None
    rejected = films.read_credits(spark, path, keep_rejects=True).filter(F.size("problems") > 0)
    assert rejected.count() == 3


def test_quoted_credits_fields(spark):
    """Quotes are undone by CSV rules, whatever they enclose."""
    odd = member('a ""b"" {c')
    lines = [credits_line([member('He said "no", twice'), odd], [], 1), '"[]","[]", 2 ', "[],[],3,4", "[],[]",
             "5", "[{'x': 1}],[],6", "[],x,7", "[],[],", "[],[],99999999999999999999", "", "  "]
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = {r.id: [c.name for c in r.cast] for r in films.decode_credits(raw).collect()}
    assert rows == {1: ['He said "no", twice', 'a ""b"" {c'], 2: [], 6: []}
    kept = films.decode_credits(raw, keep_rejects=True)
    assert kept.count() == 9 and kept.filter(F.size("problems") > 0).count() == 6


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_text_is_parsed_once(spark):
    """A list is read once, and Python is met at most once, also where rejects are dropped."""
    lines = spark.createDataFrame([("[],[],1",)], "value string")
    raw = spark.createDataFrame([tuple(movie().values())], S.RAW_MOVIE)
    for df, lists in ((films.decode_credits(lines), 2), (films.decode_movies(raw), 5)):
        plan = _plan(df)
        assert plan.count("ArrowEvalPython") == 1
        assert plan.count("from_json(") == lists and plan.count("RLIKE(") <= 2 * lists + 10
    assert _plan(films.decode_credits(lines)).count("from_csv(") == 1


def test_ratings(spark, tmp_path):
    path = write_lines(tmp_path / "r.csv", "userId,movieId,rating,timestamp", [
        "1,10,4.5,1425941529", "1,10,4.5", "1,10,4.5,1425941529,9", "1,x,4.5,1425941529",
        "2,10,,1425941529", "3,11,2,1425941530"])
    df = films.read_ratings(spark, path)
    assert sorted(tuple(r) for r in df.collect()) == [
        (1, 10, 4.5, 1425941529), (3, 11, 2.0, 1425941530)]
    # A query that needs one column only must not let malformed lines back in.
    assert df.select("movieId").count() == 2
    assert sorted(r.rating for r in clean.clean_ratings(df).select("rating").collect()) == [2.0, 4.5]


def test_csv_round_trip(spark, tmp_path):
    path = write_movies(tmp_path / "m.csv", [movie(id="1", overview='a "quoted", text')])
    raw = spark.read.schema(S.RAW_MOVIE).option("header", True).option("escape", '"').csv(path)
    films.write_csv(raw, str(tmp_path / "out"))
    again = films.read_movies(spark, str(tmp_path / "out")).collect()
    assert [(r.id, r.overview, r.tagline) for r in again] == [(1, 'a "quoted", text', "")]


def test_coproduction_constants():
    assert ast.literal_eval(ARGENTINA)["name"] == "Argentina"
    assert ast.literal_eval(SPAIN)["name"] == "Spain"
