"""Records over several lines, in files that are split anywhere."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from film_files import movie, write_movies
from pyspark.sql import functions as F

from marquee.sources import films, records


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def _written(folder, name, rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["k", "text"], *rows])
    (folder / name).write_text(out.getvalue(), encoding="utf-8")
    return rows


def test_records_across_many_splits(spark, tmp_path, small_splits):
    rng, rows = random.Random(4), []
    for k in range(3):
        text = lambda: "".join(rng.choice(['a', 'é', '"', '""', ",", "\n", "\n\n", " ", "\\", "word "])
                               for _ in range(rng.choice([0, 1, 5, 120])))
        rows += _written(tmp_path, f"f{k}.csv", [[f"{k}-{i}", text()] for i in range(150)])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    found = records.quoted_records(spark, str(tmp_path))
    got = found.select(F.from_csv("value", "k string, text string", {"escape": '"'}).alias("r")).select("r.*")
    assert sorted((r["k"], r["text"] or "") for r in got.collect()) == sorted(map(tuple, rows))


def test_plain_lines_are_not_shuffled(spark, tmp_path):
    _written(tmp_path, "f.csv", [["a", "b"], ["c", 'd "e"']])
    plan = records.quoted_records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "Sort [" not in plan.split("Window")[0]


def test_unclosed_quote_and_blank_lines(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('h\n\n"x\ny"\n  \nz\n"never closed\nend', encoding="utf-8")
    (tmp_path / "b.csv").write_text('h\nown file\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("", encoding="utf-8")
    got = sorted(r["value"] for r in records.quoted_records(spark, str(tmp_path)).collect())
    assert got == ['"never closed\nend', '"x\ny"', "own file", "z"]
    with_header = records.quoted_records(spark, str(tmp_path / "b.csv"), header=False)
    assert sorted(r["value"] for r in with_header.collect()) == ["h", "own file"]


def test_films_with_line_breaks(spark, tmp_path, small_splits):
    rows = [movie(id=str(k), overview=f"line one {k}\n\nline \"three\", more" if k % 3 == 0 else "one line",
                  popularity="" if k % 7 == 0 else "1.5") for k in range(1, 60)]
    path = write_movies(tmp_path / "m.csv", rows)
    got = {r.id: r.overview for r in films.read_movies(spark, path).select("id", "overview").collect()}
    assert got == {int(r["id"]): r["overview"] for r in rows if r["popularity"]}
    every = films.read_movies(spark, path, keep_rejects=True)
    assert every.count() == 59 and every.filter(F.size("problems") > 0).count() == 8


# --- JSON objects -------------------------------------------------------------------------

def _documents(spark, path):
    return sorted((r["path"].rsplit("/", 1)[1], json.loads(r["document"]))
                  for r in records.json_objects(spark, str(path)).collect())


def _value(rng, depth):
    kind = rng.randrange(7 if depth else 4)
    if kind == 0:
        return rng.choice([None, True, 1.5, -3])
    if kind < 4:
        return "".join(rng.choice(['}', '{', '}{', '"', "\\", "\n", "é", "a", "word ", '\\"', "[]"])
                       for _ in range(rng.choice([0, 3, 9, 60])))
    if kind == 4:
        return [_value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return {f"k{i}": _value(rng, depth - 1) for i in range(rng.randrange(4))}


@pytest.mark.parametrize("indent, between", [(None, ""), (None, "\n"), (2, "\n"), (1, " , [ \n")])
def test_objects_across_many_splits(spark, tmp_path, small_splits, indent, between):
    rng, want = random.Random(indent or 9), []
    for k in range(3):
        found = [{"n": i, "v": _value(rng, 3)} for i in range(60)]
        (tmp_path / f"f{k}.json").write_text(
            between.join(json.dumps(d, indent=indent, ensure_ascii=False) for d in found) + rng.choice(["", "\n"]),
            encoding="utf-8")
        want += [(f"f{k}.json", d) for d in found]
    order = lambda x: (x[0], x[1]["n"])
    got = [(r["path"].rsplit("/", 1)[1], json.loads(r["document"]))
           for r in records.json_objects(spark, str(tmp_path)).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_objects_in_odd_files(spark, tmp_path, small_splits):
    texts = {
        "empty": "", "blank": " \n", "list": '[{"a": 1}, {"b": {}}]', "cut": '{"a": 1}{"b": {"c": 2}',
        "cut-string": '{"a": 1}\n{"b": "}', "words": 'first: {"a": {}} then {} end', "none": "[1, 2]",
        "bad": '{"a": }{"b": 1}', "open": '{"a": 1',
        "deep": '{"a": ' * 40 + "1" + "}" * 40}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    got: dict = {}
    for r in records.json_objects(spark, str(tmp_path)).collect():
        got.setdefault(r["path"].rsplit("/", 1)[1], []).append(r["document"])
    assert {k: sorted(v) for k, v in got.items()} == {
        "list": ['{"a": 1}', '{"b": {}}'], "cut": ['{"a": 1}'], "cut-string": ['{"a": 1}'],
        "words": ['{"a": {}}', "{}"], "bad": ['{"b": 1}'], "deep": [texts["deep"]]}
