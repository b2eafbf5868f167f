"""Message bodies, stored batches, inspection and comparison of answers."""

import json

from pyspark.sql import functions as F

from marquee import schemas as S
from marquee.operators import compare, quality
from marquee.sources import batches, results


def batch(**changes):
    document = {
        "message_id": 3, "message_code": S.MESSAGE_CODE["ratings"], "client_id": "c1",
        "current_batch": 0, "is_last_batch": True,
        "processed_data": [{"userId": 1, "movieId": 2, "rating": 4.5, "timestamp": 9}]}
    document.update(changes)
    return document


def test_bodies(spark):
    df = spark.createDataFrame([
        ("m1", '{"id": 1, "rating": 2.0}'), ("m2", '[{"id": 2}, 7, {"id": 3, "rating": 1.0}]'),
        ("m3", "12"), ("m4", "not json"), ("m5", "[]")], "m string, body string")
    rows = batches.decode_bodies(df, S._struct(id=S.LONG, rating=S.DOUBLE)).collect()
    assert sorted((r.m, r.id, r.rating) for r in rows) == [
        ("m1", 1, 2.0), ("m2", 2, None), ("m2", 3, 1.0)]


def test_bodies_round_trip_in_bounded_chunks(spark):
    records = spark.range(0, 1000, 1, 4).select(F.lit("c").alias("client_id"), "id")
    bodies = batches.encode_bodies(records, ["client_id"], chunk=30)
    assert max(len(json.loads(r.body)) for r in bodies.collect()) <= 30
    back = batches.decode_bodies(bodies, S._struct(id=S.LONG))
    assert sorted(r.id for r in back.collect()) == list(range(1000))


def test_stored_batches(spark, tmp_path):
    folder = tmp_path / "c1"
    folder.mkdir()
    (folder / "3_0.json").write_text(json.dumps(batch(), indent=2))
    (folder / "1_0.json").write_text(json.dumps(batch(message_code=1, processed_data=[])))
    (folder / "3_1.json").write_text('{"message_id": 1')
    (folder / "3_2.json").write_text("{}")
    (folder / "3_3.json").write_text(json.dumps({"message_id": 1, "client_id": "c"}))
    (folder / ".tmp_3_4.json").write_text("{}")
    (folder / "3_5.json").write_bytes(b'{"message_id": "\xff\xfe" }')
    checked = batches.read_checked_batches(spark, str(tmp_path), "ratings")
    verdicts = {r.path.rsplit("/", 1)[1]: r.verdict for r in checked.collect()}
    assert verdicts == {"3_0.json": "ok", "3_1.json": "invalid_json", "3_2.json": "too_small",
                        "3_3.json": "missing_keys", "3_5.json": "unreadable"}
    good = batches.read_batches(spark, str(tmp_path), "ratings")
    assert batches.records(good).select("userId", "movieId", "rating").collect() == [(1, 2, 4.5)]

    batches.write_batches(good.drop("path"), str(tmp_path / "out"))
    again = batches.read_batch_lines(spark, str(tmp_path / "out"), "ratings")
    assert [(r.verdict, r.client_id, r.processed_data[0].rating) for r in again.collect()] == [("ok", "c1", 4.5)]

    quality.write_split(checked.drop("processed_data"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.json(str(tmp_path / "bad")).count() == 4


def test_inspection(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(batch()))
    (tmp_path / "b.json").write_text('{"message_id": 1, "processed_data": [1,]')
    (tmp_path / "c.json").write_text("]")
    (tmp_path / "d.json").write_text(json.dumps([1, "x", {"k": 1}, [2], 5, 6]))
    rows = {r.path.rsplit("/", 1)[1]: r for r in quality.inspect_folder(spark, str(tmp_path)).collect()}
    assert rows["a.json"].valid_json and not rows["a.json"].repaired and rows["a.json"].issues == []
    assert rows["b.json"].repaired and rows["b.json"].issues == [
        "missing message_code", "missing client_id", "missing current_batch", "missing is_last_batch",
        "processed_data holds something that is not a record"]
    assert not rows["c.json"].valid_json and rows["c.json"].structure.kind is None
    assert rows["d.json"].structure.length == 6 and len(rows["d.json"].structure.item_types) == 5
    assert rows["a.json"].file_size == rows["a.json"].bytes


def test_profile_and_random_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert [tuple(r) for r in quality.profile(df).collect()] == [
        ("a", "bigint", 2, 2), ("b", "string", 2, 1)]
    assert quality.random_rows(spark.range(50), 10).count() == 10


def test_diff_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "name string, count long")
    right = spark.createDataFrame([("b", 3), ("c", None), ("d", 4)], "name string, count long")
    assert sorted((r.name, r.status) for r in compare.diff_rows(left, right, ["name"]).collect()) == [
        ("a", "missing"), ("b", "changed"), ("d", "extra")]


def answers_text():
    return "\n\n".join(json.dumps(doc, indent=2, ensure_ascii=False) for doc in [
        {"query_id": "Q1", "results": {"La Ciénaga": ["Comedy", "Drama"], "Gerry": []}},
        {"query_id": "Q5", "results": {"average_positive_rate": 2.00001, "average_negative_rate": 0}},
        {"query_id": "Q2", "results": [["Peru", 5], ["Chile", 4]]},
        {"query_id": "Q4", "results": {"actors": [{"name": "A", "count": 2}, {"name": "B", "count": 1}]}},
        {"query_id": "Q3", "results": {"highest": {"title": "x", "rating": 4.5},
                                       "lowest": {"title": "y", "rating": 1.0}}},
        {"no_query": 1}]) + "\n\n"


def test_comparison_of_runs(spark, tmp_path):
    reference = tmp_path / "reference.txt"
    reference.write_text(answers_text(), encoding="utf-8")
    folder = tmp_path / "runs"
    folder.mkdir()
    same = answers_text().replace("2.00001", "2.000012").replace(
        '"Comedy",\n      "Drama"', '" Drama",\n      "Comedy"')
    assert same != answers_text()
    (folder / "resultados_good.txt").write_text(same, encoding="utf-8")
    (folder / "resultados_bad.txt").write_text(
        answers_text().replace('"count": 1', '"count": 7').replace('"Q3"', '"Q9"'), encoding="utf-8")
    (folder / "resultados_short.txt").write_text(
        json.dumps({"query_id": "Q3", "results": {}}), encoding="utf-8")
    expected = results.read_reference_results(spark, str(reference))
    obtained = results.read_client_results(spark, str(folder))
    assert expected.count() == 5
    got = sorted(tuple(r) for r in compare.compare_answers(expected, obtained).collect())
    assert got == [
        ("bad", "Q3", "missing"), ("bad", "Q4", "anomalous"), ("bad", "Q9", "unknown"),
        ("short", "Q1", "missing"), ("short", "Q2", "missing"), ("short", "Q3", "anomalous"),
        ("short", "Q4", "missing"), ("short", "Q5", "missing")]
    people = compare.actor_rows(obtained.filter("client_id = 'bad'")).drop("client_id")
    diff = compare.diff_rows(compare.actor_rows(expected), people, ["name"]).collect()
    assert [(r.name, r.expected["count"], r.obtained["count"], r.status) for r in diff] == [
        ("B", 1, 7, "changed")]


def test_normalize(spark):
    df = spark.createDataFrame(
        [(" a ", [3.00004, 1.0], {"k ": ["b ", "a"]}, (2.5, "x "))],
        "s string, l array<double>, m map<string,array<string>>, r struct<z:double,a:string>")
    row = compare.normalize(df).collect()[0]
    assert (row.s, row.l, row.m) == ("a", [1.0, 3.0], {"k": ["a", "b"]})
    assert row.r.asDict() == {"a": "x", "z": 2.5}


def test_keys_that_become_equal(spark):
    """Titles that differ in outer blanks only are one title, not a failed job."""
    df = spark.createDataFrame([({"A": 2.0, " A": 1.00004, "b": None},)], "m map<string,double>")
    assert compare.normalize(df).first().m == {"A": 1.0, "b": None}
    answer = [("Q1", '{"A": ["x"], " A": ["x"]}')]
    expected = spark.createDataFrame(answer, "query_id string, results string")
    obtained = expected.select(F.lit("c").alias("client_id"), "query_id", "results")
    assert compare.compare_answers(expected, obtained, ["Q1"]).count() == 0


def test_numbers_within_the_tolerance(spark):
    """Close numbers are equal wherever they lie, also across an edge of rounding."""
    want = [("Q5", '{"average_positive_rate": 1.00005, "average_negative_rate": 2.0}'),
            ("Q3", '{"highest": {"title": "T", "rating": 4.00005}, "lowest": {"title": " U", "rating": 1.0}}'),
            ("Q2", '[["AR", "10"], ["ES", "9"]]'), ("Q4", '{"actors": [{"name": "N", "count": 3}]}')]
    expected = spark.createDataFrame(want, "query_id string, results string")

    def judged(*changes):
        rows = expected.withColumn("results", F.col("results"))
        for old, new in changes:
            rows = rows.withColumn("results", F.replace("results", F.lit(old), F.lit(new)))
        found = compare.compare_answers(expected, rows.withColumn("client_id", F.lit("c")), ["Q2", "Q3", "Q4", "Q5"])
        return sorted((r.query_id, r.status) for r in found.collect())

    assert judged(("1.00005", "1.000049"), ("4.00005", "4.000051"), ('" U"', '"U"'), ('"10"', '"10.0"')) == []
    assert judged(("1.00005", "1.0002"), ('"9"', '"8"')) == [("Q2", "anomalous"), ("Q5", "anomalous")]
    assert judged(('"T"', '"t"'), ('"count": 3', '"count": null')) == [("Q3", "anomalous"), ("Q4", "anomalous")]
    assert judged(('"AR"', '"BR"'), ("2.0", "null")) == [("Q2", "anomalous"), ("Q5", "anomalous")]


def test_faults_and_structure(spark):
    texts = ['{"a": 1}', '{"a": \n 1,}', "[1, \"x\", {\"b\": null}]", "{", "", "7 8", '"text"', "null", "true", "1.5",
             '{"a": 1} x', None, '{"a": 1, "a": 2}', "[" * 3 + "]" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string")
    rows = {texts[r.i]: r for r in quality.inspect(df).collect()}
    kinds = {t: rows[t].structure.kind for t in texts if rows[t].valid_json}
    assert kinds == {texts[0]: "object", texts[1]: "object", texts[2]: "array", "{": "object", '"text"': "string",
                     "null": "null", "true": "boolean", "1.5": "number", "[[[]]]": "array"}
    assert rows[texts[2]].structure.length == 3 and rows[texts[0]].structure["keys"] == ["a"]
    assert rows[texts[2]].structure.item_types == ["BIGINT", "STRING", "OBJECT<b: VOID>"]
    assert rows[texts[0]].fault is None and rows[None].fault is None and not rows[None].readable
    assert (rows[texts[1]].fault.position, rows[texts[1]].fault.line, rows[texts[1]].repaired) == (9, 2, True)
    assert rows["7 8"].fault.error == "Extra data" and rows["7 8"].fault.position == 2
    assert rows[""].fault.position == 0 and not rows["7 8"].valid_json and rows['{"a": 1} x'].fault.column == 10
    assert rows['{"a": 1, "a": 2}'].fault.error == "not JSON by the stricter reader"


def test_inspection_parses_once(spark):
    df = spark.createDataFrame([("{}",)], "raw string")
    plan = quality.inspect(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") <= 2 and plan.count("ArrowEvalPython") == 1
