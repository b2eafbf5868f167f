"""What has to stay bounded, or small, as tables grow."""

from __future__ import annotations

import os
from contextlib import contextmanager
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.functions import casts, literals, sentiment
from marquee.plans import bindings, file_bindings
from marquee.session import scratch_path
from marquee.sources import films, records
from marquee.streaming import jobs, stateful


@contextmanager
def _set(spark, **values):
    names = {name.replace("_", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _size(path: str) -> int:
    return sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few thousand line items and what they refer to; a part is missing."""
    folder = str(tmp_path_factory.mktemp("tables"))
    sql = {
        "nation": "SELECT id AS n_nationkey, concat('NATION_', id) AS n_name FROM range(3)",
        "supplier": "SELECT id AS s_suppkey, id % 3 AS s_nationkey FROM range(9)",
        "part": """SELECT id AS p_partkey, concat('part ', id) AS p_name, 'Brand#1' AS p_brand,
                   'STEEL' AS p_type, id AS p_size FROM range(50)""",
        "orders": """SELECT id AS o_orderkey, DATE '2003-01-01' AS o_orderdate, 10.0D AS o_totalprice,
                     '5-LOW' AS o_orderpriority FROM range(1000)""",
        "lineitem": """SELECT id div 4 AS l_orderkey, id % 51 AS l_partkey, id % 9 AS l_suppkey,
                       1 + id % 4 AS l_linenumber, 2.5D AS l_extendedprice FROM range(4000)""",
        "events": "SELECT id AS user_id, id AS event_id, 1.5D AS value FROM range(100)",
        "documents": "SELECT id AS doc_id, 'one\\n\"two\"' AS text FROM range(10)",
    }
    for name, text in sql.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_raw_files_are_packed_and_whole(spark, tables):
    paths = file_bindings._raw_files(spark, tables)
    lines = file_bindings._credit_lines(spark, tables)
    texts = sorted(row.value for row in lines.collect())
    assert len(texts) == 4000 - len([k for k in range(4000) if k % 51 == 50])
    assert sorted(row.value for row in spark.read.text(paths["credits"]).collect()) == texts
    assert _size(paths["credits"]) < sum(map(len, texts)) / 8
    for path in paths.values():
        assert [name for name in os.listdir(path) if name.startswith("part-") and not name.endswith(".gz")] == []


def test_lines_are_not_shuffled_to_find_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"one\n\ntwo"\nthree\n')
    with _set(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        found = records.quoted_records(spark, str(tmp_path))
        assert "SortMergeJoin" not in found._jdf.queryExecution().sparkPlan().toString()
        assert sorted(row.value for row in found.collect()) == ['"one\n\ntwo"', "three"]


def test_reading_lines_counts_no_characters(spark, tmp_path):
    """Quotes are told by lengths in bytes, which need no pass over the text."""
    (tmp_path / "a.csv").write_text('h\n"é\n\n""ü""\n"\n"one"\n', encoding="utf-8")
    found = records.quoted_records(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and "char_length" not in plan and " length(" not in plan
    assert sorted(row.value for row in found.collect()) == ['"one"', '"é\n\n""ü""\n"']
    (tmp_path / "b.csv").write_text('h\n»a\nb»\n»c»\n', encoding="utf-8")
    rows = records.quoted_records(spark, str(tmp_path / "b.csv"), quote="»").collect()
    assert sorted(row.value for row in rows) == ["»a\nb»", "»c»"]


def test_only_texts_with_none_are_replaced(spark):
    rows = [(None,), ("",), ("[{'id': 1, 'name': 'a'}]",), ("[{'id': None, 'name': \"None\"}]",),
            ("[{\"id\": None, 'name': ': None'}]",), ("[{'id': 2, 'name': 'x\\': None'}]",)]
    df = spark.createDataFrame(rows, "g string")
    assert df.select(literals._with_nulls(F.col("g")))._jdf.queryExecution().toString().count("CASE WHEN") > 0
    got = [row["_g"] for row in literals.with_literals(df, lists=["g"]).collect()]
    assert got == [[], [], [{"id": "1", "name": "a"}], [{"id": None, "name": "None"}],
                   [{"id": None, "name": ": None"}], [{"id": "2", "name": "x': None"}]]


def _credit(name: str, key) -> str:
    return (f"""\"[{{'cast_id': 1, 'character': \"\"x {{y\"\", 'credit_id': 'c', 'gender': None, 'id': 9, """
            f"""'name': '{name}', 'order': 0, 'profile_path': None}}]\",[],{key}""")


def test_credits_of_other_films_are_not_decoded(spark):
    """They go by a filter over the wanted ids before Python and JSON see their lists; none that is wanted goes."""
    lines = spark.createDataFrame([(_credit(f"n{k}", k),) for k in range(3000)] + [("[],[],",), ("x",)], "value string")
    wanted = spark.range(0, 3000, 100)
    found = films.decode_credits(lines, of=wanted.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id")))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Join LeftSemi")
    rows = {row.id: [member.name for member in row.cast] for row in found.collect()}
    assert len(rows) < 100 and {k: rows[k] for k in range(0, 3000, 100)} == {k: [f"n{k}"] for k in range(0, 3000, 100)}
    assert films.decode_credits(lines, of=wanted.limit(0)).count() == 0
    assert films.decode_credits(lines, keep_rejects=True, of=wanted).count() == 3002


def test_five_answers_decode_credits_of_their_films_only(spark, tables, monkeypatch):
    asked = []
    read = films.read_credits
    monkeypatch.setattr(file_bindings.films, "read_credits", lambda *a, **k: asked.append(k.get("of")) or read(*a, **k))
    file_bindings._five(spark, tables)
    assert [of.columns for of in asked] == [["id"]]


def test_plain_lists_are_not_taken_apart(spark):
    """Pieces are looked for only where closing braces or line breaks stand in strings
    or anything else is odd; what is read is the same."""
    texts = ["[{'a': 'x', 'b': None}, {'a': \"o'b\"}]", "[{'a': 'x {y'}, {'a': 'z'}]", "[{'a': 'x }'}, {'a': 'z'}]",
             "[{'a': 1},{'a': 2}]", "[{'a': 'p\u2028q'}, {'a': '1'}]", "[{'a': 'p\u0085'}, {'a': '1'}]", "[{'a': '\r'}, {'a': '2'}]", "x{'a': 3}y", "[]", ""]
    read = literals.with_literals(spark.createDataFrame([(t,) for t in texts], "x string"), objects=["x"])
    assert "_g_x" in read._jdf.queryExecution().optimizedPlan().toString()
    got = {row.x: row._x for row in read.collect()}
    one = lambda *values: [{"a": v} for v in values]
    assert got == dict(zip(texts, [
        [{"a": "x", "b": None}, {"a": "o'b"}], one("x {y", "z"), one("z"), one("1", "2"), one("1"), one("1"), one("2"), one("3"), [], []]))


def test_numbers_with_type_letters_and_empty_texts(spark):
    texts = [None, "", " ", "1.5", "1.5d", "2F ", "1e3", "NaN", "Infinity", "d", "1d\n", " 7 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row.v for row in df.select(casts.to_double(F.col("t")).alias("v")).collect()]
    assert [str(v) for v in got] == ["None", "None", "None", "1.5", "None", "None", "1000.0", "nan", "inf", "None", "None", "7.0"]


def test_splits_of_files_are_told_apart():
    """Counts go on through batches of one split, and begin again with another split or file."""
    batch = lambda *rows: tuple(pa.array(column) for column in zip(*rows))
    batches = [batch((5, 0, True), (5, 0, False)), batch((5, 0, True), (5, 9, True)), batch((6, 9, False), (6, 9, True))]
    got = [row for part in records._running(iter(batches)) for row in part.to_pylist()]
    assert [(row["odd"], row["line"]) for row in got] == [(0, 0), (1, 1), (1, 2), (0, 0), (0, 0), (0, 1)]


# --- streams ------------------------------------------------------------------------------

def _deliver(spark, path: str, rows, schema: str):
    frame = spark.createDataFrame(rows, schema)
    frame.write.mode("append").parquet(path)
    return jobs.open_stream(spark, path, frame.schema)


def test_keys_share_entries_of_the_state(spark):
    schema = "client_id string, queue string, message_id long, at timestamp, value long"
    big, base = 2**53, datetime(2024, 1, 1)
    keys = [(f"c{k % 7}", None if k % 5 == 0 else "q", None if k == 3 else big + k) for k in range(900)]
    rows = [(*key, base + timedelta(microseconds=k), None if k % 2 else big + 1) for k, key in enumerate(keys)]
    rows.append(("c", '","', None, base, 1))  # no other than itself, whatever its texts hold
    inbox, sink, state = (scratch_path(spark, n) for n in ("inbox", "sink", "state"))
    with stateful.rocksdb(spark), _set(spark, spark_sql_shuffle_partitions="2"):
        for part in (rows[:500], rows):
            stream = _deliver(spark, inbox, part + part, schema)
            query = jobs.run_once(stateful.dedup_within(stream, 3_600_000, shards=2, buckets=4), sink, state)
    assert query.lastProgress.stateOperators[0].numRowsTotal == 8
    got = [tuple(row) for row in spark.read.parquet(sink).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


class _Entries(dict):
    """A map or value state without Spark."""

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return dict.get(self, key)

    def containsKey(self, key):
        return key in self

    def removeKey(self, key):
        del self[key]

    def update(self, value):
        self[()] = value

    def get(self):
        return dict.get(self, ())


class _Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, _Entries())

    getValueState = getListState = getMapState


def test_waiting_rows_are_held_in_pieces():
    handle, most, chunks = _Handle(), 10_000, 12
    barrier = stateful._Barrier(nodes=1)
    barrier.init(handle)

    def chunk(keys, bodies, nodes):
        return pd.DataFrame({"key": keys, "body": bodies, "node": nodes}, dtype=object)

    def probes():  # one at a time, as a worker gets them
        for n in range(chunks):
            keys = [str(k) for k in range(n * 5000, n * 5000 + 5000)]
            yield chunk(keys, [f"row {k}" for k in keys], None)

    assert list(barrier.handleInputRows(("0",), probes(), None)) == []
    entries = list(handle.states["waiting"].values())
    assert len(entries) == chunks * 5000 / most and max(len(entry[0]) for entry in entries) < 30 * most
    # the build side and its end come behind as many rows of their own batch
    build = chunk([str(k) for k in range(0, chunks * 5000, 2)], None, None)
    batch = [*probes(), build, chunk([None], [None], ["n"])]
    out = list(barrier.handleInputRows(("0",), iter(batch), None))
    assert max(map(len, out)) <= most and not handle.states["waiting"] and not handle.states["pieces"]
    want = [f"row {k}" for k in range(0, chunks * 5000, 2)]
    assert sorted(body for frame in out for body in frame["body"]) == sorted(want * 2)


def test_partners_share_entries_of_the_state(monkeypatch):
    calls = []

    class Counted(_Entries):
        def __getattribute__(self, name):
            if name in ("updateValue", "getValue", "containsKey", "removeKey"):
                calls.append(name)
            return super().__getattribute__(name)

    monkeypatch.setattr(_Handle, "getMapState", lambda self, name, *_: self.states.setdefault(name, Counted()))
    monkeypatch.setattr(stateful, "_HELD", 500, raising=False)  # waiting rows are read for some keys at a time
    barrier = stateful._Barrier(nodes=1)
    barrier.init(_Handle())

    def send(*rows):
        chunk = pd.DataFrame(list(rows), columns=["key", "body", "node"], dtype=object)
        return sorted(body for out in barrier.handleInputRows(("0",), iter([chunk]), None) for body in out["body"])

    probes = [(str(k % 4000), f"row {k}", None) for k in range(12_000)]
    assert send(*probes) == []
    assert send(*[(str(k), None, None) for k in [*range(0, 1000), *range(500, 1500)]]) == []
    assert send(*[(str(k), None, None) for k in range(1400, 2000)], (None, None, None)) == []
    assert send(("0", "late", None), ("2000", "none", None), (None, None, "n")) == sorted(
        ["late", *(body for key, body, _ in probes if int(key) < 2000)])
    assert send(("1999", "later", None), ("2000", "none", None), ("2001", None, None), ("2001", "both", None)) == [
        "both", "later"]
    assert len(calls) < 200


def test_rows_are_packed_by_group():
    schema = pa.schema([("t", pa.string()), ("shard", pa.int64()), ("key", pa.string()), ("body", pa.string())])
    rows = [("ab"[k % 2] if k % 5 else None, k % 3, f"k{k % 50}", None if k % 7 == 0 else "é" * (k % 900))
            for k in range(3000)]
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows[k:k + 700]), schema.types)], schema=schema)
        for k in range(0, 3000, 700)]
    packs = [pack for out in stateful._pack(iter([batches[0].slice(0, 0), *batches]), ["t", "shard"]) for pack in out.to_pylist()]
    got = [(p["t"], p["shard"], *pair) for p in packs for pair in zip(p["key"], p["body"], strict=True)]
    assert sorted(got, key=str) == sorted(rows, key=str) and len(packs) < len(rows) / 3
    # a packed row is full at 4000 bytes
    assert max(len("".join(map(str, p["body"][:-1])).encode()) for p in packs) < 4100


# --- decoding and words -------------------------------------------------------------------

def test_rows_read_in_the_jvm_go_to_python_as_empty_lists(spark):
    rows = [("[]",), ("[{'a': 1}]",), ("[{'a': (1, 2)}]",), ("no list",), (None,)]
    read = literals.with_literals(spark.createDataFrame(rows, "x string"), lists=["x"])
    found = {row.x: row._x for row in read.collect()}
    assert found == {"[]": [], "[{'a': 1}]": [{"a": "1"}], "[{'a': (1, 2)}]": [{"a": "[1, 2]"}], "no list": None, None: []}
    sent = read.filter("x = '[]'")._jdf.queryExecution().analyzed().toString()
    assert "THEN cast(array() as array<array<string>>)" in sent


def test_credits_are_decoded_by_many_tasks(spark, tables):
    with _set(spark, spark_sql_shuffle_partitions="3"):
        plan = bindings.decode_credits_(spark, tables)._jdf.queryExecution().sparkPlan().toString()
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert f"RoundRobinPartitioning({tasks})" in plan


def test_frequent_words_are_counted_before_the_join(spark):
    texts = spark.createDataFrame(
        [(1, "the cat " * 3000 + "the end"), (2, ""), (3, None), (1, "cat"), (4, "it's"), (None, "the")], "k long, t string")
    own = F.array_append(sentiment.tokens(F.col("t")), F.lit("\0"))
    counted = [sorted(tuple(word) for word in row[0]) for row in texts.select(sentiment._counted(own)).collect()]
    assert counted == [[("\0", 1), ("cat", 3000), ("end", 1), ("the", 3001)], [("\0", 1)], [("\0", 1)],
                       [("\0", 1), ("cat", 1)], [("\0", 1), ("it's", 1)], [("\0", 1), ("the", 1)]]
    lexicon = spark.createDataFrame([("the", 1.0), ("cat", -0.5), ("end", 0.25)], "word string, polarity double")
    got = {row.k: row.polarity for row in sentiment.polarity_by_table(texts, "k", "t", lexicon).collect()}
    assert got == {1: (3001 - 0.5 * 3001 + 0.25) / 6003, 2: 0.0, 3: 0.0, 4: 0.0, None: 1.0}
