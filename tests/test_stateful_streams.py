"""Streams with state of their own: forgetting, completeness, barriers, compacted sinks.

The queries over the tables are compared with SQL in test_oracle.
"""

from __future__ import annotations

import shutil
import time

import pytest
from pyspark.sql import functions as F

from marquee.session import scratch_path
from marquee.streaming import jobs, snapshots, stateful


@pytest.fixture(autouse=True, scope="module")
def few_state_stores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Box:
    """A folder that rows are delivered to, and the stream over it."""

    def __init__(self, spark, schema: str):
        self.spark, self.schema, self.path = spark, schema, scratch_path(spark, "box")

    def deliver(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.path)
        return jobs.open_stream(self.spark, self.path, self.spark.createDataFrame([], self.schema).schema)


def _rows(spark, path, schema):
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())


# --- duplicates with a time to live -------------------------------------------------------

def test_keys_are_forgotten(spark):
    box = Box(spark, "client_id string, queue string, message_id long, sent string")
    sink, state = scratch_path(spark, "sink"), scratch_path(spark, "state")

    def run(*rows):
        with stateful.rocksdb(spark):
            query = jobs.run_once(stateful.dedup_within(box.deliver(*rows), span_ms=6000), sink, state)
        kept = query.lastProgress.stateOperators[0].numRowsTotal
        return sorted(r["sent"] for r in spark.read.parquet(sink).collect()), kept

    got, kept = run(("a", "q", 1, "new"), ("a", "q", 1, "new"), ("b", "q", 1, "other"), (None, "q", 1, "null"))
    assert got == ["new", "null", "other"] and kept == 3
    time.sleep(8)
    # forgotten: what comes again counts as new, and only its key is held
    got, kept = run(("a", "q", 1, "after the span"))
    assert got == ["after the span", "new", "null", "other"] and kept <= 2


# --- totals on completion -----------------------------------------------------------------

def _totals(spark, records, ends, nodes, most, sink, state, shards=3):
    out = stateful.totals_on_completion(records, ends, nodes, most, shards)
    with stateful.rocksdb(spark):
        jobs.run_to_files(out, sink, state)
    got = stateful.largest(spark.read.schema(out.schema).parquet(sink), most)
    return sorted(tuple(r) for r in got.collect())


def test_only_finished_clients_are_answered(spark):
    records, ends = Box(spark, "client_id string, item string, amount long"), Box(spark, "client_id string, node string")
    sink, state = scratch_path(spark, "sink"), scratch_path(spark, "state")
    run = lambda r, e: _totals(spark, records.deliver(*r), ends.deliver(*e), 2, 2, sink, state)
    # a repeated marker isn't a second node
    assert run([("a", "x", 5), ("a", "y", 5), ("b", "x", 1), ("a", None, 9), (None, "x", 9)],
               [("a", "n1"), ("a", "n1"), ("b", "n1"), (None, "n1"), ("b", None)]) == []
    # the last marker comes in the same batch as its node's last records
    assert run([("a", "x", 1), ("a", "z", 5), ("b", "x", 2)], [("a", "n2")]) == [("a", "x", 6, 2), ("a", "y", 5, 1)]
    # what follows the answer changes nothing; another client's answer is not held up
    assert run([("a", "z", 100), ("b", "w", 3)], [("a", "n2"), ("b", "n2")]) == [
        ("a", "x", 6, 2), ("a", "y", 5, 1), ("b", "w", 3, 1), ("b", "x", 3, 2)]


def test_hot_client_and_no_records(spark):
    records, ends = Box(spark, "client_id string, item string, amount long"), Box(spark, "client_id string, node string")
    rows = [("hot", f"i{k % 50}", k) for k in range(3000)]
    want = sorted(((-sum(k for k in range(3000) if k % 50 == i), f"i{i}") for i in range(50)))[:4]
    got = _totals(spark, records.deliver(*rows), ends.deliver(("hot", "n"), ("idle", "n")), 1, 4,
                  scratch_path(spark, "sink"), scratch_path(spark, "state"), shards=8)
    assert [(i, t) for _, i, t, _ in sorted(got, key=lambda r: (-r[2], r[1]))] == [(i, -t) for t, i in want]


# --- build barrier ------------------------------------------------------------------------

def test_probe_rows_wait_for_the_build_side(spark):
    probe = Box(spark, "tenant string, id long, cast array<string>")
    build, ends = Box(spark, "tenant string, id long, title string"), Box(spark, "tenant string, node string")
    sink, state = scratch_path(spark, "sink"), scratch_path(spark, "state")

    def run(p, b, e):
        joined = stateful.join_behind_barrier(
            probe.deliver(*p), build.deliver(*b), ends.deliver(*e), nodes=2, by=["tenant"], shards=3)
        assert joined.columns == ["tenant", "id", "cast"]
        with stateful.rocksdb(spark):
            jobs.run_to_files(joined, sink, state)
        return sorted((r["tenant"], r["id"], r["cast"]) for r in spark.read.schema(joined.schema).parquet(sink).collect())

    assert run([("a", 1, ["x", None]), ("a", 2, []), ("a", 1, ["x", None]), ("e", 1, ["q"]), ("a", None, ["n"])],
               [("b", 1, "t")], [("a", "n1")]) == []
    # the second marker frees those that wait; tenant e has a film side without films
    first = [("a", 1, ["x", None]), ("a", 1, ["x", None])]
    assert run([("b", 1, ["w"])], [("a", 1, "t"), ("a", 1, "u")], [("a", "n2"), ("e", "n1"), ("e", "n2")]) == first
    # behind the barrier rows pass or go at once; tenant b still waits for its end
    late = sorted([*first, ("a", 1, ["late"])])
    assert run([("a", 1, ["late"]), ("a", 3, ["no"])], [], [("b", "n1"), ("b", "n1")]) == late
    assert ("b", 1, ["w"]) in run([], [], [("b", "n2")])


# --- compacted sink -----------------------------------------------------------------------

@pytest.fixture
def totals(spark):
    """Runs running totals per key over deliveries; gives the current rows."""
    box = Box(spark, "k string, v long")
    path = scratch_path(spark, "table")
    state = [scratch_path(spark, "state")]

    def run(*rows, most_pending=1):
        stream = box.deliver(*rows).groupBy("k").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
        snapshots.run_snapshots(stream, path, state[0], ["k"], most_pending)
        return {r["k"]: (r["total"], r["n"]) for r in snapshots.current(spark, path, stream.schema, ["k"]).collect()}

    run.path, run.state = path, state
    return run


@pytest.mark.parametrize("most_pending", [1, 3])
def test_sink_is_compacted(spark, totals, most_pending):
    want: dict = {}
    for step in range(6):
        rows = [("hot", step), (f"k{step % 4}", 1), (None, 2)]
        for k, v in rows:
            total, n = want.get(k, (0, 0))
            want[k] = (total + v, n + 1)
        assert totals(*rows, most_pending=most_pending) == want
        read = [spark.read.parquet(f"{totals.path}/{f}").count() for f in snapshots.folders_read(spark, totals.path)]
        assert sum(read) <= len(want) + 3 * most_pending
    assert len(list(snapshots._markers(spark, totals.path))) <= 2


def test_lost_checkpoint_starts_anew(spark, totals):
    for step in range(4):
        totals(("a", 1), ("gone", 1))
    shutil.rmtree(totals.state[0])
    # all five deliveries are read again under a new run; its batch number is 0
    assert totals(("a", 1)) == {"a": (5, 5), "gone": (4, 4)}
    assert {m["run_order"] for m in snapshots._markers(spark, totals.path)} == {1}
    assert totals(("a", 1)) == {"a": (6, 6), "gone": (4, 4)}


def test_replayed_batch_is_the_same(spark, totals):
    totals(("a", 1))
    totals(("a", 2), ("b", 1))
    before = snapshots._markers(spark, totals.path)
    again = spark.createDataFrame([("a", 3, 2), ("b", 1, 1)], "k string, total long, n long")
    for _ in range(2):
        snapshots.save_epoch(again, before[0]["batch"], totals.path, totals.state[0], ["k"])
    assert totals(("b", 1)) == {"a": (3, 2), "b": (2, 2)}


def test_nothing_saved_yet(spark):
    assert snapshots.current(spark, scratch_path(spark, "none"), "k string", ["k"]).count() == 0
    assert snapshots.folders_read(spark, scratch_path(spark, "none")) == []
