"""Stateful streams that a built-in operator can't express.

Each is one processor of ``transformWithState``: state is kept by key in RocksDB, so it
may be larger than an executor's memory, and is saved with the stream's checkpoint.  Start
the queries inside ``rocksdb(spark)`` or with that provider set for the session.

What all rows of a client have to wait for (end markers) is sent to every part of the
client's state, so a client with a third of all rows is spread over ``shards`` keys.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from marquee.operators import ranking
from marquee.operators.dedup import MESSAGE_KEYS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting is back afterwards."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


# --- duplicates -------------------------------------------------------------------------

#: Rows that are held at a time, so that a key with many rows needs no more memory.
_ROWS = 10_000
_CHARS = 4_000_000


def _pieces(rows: Iterator[Row]) -> Iterator[list[Row]]:
    while piece := list(islice(rows, _ROWS)):
        yield piece


class _FirstDelivery(StatefulProcessor):
    """Lets the first row of a key through and remembers the key for a time span.

    The keys of a bucket are one entry of the state, with the time of their last delivery.
    """

    def __init__(self, span_ms: int, columns: Sequence[str]):
        self.span_ms, self.columns = span_ms, list(columns)

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "bucket int", "keys string", self.span_ms)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[Row]:
        now, whole = timer_values.getCurrentProcessingTimeInMs(), Row(*self.columns)
        for piece in _pieces(rows):
            buckets: dict[int, dict[str, Row]] = defaultdict(dict)
            for row in piece:
                buckets[row["_bucket"]].setdefault(row["_key"], row)
            for bucket, firsts in buckets.items():
                held = self.seen.getValue((bucket,))
                times = json.loads(held[0]) if held else {}
                times = {name: time for name, time in times.items() if time + self.span_ms > now}
                for name, row in firsts.items():
                    if name not in times:
                        yield whole(*row[:len(self.columns)])
                    times[name] = now  # a delivery of any kind starts the span anew
                self.seen.updateValue((bucket,), (json.dumps(times),))

    def close(self) -> None:
        pass


def dedup_within(messages: DataFrame, span_ms: int, keys: Sequence[str] = MESSAGE_KEYS,
                 shards: int = 4096, buckets: int = 64) -> DataFrame:
    """One row per message; a key is forgotten ``span_ms`` after its last delivery.

    No event time is involved: a first delivery comes through however late it is, and a
    repeat is told from it as long as it follows within the span.  A message that comes
    again after that is taken for a new one.  Give the stream a processing-time trigger (or
    ``run_once``): it has no end, as forgetting needs batches without input.

    A call of Python for every key, and a question to the state for each, would take
    milliseconds a key.  Keys are dealt to ``shards`` calls, and each to ``buckets`` entries of the
    state, which are read and written whole: a batch touches no more of them than it has keys,
    and they hold a few hundred keys at a hundred million in all.
    """
    hashed = F.xxhash64(*keys)
    named = F.to_json(F.struct(*keys), {  # null fields too, and times to the microsecond
        "ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    dealt = messages.select(
        *messages.columns, named.alias("_key"), F.pmod(hashed, F.lit(shards)).alias("_shard"),
        F.pmod(F.shiftright(hashed, 32), F.lit(buckets)).cast("int").alias("_bucket"))
    return dealt.groupBy("_shard").transformWithState(
        _FirstDelivery(span_ms, messages.columns), messages.schema, "append", "processingTime")


# --- a question per client, answered when it is complete --------------------------------

_TAGGED = "client_id string, item string, amount long, n long, node string"


class _TotalsUntilComplete(StatefulProcessor):
    """Sums per item; the largest come out, and the sums go, when all nodes have ended."""

    def __init__(self, nodes: int, most: int):
        self.nodes, self.most = nodes, most

    def init(self, handle) -> None:
        self.totals = handle.getMapState("totals", "item string", "total long, n long")
        self.ended = handle.getMapState("ended", "node string", "seen boolean")
        self.done = handle.getValueState("done", "done boolean")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        done, ended, sums = self.done.exists(), set(), defaultdict(lambda: [0, 0])
        for chunk in rows:
            if done:
                continue  # rows after the last end marker belong to no answer
            ended.update(chunk["node"].dropna().unique())
            records = chunk[chunk["item"].notna()]
            for item, total, n in records.groupby("item")[["amount", "n"]].sum().itertuples():
                sums[item][0] += int(total)
                sums[item][1] += int(n)
        if done:
            return
        for node in ended:
            self.ended.updateValue((node,), (True,))
        complete = sum(1 for _ in self.ended.keys()) >= self.nodes
        for item, (total, n) in sums.items():
            if self.totals.containsKey((item,)):
                old = self.totals.getValue((item,))
                total, n = total + old[0], n + old[1]
            self.totals.updateValue((item,), (total, n))
        if complete:
            best = sorted((-value[0], item[0], value[1]) for item, value in self.totals.iterator())[:self.most]
            self.totals.clear()
            self.ended.clear()
            self.done.update((True,))
            if best:
                yield pd.DataFrame({
                    "client_id": key[0], "item": [item for _, item, _ in best],
                    "total": [-total for total, _, _ in best], "n": [n for _, _, n in best]})

    def close(self) -> None:
        pass


def _sum_by_task(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial sums before the shuffle; end markers pass, once a chunk."""
    for chunk in chunks:
        marks = chunk["node"].notna()
        records = chunk[~marks & chunk["item"].notna()].groupby(
            ["client_id", "shard", "item"], as_index=False)[["amount", "n"]].sum()
        ends = chunk.loc[marks, ["client_id", "shard", "node"]].drop_duplicates()
        for part in (records.assign(node=None), ends.assign(item=None, amount=0, n=0)):
            if len(part):
                yield part[["client_id", "shard", "item", "amount", "n", "node"]]


def largest(totals: DataFrame, most: int) -> DataFrame:
    """A client's ``most`` largest of what ``totals_on_completion`` left in its sink."""
    return ranking.top_k_by(totals, most, ["client_id"], F.desc("total"), F.asc("item"))


def totals_on_completion(records: DataFrame, ends: DataFrame, nodes: int, most: int,
                         shards: int = 8) -> DataFrame:
    """``client_id, item, total, n`` of a client's largest totals once all its nodes have ended.

    ``records`` are ``client_id, item, amount``, a stream that has passed whatever filters the
    question has; ``ends`` are ``client_id, node``, of ``nodes`` distinct nodes, each behind
    its node's last record.  Records without an item or a client are left out.  The totals of
    a client are spread over ``shards`` keys, of which each gives its ``most`` largest (ties:
    smallest item); ``largest`` takes the client's from these.  A client without all end
    markers gives nothing yet.  Repeated markers count once; what comes after the last
    marker is ignored; a finished client keeps one flag a shard and no totals.
    """
    shard = F.pmod(F.xxhash64("item"), F.lit(shards))
    rows = records.where("client_id IS NOT NULL AND item IS NOT NULL").select(
        F.col("client_id").cast("string"), shard.alias("shard"), F.col("item").cast("string"),
        F.col("amount").cast("long"), F.lit(1).cast("long").alias("n"), F.lit(None).cast("string").alias("node"))
    marks = ends.where("client_id IS NOT NULL AND node IS NOT NULL").select(
        F.col("client_id").cast("string"), _every(shards).alias("shard"), F.lit(None).cast("string").alias("item"),
        F.lit(0).cast("long").alias("amount"), F.lit(0).cast("long").alias("n"), F.col("node").cast("string"))
    both = rows.unionByName(marks)
    return (both.mapInPandas(_sum_by_task, both.schema).groupBy("client_id", "shard")
            .transformWithStateInPandas(_TotalsUntilComplete(nodes, most),
                                        "client_id string, item string, total long, n long", "append", "none"))


def _every(shards: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))


# --- a join that waits for its build side -----------------------------------------------

#: Keys of a build side that are held at a time, and entries of the state that a shard's are dealt to.
_HELD = 250_000
_BUCKETS = 16
#: Bytes of keys and bodies in a packed row: ten thousand of them go to a worker in one batch.
_PACK = 4_000


def _bucket(key: str) -> int:
    return crc32(key.encode("utf-8", "surrogatepass")) % _BUCKETS


class _Barrier(StatefulProcessor):
    """Probe rows wait until the build side has ended, then those with a partner come out.

    Rows wait as pieces of bounded length, one entry of the state each, and so do those of a
    batch that are too many to be held until the batch's last end marker and partner are known.
    Keys of the build side share few entries as well, as a question to the state for every key
    would take most of the time.
    """

    def __init__(self, nodes: int):
        self.nodes = nodes

    def init(self, handle) -> None:
        self.build = handle.getMapState("build", "bucket int", "keys string")
        self.ended = handle.getMapState("ended", "node string", "seen boolean")
        self.waiting = handle.getMapState("waiting", "piece long", "probes string")
        self.pieces = handle.getValueState("pieces", "n long")

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        found = self.pieces.get()
        before = pieces = found[0] if found else 0
        partners: set[str] = set()
        probes: list[tuple[str, str]] = []
        size = chars = 0
        for chunk in rows:
            for node in chunk["node"].dropna().unique():
                self.ended.updateValue((node,), (True,))
            for keys, bodies in self._unpacked(chunk):
                if bodies is None:
                    partners.update(keys)
                    chars += sum(map(len, keys))
                    if len(partners) >= _HELD or chars >= _CHARS:
                        self._add(partners)
                        partners, chars = set(), 0
                    continue
                for pair in zip(keys, bodies):
                    probes.append(pair)
                    size += len(pair[0]) + len(pair[1])
                    if len(probes) >= _ROWS or size >= _CHARS:
                        self.waiting.updateValue((pieces,), (json.dumps(probes),))
                        probes, size, pieces = [], 0, pieces + 1
        self._add(partners)
        if sum(1 for _ in self.ended.keys()) < self.nodes:
            if probes:
                self.waiting.updateValue((pieces,), (json.dumps(probes),))
                pieces += 1
            if pieces > before:
                self.pieces.update((pieces,))
            return
        for held in self._partners(range(_BUCKETS) if pieces else {_bucket(partner) for partner, _ in probes}):
            yield from self._met(probes, held)
            for piece in range(pieces):
                yield from self._met(json.loads(self.waiting.getValue((piece,))[0]), held)
        for piece in range(pieces):
            self.waiting.removeKey((piece,))
        if before:
            self.pieces.clear()

    def _unpacked(self, chunk: pd.DataFrame) -> Iterator[tuple[Sequence[str], Sequence[str] | None]]:
        """Keys of the build side, beside None, and keys and bodies of probe rows."""
        probe = chunk["body"].notna()
        yield chunk.loc[~probe, "key"].dropna(), None
        yield chunk.loc[probe, "key"], chunk.loc[probe, "body"]

    def _add(self, partners: set[str]) -> None:
        buckets: dict[int, set[str]] = defaultdict(set)
        for partner in partners:
            buckets[_bucket(partner)].add(partner)
        for bucket, new in buckets.items():
            held = self.build.getValue((bucket,))
            old = json.loads(held[0]) if held else []
            new.difference_update(old)
            if new:
                self.build.updateValue((bucket,), (json.dumps([*old, *new]),))

    def _partners(self, buckets: Iterable[int]) -> Iterator[set[str]]:
        """The build side's keys in these buckets, no key twice, so many at a time as may be held."""
        held: set[str] = set()
        chars = 0
        for bucket in buckets:
            found = self.build.getValue((bucket,))
            if found:
                held.update(json.loads(found[0]))
                chars += len(found[0])
            if len(held) >= _HELD or chars >= 4 * _CHARS:
                yield held
                held, chars = set(), 0
        if held:
            yield held

    def _met(self, probes: Sequence[Sequence[str]], held: set[str]) -> Iterator[pd.DataFrame]:
        out = [body for partner, body in probes if partner in held]
        if out:
            yield pd.DataFrame({"body": out})

    def close(self) -> None:
        pass


class _PackedBarrier(_Barrier):
    """The same for rows of ``_pack``: lists of keys and bodies."""

    def _unpacked(self, chunk: pd.DataFrame) -> Iterator[tuple[Sequence[str], Sequence[str] | None]]:
        for keys, bodies, built in zip(chunk["key"], chunk["body"], chunk["built"]):
            yield keys, None if built else bodies


def _pack(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """One row for some of equal ``by``, with their keys and bodies as lists: Spark makes a Python
    object of every row that it hands to a processor."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= 2 * _CHARS:
            yield _packed(held, by)
            held = []
    if held:
        yield _packed(held, by)


def _packed(batches: list[pa.RecordBatch], by: Sequence[str]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    group = np.zeros(len(rows), np.int64)
    for name in by:  # numbers that are equal where all columns so far are; 0 is null
        codes = rows[name].chunk(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1
        group = np.unique(group * (codes.max() + 1) + codes, return_inverse=True)[1]
    order = np.argsort(group, kind="stable")
    rows, group = rows.take(order).combine_chunks(), group[order]
    size = sum(pc.binary_length(rows[name].chunk(0)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
               for name in ("key", "body"))
    ahead = np.cumsum(size) - size
    ahead -= ahead[np.searchsorted(group, group)]  # bytes of the group's earlier rows
    starts = np.flatnonzero(np.diff(group, prepend=-1) | np.diff(ahead // _PACK, prepend=0))
    stops = pa.array(np.append(starts, len(order)), pa.int32())
    lists = {name: pa.ListArray.from_arrays(stops, rows[name].chunk(0)) for name in ("key", "body")}
    return pa.RecordBatch.from_arrays(
        [*(rows[name].chunk(0).take(pa.array(starts)) for name in by), *lists.values()], names=[*by, *lists])


def join_behind_barrier(probe: DataFrame, build: DataFrame, ends: DataFrame, nodes: int,
                        key: str = "id", by: Sequence[str] = (), shards: int = 64) -> DataFrame:
    """Rows of the stream ``probe`` whose ``key`` the stream ``build`` has, columns unchanged.

    Rows may come in any order: probe rows wait until ``ends`` (the columns ``by`` and
    ``node``) has told of ``nodes`` distinct nodes that the build side is whole; from then
    on they pass or go at once.  An ended build side without rows lets none pass, one that
    has not ended keeps all waiting.  With ``by`` every tenant has a barrier of its own.
    Null keys have no partner.  Keys are dealt to ``shards`` parts, each of which is told of
    every end marker; waiting rows are kept in RocksDB, and are read again for every 250,000
    keys that a part's build side has.
    """
    def tagged(rows: DataFrame, body: Column, built: bool) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).select(
            *by, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).alias("shard"),
            F.lit(built).alias("built"), F.col(key).cast("string").alias("key"), body.cast("string").alias("body"))

    rows = (tagged(probe, F.to_json(F.struct(*probe.columns)), False)
            .unionByName(tagged(build, F.lit(None), True)))
    same = [*by, "shard", "built"]
    texts = T.ArrayType(T.StringType())
    packed = T.StructType([rows.schema[name] for name in same]).add("key", texts).add("body", texts)
    none = F.array().cast(texts)
    marks = ends.select(*by, _every(shards).alias("shard"), F.lit(False).alias("built"),
                        none.alias("key"), none.alias("body"), F.col("node").cast("string").alias("node"))
    rows = (rows.mapInArrow(lambda batches: _pack(batches, same), packed)
            .withColumn("node", F.lit(None).cast("string")).unionByName(marks))
    joined = rows.groupBy(*by, "shard").transformWithStateInPandas(
        _PackedBarrier(nodes), "body string", "append", "none")
    return joined.select(F.from_json("body", probe.schema).alias("row")).select("row.*")
