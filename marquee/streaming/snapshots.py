"""A table of current rows behind an updating stream, compacted and safe against replay.

Each micro-batch writes its changed rows to a folder, then a marker that names all folders
which together are the table.  A reader takes the newest marker, so it never sees half an
epoch.  When ``most_pending`` change folders have gathered, the next epoch first folds them
into a new base, so what a reader goes through is the table and a few batches, however long
the stream has run.

A replayed batch starts from the marker of the batch before it and writes its folders again.
Markers carry the run, which is Spark's query id and lives in the checkpoint: a stream that
has lost its checkpoint reads its input anew under another id.  Such a run is ordered behind
all runs that left markers, so the higher batch numbers of an older run can't win, and folders
that no marker of the newest run names are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_MARKER = "run_order long, run string, batch long, base string, base_epoch long, pending array<string>"
_EPOCH = "_epoch"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _markers(spark: SparkSession, path: str):
    """All markers, newest first.  There are at most a few: old ones are deleted."""
    place, files = _files(spark, f"{path}/markers")
    if not files.exists(place):
        return []
    rows = spark.read.schema(_MARKER).json(f"{path}/markers/*").collect()
    return sorted(rows, key=lambda r: (r["run_order"], r["batch"]), reverse=True)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _table(spark: SparkSession, path: str, marker, schema, keys: Sequence[str]) -> DataFrame:
    """Current rows by a marker: the base, with later changes over it."""
    folders = [f for f in (marker["base"], *marker["pending"]) if f]
    parts = [spark.read.schema(schema).parquet(f"{path}/{f}").withColumn(_EPOCH, F.lit(k))
             for k, f in enumerate(folders)]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    if len(parts) == 1:
        return rows.drop(_EPOCH)
    others = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), _EPOCH).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c)
                           for c in rows.columns if c != _EPOCH])


def save_epoch(rows: DataFrame, batch: int, path: str, checkpoint: str, keys: Sequence[str],
               most_pending: int = 1) -> None:
    """Add the changed rows of one micro-batch.  ``keys`` are unique within a batch."""
    spark = rows.sparkSession
    run, markers = _query_id(spark, checkpoint), _markers(spark, path)
    own = [m for m in markers if m["run"] == run]
    order = own[0]["run_order"] if own else (markers[0]["run_order"] + 1 if markers else 0)
    before = next((m for m in own if m["batch"] < batch), None)
    folder = f"run-{order:06d}/{batch:012d}"
    rows.write.mode("overwrite").parquet(f"{path}/{folder}/changes")

    base, pending = (before["base"], list(before["pending"])) if before else (None, [])
    if before and len(pending) >= most_pending:
        base = f"{folder}/base"
        _table(spark, path, before, rows.schema, keys).write.mode("overwrite").parquet(f"{path}/{base}")
        pending = []
    marker = spark.createDataFrame(
        [(order, run, batch, base, batch, [*pending, f"{folder}/changes"])], _MARKER).coalesce(1)
    marker.write.mode("overwrite").json(f"{path}/markers/{order:06d}-{batch:012d}")
    _clean(spark, path, order, batch, before)


def _clean(spark: SparkSession, path: str, order: int, batch: int, before) -> None:
    """Delete what neither this epoch nor the one before it (needed for a replay) names."""
    kept = [m for m in _markers(spark, path) if m["run_order"] == order
            and m["batch"] in (batch, before["batch"] if before else batch)]
    named = {f for m in kept for f in (m["base"], *m["pending"]) if f}
    place, files = _files(spark, path)
    for run in files.listStatus(place):
        name = run.getPath().getName()
        if name == "markers":
            good = {f"{m['run_order']:06d}-{m['batch']:012d}" for m in kept}
            for entry in files.listStatus(run.getPath()):
                if entry.getPath().getName() not in good:
                    files.delete(entry.getPath(), True)
        elif name.startswith("run-"):
            for epoch in files.listStatus(run.getPath()):
                for part in files.listStatus(epoch.getPath()):
                    if f"{name}/{epoch.getPath().getName()}/{part.getPath().getName()}" not in named:
                        files.delete(part.getPath(), True)


def run_snapshots(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
                  most_pending: int = 1) -> StreamingQuery:
    """Process everything available of a stream in update mode into the table at ``path``."""
    query = (
        stream.writeStream.outputMode("update").foreachBatch(
            lambda rows, batch: save_epoch(rows, batch, path, checkpoint, keys, most_pending))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def current(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """The current row of each key; no rows before the first epoch."""
    markers = _markers(spark, path)
    if not markers:
        return spark.createDataFrame([], schema)
    return _table(spark, path, markers[0], schema, keys)


def folders_read(spark: SparkSession, path: str) -> list[str]:
    """The folders that ``current`` reads."""
    markers = _markers(spark, path)
    return [f for f in (markers[0]["base"], *markers[0]["pending"]) if f] if markers else []
