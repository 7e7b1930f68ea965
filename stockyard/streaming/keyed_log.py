"""Continuous results by key: aggregates without windows, kept as a log of changed rows and read as the latest per key.

A stream's update mode gives the rows that a micro-batch changed. They are appended under the batch's number, so a batch
that runs again replaces its own rows only and none rewrites the table. `latest` takes each key's last row; `compact`
turns the log so far into a base, behind a pointer file that is moved when the base is complete.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.dedup import latest_by_key
from ..operators.masters import uom_pivot
from ..sources.shared import Files


def pivot(rows: DataFrame, key: str, level: str, attributes: list[str], levels: tuple, created: str, updated: str, active: Column | None = None) -> DataFrame:
    """The units-of-measure pivot of a stream (or a batch): a group-by without windows, with first creation and last update."""
    times = F.min(created).alias("created_at"), F.max(updated).alias("updated_at")
    return uom_pivot(rows, key, level, attributes, levels, active, times)


def append(changes: DataFrame, path: str, checkpoint: str, bounded: bool = True, seconds: int = 30, mode: str = "update", single: bool = False) -> StreamingQuery:
    """Write what each micro-batch changes. bounded: stop when the input so far is read; a later start goes on from there.

    single: the input so far is one batch. State with a time to live always asks for another batch, so a bounded query
    over such state ends only this way.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id:012d}")

    writer = changes.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if single:
        return writer.trigger(once=True).start()
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=f"{seconds} seconds")).start()


def _base(files: Files, path: str) -> dict:
    return json.loads(files.text(f"{path}/base.json") or '{"run": null, "upto": ""}')


def _rows(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Base and log as one table with `_batch`, and the last batch that it holds."""
    files = Files(spark)
    base = _base(files, path)
    batches = [n for n in (b.removeprefix("batch=") for b in files.folders(f"{path}/log")) if n > base["upto"] and files.exists(f"{path}/log/batch={n}/_SUCCESS")]
    found = [spark.read.parquet(f"{path}/base/{base['run']}")] if base["run"] else []
    if batches:
        log = spark.read.option("basePath", f"{path}/log").parquet(*[f"{path}/log/batch={n}" for n in batches])
        found.append(log.withColumn("_batch", F.col("batch").cast("bigint")).drop("batch"))
    if not found:
        raise ValueError(f"{path} holds nothing yet")
    return (found[0] if len(found) == 1 else found[0].unionByName(found[1])), batches[-1] if batches else base["upto"]


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last row of each key."""
    return latest_by_key(_rows(spark, path)[0], keys, ["_batch"]).drop("_batch")


def compact(spark: SparkSession, path: str, keys: list[str]) -> None:
    """Make a base of all batches so far and delete them. Readers see the old state or the new one, as the pointer says."""
    files, run = Files(spark), uuid.uuid4().hex
    old = _base(files, path)
    rows, upto = _rows(spark, path)
    latest_by_key(rows, keys, ["_batch"]).write.parquet(f"{path}/base/{run}")
    files.create(f"{path}/base.json", json.dumps({"run": run, "upto": upto}), overwrite=True)
    for name in files.folders(f"{path}/log"):
        if name.removeprefix("batch=") <= upto:
            files.delete(f"{path}/log/{name}")
    if old["run"]:
        files.delete(f"{path}/base/{old['run']}")
