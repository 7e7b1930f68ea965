"""Stream enrichment: each micro-batch is joined to the dimensions as they are then, and rows that found none are tried again.

Rows whose dimensions are not there yet go out with sentinels at once and wait in a pending table. The next micro-batch
(or `repair`, if nothing arrives) joins them again; the corrected row goes out under a later batch, and `latest` of the
log shows it. What waits is only what is unmatched, for `tries` batches at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.defaults import sentinel
from ..operators.dedup import latest_by_key
from ..operators.enrich import Dimension, enrich
from ..sources.shared import Files

#: Gives the dimensions anew for each micro-batch, so that changed tables are seen.
Dimensions = Callable[[], list[Dimension]]


def _missing(rows: DataFrame, required: list[str]) -> Column:
    test = F.lit(False)
    for c in required:
        test = test | (F.col(c) == sentinel(rows.schema[c].dataType))
    return test


def _last_pending(files: Files, path: str, before: str) -> str | None:
    """The newest complete pending table before a batch."""
    names = [n for n in files.folders(f"{path}/pending") if n < f"batch={before}" and files.exists(f"{path}/pending/{n}/_SUCCESS")]
    return f"{path}/pending/{names[-1]}" if names else None


def _write(spark: SparkSession, path: str, label: str, fresh: DataFrame | None, dimensions: Dimensions, required: list[str], tries: int, columns: list[str]) -> None:
    files = Files(spark)
    waiting = _last_pending(files, path, label)
    rows = fresh.withColumn("_tries", F.lit(0)) if fresh is not None else None
    if waiting:
        old = spark.read.parquet(waiting)
        rows = old if rows is None else rows.unionByName(old)
    if rows is None:
        return
    out = f"{path}/rows/batch={label}"
    enrich(rows, dimensions()).write.mode("overwrite").parquet(out)
    done = spark.read.parquet(out)  # the joins run once; what is still missing is read from their result
    again = done.where(_missing(done, required) & (F.col("_tries") + 1 < tries)).select(*columns, (F.col("_tries") + 1).alias("_tries"))
    again.write.mode("overwrite").parquet(f"{path}/pending/batch={label}")


def start(stream: DataFrame, dimensions: Dimensions, path: str, checkpoint: str, required: list[str], tries: int = 100, bounded: bool = True, seconds: int = 30) -> StreamingQuery:
    """required: output columns whose sentinel means that a dimension row was not there. A repeated batch replaces its own files."""
    columns = stream.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        _write(batch.sparkSession, path, f"{batch_id:012d}", batch, dimensions, required, tries, columns)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=f"{seconds} seconds")).start()


def repair(spark: SparkSession, path: str, dimensions: Dimensions, required: list[str], columns: list[str], tries: int = 100) -> None:
    """Join what waits once more, between batches of a stream that is stopped or idle."""
    last = [n.removeprefix("batch=") for n in Files(spark).folders(f"{path}/rows")]
    if last:
        number, _, repairs = last[-1].partition("r")
        _write(spark, path, f"{number}r{int(repairs or 0) + 1:04d}", None, dimensions, required, tries, columns)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last version of each row."""
    names = [n for n in Files(spark).folders(f"{path}/rows") if Files(spark).exists(f"{path}/rows/{n}/_SUCCESS")]
    rows = spark.read.option("basePath", f"{path}/rows").schema(f"{spark.read.parquet(f'{path}/rows/{names[-1]}')._jdf.schema().toDDL()}, batch string").parquet(*[f"{path}/rows/{n}" for n in names])
    return latest_by_key(rows, keys, ["batch", "_tries"]).drop("batch", "_tries")
