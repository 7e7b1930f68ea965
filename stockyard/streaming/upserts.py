"""Structured Streaming: keyed upserts, stream-static enrichment, windowed and continuous aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedup import latest_by_key
from ..sources.tables import as_json_lines, merge_by_month, split_rejects, without_cdc_columns, write_tsv


def change_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """A topic kept as Parquet files, read from its first file on."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def upsert_by_month(stream: DataFrame, path: str, keys: list[str], version: list[Column | str], ts: str, checkpoint: str, required: list[str] | None = None, quarantine: str | None = None, bounded: bool = True) -> StreamingQuery:
    """Keep the latest row per key in a month-partitioned table; rows without required columns go to quarantine.

    A batch that is run again merges to the same table, so the sink is idempotent.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_rejects(without_cdc_columns(batch), required or keys)
        if quarantine:
            bad.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        merge_by_month(batch.sparkSession, path, good, keys, version, ts)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime="30 seconds")).start()


def enriched_stream(stream: DataFrame, enrich: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, bounded: bool = True) -> StreamingQuery:
    """Insert-time enrichment: each batch is joined to the dimensions as they are then. A repeated batch replaces its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime="30 seconds")).start()


def route(stream: DataFrame, topic: str, sinks: dict[str, str], checkpoint: str, rest: str) -> StreamingQuery:
    """One stream to a table per topic; unknown topics go to `rest`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, path in sinks.items():
            batch.where(F.col(topic) == name).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.where(~F.coalesce(F.col(topic).isin(list(sinks)), F.lit(False))).write.mode("overwrite").parquet(f"{rest}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def text_sink(stream: DataFrame, path: str, checkpoint: str, kind: str = "json", bounded: bool = True) -> StreamingQuery:
    """Rows as JSON lines or tab-separated values, in a folder per micro-batch that a repeated batch replaces."""
    if kind not in ("json", "tsv"):
        raise ValueError(f"no text sink of kind {kind}")

    def write(batch: DataFrame, batch_id: int) -> None:
        to = f"{path}/batch={batch_id:012d}"
        if kind == "json":
            as_json_lines(batch).write.mode("overwrite").text(to)
        else:
            write_tsv(batch, to)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime="30 seconds")).start()


def tumbling(events: DataFrame, ts: str, keys: list[str], width: str, aggregates: list[Column], late: str | None = None) -> DataFrame:
    """Aggregates per window and key, for a stream (with a watermark) or a batch."""
    df = events.withColumn("_t", F.col(ts).cast("timestamp"))
    if late:
        df = df.withWatermark("_t", late)
    out = df.groupBy(F.window("_t", width).alias("_w"), *keys).agg(*aggregates)
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), F.col("_w.end").cast("timestamp_ntz").alias("window_end"), *[c for c in out.columns if c != "_w"])


def latest_view(stream: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Continuous latest row per key (update mode)."""
    return latest_by_key(stream, keys, version)


def pause(query: StreamingQuery) -> None:
    """Stop after the batch under way; a query started with the same checkpoint goes on from there."""
    query.processAllAvailable()
    query.stop()


def running(spark: SparkSession) -> DataFrame:
    """The session's streaming queries, by name."""
    rows = [(q.name or "", str(q.id), q.isActive, (q.lastProgress or {}).get("batchId")) for q in spark.streams.active]
    return spark.createDataFrame(rows, "name string, id string, active boolean, batch bigint")
