"""What tables take on disk: rows, bytes and compression per column, from the footers of their files.

Footers are read in tasks, some files to each; only names and sizes go over the driver's plan. A store that pyarrow can
open is read at the files' ends; any other is read by Spark, whole files at a time.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS = "file string, row_group int, column string, codec string, n_values long, n_nulls long, compressed long, uncompressed long"
#: Schemes that pyarrow opens by itself.
OPENED = ("file", "s3", "gs", "gcs", "hdfs")


def _chunks(name: str, source) -> list[tuple]:
    import pyarrow.parquet as pq

    meta = pq.read_metadata(source)
    rows = []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            x = group.column(c)
            known = x.statistics is not None and x.statistics.has_null_count
            rows.append((name, g, x.path_in_schema, x.compression, x.num_values, x.statistics.null_count if known else None, x.total_compressed_size, x.total_uncompressed_size))
    return rows


def footers(spark: SparkSession, path: str, files_per_task: int = 64) -> DataFrame:
    """One row per file, row group and column."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    first = files.select("path").first()
    scheme = first["path"].partition(":")[0] if first else "file"
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            rows = []
            for name in batch["path"]:
                store, at = FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                with store.open_input_file(at) as source:
                    rows += _chunks(name, source)
            yield pd.DataFrame(rows, columns=names)

    def given(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame(_chunks(name, io.BytesIO(content)), columns=names)

    if scheme in OPENED:
        tasks = max(1, -(-files.select("path").count() // files_per_task))
        return files.select("path").repartition(tasks, "path").mapInPandas(opened, CHUNKS)
    return files.select("path", "content").mapInPandas(given, CHUNKS)


def usage(chunks: DataFrame, *by: str) -> DataFrame:
    """Per column (or what `by` says): files, values, nulls, bytes and the ratio of compression."""
    ratio = F.round(F.sum("uncompressed") / F.sum("compressed"), 2)
    return chunks.groupBy(*(by or ("column",))).agg(
        F.count_distinct("file").alias("n_files"), F.sum("n_values").alias("n_values"), F.sum("n_nulls").alias("n_nulls"), F.sum("compressed").alias("compressed"), F.sum("uncompressed").alias("uncompressed"), ratio.alias("ratio")
    )
