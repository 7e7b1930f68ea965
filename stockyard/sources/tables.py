"""Tables as Parquet: month partitions, upserts without MERGE, compaction, quarantine and text sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import year_month
from ..operators.dedup import latest_by_key
from .shared import Files

#: Columns that change-data capture adds.
CDC_COLUMNS = ("__op", "__source_ts_ms", "__deleted", "__source_snapshot")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_by_month(df: DataFrame, path: str, ts: str, sort: list[str], mode: str = "append") -> None:
    """Partition by month of ts; rows sorted inside files, so that row-group statistics serve as a sparse index."""
    out = df.withColumn("ym", year_month(F.col(ts)))
    out.repartition("ym", *sort[:1]).sortWithinPartitions("ym", *sort).write.mode(mode).partitionBy("ym").option("compression", "zstd").parquet(path)


def read_by_month(spark: SparkSession, path: str, ts: str, since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
    """Rows with since < ts <= until; the month bounds prune partitions, which Spark can't derive from ts itself."""
    df = spark.read.option("basePath", path).parquet(path).withColumn("ym", F.col("ym").cast("string"))
    if since is not None:
        df = df.where((F.col("ym") >= since.strftime("%Y%m")) & (F.col(ts) > F.lit(since)))
    if until is not None:
        df = df.where((F.col("ym") <= until.strftime("%Y%m")) & (F.col(ts) <= F.lit(until)))
    return df.drop("ym")


def without_tombstones(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull())


def without_cdc_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in CDC_COLUMNS if c in df.columns])


def split_rejects(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose required columns are all there, and the others for quarantine."""
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return df.where(~bad), df.where(bad)


def merge_by_month(spark: SparkSession, path: str, new: DataFrame, keys: list[str], version: list[Column | str], ts: str, files_per_month: int = 4) -> None:
    """Upsert: the latest row per key of the touched months replaces those months.

    The merged months go to a side path first: a path that is read can't be overwritten. A side path that is complete
    but still there is of a run that died while it replaced months; it is put in place first, so nothing is lost.

    Rows move and are sorted once: a slot of a month holds whole keys, so it is merged and written where it is.
    """
    _put_in_place(spark, path, f"{path}__merge")
    new = new.withColumn("ym", year_month(F.col(ts)))
    months = [r["ym"] for r in new.select("ym").distinct().collect()]  # months of one batch
    if not months:
        return
    try:
        old = spark.read.option("basePath", path).parquet(path).withColumn("ym", F.col("ym").cast("string"))
        touched = F.col("ym").isin([m for m in months if m is not None])
        new = old.where(touched | F.col("ym").isNull() if None in months else touched).unionByName(new)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    side = f"{path}__merge"
    slots = new.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(files_per_month))).repartition("ym", "_slot")
    latest_by_key(slots, ["ym", "_slot", *keys], version).drop("_slot").write.mode("overwrite").partitionBy("ym").parquet(side)
    _put_in_place(spark, path, side)


def _put_in_place(spark: SparkSession, path: str, side: str) -> None:
    """The months of a complete side path replace those of the table, by renames; then the side path goes.

    A month that has been moved is no longer in the side path, so after a crash the others follow.
    """
    files = Files(spark)
    if files.exists(f"{side}/_SUCCESS"):
        files.make(path)
        for month in files.folders(side):
            files.delete(f"{path}/{month}")
            files.rename(f"{side}/{month}", f"{path}/{month}")
        files.delete(side)


def compact(spark: SparkSession, path: str, keys: list[str], version: list[Column | str], files_per_month: int = 1) -> None:
    """Rewrite a month-partitioned table with the latest row per key in few, sorted files."""
    side = f"{path}__compact"
    _put_in_place(spark, path, f"{path}__merge")
    _put_in_place(spark, path, side)
    df = spark.read.option("basePath", path).parquet(path).withColumn("ym", F.col("ym").cast("string"))
    slots = F.pmod(F.xxhash64(*keys), F.lit(files_per_month))
    latest_by_key(df, [*keys, "ym"], version).repartition("ym", slots).sortWithinPartitions("ym", *keys).write.mode("overwrite").partitionBy("ym").parquet(side)
    _put_in_place(spark, path, side)


def as_json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("quote", "").csv(path)


def catalog(spark: SparkSession) -> DataFrame:
    """Tables and views of the session with their columns."""
    rows = [(t.name, t.tableType, c.name, c.dataType) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table string, kind string, column string, type string")
