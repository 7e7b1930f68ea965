"""Backfill of an enriched table month by month: each month is written whole, once, and its rows are counted before and after.

A month that is done has a commit file, so a run that dies goes on where it was; a month whose rows after the write are
not those of its source is an error and stays undone.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import year_month
from ..sources.shared import Files

REPORT = "ym string, before bigint, staging bigint, after bigint"


class WrongCount(RuntimeError):
    pass


def months_of(source: DataFrame, ts: str) -> list[str]:
    return sorted(r[0] for r in source.select(year_month(F.col(ts)).alias("ym")).distinct().collect())  # names of months


def _count(spark: SparkSession, folder: str) -> int:
    return spark.read.parquet(folder).count() if Files(spark).exists(folder) else 0


def _staged(source: DataFrame, ts: str, side: str, enrich: Callable[[DataFrame], DataFrame], months: list[str]) -> dict[str, int]:
    """Enrich the months' rows in one job into a folder per month; the source's rows per month."""
    ym = year_month(F.col(ts))
    rows = source.where(ym.isin(months))
    staging = {r["ym"]: r["n"] for r in rows.groupBy(ym.alias("ym")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per month
    enriched = enrich(rows)
    if len(months) == 1:
        enriched.write.mode("overwrite").parquet(f"{side}/ym={months[0]}")
    else:
        enriched.withColumn("ym", ym).write.mode("overwrite").partitionBy("ym").parquet(side)
    return staging


def backfill(spark: SparkSession, source: DataFrame, ts: str, path: str, enrich: Callable[[DataFrame], DataFrame], commits: str, months: list[str] | None = None, months_per_job: int = 1) -> DataFrame:
    """Enrich the source's rows of each month into path/ym=<month>; one row of counts per month, also of those done before.

    What a month held before is replaced. Only the months of one job are worked on at a time, so their joins have the cluster.

    months_per_job: months that are enriched together. The source is scanned and each dimension joined (broadcast, if it is
    small) once per job, not once per month; such an enrichment keeps the column ts. A run that dies loses the job's months
    that have no commit file.
    """
    files, months = Files(spark), months or months_of(source, ts)
    done = {ym: files.text(f"{commits}/{ym}.json") for ym in months}
    open_months = [ym for ym in months if done[ym] is None]
    for k in range(0, len(open_months), months_per_job):
        job = open_months[k : k + months_per_job]
        side = f"{commits}/side/{job[0]}"
        staging = _staged(source, ts, side, enrich, job)
        for ym in job:
            folder, fresh, n = f"{path}/ym={ym}", f"{side}/ym={ym}", staging.get(ym, 0)
            before, after = _count(spark, folder), _count(spark, fresh)
            if after != n:
                raise WrongCount(f"{ym}: {n} rows in the source, {after} enriched")
            files.delete(folder)
            if not files.exists(path):
                files.create(f"{path}/_made", "", overwrite=True)
            if files.exists(fresh):  # a month without rows has no folder
                files.rename(fresh, folder)
            done[ym] = json.dumps([ym, before, n, after])
            files.create(f"{commits}/{ym}.json", done[ym], overwrite=True)
        files.delete(side)
    return spark.createDataFrame([tuple(json.loads(done[ym])) for ym in months], REPORT)
