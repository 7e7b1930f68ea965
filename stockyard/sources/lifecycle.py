"""The life of tables: bucketed layouts, retention by month, and migration to another layout that a crash can't harm."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Files


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A catalog table dealt by the hash of its join keys, sorted in each bucket: joins and groups on the keys need no shuffle.

    Tables that are joined must have as many buckets. The rows are dealt before the write, so each bucket is one file.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def expire_months(spark: SparkSession, path: str, keep: int, as_of: dt.date, dry_run: bool = False) -> list[str]:
    """Drop the `ym=` folders that lie more than `keep` months before the month of `as_of`; the current month is the first kept.

    Folders of other names are left alone. Running it again after a crash drops what is left.
    """
    oldest = as_of.year * 12 + as_of.month - 1 - (keep - 1)
    files, gone = Files(spark), []
    for name in files.folders(path):
        ym = name.removeprefix("ym=")
        if name.startswith("ym=") and len(ym) == 6 and ym.isdigit() and int(ym[:4]) * 12 + int(ym[4:]) - 1 < oldest:
            gone.append(ym)
            if not dry_run:
                files.delete(f"{path}/{name}")
    return gone


def checksum(df: DataFrame, columns: list[str]) -> tuple[int, int, int]:
    """Rows, and two sums of row hashes that do not depend on the order."""
    h = F.xxhash64(*sorted(columns))
    row = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.sum(F.hash(*sorted(columns)).cast("bigint"))).first()
    return int(row[0]), int(row[1] or 0), int(row[2] or 0)


def migrate(spark: SparkSession, path: str, rewrite: Callable[[DataFrame, str], None], keep_old: bool = False, stop_after: str | None = None) -> str:
    """Copy a table into another layout, verify the copy, and swap the two; returns the last step done.

    rewrite(df, path): writes the rows to a new path. Steps: copy, verify, away (the old table is renamed), swap (the
    copy takes its place), done. Each step is noted after it has been done, and a call after a crash goes on from what
    is there: until the copy is verified the old table stays in place, after that both are there until the swap is over.
    stop_after: end after a step, as a crash would (tests).
    """
    files = Files(spark)
    path, new, old, note = path.rstrip("/"), f"{path.rstrip('/')}__new", f"{path.rstrip('/')}__old", f"{path.rstrip('/')}__migration.json"
    state = json.loads(files.text(note) or '{"step": "begin"}')

    def did(step: str) -> bool:
        state["step"] = step
        files.create(note, json.dumps(state), overwrite=True)
        return step == stop_after

    if state["step"] == "begin":
        if files.exists(old):
            raise ValueError(f"{old} is left of an earlier migration; remove it first")
        files.delete(new)
        rewrite(spark.read.parquet(path), new)
        if did("copy"):
            return "copy"
    if state["step"] == "copy":
        before, after = spark.read.parquet(path), spark.read.parquet(new)
        columns = before.columns
        kinds = dict(before.dtypes)
        same = set(columns) <= set(after.columns) and checksum(before, columns) == checksum(after.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns]), columns)
        if not same:
            files.delete(note)
            raise ValueError(f"the copy of {path} differs from it; the table is as it was")
        if did("verify"):
            return "verify"
    if state["step"] == "verify":
        if files.exists(path) and files.exists(new) and not files.exists(old):
            files.rename(path, old)
        if did("away"):
            return "away"
    if state["step"] == "away":
        if files.exists(new) and not files.exists(path):
            files.rename(new, path)
        if did("swap"):
            return "swap"
    if not keep_old:
        files.delete(old)
    files.delete(note)
    return "done"
