"""Sentinels instead of nulls, and the resolution of overrides against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01 00:00:00"


def sentinel(kind: T.DataType) -> Column:
    """The value that stands for "missing" in a column of this type."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(EPOCH).cast(kind)
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    return F.lit(0).cast(kind)


def fill_defaults(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace nulls by sentinels, as after every left join of an enrichment."""
    chosen = set(columns or df.columns)
    return df.select(*[F.coalesce(F.col(f.name), sentinel(f.dataType)).alias(f.name) if f.name in chosen else F.col(f.name) for f in df.schema])


def override(own: Column, master: Column, kind: T.DataType) -> Column:
    """The override unless it is missing: null, or the sentinel of its type."""
    return F.when(own.isNotNull() & (own != sentinel(kind)), own).otherwise(master)


def override_if_active(active: Column, own: Column, master: Column, kind: T.DataType) -> Column:
    return F.when(active & own.isNotNull() & (own != sentinel(kind)), own).otherwise(master)


def greatest_or(first: str, *columns: Column) -> Column:
    """GREATEST over columns whose nulls count as a fixed early timestamp."""
    return F.greatest(*[F.coalesce(c, F.lit(first).cast("timestamp_ntz")) for c in columns])


def least_or(last: str, *columns: Column) -> Column:
    return F.least(*[F.coalesce(c, F.lit(last).cast("timestamp_ntz")) for c in columns])
