"""The latest row per key, and rows that are not deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.defaults import EPOCH


def latest_by_key(df: DataFrame, keys: list[str], version: list[Column | str]) -> DataFrame:
    """One row per key: the one with the greatest version.

    `version` should be a total order; on ties any of the equal rows stays. A single maximum over the whole row is
    aggregated on the map side first, so a key with many versions does not meet in one task as it would in a window.
    Each column moves once, and the keys stay columns of the grouping, so that a join by them needs no further shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    named = list(dict.fromkeys(v for v in version if isinstance(v, str) and v in rest)) if all(isinstance(v, str) for v in version) else []
    if rest and (named or not version) and not any(kind in df.schema[c].dataType.simpleString() for c in rest for kind in ("map<", "variant")):
        best = F.max(F.struct(*named, *[c for c in rest if c not in named]))
    else:
        order = F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(f"v{k}") for k, v in enumerate(version)])
        best = F.max_by(F.struct(*(rest or df.columns)), order)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`") for c in df.columns])


def not_deleted(df: DataFrame, as_of: Column, column: str = "deactivated_at") -> DataFrame:
    """Rows without a deletion time (null or the sentinel), or with one after `as_of`."""
    epoch = F.lit(EPOCH).cast(df.schema[column].dataType)
    gone = (F.col(column) > epoch) & (F.col(column) <= as_of)
    return df.where(~F.coalesce(gone, F.lit(False)))
