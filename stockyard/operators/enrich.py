"""Star enrichment: events left-joined to dimensions by a mapping, nulls filled with sentinels."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.defaults import fill_defaults, override
from ..functions.json_text import merge_patch, object_or_empty
from .dedup import latest_by_key


@dataclass(frozen=True)
class Dimension:
    """on: event (or earlier joined) column -> dimension column. columns: dimension column -> output name."""

    table: DataFrame
    on: dict[str, str]
    columns: dict[str, str]
    where: str | None = None
    #: Of several rows of one key the greatest by these columns counts, then by the chosen columns.
    version: tuple[str, ...] = ()
    #: Columns of an override table -> output columns that it resolves (sentinel means: keep).
    overrides: dict[str, str] = field(default_factory=dict)
    #: JSON columns of an override table -> output columns over whose objects theirs are merged.
    merges: dict[str, str] = field(default_factory=dict)
    #: The table has one row per key already.
    unique: bool = False
    #: Sent to every executor whatever Spark takes its size to be, so that events don't move for it.
    small: bool = False


def asked_for(dimensions: list[Dimension], columns: set[str]) -> list[Dimension]:
    """The dimensions that columns come from, directly or by a key."""
    want, kept = set(columns), []
    for d in reversed(dimensions):
        if want & {*d.columns.values(), *d.overrides.values(), *d.merges.values()}:
            kept.insert(0, d)
            want |= set(d.on)
    return kept


def enrich(events: DataFrame, dimensions: list[Dimension], defaults: bool = True, columns: set[str] | None = None) -> DataFrame:
    """Joins in order, so that a later dimension can use a key that an earlier one brought.

    Conditions on a dimension are applied before its join; of its duplicates the latest row by a total order stays, so a join
    never multiplies events and a rerun gives the same rows. Small dimensions are broadcast by Spark's own size check.
    An override may be joined before the dimension that it overrides: it counts as soon as that is there, so that events move
    for it while they are narrow.

    columns: of the dimensions' columns only these are asked for; as joins neither drop nor multiply events, a dimension that
    brings none of them, nor a key of one that does, is not joined. JSON that a later dimension merges is brought to normal form per dimension row, and merged where there is a patch.
    """
    dimensions = dimensions if columns is None else asked_for(dimensions, columns)
    out, made, open_ones = events, [], []
    merged, normal = {n for d in dimensions for n in d.merges.values()}, set()
    for k, d in enumerate(dimensions):
        table = d.table.where(d.where) if d.where else d.table
        chosen = {**{c: n for c, n in d.columns.items()}, **{c: f"_o{k}_{n}" for c, n in [*d.overrides.items(), *d.merges.items()]}}
        keys = {ek: f"_k{k}_{i}" for i, ek in enumerate(d.on)}
        right = table.select(*[F.col(d.on[ek]).alias(name) for ek, name in keys.items()], *[F.col(c).alias(n) for c, n in chosen.items()], *[F.col(c).alias(f"_v{k}_{i}") for i, c in enumerate(d.version)])
        versions = [f"_v{k}_{i}" for i in range(len(d.version))]
        right = (right if d.unique else latest_by_key(right, list(keys.values()), [*versions, *chosen.values()])).drop(*versions)
        for n in merged & set(d.columns.values()):
            right = right.withColumn(n, merge_patch(object_or_empty(F.col(n)), F.lit("{}")))
            normal.add(n)
        condition = None
        for ek, name in keys.items():
            test = out[ek] == right[name]
            condition = test if condition is None else condition & test
        out = out.join(F.broadcast(right) if d.small else right, condition, "left").drop(*keys.values())
        open_ones.append((k, d))
        for j, o in [x for x in open_ones if {*x[1].overrides.values(), *x[1].merges.values()} <= set(out.columns)]:
            kinds = {f.name: f.dataType for f in out.schema}
            for n in o.overrides.values():
                out = out.withColumn(n, override(F.col(f"_o{j}_{n}"), F.col(n), kinds[n])).drop(f"_o{j}_{n}")
            for n in o.merges.values():
                base = F.coalesce(F.col(n), F.lit("{}")) if n in normal else merge_patch(object_or_empty(F.col(n)), F.lit("{}"))
                patch = F.col(f"_o{j}_{n}")
                out = out.withColumn(n, F.when(patch.isNull(), base).otherwise(merge_patch(base, object_or_empty(patch)))).drop(f"_o{j}_{n}")
                normal.add(n)
            open_ones.remove((j, o))
        made += list(d.columns.values())
    if open_ones:
        raise ValueError(f"no dimension brings what these override: {[(d.overrides, d.merges) for _, d in open_ones]}")
    return fill_defaults(out, made) if defaults else out


def coverage(enriched: DataFrame, columns: dict[str, object]) -> DataFrame:
    """Per column, the percentage of rows that found their dimension (value differs from the sentinel)."""
    aggs = [F.round(100.0 * F.count(F.when(F.col(c) != F.lit(v), 1)) / F.count(F.lit(1)), 2).alias(f"{c}_pct") for c, v in columns.items()]
    return enriched.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


def backfill_report(before: DataFrame, staging: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of a backfill, as text values in rows."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit(name).alias("item"), "value")
    return count(before, "before").unionByName(count(staging, "staging")).unionByName(count(after, "after"))
