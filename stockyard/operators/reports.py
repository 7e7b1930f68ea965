"""Reports over enriched event tables, positions, bins and area mappings.

Each takes a table and the names of its columns, so that one report serves every enriched table. Rows whose time or
quantity is the sentinel of a missing value (the epoch, zero, an empty text) are left out where a report says so, as a
mean over sentinels means nothing. Everything is one grouping, combined before its shuffle, but for the distinct counts;
lists of names are sets, so their size is that of the distinct names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import defaults
from ..functions.times import seconds_between


def epoch() -> Column:
    return F.lit(defaults.EPOCH).cast("timestamp_ntz")


def names(c: str) -> Column:
    """The distinct values as one text, in order."""
    return F.array_join(F.array_sort(F.collect_set(c)), ", ")


def rows() -> Column:
    return F.count(F.lit(1))


def happened(c: str) -> Column:
    """The time is there and no sentinel."""
    return F.col(c) > epoch()


def productivity(events: DataFrame, worker: list[str], at: str, quantity: str, least: int = 10) -> DataFrame:
    """Per worker with at least `least` events: events, quantity, days with work, events per such day."""
    g = events.where(happened(at)).groupBy(*worker).agg(rows().alias("n"), F.sum(quantity).alias("quantity"), F.countDistinct(F.to_date(at)).alias("days"))
    return g.where(F.col("n") >= least).withColumns({"per_event": F.round(F.col("quantity") / F.col("n"), 4), "per_day": F.round(F.col("n") / F.col("days"), 4)})


def frequency(events: DataFrame, item: list[str], quantity: str, others: str, top: int) -> DataFrame:
    """The `top` items by events with a quantity; ties by the item, so that the cut is defined."""
    g = events.where(F.col(quantity) > 0).groupBy(*item).agg(rows().alias("n"), F.sum(quantity).alias("quantity"), F.countDistinct(others).alias("n_others"))
    return g.orderBy(F.desc("n"), *item).limit(top)


def timing(events: DataFrame, by: Column, start: str, end: str) -> DataFrame:
    """Mean seconds from start to end by a part of the time, over events in which both happened."""
    both = events.where(happened(start) & happened(end))
    return both.groupBy(by.alias("part")).agg(rows().alias("n"), F.round(F.avg(seconds_between(F.col(start), F.col(end))), 2).alias("mean_seconds"))


def loads(events: DataFrame, by: list[str], quantity: str, weight: str, item: str) -> DataFrame:
    """Weight moved by group, over events that have quantity and weight."""
    kept = events.where((F.col(quantity) > 0) & (F.col(weight) > 0))
    return kept.groupBy(*by).agg(rows().alias("n"), F.sum(quantity).alias("quantity"), F.countDistinct(item).alias("items"), F.round(F.sum(F.col(quantity) * F.col(weight)), 2).alias("weight"))


def sessions(events: DataFrame, session: list[str], at: str, item: str, least: int = 5) -> DataFrame:
    """Per session with at least `least` events: first and last time, whole minutes between them by minute boundaries, distinct items."""
    g = events.groupBy(*session).agg(rows().alias("n"), F.min(at).alias("first"), F.max(at).alias("last"), F.countDistinct(item).alias("items"))
    minutes = seconds_between(F.date_trunc("minute", "first").cast("timestamp_ntz"), F.date_trunc("minute", "last").cast("timestamp_ntz")) / 60
    return g.where(F.col("n") >= least).withColumn("minutes", minutes.cast("bigint"))


def compared(periods: dict[str, DataFrame], quantity: str, item: str) -> DataFrame:
    """One row per named state of the stock: positions with a quantity, their sum, distinct items."""
    out = None
    for name, stock in periods.items():
        one = stock.where(F.col(quantity) > 0).agg(rows().alias("positions"), F.round(F.coalesce(F.sum(quantity), F.lit(0.0)), 2).alias("quantity"), F.countDistinct(item).alias("items"))
        one = one.withColumn("period", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def spread(stock: DataFrame, item: list[str], quantity: str, place: str, at: str, over: float) -> DataFrame:
    """Items (or batches) of which more than `over` is in stock: their places by name, and the times of first and last change."""
    g = stock.where(F.col(quantity) > 0).groupBy(*item).agg(rows().alias("positions"), F.sum(quantity).alias("q"), names(place).alias("places"), F.min(at).alias("first_change"), F.max(at).alias("last_change"))
    return g.where(F.col("q") > over).withColumn("quantity", F.round("q", 2)).drop("q")


def mapping_status(visible: str, feeds: str) -> Column:
    """How far an area is integrated, by its two switches; a missing switch is off."""
    v, f = (F.coalesce(F.col(c), F.lit(False)) for c in (visible, feeds))
    return F.when(v & f, "full").when(v, "visible only").when(f, "feed only").otherwise("none")


def mapping_summary(mappings: DataFrame, by: list[str], visible: str, feeds: str, counted: list[str], listed: str) -> DataFrame:
    """Mappings by group: how many are visible or feed the ledger, as counts and rates, distinct members, one member's names."""
    rate = lambda c: F.round(F.avg(F.when(F.col(c), 1.0).otherwise(0.0)), 4)
    return mappings.groupBy(*by).agg(
        rows().alias("n"), F.count_if(visible).alias("n_visible"), F.count_if(feeds).alias("n_feeding"), rate(visible).alias("visible_rate"), rate(feeds).alias("feeding_rate"),
        *[F.countDistinct(c).alias(f"n_{c}") for c in counted], names(listed).alias(f"{listed}_list"),
    )


def share(table: DataFrame, by: str) -> DataFrame:
    """Rows by group, and their part of all rows in percent."""
    g = table.groupBy(by).agg(rows().alias("n"))  # one row per group meets in the window
    return g.withColumn("percent", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def changes(mappings: DataFrame, created: str, updated: str, ended: str, since: Column, now: Column) -> DataFrame:
    """Mappings touched since then: what the last change was, and its age in days by day boundaries."""
    touched = F.greatest(created, updated, F.coalesce(F.col(ended), epoch()))
    kind = F.when(F.col(ended).isNotNull(), "ended").when(F.col(updated) > F.col(created), "updated").otherwise("created")
    age = F.datediff(now, F.coalesce(updated, created)).cast("bigint")
    return mappings.where(touched >= since).withColumns({"change": kind, "age_days": age, "touched": touched})


def stock_by_mapping(stock: DataFrame, mappings: DataFrame, on: list[str], columns: list[str], ended: str, quantity: str) -> DataFrame:
    """Stock summed by what its area is mapped to now. Ended mappings are left out before the join; an unmapped area stays, with nulls."""
    return stock.join(mappings.where(F.col(ended).isNull()).select(*on, *columns), on, "left").groupBy(on[-1], *columns).agg(F.round(F.sum(quantity), 2).alias("quantity"), rows().alias("positions"))


def occupancy(bins: DataFrame, by: list[str], taken: Column, capacity: str) -> DataFrame:
    """Bins, occupied ones, their rate in percent, capacity in all and the extremes."""
    g = bins.groupBy(*by).agg(rows().alias("bins"), F.count_if(taken).alias("occupied"), F.sum(capacity).alias("capacity"), F.min(capacity).alias("least"), F.max(capacity).alias("most"))
    return g.withColumn("rate", F.round(F.col("occupied") * 100.0 / F.col("bins"), 2))


def movements(events: DataFrame, unit: list[str], place: str, at: str, least: int) -> DataFrame:
    """Units with at least `least` events: places by name, first and last time."""
    g = events.groupBy(*unit).agg(rows().alias("n"), F.countDistinct(place).alias("n_places"), F.min(at).alias("first"), F.max(at).alias("last"), F.array_join(F.array_sort(F.collect_set(F.col(place).cast("string"))), " -> ").alias("path"))
    return g.where(F.col("n") >= least)
