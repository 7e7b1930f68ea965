"""Left join of two change streams with state that lives for a time, without watermarks.

Rows of both sides come as one stream with `side` ('left' or 'right'), a key and a payload. The latest row of each
side is kept per key for the time to live. Every arrival emits what the join holds then, so a left row first appears
unmatched and again when its right row comes; the sink keeps the latest row per key (upsert). A row that comes after
its partner's state has gone appears unmatched.

Keys share state: a bucket of keys is one value per side, so that calls to the state store grow with the buckets that a
micro-batch touches, not with its keys. Each row in a bucket keeps its own time of arrival and is gone when that is over.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructType

OUTPUT = "key string, version bigint, left_row string, right_row string"
#: Values of state per side; a checkpoint is bound to the number it began with. A touched bucket is rewritten whole.
BUCKETS = 1024


def tagged(df: DataFrame, side: str, key: str, version: str) -> DataFrame:
    """One side of the join: its row as JSON with key and version."""
    return df.select(F.lit(side).alias("side"), F.col(key).cast("string").alias("key"), F.col(version).cast("bigint").alias("version"), F.to_json(F.struct(*df.columns)).alias("payload"))


class LatestPairs(StatefulProcessor):
    """Per bucket and side: JSON rows of key, version, payload and time of arrival."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kept = StructType().add("rows", StringType())
        self.sides = {s: handle.getValueState(s, kept, ttlDurationMs=self.ttl_ms) for s in ("left", "right")}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held, touched, changed = {}, {}, set()
        for side, state in self.sides.items():
            stored = state.get()
            held[side] = {k: row for k, *row in json.loads(stored[0])} if stored is not None else {}
            held[side] = {k: row for k, row in held[side].items() if row[2] + self.ttl_ms > now}
        for batch in rows:
            for side, k, version, payload in zip(batch.side, batch.key, batch.version, batch.payload, strict=True):
                touched[k] = None
                old = held[side].get(k)
                if old is None or old[0] <= version:
                    held[side][k] = (int(version), payload, now)
                    changed.add(side)
        for side in changed:
            self.sides[side].update((json.dumps([[k, *row] for k, row in held[side].items()]),))
        left, right = held["left"], held["right"]
        pairs = [(k, left[k], right.get(k)) for k in touched if k in left]
        if pairs:
            out = [(k, max(a[0], b[0]) if b else a[0], a[1], b[1] if b else None) for k, a, b in pairs]
            yield pd.DataFrame(out, columns=["key", "version", "left_row", "right_row"])

    def close(self) -> None:
        pass


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started in this block keep their state in RocksDB, whatever the session's own store is."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, old)


def left_join_with_ttl(left: DataFrame, right: DataFrame, ttl_ms: int, buckets: int = BUCKETS) -> DataFrame:
    """tagged() sides to one update stream of joined pairs. Start it in `state_in_rocksdb`: no other store keeps such state."""
    both = left.unionByName(right).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return both.groupBy("bucket").transformWithStateInPandas(statefulProcessor=LatestPairs(ttl_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="ProcessingTime")
