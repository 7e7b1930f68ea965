"""A table sink with batches by size and time, dead letters, and a share of rejects beyond which a batch fails.

Rejected rows carry the first rule that they break and go to a dead-letter table. If more than `reject_ratio` of a
batch is rejected, something is wrong with the producer: the batch fails, nothing of it is added to the table, and the
same batch is tried again when the query is started anew.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.tables import without_cdc_columns

#: Names that Avro and its JSON form give to the branches of a union.
BRANCHES = {"string", "int", "long", "float", "double", "boolean", "bytes"}
MALFORMED = "malformed"


class TooManyRejects(RuntimeError):
    pass


@dataclass(frozen=True)
class Batching:
    """A micro-batch is due after `seconds` and takes `files` (`megabytes`, if set) of the source; files hold `rows` at most."""

    rows: int = 100_000
    seconds: int = 30
    files: int = 100
    megabytes: int | None = None


def source(spark: SparkSession, path: str, schema: T.StructType | str, batching: Batching, kind: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(kind)
    reader = reader.schema(schema) if kind != "text" else reader
    limit = ("maxBytesPerTrigger", f"{batching.megabytes}m") if batching.megabytes else ("maxFilesPerTrigger", batching.files)
    return reader.option(*limit).load(path)


def decoded(rows: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON text to columns; `_malformed` holds the text of rows that don't fit the schema."""
    kind = T.StructType.fromDDL(schema).add("_malformed", T.StringType())
    return rows.select(F.from_json(value, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}).alias("_r")).select("_r.*")


def _is_union(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and len(kind) > 0 and all(f.name in BRANCHES or f.name.startswith("member") and f.name[6:].isdigit() for f in kind)


def unwrapped(df: DataFrame) -> DataFrame:
    """Unions, which arrive as a struct with a field per branch, become the value of the branch that is set.

    Branches of one type keep it; numbers widen to double or long; anything else becomes text.
    """
    out = []
    for f in df.schema:
        if not _is_union(f.dataType):
            out.append(F.col(f.name))
            continue
        kinds = [x.dataType for x in f.dataType]
        if len({k.simpleString() for k in kinds}) == 1:
            to: T.DataType = kinds[0]
        elif all(isinstance(k, T.NumericType) for k in kinds):
            to = T.DoubleType() if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds) else T.LongType()
        else:
            to = T.StringType()
        out.append(F.coalesce(*[F.col(f"{f.name}.{x.name}").cast(to) for x in f.dataType]).alias(f.name))
    return df.select(*out)


def judged(df: DataFrame, required: list[str], rules: dict[str, Column]) -> DataFrame:
    """Adds `_reason`: null, or the first of: malformed, a required column that is null, a rule that holds."""
    reason = F.when(F.col("_malformed").isNotNull(), MALFORMED) if "_malformed" in df.columns else F.lit(None).cast("string")
    checks = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in required] + [F.when(bad, F.lit(name)) for name, bad in rules.items()]
    return df.withColumn("_reason", F.coalesce(reason, *checks))


def start(stream: DataFrame, path: str, dead_letters: str, checkpoint: str, required: list[str], rules: dict[str, Column] | None = None, reject_ratio: float = 0.1, batching: Batching = Batching(), bounded: bool = True) -> StreamingQuery:
    """Unwrap, drop the columns of change capture, judge, and write good rows to path/batch=N, rejects to dead_letters/batch=N."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = judged(unwrapped(without_cdc_columns(batch)), required, rules or {}).persist()
        try:
            n, bad = rows.agg(F.count(F.lit(1)), F.count("_reason")).first()
            letters = rows.where(F.col("_reason").isNotNull()).withColumn("_failed", F.lit(bad > reject_ratio * n))
            letters.write.mode("overwrite").parquet(f"{dead_letters}/batch={batch_id:012d}")
            if bad > reject_ratio * n:
                raise TooManyRejects(f"batch {batch_id}: {bad} of {n} rows are rejected, {reject_ratio:g} of them are allowed")
            good = rows.where(F.col("_reason").isNull()).drop("_reason", "_malformed")
            files = max(1, math.ceil((n - bad) / batching.rows))
            good.repartition(files).write.mode("overwrite").option("maxRecordsPerFile", batching.rows).parquet(f"{path}/batch={batch_id:012d}")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=f"{batching.seconds} seconds")).start()
