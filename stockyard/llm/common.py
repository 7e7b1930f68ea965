"""Helpers shared by the training-data operators: input normalisation, shared folders, Arrow text access, hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; longer single documents make a step of their own.
SLICE_BYTES = 1 << 20
#: Separator bytes: space and 0x09-0x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15 | 1, np.uint64))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Stands for a null id inside operators; results show null again.
NO_ID = -(2**63)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators work on; a null text counts as empty, a null id as the smallest id."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def restored(df: DataFrame, *id_cols: str) -> DataFrame:
    """Show null ids as null again."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in id_cols or ("doc_id",)})


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, text: id and hash together name a row, also where ids are null or given twice.

    Rows equal in both are one document given twice.
    """
    return texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def row_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The whole rows as a struct `row`, beside the doc_id and text_hash that `keyed_texts` gives them."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.struct("*").alias("row"), key[0].alias("doc_id"), key[1].alias("text_hash"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master (tests) a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not where and jvm_dir.isDefined():
        where = jvm_dir.get()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="stockyard-")
    if not jvm_dir.isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write a small or costly intermediate result as a table in the shared folder and read it back.

    Lost executors then do not force it to be made again, and later plans start from its files and their sizes.
    """
    path = shared_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one run that nothing needs after it; `clear` deletes them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.steps = spark, shared_path(spark, name), 0
        self.tables: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        self.steps += 1
        path = f"{self.path}/{self.steps}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, column: str) -> DataFrame:
        """The same in as many buckets of `column` as a shuffle has partitions, so that joins on it do not shuffle it again."""
        self.steps += 1
        table, buckets = f"scratch_{uuid.uuid4().hex}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables.append(table)
        dealt = df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
        dealt.format("parquet").option("path", f"{self.path}/{self.steps}").saveAsTable(table)
        return self.spark.table(table)

    def clear(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Parts in which the rows of one key are joined with what is known of the key.
CELLS = 64


def cell_of(*members: str) -> Column:
    return F.pmod(F.xxhash64(*members), F.lit(CELLS)).cast("int")


def cells_seen(cell: Column) -> Column:
    """Aggregate: the cells of a group as bits of one long, combined before the shuffle."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), cell))


def each_cell(cells: Column) -> Column:
    """One row for each cell in the bits."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.getbit(cells, c) == 1))


def with_group(rows: DataFrame, keys: list[str], members: list[str], known: list[Column], where: str = "true") -> DataFrame:
    """Rows of the groups that pass, with the group's aggregates beside them.

    Aggregates are combined before the shuffle, and a group is joined back in CELLS parts, so a hot key meets in no
    single task. The rows are read twice: give a written table or a cheap one.
    """
    dealt = rows.withColumn("_cell", cell_of(*members))
    groups = dealt.groupBy(*keys).agg(*known, cells_seen(F.col("_cell")).alias("_cells")).where(where)
    groups = groups.withColumn("_cell", each_cell(F.col("_cells"))).drop("_cells")
    return dealt.join(groups, [*keys, "_cell"]).drop("_cell")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a string or binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return off, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) whose texts hold about `most` bytes, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in `data`; no word crosses one of the row bounds."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    at = bounds[(bounds > 0) & (bounds < len(data))]
    begins[at] = inside[at + 1]
    ends[at - 1] = inside[at]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    first = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=first[1:])
    inner = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    values = _BYTE_VALUE[data[inner + np.repeat(starts, lengths)]] * _POWERS[inner & 0xFFFF]
    return mix(np.add.reduceat(values, first) ^ lengths.astype(np.uint64))


def keep_rows(docs: DataFrame, verdicts: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.Array]]) -> DataFrame:
    """The rows whose text passes, with all columns and without a shuffle; each row is judged by itself.

    verdicts: batches of (row number, text) to booleans in the same order.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = batch.column(at).fill_null("") if batch.column(at).null_count else batch.column(at)
                pair = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), text], names=["doc_id", "text"])
                yield batch.filter(pa.concat_arrays(list(verdicts(iter([pair])))))

    return docs.mapInArrow(run, docs.schema)


def tokenizer_file(name: str) -> str:
    """A tokenizer file given by path, or by its name in the public_tokenizers package."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
