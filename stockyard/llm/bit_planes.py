"""Token ids on disk as bit or byte planes.

Format: a dataset of block rows. A shard is one range of document ids; its ids, each document followed by the end id,
are cut into blocks of `block` ids. A block's 32-bit ids are transposed into 4 byte planes or 32 bit planes; each plane
that is not all zero is compressed with zstandard, and the planes stand one after another in `planes`. The other
columns are the chunk index: shard, chunk, first (ids of the shard before the block), n_ids, mode, plane_sizes (0: all
zero), and for the documents that reach into the block doc_ids, doc_starts (in the shard) and doc_lengths. Readers
that want few documents read the index columns first and then only the blocks they need.

Documents are in ascending doc_id order, repeated ids by text; a null text is empty and has the end id alone. Extra
columns are ignored, an empty table gives an empty dataset. The files are written by Spark, so a lost executor's tasks
are run again and leave no partial file. Memory of a task: one batch of texts, one document's ids and one block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, restored, shared_path, text_bytes, texts
from .tokens import WordEncoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK = 1 << 16
LEVEL = 3

BLOCK_SCHEMA = (
    "shard int, chunk bigint, first bigint, n_ids int, mode string, plane_sizes array<int>, planes binary, "
    "doc_ids array<bigint>, doc_starts array<bigint>, doc_lengths array<bigint>"
)
PART_SCHEMA = "shard int, doc_id bigint, doc_start bigint, n_tokens bigint, part_first bigint, part_length bigint, crc bigint"
DOCUMENT_SCHEMA = "shard int, doc_id bigint, doc_start bigint, n_tokens bigint, ids_crc32 bigint"

_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer: str) -> WordEncoder:
    """One per worker process."""
    if tokenizer not in _ENCODERS:
        _ENCODERS[tokenizer] = WordEncoder(tokenizer)
    return _ENCODERS[tokenizer]


def to_planes(ids: np.ndarray, mode: str, level: int = LEVEL) -> tuple[list[int], bytes]:
    import zstandard

    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if mode == "bit":
        bits = np.unpackbits(planes.reshape(4, -1, 1), axis=2, bitorder="little")
        planes = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1)
    elif mode != "byte":
        raise ValueError(f"mode {mode!r} is neither bit nor byte")
    packer = zstandard.ZstdCompressor(level=level)
    parts = [packer.compress(p.tobytes()) if p.any() else b"" for p in planes]
    return [len(p) for p in parts], b"".join(parts)


def from_planes(sizes: list[int], planes: bytes, n_ids: int, mode: str) -> np.ndarray:
    import zstandard

    width = n_ids if mode == "byte" else (n_ids + 7) // 8
    out, at, opener = np.zeros((len(sizes), width), np.uint8), 0, zstandard.ZstdDecompressor()
    for k, size in enumerate(sizes):
        if size:
            out[k] = np.frombuffer(opener.decompress(planes[at : at + size]), np.uint8)
            at += size
    if mode == "bit":
        bits = np.unpackbits(out, axis=1, count=n_ids).reshape(4, 8, n_ids)
        out = np.packbits(bits, axis=1, bitorder="little").reshape(4, n_ids)
    return np.ascontiguousarray(out.T).view("<u4").reshape(-1)


#: What 2**k zero bytes do to a crc32, as 32 columns, for each k met so far.
_ZEROS: list[list[int]] = []


def _times(m: list[int], v: int) -> int:
    out, k = 0, 0
    while v:
        if v & 1:
            out ^= m[k]
        v, k = v >> 1, k + 1
    return out


def _zeros(k: int) -> list[int]:
    if not _ZEROS:
        step = [0xEDB88320] + [1 << j for j in range(31)]
        for _ in range(3):  # one zero bit -> one zero byte
            step = [_times(step, x) for x in step]
        _ZEROS.append(step)
    while len(_ZEROS) <= k:
        _ZEROS.append([_times(_ZEROS[-1], x) for x in _ZEROS[-1]])
    return _ZEROS[k]


def crc32_combine(a: int, b: int, length: int) -> int:
    """crc32 of two strings one after the other, from both checksums and the second's length in bytes."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            a = _times(_zeros(k), a)
    return a ^ b


def _blocks(batches: Iterator[pa.RecordBatch], tokenizer: str, block: int, mode: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    shard, enc, end = TaskContext.get().partitionId(), encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
    held, first, chunk, docs, rows = bytearray(), 0, 0, [], []

    def block_row(n: int) -> dict:
        nonlocal first, chunk, docs
        sizes, planes = to_planes(np.frombuffer(bytes(held[: 4 * n]), "<u4"), mode)
        inside = [d for d in docs if d[1] < first + n]
        row = {"shard": shard, "chunk": chunk, "first": first, "n_ids": n, "mode": mode, "plane_sizes": sizes, "planes": planes}
        row |= {"doc_ids": [d[0] for d in inside], "doc_starts": [d[1] for d in inside], "doc_lengths": [d[2] for d in inside]}
        del held[: 4 * n]
        first, chunk = first + n, chunk + 1
        docs = [d for d in docs if d[1] + d[2] > first]
        return row

    for batch in batches:
        ids = batch.column(0).to_pylist()
        off, data = text_bytes(batch.column(1))
        text = memoryview(data)
        for k, doc_id in enumerate(ids):
            tokens = enc.encode(bytes(text[off[k] : off[k + 1]])) + end
            docs.append((doc_id, first + len(held) // 4, len(tokens) // 4))
            held += tokens
            while len(held) >= 4 * block:
                rows.append(block_row(block))
            if len(rows) >= 16:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
    enc.forget()
    if held:
        rows.append(block_row(len(held) // 4))
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def write_ids(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, block: int = BLOCK, mode: str = "byte") -> None:
    """Encode whole texts and write them as planes, in ascending doc_id order over the shards."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(BLOCK_SCHEMA))
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda it: _blocks(it, tokenizer, block, mode, schema), BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


def _parts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            ids = from_planes(row["plane_sizes"], row["planes"], row["n_ids"], row["mode"]).astype("<u4").tobytes()
            first, last = row["first"], row["first"] + row["n_ids"]
            for doc_id, start, length in zip(row["doc_ids"], row["doc_starts"], row["doc_lengths"], strict=True):
                a, b = max(start, first), min(start + length, last)
                out.append((row["shard"], doc_id, start, length, a - start, b - a, zlib.crc32(memoryview(ids)[4 * (a - first) : 4 * (b - first)])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _documents(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Documents from parts in the order of their shards and starts; a document's parts may come in several batches."""
    import pyarrow.compute as pc

    length = crc = 0  # of a document that is not complete yet
    for batch in batches:
        whole = pc.equal(batch.column("part_length"), batch.column("n_tokens"))
        done = batch.filter(whole)
        yield pa.RecordBatch.from_arrays([done.column(k) for k in (0, 1, 2, 3, 6)], schema=schema)
        out = []
        for shard, doc_id, start, n, first, part, part_crc in zip(*(c.to_pylist() for c in batch.filter(pc.invert(whole)).columns), strict=True):
            if first != length:
                raise ValueError(f"document {doc_id} of shard {shard}: ids {length} to {first} are in no block")
            length, crc = length + part, crc32_combine(crc, part_crc, 4 * part)
            if length == n:
                out.append((shard, doc_id, start, n, crc))
                length = crc = 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if length:
        raise ValueError(f"the last {length} ids read are of a document without its end")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Blocks are decoded once and apart from each other; what is brought together of documents that lie in several blocks
    are the checksums of their parts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    part_schema, schema = (to_arrow_schema(StructType.fromDDL(s)) for s in (PART_SCHEMA, DOCUMENT_SCHEMA))
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("ids"))
    # One row per shard.
    bases = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))
    parts = blocks.mapInArrow(lambda it: _parts(it, part_schema), PART_SCHEMA)
    ordered = parts.repartition("shard", "doc_start").sortWithinPartitions("shard", "doc_start", "part_first")
    return restored(
        ordered.mapInArrow(lambda it: _documents(it, schema), DOCUMENT_SCHEMA)
        .join(bases, "shard")
        .select("doc_id", (F.col("base") + F.col("doc_start")).alias("start"), "n_tokens", "ids_crc32")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The ids of each block, decoded: shard, chunk, first, ids."""

    def decode(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = from_planes(r["plane_sizes"], r["planes"], r["n_ids"], r["mode"])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([r["shard"]], pa.int32()), "chunk": [r["chunk"]], "first": [r["first"]], "ids": pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))})

    return spark.read.parquet(path).mapInArrow(decode, "shard int, chunk bigint, first bigint, ids array<bigint>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-planes")
    write_ids(read(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
