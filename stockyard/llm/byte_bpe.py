"""Byte-level BPE: encoding with character offsets, and decoding.

A vocabulary is a file of ranks (base64 bytes and rank per line). The tokenizers library gets it as a BPE model over the
characters that stand for bytes; every pair of entries whose bytes together are an entry is a merge with that entry's
rank, so the library joins what the ranks join.

`encode` works on Arrow batches. Each match of the split pattern is encoded by itself, and no match goes from a
character that is not white space to one that is; so a text falls into units (white space, then what follows up to the
next white space), and a worker asks the library once for each new short unit and keeps its ids; the matches in a new
unit of ASCII and Latin letters go to the library's model directly. Offsets are counted in
characters: a token's bytes are mapped to the characters that they belong to, so tokens that share a split character
all span it.

`decode` looks up each id's bytes, which reverses the byte table, and joins them before any text is made of them, so
characters split over tokens become whole again; bytes that are no UTF-8 become U+FFFD in `text` and stay in `decoded`.

A null text counts as empty and has no tokens; a null id stays null. Repeated rows are encoded one by one, extra columns
are ignored, an empty table gives an empty result. Very long texts are encoded unit by unit; a unit of more than
LONG_UNIT characters is cut further where the pattern cuts for certain. Ids that the vocabulary lacks decode to nothing
and are counted in `n_unknown`.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, slices, text_bytes, tokenizer_file
from .tokens import byte_characters

RANKS = "byte_bpe_50k.tiktoken"
#: Units kept per worker; the cache starts anew beyond it, results do not depend on it.
CACHE_UNITS = 250_000
#: Longer units go to the library each time.
CACHE_UNIT_CHARS = 48
LONG_UNIT = 1 << 16
LONG_TEXT = 1 << 20

#: The characters with the Unicode property White_Space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Places inside a unit at which one kind of character ends and the next begins, whatever stands around them.
CERTAIN = re.compile("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[.,;:!?、。，])(?=[A-Za-z0-9ぁ-ゖァ-ヺ一-龥])")

#: Units of ASCII and Latin letters up to U+00FF, in which the default pattern's matches can be told by these classes.
PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
PLAIN_MATCH = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9À-ÖØ-öø-ÿ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

ENCODED = "doc_id long, ids array<int>, char_start array<int>, char_end array<int>"
DECODED = "doc_id long, ids_bytes binary, decoded binary, text string, n_unknown long"


def ranks_of(path: str) -> dict[bytes, int]:
    with open(tokenizer_file(path), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Units(dict[str, bytes]):
    """Ids of units and matches met before; what is new is encoded, and kept if it is short."""

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe

    def __missing__(self, unit: str) -> bytes:
        if len(unit) > CACHE_UNIT_CHARS:
            return self.bpe.long(unit)
        self[unit] = ids = self.bpe.plain_ids(unit) if self.bpe.plain and PLAIN.fullmatch(unit) else self.bpe.library_ids(unit)
        return ids


class ByteBpe:
    """Encoder and decoder of one vocabulary; `of` keeps one per worker."""

    def __init__(self, path: str, pattern: str):
        self.path, self.pattern, self.shown = path, pattern, byte_characters()
        self.cache = Units(self)
        # Bytes of all entries in the order of their ids, through the characters that stand for them.
        back = {c: b for b, c in self.shown.items()}
        ranks = ranks_of(path)
        size = max(ranks.values(), default=-1) + 1
        entries = [b""] * size
        for token, rank in ranks.items():
            entries[rank] = bytes([back[c] for c in self.named(token)])
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.lengths = np.array([len(x) for x in entries], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])[:size]
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)

    def named(self, token: bytes) -> str:
        return "".join([self.shown[b] for b in token])

    @cached_property
    def library(self):
        """The tokenizers library with the ranks as merges; a worker that only decodes never makes it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = ranks_of(self.path)
        merges = [
            (self.named(token[:k]), self.named(token[k:]))
            for token in sorted(ranks, key=ranks.get)
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        library = Tokenizer(models.BPE(vocab={self.named(t): r for t, r in ranks.items()}, merges=merges))
        split = pre_tokenizers.Split(Regex(self.pattern), "isolated")
        library.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return library

    @cached_property
    def model(self):
        return self.library.model

    @cached_property
    def ascii(self) -> dict[int, str]:
        return {b: self.shown[b] for b in range(128)}

    @cached_property
    def plain(self) -> bool:
        """Whether the matches of plain units are this pattern's own; else every new unit takes the full path."""
        odd = (" Word", "\n\n naïve", "don't'", " won'tx!?", "a1b22 ", "  \t x--'s", "'S'reé", "\x1c.\x00z  ", " ", "ÀÉ'll.9")
        return all(self.plain_ids(x) == self.library_ids(x) for x in odd)

    def forget(self) -> None:
        """Free the cache, at the end of a task: workers stay, and other tasks need their memory."""
        self.cache = Units(self)

    def library_ids(self, piece: str) -> bytes:
        return array("I", self.library.encode_batch_fast([piece], add_special_tokens=False)[0].ids).tobytes()

    def plain_ids(self, unit: str) -> bytes:
        """The same of a plain unit: its matches go to the library's model directly."""
        out = []
        for piece in PLAIN_MATCH.findall(unit):
            ids = self.cache.get(piece)
            if ids is None:
                named = piece.translate(self.ascii) if piece.isascii() else "".join([self.shown[b] for b in piece.encode()])
                ids = array("I", [t.id for t in self.model.tokenize(named)]).tobytes()
                if piece != unit and len(piece) <= CACHE_UNIT_CHARS:
                    self.cache[piece] = ids
            out.append(ids)
        return b"".join(out)

    def long(self, unit: str) -> bytes:
        if len(unit) <= LONG_UNIT:
            return self.library_ids(unit)
        at = [0, *(m.start() for m in CERTAIN.finditer(unit)), len(unit)]
        found, begin = [], 0
        for here, after in zip(at[1:], [*at[2:], at[-1] + LONG_UNIT], strict=True):
            if after - begin > LONG_UNIT or here == len(unit):  # the last certain place before a piece would get too long
                found += [self.library_ids(unit[begin:here])] if here > begin else []
                begin = here
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_UNITS:
            self.cache = Units(self)
        if len(text) <= LONG_TEXT:
            return b"".join(map(self.cache.__getitem__, UNIT.findall(text)))
        out, units = [], map(re.Match.group, UNIT.finditer(text))
        while part := list(islice(units, 100_000)):
            out.append(b"".join(map(self.cache.__getitem__, part)))
            if len(self.cache) > CACHE_UNITS:
                self.cache = Units(self)
        return b"".join(out)

    def token_lengths(self, ids: np.ndarray) -> np.ndarray:
        inside = (ids >= 0) & (ids < len(self.lengths))
        return np.where(inside, self.lengths[np.where(inside, ids, 0)], 0) if len(self.lengths) else np.zeros(len(ids), np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.token_lengths(ids)
        ids, lengths = ids[lengths > 0], lengths[lengths > 0]
        first = np.cumsum(lengths) - lengths
        return self.bytes[np.arange(int(lengths.sum())) + np.repeat(self.begins[ids] - first, lengths)].tobytes()

    def unknown(self, ids: np.ndarray) -> int:
        inside = (ids >= 0) & (ids < len(self.known))
        return int(len(ids) - self.known[ids[inside]].sum())

    def spans(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The characters [start, end) that each token's bytes belong to."""
        if not len(ids):
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        raw = np.frombuffer(data, np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32) - 1
        ends = np.cumsum(self.token_lengths(ids))
        return character[ends - self.token_lengths(ids)], character[ends - 1] + 1


@lru_cache(maxsize=2)
def of(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str | None = None) -> DataFrame:
    """doc_id, ids, and the characters [char_start, char_end) that each id's bytes belong to."""
    pattern = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = of(ranks, pattern)
        for batch in batches:
            offsets, data = text_bytes(batch.column(1))
            for lo, hi in slices(offsets):
                ids, starts, ends = [], [], []
                for k in range(lo, hi):
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    own = np.frombuffer(bpe.encode(raw.decode("utf-8", "replace")), "<u4").astype(np.int32)
                    begin, end = bpe.spans(raw, own)
                    ids.append(own)
                    starts.append(begin)
                    ends.append(end)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), _lists(ids), _lists(starts), _lists(ends)], names=["doc_id", "ids", "char_start", "char_end"])
        bpe.forget()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, ranks: str = RANKS, pattern: str | None = None) -> DataFrame:
    """doc_id, the ids as little-endian unsigned 32-bit integers, their bytes and text, and how many ids are unknown."""
    pattern = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = of(ranks, pattern)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            offsets = np.asarray(lists.offsets)
            values = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(offsets, 1 << 19):
                own = [values[offsets[k] : offsets[k + 1]] for k in range(lo, hi)]
                found = [bpe.decode(x) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([x.astype("<u4").tobytes() for x in own], pa.binary()),
                        pa.array(found, pa.binary()),
                        pa.array([x.decode("utf-8", "replace") for x in found], pa.string()),
                        pa.array([bpe.unknown(x) for x in own], pa.int64()),
                    ],
                    names=["doc_id", "ids_bytes", "decoded", "text", "n_unknown"],
                )

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, DECODED)


class Decoder:
    """Text of ids that arrive in parts: a character whose bytes are not all there yet waits for the next part."""

    def __init__(self, ranks: str = RANKS, pattern: str | None = None):
        import codecs

        self.bpe, self.rest = of(ranks, pattern or split_pattern()), codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        return self.rest.decode(self.bpe.decode(np.array(ids, np.int64)), last)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = decode(encode(read(spark, sf_dir, "documents")))
    return back.select(
        "doc_id",
        (F.octet_length("ids_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
