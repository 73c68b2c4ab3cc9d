"""Helpers shared by the operators of this subpackage.

Text is handled as UTF-8 bytes in numpy: all word patterns of the operators
separate words at ASCII bytes only, so byte positions and characters split
alike.  Word and window hashes are 64-bit.
"""

from __future__ import annotations

import ctypes
import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

MASK = (1 << 64) - 1


# ---------------------------------------------------------------- Spark side

def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a given table, and nothing else of it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns under the operator's own names (extra columns, clashing or not, fall away)."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in wanted.items()])


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 3; rows of fold 1 are held out of every fit."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def excerpt(text: str, chars: int) -> Column:
    """The text itself up to ``chars`` characters; of a longer one pieces from its first to its last character, as long together."""
    k = max(2, min(20, chars // 64))
    n = max(1, chars // k - 1)
    return F.expr(f"IF(length({text}) <= {chars}, {text}, array_join(transform(sequence(0, {k - 1}), i -> substring({text}, "
                  f"1 + cast(i * (length({text}) - {n}) div {k - 1} as int), {n})), ' '))")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives executors)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_bits(spark: SparkSession) -> int:
    """Buckets of the hash exchange: a power of two, at least the session's shuffle partitions."""
    return max(1, math.ceil(math.log2(shuffle_width(spark))))


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as bytes; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x if x is not None else b"" for x in column.cast(kind).to_pylist()]


def give_back() -> None:
    """Memory that is free in this Python worker goes back to the system; a worker lives on between groups and stages.

    Arrow's pool keeps what was freed, and so does the C library (where it is glibc).
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# -------------------------------------------------------------- packed bytes

def squeeze(a: np.ndarray, level: int = 1) -> bytes:
    """An integer array as zstd-compressed byte planes."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(planes).tobytes())


def expand(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def squeeze_sorted(a: np.ndarray) -> bytes:
    """As ``squeeze`` for ascending unsigned integers: their differences."""
    d = a.copy()
    d[1:] = a[1:] - a[:-1]
    return squeeze(d)


def expand_sorted(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(expand(blob, dtype), dtype=dtype)


# -------------------------------------------------------------------- words

def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))                                    # all but these are word bytes
PUNCT = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_rng = np.random.default_rng(20250101)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_Q = 0xD6E8FEB86659FD93
SUMMED = 256                                                                        # bytes of a word up to which a sum of powers is its hash


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a list of byte texts: byte starts and ends, document number, and 64-bit hash of each word."""

    def __init__(self, texts: list[bytes], separators: np.ndarray, lower: bool = False, hashes: bool = True):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        b = LOWER[self.buf] if lower else self.buf
        self._inside = ~separators[b]
        inside = np.concatenate([[False], self._inside, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))          # word number at which each document begins
        if hashes:
            self.hash = self._hash(b)
        del self._inside

    def _hash(self, b: np.ndarray) -> np.ndarray:
        n = self.ends - self.starts
        if not len(n):
            return np.zeros(0, np.uint64)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(n.max()), _R)]), dtype=np.uint64)
        stops = np.cumsum(n)
        rel = np.arange(stops[-1], dtype=np.int32) - np.repeat((stops - n).astype(np.int32), n)
        total = np.add.reduceat(_BYTE[b[self._inside]] * power[rel], stops - n)
        out = mix(total + n.astype(np.uint64))
        for k in np.flatnonzero(n > SUMMED).tolist():                               # sums with powers repeat on long words of a pattern
            out[k] = int.from_bytes(hashlib.blake2b(b[self.starts[k]:self.ends[k]].tobytes(), digest_size=8).digest(), "little")
        return out

    def windows(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on (meaningful where ``fits`` holds)."""
        return window_hash(self.hash, size)

    def fits(self, size: int) -> np.ndarray:
        """Whether ``size`` words from each word on lie in its document."""
        return np.arange(len(self.doc)) + size <= self.first[self.doc + 1]


def window_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of ``size`` consecutive values, by doubling; the tail past the end counts as zeros."""
    out, done, one, width = np.zeros(len(h), np.uint64), 0, h, 1
    while width <= size:
        if size & width:
            out = out + shifted(one, done) * np.uint64(pow(_Q, done, 1 << 64))
            done += width
        if width * 2 <= size:
            one = one + shifted(one, width) * np.uint64(pow(_Q, width, 1 << 64))
        width *= 2
    return mix(out)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values and their counts."""
    h = np.sort(h)
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[at], np.diff(np.append(at, len(h)))


def is_member(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(x), bool)
    at = np.searchsorted(ascending, x)
    at[at == len(ascending)] = 0
    return ascending[at] == x


def shifted(a: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(a)
    if by < len(a):
        out[:len(a) - by] = a[by:]
    return out


# ------------------------------------------------------------ text in blocks

BLOCK_SCHEMA = "block string, ids array<bigint>, sizes array<int>, body binary"


def text_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Documents (id, text) in blocks of about ``block_bytes`` of whole texts, one row per block, dealt by block.

    A block is named by its partition and number, so that a task that is run again makes the same blocks.  The
    result is an exchange: plans that use it several times shuffle the texts once.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def row():
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_pydict(
                {"block": [f"{part}-{n}"], "ids": [ids], "sizes": [[len(t) for t in texts]], "body": [body]},
                schema=pa.schema([("block", pa.string()), ("ids", pa.list_(pa.int64())),
                                  ("sizes", pa.list_(pa.int32())), ("body", pa.binary())]))

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t) + 1
                if size >= block_bytes:
                    yield row()
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield row()

    spark = docs.sparkSession
    return docs.mapInArrow(make, BLOCK_SCHEMA).repartition(shuffle_width(spark), "block")


def block_texts(sizes: list[int], body: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(body) if body else b""
    out, at = [], 0
    for n in sizes:
        out.append(raw[at:at + n])
        at += n
    return out


def by_bucket(sorted_hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending 64-bit hashes by their first ``bits`` bits; empty buckets are left out."""
    if not len(sorted_hashes):
        return []
    top = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    ends = np.append(cuts[1:], len(top))
    return [(int(top[a]), int(a), int(b)) for a, b in zip(cuts, ends, strict=True)]


def finger(h: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits of a hash behind its bucket's."""
    return ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
