"""Vectorised text kernels and small Spark helpers shared by the operators of this subpackage.

Every kernel works on one flat byte buffer that holds several documents, so the
cost per word is a few array passes instead of interpreted Python.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text handled at once by a kernel; bounds the memory of its temporaries.
CHUNK_BYTES = 1 << 18
#: The words of the contracts: runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = ~_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit generator: spreads every input bit over all output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _table(seed: int) -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))


#: (value of each byte, odd multiplier, its inverse modulo 2^64) for two independent hashes.
_SEEDS = [(seed, odd, pow(odd, -1, 1 << 64)) for seed, odd in ((0x1234567, 0xD6E8FEB86659FD93), (0x7654321, 0xA0761D6478BD642F))]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least n of them."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, math.ceil(math.log2(max(2, n))))
        _, odd, inverse = _SEEDS[which]
        with np.errstate(over="ignore"):
            have = tuple(np.multiply.accumulate(np.concatenate(([U64(1)], np.full(size - 1, b, dtype=np.uint64)))) for b in (odd, inverse))
        if size <= 1 << 21:
            _POWERS[which] = have
    return have


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of values[start:end] for many spans at once; it does not depend on where a span lies."""
    up, down = _powers(which, len(values) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=total[1:])
        return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


class SpanHash:
    """span_hash for several sets of spans of the same values: the running sum is made once."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.up, self.down = _powers(which, len(values) + 1)
        with np.errstate(over="ignore"):
            self.total = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(values * self.up[: len(values)], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


def byte_values(data: np.ndarray, which: int = 0, lower: bool = False) -> np.ndarray:
    table = _table(_SEEDS[which][0])
    return (table[LOWER] if lower else table)[data]


class Words:
    """Words of a chunk of documents: begin and end byte, and the first word of each document (one more at the end)."""

    __slots__ = ("data", "offsets", "start", "end", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray = WORD_BYTE):
        inside = word_byte[data]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        before = np.empty(len(data), dtype=bool)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            before[edge] = False
        after = np.empty(len(data), dtype=bool)
        if len(data):
            after[-1], after[:-1] = False, inside[1:]
            after[edge - 1] = False
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self, which: int = 0, lower: bool = False) -> np.ndarray:
        table = _table(_SEEDS[which][0])
        with np.errstate(over="ignore"):
            return span_hash((table[LOWER] if lower else table)[self.data], self.start, self.end, which)

    def doc(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def limit(self) -> np.ndarray:
        """For each word, one past the last word of its document."""
        return np.repeat(self.first[1:], np.diff(self.first))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of a batch with about `size` bytes; a document is never cut."""
    data, at = text_buffer(batch.column(batch.schema.get_field_index(column)))
    row, n = 0, len(at) - 1
    while row < n:
        stop = max(row + 1, min(n, int(np.searchsorted(at, at[row] + size, side="right")) - 1))
        yield row, stop, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


def lean(run):
    """`run` over Arrow batches, after which a worker gives freed memory back: workers are kept for later tasks, and their heaps add up on an executor."""

    def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return give_back


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by doubling."""
    if len(values) < width:
        return values[:0]
    span, best = 1, values
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    return best if span == width else np.minimum(best[: len(values) - width + 1], best[width - span :])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def share(spark: SparkSession, model):
    """Broadcast a model with its classes by value, so that workers need nothing of this package; `opened` reads it there. Arrays travel, and lie on disk, compressed."""
    buffers: list = []
    head = cloudpickle.dumps(model, protocol=5, buffer_callback=buffers.append)
    return spark.sparkContext.broadcast((head, [(b.raw().nbytes, pa.compress(b.raw(), codec="zstd", asbytes=True)) for b in buffers]))


def opened(shared):
    """The model of `share`; its arrays are read-only."""
    head, buffers = shared.value
    return pickle.loads(head, buffers=[pa.decompress(b, decompressed_size=size, codec="zstd") if size else b"" for size, b in buffers])


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores added as keep it apart from the columns (case counts for nothing in Spark)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder that the cluster names in spark.checkpoint.dir; only where it names none (tests) set a local one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so that a lost executor costs no recomputation of what came before."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(column: str, n: int):
    """crc32 of an integer id as text, modulo n; a null id belongs to no fold but -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))
