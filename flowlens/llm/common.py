"""Shared helpers: written intermediate tables, Arrow buffers, text chunks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import ship_package, work_dir

U64 = np.uint64
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint root and read it back.

    Cuts lineage: what was decided (names, offsets, links) is never computed
    twice, and a lost executor rereads files instead of rerunning the job.
    """
    path = work_dir(df.sparkSession, f"llm-{name}") + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(df: DataFrame) -> SparkSession:
    """Make this package importable in the executors' Python workers, and
    bound an Arrow batch by bytes where the session does not: whole texts make
    batches of ten thousand rows large."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(_BATCH_BYTES) == "67108864b":     # Spark's own default
        spark.conf.set(_BATCH_BYTES, str(8 << 20))
    return spark


def releasing(run: Callable) -> Callable:
    """A mapInArrow body that gives its freed memory back when a task ends:
    workers are kept for later tasks and would hold their highest use. The
    powers of the hashes go too; a task makes them anew in milliseconds."""
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _POWERS.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)
    return task


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for b in batches:
        for lo in range(0, len(b), rows):
            yield b.slice(lo, rows)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else (locale and Unicode free)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def replace_columns(row: str, fields: list[str], new: dict[str, Column]) -> list[Column]:
    """``row``'s fields in order, then ``new``; a new column replaces an input
    column of the same name (compared without case, as Spark does)."""
    taken = {n.lower() for n in new}
    return [F.col(f"`{row}`.`{f}`").alias(f) for f in fields if f.lower() not in taken] + \
        [c.alias(n) for n, c in new.items()]


def binary_views(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a binary Arrow column without copying; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"")
    wide = pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return offs, (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))


def chunks(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of neighbouring rows of about ``limit`` in all (one row at least)."""
    i, total = 0, 0
    for j, n in enumerate(sizes.tolist()):
        if j > i and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if i < len(sizes):
        yield i, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of splitmix64 over an array of uint64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, U64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[:] = out
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of every ``data[starts:ends]``, by prefix sums."""
    n = len(data)
    up, down = _powers(n + 1)
    pre = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:n], out=pre[1:])
    return mix64((pre[ends] - pre[starts]) * down[starts] + (ends - starts).astype(U64))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive bytes; [i] starts at i."""
    n = len(data)
    if n < k:
        return np.zeros(0, U64)
    up, down = _powers(n + 1)
    pre = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:n], out=pre[1:])
    return mix64((pre[k:] - pre[:-k]) * down[:n - k + 1])


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by doubling spans."""
    span, m = 1, a
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        d = w - span
        m = np.minimum(m[:len(m) - d], m[d:])
    return m


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def pack_chunks(parts: list[bytes]) -> bytes:
    """Byte strings as one compressed value."""
    sizes = np.array([len(p) for p in parts], "<u4").tobytes()
    return zstandard.compress(len(parts).to_bytes(4, "little") + sizes + b"".join(parts), 3)


def unpack_chunks(value: bytes) -> list[bytes]:
    raw = zstandard.decompress(value)
    n = int.from_bytes(raw[:4], "little")
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)).tolist()
    return [raw[i:j] for i, j in zip([4 + 4 * n, *ends], ends)]


BLOB = "bucket long, blob binary"


def to_blobs(bucket: np.ndarray, pack: Callable[[np.ndarray], list[bytes]]) -> pa.RecordBatch:
    """One row for each bucket: ``pack(rows)`` of the rows it has."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    groups = np.split(order, edges) if len(order) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[g[0]]) for g in groups], pa.int64()),
         pa.array([pack_chunks(pack(g)) for g in groups], pa.binary())], ["bucket", "blob"])


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list[bytes]]]:
    """Rows sorted by bucket -> the unpacked values of each bucket in turn."""
    now, held = None, []
    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1)):
            if k != now and held:
                yield held
                held = []
            now = k
            held.append(unpack_chunks(blob.as_py()))
    if held:
        yield held
