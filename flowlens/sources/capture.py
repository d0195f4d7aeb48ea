"""Capture files (A1, A2) as a Spark data source: ``format("pcap")``.

Reading:

* ``partitions()`` lists the files and hops over record headers (16 bytes
  each, payloads skipped) to cut every file into chunks of about
  ``chunkBytes`` packet bytes. A chunk ends with the packet that reaches the
  budget, like the reference's byte-budget batches, but here chunks are input
  partitions read in parallel by executors instead of driver-side batches
  broadcast to every executor. ``chunkBytes=0`` makes one partition per file
  and skips the header hop.
* ``read()`` opens its byte range and returns Arrow record batches.
* Little- and big-endian files, microsecond and nanosecond magics are
  accepted. A truncated last record ends the file (``mode=FAILFAST`` raises).

Writing (``df.write.format("pcap")``): each task writes one little-endian
microsecond capture to a temporary name; the driver renames the files of
committed tasks, so a retried or failed task never leaves a partial file.

Schema: ``ts_sec BIGINT, ts_usec INT, orig_len INT, raw BINARY,
capture STRING, ordinal BIGINT`` (ordinal = 0-based packet index in file).
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

# Fixed values of the capture file format.
MAGIC_MICROS = 0xA1B2C3D4
MAGIC_NANOS = 0xA1B23C4D
GLOBAL_HEADER_LEN = 24
RECORD_HEADER_LEN = 16
LINKTYPE_ETHERNET = 1
DEFAULT_SNAPLEN = 262144

SCHEMA_DDL = "ts_sec BIGINT, ts_usec INT, orig_len INT, raw BINARY, capture STRING, ordinal BIGINT"
DEFAULT_CHUNK_BYTES = 64 << 20
BATCH_ROWS = 8192
HOP_BLOCK = 8 << 20


def _fs(uri: str):
    """(filesystem, path) for a local path, a ``file:`` URI or any URI pyarrow
    knows (hdfs://, s3://, ...)."""
    import pyarrow.fs as pafs
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        rest = rest[2:] if rest.startswith("//") else rest   # file:///x and file:/x
        return pafs.LocalFileSystem(), posixpath.abspath(rest)
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), posixpath.abspath(uri)


def list_captures(uri: str) -> list[tuple[str, int]]:
    """(path, size) of the capture files under ``uri`` (a file or folder)."""
    import pyarrow.fs as pafs
    fs, p = _fs(uri)
    prefix = _uri_prefix(uri)
    info = fs.get_file_info(p)
    if info.type == pafs.FileType.File:
        return [(prefix + p, info.size)]
    sel = pafs.FileSelector(p, recursive=True)
    out = [(prefix + i.path, i.size) for i in fs.get_file_info(sel)
           if i.type == pafs.FileType.File and not posixpath.basename(i.path).startswith(("_", "."))
           and "/_temporary" not in i.path]
    return sorted(out)


def _uri_prefix(uri: str) -> str:
    """Scheme (and authority) to put back in front of a filesystem path, so
    listed files can be reopened by ``_fs`` on any task."""
    if "://" not in uri or uri.startswith("file:"):
        return ""
    from urllib.parse import urlparse
    u = urlparse(uri)
    if u.scheme in ("s3", "s3a", "gs", "gcs", "abfs", "abfss"):
        return f"{u.scheme}://"          # pyarrow paths start with the bucket
    return f"{u.scheme}://{u.netloc}"


def parse_global_header(b: bytes) -> tuple[str, bool, int, int]:
    """-> (struct byte-order prefix, nanosecond resolution, snaplen, linktype)."""
    if len(b) < GLOBAL_HEADER_LEN:
        raise ValueError("capture shorter than its 24-byte header")
    for order in ("<", ">"):
        (magic,) = struct.unpack(order + "I", b[:4])
        if magic in (MAGIC_MICROS, MAGIC_NANOS):
            snap, link = struct.unpack(order + "II", b[16:24])
            return order, magic == MAGIC_NANOS, snap, link
    raise ValueError("not a capture file (unknown magic)")


def check_link_type(uri: str, link: int, any_link: bool) -> None:
    """Frames of another link layer would be decoded as Ethernet: refuse them,
    unless the caller reads raw records (``any_link``)."""
    if link & 0xFFFF != LINKTYPE_ETHERNET and not any_link:
        raise ValueError(f"{uri}: link type {link & 0xFFFF} is not Ethernet; pass any_link to read its records")


class Chunk(InputPartition):
    """One input partition: ``count`` records (-1: all) from byte ``start``
    to ``end``."""

    def __init__(self, uri, start, end, count, first_ordinal, order, nanos, snaplen=0):
        super().__init__((uri, start))
        self.uri, self.start, self.end, self.count = uri, start, end, count
        self.first_ordinal, self.order, self.nanos, self.snaplen = first_ordinal, order, nanos, snaplen


def plan_chunks(uri: str, size: int, chunk_bytes: int, failfast: bool = False, any_link: bool = False) -> list[Chunk]:
    """Header hop over one file -> chunks of about ``chunk_bytes`` packet
    bytes (a chunk ends with the packet that reaches the budget)."""
    fs, p = _fs(uri)
    with fs.open_input_file(p) as f:
        order, nanos, snaplen, link = parse_global_header(f.read_at(GLOBAL_HEADER_LEN, 0))
    check_link_type(uri, link, any_link)
    if chunk_bytes <= 0:
        return [Chunk(uri, GLOBAL_HEADER_LEN, size, -1, 0, order, nanos, snaplen)]
    _, _, chunks, gaps = _walk_split(uri, size, size, GLOBAL_HEADER_LEN, chunk_bytes, order, nanos, snaplen)
    if failfast and gaps:
        raise ValueError(f"{uri}: {gaps[0][2]} at byte {gaps[0][0]}")
    return [Chunk(uri, a, b, c, d, order, nanos, snaplen) for a, b, c, d in chunks]


def read_chunk(ch: Chunk, failfast: bool = False):
    """Yield Arrow record batches for one chunk.

    Only the 16-byte record headers are walked in Python (the layout is
    sequential); payloads are never sliced one by one: a numpy mask removes
    the headers from the chunk and the Arrow binary column is built directly
    from the payload buffer and an offsets array.
    """
    import numpy as np
    import pyarrow as pa
    if ch.count < 0:            # a whole file: its records are found here, damaged places left out
        _, _, runs, gaps = _walk_split(ch.uri, ch.end, ch.end, ch.start, CHUNK_IN_TASK, ch.order, ch.nanos, ch.snaplen)
        if failfast and gaps:
            raise ValueError(f"{ch.uri}: {gaps[0][2]} at byte {gaps[0][0]}")
        for a, b, n, rel in runs:
            yield from read_chunk(Chunk(ch.uri, a, b, n, ch.first_ordinal + rel, ch.order, ch.nanos), failfast)
        return
    fs, p = _fs(ch.uri)
    with fs.open_input_file(p) as f:
        data = f.read_at(ch.end - ch.start, ch.start)
    hdr = struct.Struct(ch.order + "IIII")
    n, pos = len(data), 0
    starts: list[int] = []
    while pos + RECORD_HEADER_LEN <= n and len(starts) < ch.count:
        starts.append(pos)
        pos += RECORD_HEADER_LEN + hdr.unpack_from(data, pos)[2]
    if pos > n or len(starts) < ch.count:
        raise ValueError(f"{ch.uri}: changed since it was indexed, at byte {ch.start + pos}")
    if not starts:
        return
    buf = np.frombuffer(data, dtype=np.uint8, count=pos)
    h = np.asarray(starts, dtype=np.int64)
    dt = np.dtype([("s", ch.order + "u4"), ("f", ch.order + "u4"), ("i", ch.order + "u4"), ("o", ch.order + "u4")])
    heads = np.empty(len(h), dtype=dt)
    hb = buf[(h[:, None] + np.arange(RECORD_HEADER_LEN)).ravel()].reshape(len(h), RECORD_HEADER_LEN)
    heads[:] = np.frombuffer(np.ascontiguousarray(hb).tobytes(), dtype=dt)
    keep = np.ones(pos, dtype=bool)
    keep[(h[:, None] + np.arange(RECORD_HEADER_LEN)).ravel()] = False
    payload = buf[keep]
    offsets = np.zeros(len(h) + 1, dtype=np.int64)
    np.cumsum(heads["i"].astype(np.int64), out=offsets[1:])
    frac = heads["f"].astype(np.int64) // (1000 if ch.nanos else 1)
    for a in range(0, len(h), BATCH_ROWS):
        b = min(a + BATCH_ROWS, len(h))
        off = offsets[a:b + 1] - offsets[a]
        raw = pa.BinaryArray.from_buffers(
            pa.binary(), b - a, [None, pa.py_buffer(off.astype(np.int32)),
                                 pa.py_buffer(payload[offsets[a]:offsets[b]])])
        yield pa.RecordBatch.from_arrays(
            [pa.array(heads["s"][a:b].astype(np.int64)), pa.array(frac[a:b].astype(np.int32)),
             pa.array(heads["o"][a:b].astype(np.int32)), raw,
             pa.array([ch.uri] * (b - a), pa.string()),
             pa.array(np.arange(ch.first_ordinal + a, ch.first_ordinal + b, dtype=np.int64))],
            names=["ts_sec", "ts_usec", "orig_len", "raw", "capture", "ordinal"])


# The data source hops headers in its planner (one driver-side process) only
# for small inputs; beyond these bounds it refuses (chunkBytes would not hold),
# and ``read_capture`` indexes the input with a Spark job instead.
DRIVER_HOP_MAX_FILES = 64
DRIVER_HOP_MAX_BYTES = 4 << 30


class CaptureReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        self.chunk_bytes = int(options.get("chunkBytes", DEFAULT_CHUNK_BYTES))
        self.failfast = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.any_link = options.get("anyLink", "false").lower() == "true"

    def partitions(self):
        files = list_captures(self.path)
        if self.chunk_bytes > 0 and (len(files) > DRIVER_HOP_MAX_FILES
                                     or sum(sz for _, sz in files) > DRIVER_HOP_MAX_BYTES):
            raise ValueError("too much for the planner of format('pcap'): use read_capture, or chunkBytes 0")
        parts: list[Chunk] = []
        for uri, size in files:
            parts.extend(plan_chunks(uri, size, self.chunk_bytes, self.failfast, self.any_link))
        return parts or [Chunk("", 0, 0, 0, 0, "<", False)]

    def read(self, partition: Chunk):
        if not partition.uri:
            return iter(())
        return read_chunk(partition, self.failfast)


@dataclass
class _Written(WriterCommitMessage):
    tmp: str
    final: str
    packets: int


def _records_bytes(batch) -> bytes:
    """One Arrow batch (ts_sec, ts_usec, orig_len, raw) -> capture records:
    the 16-byte headers are built as a numpy array and inserted in front of
    every payload of the Arrow values buffer in one ``np.insert``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    m = batch.num_rows
    if m == 0:
        return b""
    raw = batch.column(batch.schema.get_field_index("raw"))
    if raw.null_count:
        raw = pc.fill_null(raw, pa.scalar(b"", pa.binary()))
    raw = pa.concat_arrays([raw]) if raw.offset else raw
    lens = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    offs = np.frombuffer(raw.buffers()[1], dtype=np.int32, count=m + 1).astype(np.int64)
    vals = raw.buffers()[2]
    body = (np.frombuffer(vals, dtype=np.uint8)[offs[0]:offs[-1]] if vals is not None
            else np.zeros(0, dtype=np.uint8))
    def col(name):
        return batch.column(batch.schema.get_field_index(name)).fill_null(0).to_numpy(zero_copy_only=False)
    orig_arr = batch.column(batch.schema.get_field_index("orig_len"))
    orig = pc.if_else(pc.is_null(orig_arr), pa.array(lens, pa.int64()), orig_arr.cast(pa.int64()))
    orig = orig.to_numpy(zero_copy_only=False).astype(np.int64)
    heads = np.empty(m, dtype=[("s", "<u4"), ("f", "<u4"), ("i", "<u4"), ("o", "<u4")])
    heads["s"] = col("ts_sec").astype(np.int64) & 0xFFFFFFFF
    heads["f"] = col("ts_usec").astype(np.int64)
    heads["i"] = lens
    heads["o"] = orig
    hb = heads.view(np.uint8).reshape(m, RECORD_HEADER_LEN)
    at = np.repeat(offs[:-1] - offs[0], RECORD_HEADER_LEN)
    return np.insert(body, at, hb.ravel()).tobytes()


class CaptureWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options.get("path")
        self.overwrite = overwrite
        self.snaplen = int(options.get("snaplen", DEFAULT_SNAPLEN))
        self.job = uuid.uuid4().hex[:12]        # in every name: an append never meets another job's files

    def write(self, iterator):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid, attempt = (ctx.partitionId(), ctx.attemptNumber()) if ctx else (0, 0)
        fs, root = _fs(self.path)
        tmp_dir = posixpath.join(root, f"_temporary-{self.job}")
        fs.create_dir(tmp_dir, recursive=True)
        tmp = posixpath.join(tmp_dir, f"part-{pid:05d}-{ctx.taskAttemptId() if ctx else attempt}.pcap")
        n = 0
        with fs.open_output_stream(tmp) as out:
            out.write(struct.pack("<IHHiIII", MAGIC_MICROS, 2, 4, 0, 0, self.snaplen, LINKTYPE_ETHERNET))
            for batch in iterator:
                out.write(_records_bytes(batch))
                n += batch.num_rows
        return _Written(tmp, posixpath.join(root, f"part-{pid:05d}-{self.job}.pcap"), n)

    def commit(self, messages):
        fs, root = _fs(self.path)
        if self.overwrite:
            for p, _ in list_captures(self.path):
                fs.delete_file(p)
        for m in messages:
            if m is not None:
                fs.move(m.tmp, m.final)
        fs.delete_dir(posixpath.join(root, f"_temporary-{self.job}"))
        with fs.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass   # completion marker, as Hadoop output committers write

    def abort(self, messages):
        fs, root = _fs(self.path)
        try:
            fs.delete_dir(posixpath.join(root, f"_temporary-{self.job}"))
        except OSError:
            pass


class CaptureDataSource(DataSource):
    @classmethod
    def name(cls):
        return "pcap"

    def schema(self):
        return SCHEMA_DDL

    def reader(self, schema):
        return CaptureReader(self.options)

    def writer(self, schema, overwrite):
        return CaptureWriter(self.options, overwrite)


def register(spark) -> None:
    """Make ``format("pcap")`` available in this session."""
    from flowlens.session import ship_package
    ship_package(spark)
    spark.dataSource.register(CaptureDataSource)


CHUNK_SCHEMA = "uri STRING, start BIGINT, end BIGINT, count BIGINT, first_ordinal BIGINT, order STRING, nanos BOOLEAN"
PACKET_SCHEMA = SCHEMA_DDL
# Large files are indexed in parallel byte splits: each split finds a record
# boundary by itself (a chain of plausible headers) and walks to the first
# record past its end; the driver checks that consecutive splits meet.
SPLIT_BYTES = 1 << 30
SYNC_RECORDS = 16
SYNC_WINDOW = 4 << 20
CHUNK_IN_TASK = 64 << 20        # payload bytes of a whole-file task held at once
SPLIT_SCHEMA = ("uri STRING, size BIGINT, split BIGINT, lo BIGINT, hi BIGINT, entry BIGINT, exit BIGINT, "
                "records BIGINT, chunks ARRAY<STRUCT<start: BIGINT, end: BIGINT, count: BIGINT, rel: BIGINT>>, "
                "gaps ARRAY<STRUCT<start: BIGINT, end: BIGINT, reason: STRING>>, "
                "order STRING, nanos BOOLEAN, n_gaps BIGINT, first_gap BIGINT, first_reason STRING")
GAP_SCHEMA = "capture STRING, start BIGINT, end BIGINT, reason STRING"


def _plausible(buf: bytes, pos: int, hdr, snaplen: int, nanos: bool, size_left: int) -> bool:
    """SYNC_RECORDS consecutive headers at ``pos`` that could be records: a
    fraction below a second, a length within snaplen (0: no limit) and the
    packet's, no empty packet, and times at most a day apart."""
    frac_max = 1_000_000_000 if nanos else 1_000_000
    before = None
    for _ in range(SYNC_RECORDS):
        if pos == size_left:                      # exactly at the end of the file
            return True
        if pos + RECORD_HEADER_LEN > len(buf):    # past the read window
            return pos + RECORD_HEADER_LEN > size_left or len(buf) < size_left
        sec, frac, incl, orig = hdr.unpack_from(buf, pos)
        if frac >= frac_max or not incl or snaplen and incl > snaplen or incl > orig or \
                before is not None and abs(sec - before) > 86_400:
            return False
        before = sec
        pos += RECORD_HEADER_LEN + incl
    return True


def _sync_entry(uri, size, lo, order, nanos, snaplen):
    """First offset >= lo where a chain of plausible headers starts."""
    fs, p = _fs(uri)
    hdr = struct.Struct(order + "IIII")
    with fs.open_input_file(p) as f:
        buf = f.read_at(min(SYNC_WINDOW + (1 << 20), size - lo), lo)
    for i in range(0, min(SYNC_WINDOW, len(buf))):
        if _plausible(buf, i, hdr, snaplen, nanos, size - lo):
            return lo + i
    return size   # no record starts in this window: the split is empty


def _next_chain(f, size, pos, hdr, nanos, snaplen):
    """First offset >= pos where SYNC_RECORDS plausible records follow one
    another, or fewer that end with the file; ``size`` if there is none."""
    while pos < size:
        buf = f.read_at(min(SYNC_WINDOW + (1 << 20), size - pos), pos)
        for i in range(0, min(SYNC_WINDOW, len(buf))):
            if _plausible(buf, i, hdr, snaplen, nanos, size - pos) and _ends_well(buf, i, hdr, size - pos):
                return pos + i
        pos += SYNC_WINDOW
    return size


def _ends_well(buf, pos, hdr, size_left):
    """Whether the records from ``pos`` on stay inside the file: a short chain
    counts only if it ends exactly with it."""
    for _ in range(SYNC_RECORDS):
        if pos == size_left:
            return True
        if pos + RECORD_HEADER_LEN > len(buf):
            return len(buf) < size_left
        pos += RECORD_HEADER_LEN + hdr.unpack_from(buf, pos)[2]
        if pos > size_left:
            return False
    return True


def _walk_split(uri, size, hi, entry, chunk_bytes, order, nanos=False, snaplen=0):
    """Walk records from ``entry`` to the first record starting at or after
    ``hi`` (or the end of the file) -> (exit, records, chunks, gaps).

    A header that cannot be a record's (it ends past the file, is longer than
    any snap length or has a fraction of a second and more) is damage: the walk
    goes on from the next proven chain, and a gap (start, end, reason) says what
    was left out. Only a walk from a proven entry may be judged by its gaps: a
    split that synced on payload bytes goes anywhere."""
    fs, p = _fs(uri)
    hdr = struct.Struct(order + "IIII")
    chunks, gaps, pos, n = [], [], entry, 0
    c_start, c_count, c_rel, c_bytes = pos, 0, 0, 0
    frac_max = 1_000_000_000 if nanos else 1_000_000
    longest = max(snaplen, DEFAULT_SNAPLEN) if snaplen else 1 << 32
    with fs.open_input_file(p) as f:
        block, block_off = b"", pos
        while pos < hi:
            if pos + RECORD_HEADER_LEN > block_off + len(block):
                block_off = pos
                block = f.read_at(min(HOP_BLOCK, max(size - pos, 0)), pos) if pos < size else b""
            reason = None
            if pos + RECORD_HEADER_LEN > block_off + len(block):
                if pos >= size:
                    break
                reason = "truncated record"
            else:
                _, frac, incl, _ = hdr.unpack_from(block, pos - block_off)
                nxt = pos + RECORD_HEADER_LEN + incl
                if nxt > size:
                    reason = "truncated record"
                elif incl > longest or frac >= frac_max:
                    reason = "damaged header"
            if reason:
                to = _next_chain(f, size, pos + 1, hdr, nanos, snaplen)
                gaps.append((pos, to, reason))
                if c_count:
                    chunks.append((c_start, pos, c_count, c_rel))
                pos = to
                c_start, c_count, c_rel, c_bytes = pos, 0, n, 0
                continue
            n += 1
            c_count += 1
            c_bytes += incl
            pos = nxt
            if chunk_bytes > 0 and c_bytes >= chunk_bytes:
                chunks.append((c_start, pos, c_count, c_rel))
                c_start, c_count, c_rel, c_bytes = pos, 0, n, 0
    if c_count:
        chunks.append((c_start, pos, c_count, c_rel))
    return pos, n, chunks, gaps


def _index_splits(chunk_bytes: int, forced: dict | None = None, any_link: bool = False):
    def fn(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                fs, p = _fs(r.uri)
                with fs.open_input_file(p) as f:
                    order, nanos, snaplen, link = parse_global_header(f.read_at(GLOBAL_HEADER_LEN, 0))
                check_link_type(r.uri, link, any_link)
                key = (r.uri, int(r.split))
                if forced and key in forced:
                    entry = forced[key]
                elif r.split == 0:
                    entry = GLOBAL_HEADER_LEN
                else:
                    entry = _sync_entry(r.uri, int(r.size), int(r.lo), order, nanos, snaplen)
                exit_, n, chunks, gaps = _walk_split(r.uri, int(r.size), int(r.hi), entry, chunk_bytes, order, nanos, snaplen)
                first = gaps[0] if gaps else (-1, -1, "")
                out.append((r.uri, int(r.size), int(r.split), int(r.lo), int(r.hi), entry, exit_, n,
                            [{"start": a, "end": b, "count": c, "rel": d} for a, b, c, d in chunks],
                            [{"start": a, "end": b, "reason": c} for a, b, c in gaps],
                            order, nanos, len(gaps), first[0], first[2]))
            yield pd.DataFrame(out, columns=["uri", "size", "split", "lo", "hi", "entry", "exit", "records",
                                             "chunks", "gaps", "order", "nanos", "n_gaps", "first_gap", "first_reason"])
    return fn


def _index_files_in_splits(spark, files, chunk_bytes, failfast, split_bytes, forced=None, any_link=False):
    """Spark job: one index row per byte split. The driver checks that split
    k's exit equals split k+1's entry; all splits that disagree, in all files,
    are walked again in one job from the exit before them, until every chain
    is exact. The first such split of a file is right after each round.
    Returns (split table, forced entries, {(uri, split): row})."""
    rows = []
    for uri, size in files:
        n = max(1, -(-max(size - GLOBAL_HEADER_LEN, 1) // split_bytes))
        for k in range(n):
            lo = GLOBAL_HEADER_LEN + k * split_bytes
            rows.append((uri, size, k, lo, min(size, lo + split_bytes)))
    sdf = spark.createDataFrame(rows, "uri STRING, size BIGINT, split BIGINT, lo BIGINT, hi BIGINT")
    sdf = sdf.repartition(max(1, len(rows)))
    forced = dict(forced or {})
    idx = {(r.uri, r.split): r for r in
           sdf.mapInPandas(_index_splits(chunk_bytes, forced, any_link), SPLIT_SCHEMA).drop("chunks", "gaps").collect()}
    while True:
        fix = {(uri, k): idx[(uri, k - 1)].exit for (uri, k), r in idx.items()
               if k > 0 and idx[(uri, k - 1)].exit != r.entry}
        if not fix:
            break
        forced.update(fix)
        again = spark.createDataFrame([r for r in rows if (r[0], r[2]) in fix], sdf.schema)
        redo = again.repartition(len(fix)).mapInPandas(_index_splits(chunk_bytes, forced, any_link), SPLIT_SCHEMA)
        for r in redo.drop("chunks", "gaps").collect():
            idx[(r.uri, r.split)] = r
    gaps = [(uri, r) for (uri, _), r in sorted(idx.items()) if r.n_gaps]
    if failfast and gaps:
        raise ValueError(f"{gaps[0][0]}: {gaps[0][1].first_reason} at byte {gaps[0][1].first_gap}")
    return sdf, forced, idx


def _read_chunks(failfast: bool):
    def fn(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ch = Chunk(r["uri"], r["start"], r["end"], r["count"], r["first_ordinal"], r["order"], r["nanos"])
                yield from read_chunk(ch, failfast)
    return fn


def read_capture_indexed(spark, path: str, chunk_bytes: int = DEFAULT_CHUNK_BYTES, failfast: bool = False,
                         split_bytes: int = SPLIT_BYTES, any_link: bool = False, _forced: dict | None = None):
    """A1 + A2 for large inputs: the header hop is a Spark job over byte
    splits of every file (a file of any size is indexed by many tasks),
    giving a small chunk table (one row per ``chunk_bytes`` of packets) whose
    chunks are then read in parallel. Only file names, offsets and one small
    row per split (to check the chain) pass through the driver."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from flowlens.session import ship_package
    ship_package(spark)
    files = list_captures(path)
    if not files:
        return spark.createDataFrame([], PACKET_SCHEMA)
    sdf, forced, idx = _index_files_in_splits(spark, files, chunk_bytes, failfast, split_bytes, _forced, any_link)
    # ordinal of each split's first record: running count over the splits
    offs = spark.createDataFrame([(u, k, r.records) for (u, k), r in idx.items()],
                                 "uri STRING, split BIGINT, records BIGINT")
    w = Window.partitionBy("uri").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offs = offs.select("uri", "split", F.coalesce(F.sum("records").over(w), F.lit(0)).alias("base"))
    full = sdf.mapInPandas(_index_splits(chunk_bytes, forced, any_link), SPLIT_SCHEMA)
    chunks = (full.join(offs, ["uri", "split"])
                  .select("uri", "order", "nanos", "base", F.explode("chunks").alias("c"))
                  .select("uri", F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                          F.col("c.count").alias("count"), (F.col("base") + F.col("c.rel")).alias("first_ordinal"),
                          "order", "nanos"))
    chunks = chunks.checkpoint()          # a small table; fixes the chunk list for retries
    n = chunks.count()
    return chunks.repartition(max(1, n)).mapInArrow(_read_chunks(failfast), PACKET_SCHEMA)


def read_capture(spark, path: str, chunk_bytes: int = DEFAULT_CHUNK_BYTES, failfast: bool = False,
                 index: str = "auto", any_link: bool = False):
    """A1 + A2: capture file(s) -> packets DataFrame.

    Damaged places are left out, and what follows them is read; ``capture_gaps``
    lists them, ``failfast`` raises instead. Files of another link type than
    Ethernet are refused unless ``any_link``.

    ``index``: ``driver`` plans chunks in the data source (small inputs),
    ``spark`` indexes with a Spark job (many or large files), ``auto`` picks
    by the number and size of the files.
    """
    if index == "auto":
        files = list_captures(path)
        small = len(files) <= DRIVER_HOP_MAX_FILES and sum(sz for _, sz in files) <= DRIVER_HOP_MAX_BYTES
        index = "driver" if small or chunk_bytes <= 0 else "spark"
    if index == "spark":
        return read_capture_indexed(spark, path, chunk_bytes, failfast, any_link=any_link)
    register(spark)
    return (spark.read.format("pcap").option("chunkBytes", str(chunk_bytes))
            .option("mode", "FAILFAST" if failfast else "PERMISSIVE").option("anyLink", str(any_link).lower()).load(path))


def capture_gaps(spark, path: str, split_bytes: int = SPLIT_BYTES):
    """Damage table of capture file(s): a row (capture, start, end, reason) for
    each stretch of bytes that ``read_capture`` leaves out. No row: all read."""
    from pyspark.sql import functions as F
    from flowlens.session import ship_package
    ship_package(spark)
    files = list_captures(path)
    if not files:
        return spark.createDataFrame([], GAP_SCHEMA)
    sdf, forced, _ = _index_files_in_splits(spark, files, 0, False, split_bytes, any_link=True)
    return sdf.mapInPandas(_index_splits(0, forced, True), SPLIT_SCHEMA).select(
        F.col("uri").alias("capture"), F.explode("gaps").alias("g")).select("capture", "g.start", "g.end", "g.reason")


def write_capture(df, path: str, mode: str = "overwrite") -> None:
    """Packets (ts_sec, ts_usec, orig_len, raw) -> one capture file per task."""
    register(df.sparkSession)
    df.select("ts_sec", "ts_usec", "orig_len", "raw").write.format("pcap").mode(mode).save(path)
