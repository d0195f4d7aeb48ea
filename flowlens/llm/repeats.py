"""Repeated windows: which windows of W tokens also occur earlier.

Shared plumbing of the two substring operators. Shuffling every suffix of a
corpus costs tens of times its size, so suffixes are first thinned without
losing a match:

1. Every window of W tokens picks its least k-token gram (by hash, rightmost
   of ties). Equal windows pick the same gram at the same place, so a window
   can only repeat if its gram does. Only the picked grams, about one in
   (W-k)/2 tokens, are shuffled (hash, document address, place).
2. A gram met once in the whole corpus ends here. The rest go back to their
   documents, and the stretch of tokens under the windows that picked it (a
   run) is shuffled by the gram, equal runs of a task once.
3. Each group of runs is resolved by exact comparison of tokens; the two
   operators bring their own way (suffix trees; radix passes). It yields the
   windows that are not the first, and these are taken out of the texts.

What is shuffled travels as compressed blobs, one row for each sending task and
bucket; the buckets (as many as shuffle partitions) are handled one at a time.

Hot grams: a gram met more than ``HOT_BATCH`` times among a task's grams at
hand or ``HOT_TOTAL`` times in all is not a usable key. Its runs are sent window by
window with the whole window as key, after equal windows at hand are
reduced to one. So a phrase in a third of all documents spreads over as many
keys as it has contexts, and a key gets a row or so for each task.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import (
    BLOB,
    U64,
    binary_views,
    by_bucket,
    chunks,
    mix64,
    releasing,
    ship,
    sliding_min,
    small,
    to_blobs,
)

HOT_BATCH, HOT_TOTAL = 256, 20_000
HELD = 12 << 20                     # bytes of compressed documents whose equal runs are met before any is shuffled
CHUNK = 1 << 19                     # tokens handled at once; longer documents go in overlapping slices
_POS = U64((1 << 24) - 1)
LAST_ID = (1 << 63) - 1             # order of a null id: after all others


@dataclass(frozen=True)
class Tokens:
    """How an operator cuts bytes into tokens. ``grams(data, bounds)`` gives
    the k-gram hashes and token bounds of neighbouring documents; ``cut(doc)``
    a sliceable of one document's tokens; ``join`` the bytes of a slice."""
    window: int
    gram: int
    grams: Callable
    cut: Callable
    join: Callable


def picked(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram place, first window, last window) of every run of neighbouring
    windows that pick the same gram. ``bounds``: token bounds of documents."""
    n = int(bounds[-1])
    if n < window:
        return (np.zeros(0, np.int64),) * 3
    key = (hashes & ~_POS) | (_POS - np.arange(len(hashes), dtype=U64))
    place = (_POS - (sliding_min(key, window - gram + 1) & _POS)).astype(np.int64)
    lens = np.diff(bounds)
    at = np.arange(n - window + 1)
    inside = np.repeat(bounds[1:], lens)[:len(at)] - at >= window
    at, place = at[inside], place[inside]
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    new = np.flatnonzero((np.diff(place) != 0) | (np.diff(at) != 1)) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(at)])) - 1
    return place[first], at[first], at[last]


def _runs(tokens: Tokens, col: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, gram hash, gram place, windows before it: most, least) by chunk;
    places count from the document's start."""
    offs, data = binary_views(col)
    for i, j in chunks(np.diff(offs), CHUNK):
        h, bounds = tokens.grams(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        lo, n = 0, int(bounds[-1])
        while True:                                    # one slice, unless one document is very long
            hi = min(n, lo + CHUNK * 4)
            inner = np.clip(bounds, lo, hi) - lo
            g, first, last = picked(h[lo:max(lo, hi - tokens.gram + 1)], inner, tokens.window, tokens.gram)
            row = np.searchsorted(inner, g, side="right") - 1
            start = bounds[row] - lo
            yield row + i, h[lo:][g], g - start, g - first, g - last
            if hi == n:
                break
            lo = hi - tokens.window + 1


def _anchor_rows(tokens: Tokens, buckets: int) -> Callable:
    """(uid, bytes) -> picked grams (hash, uid, place and state) in buckets by
    hash. Of a gram hot among the grams at hand only the first row goes to its
    own bucket; the others, known to repeat and to be hot, spread by uid."""
    def send(parts: list[tuple]) -> pa.RecordBatch:
        h, uid, packed = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h, kind="stable")
        new = np.concatenate(([True], np.diff(h[order]) != 0))
        crowded = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > HOT_BATCH
        state = np.zeros(len(h), np.int8)
        state[order] = crowded.astype(np.int8) + (crowded & ~new)
        bucket = (np.where(state == 2, mix64(uid.view(U64)), h) % U64(buckets)).astype(np.int64)
        packed = packed | (state > 0)
        return to_blobs(bucket, lambda r: [h[r].tobytes(), uid[r].tobytes(), packed[r].tobytes(), state[r].tobytes()])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            uids = b.column(0).to_numpy()
            for row, h, g, most, least in _runs(tokens, b.column(1)):
                if len(h):
                    parts.append((h, uids[row], (g << 17) | (most << 9) | (least << 1)))
                    size += len(h)
            if size > 1 << 20:
                yield send(parts)
                parts, size = [], 0
        if size:
            yield send(parts)
    return run


def _repeated(buckets: int) -> Callable:
    """Grams of a bucket -> (uid, packed) of those met twice or known hot, in
    buckets by uid; the lowest bit of ``packed`` says that the gram is hot."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in by_bucket(batches):
            h, uid, packed, state = (np.concatenate([np.frombuffer(x[i], t) for x in got])
                                     for i, t in enumerate(("<u8", "<i8", "<i8", "i1")))
            own = np.flatnonzero(state < 2)
            own = own[np.argsort(h[own], kind="stable")]
            out, flags = [np.flatnonzero(state == 2)], [np.zeros(0, np.int64)]
            if len(own):
                group = np.cumsum(np.concatenate(([True], np.diff(h[own]) != 0))) - 1
                size = np.bincount(group)
                hot = (np.bincount(group, state[own]) > 0) | (size > HOT_TOTAL)
                keep = (hot | (size > 1))[group]
                out.append(own[keep])
                flags.append(hot[group][keep].astype(np.int64))
            rows = np.concatenate(out)
            if len(rows):
                u, p = uid[rows], packed[rows] | np.concatenate([np.ones(len(out[0]), np.int64), flags[-1]])
                bucket = (mix64(u.view(U64)) % U64(buckets)).astype(np.int64)
                yield to_blobs(bucket, lambda r: [u[r].tobytes(), p[r].tobytes()])
    return run


@releasing
def _by_uid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flagged grams of a bucket -> one row for each document."""
    for got in by_bucket(batches):
        u, p = (np.concatenate([np.frombuffer(x[i], "<i8") for x in got]) for i in range(2))
        order = np.lexsort((p, u))
        u, p = u[order], p[order]
        at = np.concatenate(([0], np.flatnonzero(np.diff(u)) + 1, [len(u)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(u[at[:-1]]), pa.array([p[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())],
            ["uid", "packed"])


def _merged_rows(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns (doc, uid, start, end) in order of uid, doc and start, the spans
    of one document merged, and where each document begins."""
    r = r[:, np.lexsort((r[2], r[0], r[1]))]
    other = np.concatenate(([True], (np.diff(r[0]) != 0) | (np.diff(r[1]) != 0)))
    far = np.cumsum(other) << 32                       # places are below 2^31: no document reaches into the next
    end = np.maximum.accumulate(far + r[3])
    new = np.flatnonzero(np.concatenate(([True], (far + r[2])[1:] > end[:-1])))
    last = np.concatenate((new[1:], [r.shape[1]])) - 1
    return np.stack([r[0, new], r[1, new], r[2, new], (end - far)[last]]), np.flatnonzero(other[new])


class _Spans:
    """Windows to be removed: (doc, uid, start, end), sent in buckets by uid."""

    def __init__(self, window: int):
        self.window, self.rows = window, array("q")

    def __len__(self) -> int:
        return len(self.rows) // 4

    def add(self, doc: int, uid: int, places: list[int], windows: int) -> None:
        for p in places:
            self.rows.extend((doc, uid, p, p + windows + self.window - 1))

    def add_windows(self, doc: np.ndarray, uid: np.ndarray, place: np.ndarray) -> None:
        if len(doc):
            r, _ = _merged_rows(np.stack([doc, uid, place, place + self.window]))
            self.rows.frombytes(np.ascontiguousarray(r.T).tobytes())

    def send(self, buckets: int) -> pa.RecordBatch:
        r, _ = _merged_rows(np.array(self.rows, "<i8").reshape(-1, 4).T)
        self.rows = array("q")
        bucket = (mix64(r[1].view(U64)) % U64(buckets)).astype(np.int64)
        return to_blobs(bucket, lambda x: [r[:, x].tobytes()])


@releasing
def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of a bucket -> one row for each document, its spans merged."""
    for got in by_bucket(batches):
        r, first = _merged_rows(np.concatenate([np.frombuffer(x[0], "<i8").reshape(4, -1) for x in got], axis=1))
        pairs = np.ascontiguousarray(r[2:].T).astype("<i8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(r[0, first]), pa.array(r[1, first]),
             pa.array([pairs[i:j].tobytes() for i, j in zip(first, [*first[1:], len(pairs)])], pa.binary())],
            ["doc", "uid", "spans"])


class _Firsts:
    """Of equal runs the earliest: of smaller documents, or of all places.

    ``strict`` (only a smaller document counts): later documents' runs are
    repeats, several places of the first document all stay. Otherwise only the
    first place of the first document stays.
    """

    def __init__(self, strict: bool, spans: _Spans):
        self.strict, self.spans, self.best = strict, spans, {}

    def add(self, at: tuple, doc: int, uid: int, places: list[int]) -> None:
        windows, old = at[1], self.best.get(at)
        if old is None:
            self.best[at] = [doc, {uid: places}]
        elif old[0] < doc:
            self.spans.add(doc, uid, places, windows)
        elif old[0] > doc:
            for u, ps in old[1].items():
                self.spans.add(old[0], u, ps, windows)
            self.best[at] = [doc, {uid: places}]
        else:
            old[1].setdefault(uid, []).extend(places)

    def close(self) -> Iterator[tuple]:
        """(at, doc, uid, places) that are first, as far as is known here."""
        for at, (doc, by) in self.best.items():
            if not self.strict and (len(by) > 1 or len(next(iter(by.values()))) > 1):
                least = min(min(ps) for ps in by.values())
                for u, ps in by.items():
                    self.spans.add(doc, u, [p for p in ps if p != least], at[1])
                by = {u: [least] for u, ps in by.items() if least in ps}
            for u, ps in by.items():
                yield at, doc, u, ps
        self.best = {}


def _run_blobs(rows: list[tuple], buckets: int) -> pa.RecordBatch:
    """rows: (key, doc, uid, places, windows, data), in buckets by key."""
    key = np.array([r[0] for r in rows], U64)
    def pack(at: np.ndarray) -> list[bytes]:
        own = [rows[i] for i in at]
        return [np.array([r[j] for r in own], "<i8" if j else "<u8").tobytes() for j in (0, 1, 2, 4)] + \
            [np.array([len(r[j]) for r in own], "<u4").tobytes() for j in (3, 5)] + \
            [np.array([p for r in own for p in r[3]], "<i8").tobytes(), b"".join(r[5] for r in own)]
    return to_blobs((key % U64(buckets)).astype(np.int64), pack)


def _unpacked_runs(value: list[bytes]) -> Iterator[tuple]:
    key, doc, uid, windows = (np.frombuffer(value[j], "<i8" if j else "<u8").tolist() for j in range(4))
    n_places, n_data = (np.frombuffer(value[j], "<u4").tolist() for j in (4, 5))
    places, data, i, j = np.frombuffer(value[6], "<i8").tolist(), value[7], 0, 0
    for k, d, u, w, n, m in zip(key, doc, uid, windows, n_places, n_data):
        yield k, d, u, places[i:i + n], w, data[j:j + m]
        i, j = i + n, j + m


def _run_rows(tokens: Tokens, strict: bool, buckets: int) -> Callable:
    """(doc, uid, body, packed) -> runs under repeated grams, equal ones at
    hand once, in buckets by key; spans settled here go to buckets below 0."""
    w, k = tokens.window, tokens.gram

    def key(g: int | None, data: bytes) -> int:
        """Of the gram at ``g`` or, where that is hot (None), of the window."""
        return xxhash.xxh64_intdigest(data, 1) if g is None else \
            xxhash.xxh64_intdigest(tokens.join(tokens.cut(data)[g:g + k]))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _Spans(w)
        firsts = _Firsts(strict, spans)
        add, join = firsts.add, tokens.join
        unzip, held = zstandard.ZstdDecompressor().decompress, 0
        for b in small(batches):
            for doc, uid, body, packed in zip(*(b.column(i).to_pylist() for i in range(4))):
                toks = tokens.cut(unzip(body))
                x = np.frombuffer(packed, "<i8")
                for g, most, least, hot in zip((x >> 17).tolist(), (x >> 9 & 255).tolist(),
                                               (x >> 1 & 255).tolist(), (x & 1).tolist()):
                    if hot:
                        for p in range(g - most, g - least + 1):
                            add((join(toks[p:p + w]), 1, None), doc, uid, [p])
                    else:
                        add((join(toks[g - most:g - least + w]), most - least + 1, most), doc, uid, [g - most])
            held += b.nbytes
            if held > HELD:
                yield from settled(firsts, spans)
                held = 0
        yield from settled(firsts, spans)

    def settled(firsts: _Firsts, spans: _Spans) -> Iterator[pa.RecordBatch]:
        # Equal runs have their gram at the same place, and it is hot in all or in none.
        rows = [(key(g, data), doc, uid, ps, n, data) for (data, n, g), doc, uid, ps in firsts.close()]
        if rows:
            yield _run_blobs(rows, buckets)
        if len(spans):
            sent = spans.send(buckets)
            yield pa.RecordBatch.from_arrays([pa.array(-1 - sent.column(0).to_numpy()), sent.column(1)],
                                             ["bucket", "blob"])
    return run


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in it) of all places of rows of these sizes."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _resolve(tokens: Tokens, strict: bool, groups: Callable, buckets: int) -> Callable:
    """Runs sorted by bucket -> spans, in buckets by uid.

    Equal runs are settled first; the groups in which different runs are left
    go to ``groups`` some at a time, window by window: (group by run, tokens by
    run, run by window, start by window) gives the windows met twice and, in
    ascending order, the number of the set of equal windows each is in."""
    w = tokens.window

    def settle(todo: list[list[tuple]], spans: _Spans) -> None:
        """todo: by group, the runs left: (data, windows, doc, uid, places)."""
        runs = [(gi, *run) for gi, own in enumerate(todo) for run in own]
        if not runs:
            return
        group, data, windows, doc, uid, places = zip(*runs)
        group, windows, doc, uid = (np.array(x, np.int64) for x in (group, windows, doc, uid))
        run, at = _ragged(windows)
        rows, sets = groups(group, [tokens.cut(x) for x in data], run, at)
        if not len(rows):
            return
        # Every place of every window that is met twice.
        n = np.array([len(p) for p in places])
        flat, begin = np.array([p for ps in places for p in ps], np.int64), np.cumsum(n) - n
        of, nth = _ragged(n[run[rows]])
        own = run[rows][of]
        place, docs = flat[begin[own] + nth] + at[rows][of], doc[own]
        edge = np.flatnonzero(np.concatenate(([True], np.diff(sets[of]) != 0)))
        size = np.diff(np.concatenate((edge, [len(of)])))
        later = docs > np.repeat(np.minimum.reduceat(docs, edge), size)
        gone = later
        if not strict:
            least = np.minimum.reduceat(np.where(later, LAST_ID, place), edge)
            gone = later | (place != np.repeat(least, size))
        spans.add_windows(docs[gone], uid[own][gone], place[gone])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _Spans(w)

        def split() -> Iterator[pa.RecordBatch]:
            """Lets run buckets through; span buckets only change hands."""
            nonlocal passed
            for b in batches:
                own = b.column(0).to_numpy() >= 0
                if not own.all():
                    passed.append(pa.RecordBatch.from_arrays(
                        [pa.array(-1 - b.column(0).to_numpy()[~own]), b.column(1).filter(pa.array(~own))],
                        ["bucket", "blob"]))
                yield b.filter(pa.array(own))

        passed: list[pa.RecordBatch] = []
        for got in by_bucket(split()):
            yield from passed
            passed = []
            by_key: dict[int, list[tuple]] = {}
            for value in got:
                for r in _unpacked_runs(value):
                    by_key.setdefault(r[0], []).append(r)
            firsts, todo, size = _Firsts(strict, spans), [], 0
            for rows in by_key.values():
                if len(rows) < 2 and (strict or len(rows[0][3]) < 2):
                    continue
                for _, doc, uid, places, n, data in rows:
                    firsts.add((0, n, data), doc, uid, places)
                left = [(data, n, doc, uid, ps) for (_, n, data), doc, uid, ps in firsts.close()]
                if len({x[0] for x in left}) > 1:
                    todo.append(left)
                    size += sum(x[1] for x in left)
                if size > 50_000:
                    settle(todo, spans)
                    todo, size = [], 0
            settle(todo, spans)
            if len(spans) > 200_000:
                yield spans.send(buckets)
        yield from passed
        if len(spans):
            yield spans.send(buckets)
    return run


@releasing
def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3).compress
    for b in small(batches):
        yield b.set_column(2, "body", pa.array([press(x) for x in b.column(2).to_pylist()], pa.binary()))


def mark_repeats(docs: DataFrame, id_col: str, text_col: str, tokens: Tokens, strict: bool,
                 groups: Callable) -> tuple[DataFrame, list[str]]:
    """``docs`` as (row struct of the columns beside the text, body: zstd of
    its UTF-8, spans: merged int64 [start, end) pairs of tokens or null), and
    the struct's fields."""
    ship(docs)
    fields = [c for c in docs.columns if c.lower() != text_col.lower()]
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"),
                      F.struct(*[F.col(f"`{c}`") for c in fields]).alias("row"))
    src = src.withColumn("uid", F.xxhash64("doc", "body")).select("doc", "uid", "body", "row")
    # One exchange of the texts, by row address; both joins below use it.
    placed = src.mapInArrow(_zipped, src.schema).repartition("uid")

    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("bucket").sortWithinPartitions("bucket")

    anchors = src.select("uid", "body").mapInArrow(_anchor_rows(tokens, buckets), BLOB)
    flagged = (dealt(dealt(anchors).mapInArrow(_repeated(buckets), BLOB))
               .mapInArrow(_by_uid, "uid long, packed binary"))
    runs = (placed.join(flagged, "uid").select("doc", "uid", "body", "packed")
            .mapInArrow(_run_rows(tokens, strict, buckets), BLOB))
    spans = (dealt(dealt(runs).mapInArrow(_resolve(tokens, strict, groups, buckets), BLOB))
             .mapInArrow(_merged, "doc long, uid long, spans binary"))
    out = placed.join(spans, ["uid", "doc"], "left").select("row", "body", "spans")
    return out, fields


def unzipped(col: pa.Array) -> list[bytes]:
    back = zstandard.ZstdDecompressor().decompress
    return [back(x) for x in col.to_pylist()]


def all_spans(parts: pa.Scalar) -> np.ndarray:
    """The merged spans of one row of ``mark_repeats``."""
    return np.frombuffer(parts.as_py() or b"", "<i8").reshape(-1, 2)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
