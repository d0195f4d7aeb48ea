"""MinHash near-dedup: circulant MinHash, banding, exact Jaccard check.

Method: two permutations only. The first scatters a document's shingles over
``DOMAIN`` places; the second, one table, gives signature coordinate k as the
least value it has at the document's places shifted by k (circularly). Rows of
``rows`` coordinates make ``bands`` band keys; documents that share a key are
candidates. Candidates are confirmed on their full shingle sets (64-bit
shingle hashes), never on signatures.

No pairs of a bucket are emitted. Documents of equal sets are one class, and
each class of a bucket is hung on the bucket's least class. The classes hung
on one head are compared with one another in blocks of ``BLOCK`` (two blocks
and one sparse product per task group), so a pair that shares any bucket is
tested, and a block passes on only a spanning forest of the links it finds.
Components are then those of all links.

With 25 bands of 5 rows a pair at similarity 0.8 stays unseen with
probability 5e-5, at 0.85 with 4e-7.

Defined results: null and empty texts, and texts without words, have an empty
set, link with nothing and are kept; fewer words than a shingle make one
shingle of all of them. A null id is larger than any other. Rows with equal
ids are separate documents; rows that repeat id and text are all returned,
``kept`` alike. Input columns beside id and text are ignored. An empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import U64, binary_views, chunks, lower_ascii, mix64, releasing, save, ship, small
from flowlens.llm.components import components
from flowlens.llm.substring_dedup import word_grams

DOMAIN = 1 << 20
BLOCK = 256
LAST_ID = (1 << 63) - 1


@lru_cache(maxsize=1)
def _circulant(num: int) -> np.ndarray:
    """[i] is the second permutation at i, i+1, ... i+num-1 (circularly)."""
    table = np.random.default_rng(20260101).permutation(DOMAIN).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((table, table[:num])), num)


def signature(shingles: np.ndarray, num: int) -> np.ndarray:
    """Circulant MinHash of a set of 64-bit shingle hashes."""
    places = (mix64(shingles) >> U64(44)).astype(np.int64)         # the first permutation
    table = _circulant(num)
    out = np.full(num, DOMAIN, np.int32)
    for i in range(0, len(places), 1 << 14):
        np.minimum(out, table[places[i:i + (1 << 14)]].min(axis=0), out=out)
    return out


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a binary column."""
    offs, data = binary_views(texts)
    for i, j in chunks(np.diff(offs), 1 << 19):
        bounds = offs[i:j + 1] - offs[i]
        part = data[offs[i]:offs[j]]
        grams, words = word_grams(part, bounds, k)
        for d in range(j - i):
            n = int(words[d + 1] - words[d])
            if n >= k:
                yield np.unique(grams[words[d]:words[d + 1] - k + 1])
            elif n:
                yield word_grams(part[bounds[d]:bounds[d + 1]], np.array([0, bounds[d + 1] - bounds[d]]), n)[0]
            else:
                yield np.zeros(0, U64)


def linked(sets: list[np.ndarray], group: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``: pairs across group 0 and
    1 and, where all are in group 0, within it."""
    size = np.array([len(s) for s in sets])
    rows, cols = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
    _, col, times = np.unique(cols, return_inverse=True, return_counts=True)
    shared = times[col] > 1                                        # others meet nothing
    _, col = np.unique(col[shared], return_inverse=True)
    rows = rows[shared]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    width = max(256, (1 << 21) // len(sets))
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        i, j = np.searchsorted(col, (lo, lo + width))
        m = np.zeros((len(sets), width), np.float32)
        m[rows[i:j], col[i:j] - lo] = 1
        common += m @ m.T
    ok = den * common.astype(np.int64) >= num * (size[:, None] + size[None, :] - common.astype(np.int64))
    ok &= np.tri(len(sets), k=-1, dtype=bool)
    if group.any():
        ok &= group[:, None] != group[None, :]
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(*(x.tolist() for x in np.nonzero(ok))):
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out


def _uid(own: Column, text: Column) -> Column:
    """Hash of id and text. Rows are told apart by the id and this together."""
    return F.xxhash64(own, text)


def near_groups(docs: DataFrame, shingle: int = 5, threshold: tuple[int, int] = (80, 100), bands: int = 25,
                rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id
    reachable), kept, and the addresses (hash of id and text) of the row,
    ``uid``, and of its component's kept row, ``component_uid``."""
    ship(docs)
    num, den = threshold
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary")
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), text.alias("text")) \
        .withColumn("uid", _uid(F.col("id"), F.col("text")))

    @releasing
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            n, digest, keys = [], [], []
            for s in shingle_sets(b.column("text"), shingle):
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    sig = signature(s, bands * rows).astype(U64).reshape(bands, rows)
                    key = np.arange(bands, dtype=U64) + U64(1)
                    for i in range(rows):
                        key = mix64(key ^ (sig[:, i] + U64(i << 32)))
                    keys.append(key.view(np.int64))
                else:
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("uid"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "uid", "n", "digest", "keys"])

    signed = save(base.select("id", "uid", "text").mapInArrow(
        sign, "id long, uid long, n long, digest binary, keys array<long>"), "signed")
    classes = signed.filter("n > 0").groupBy("digest").agg(F.min(F.struct("id", "uid")).alias("least"),
                                                          F.first("keys").alias("keys"))
    classes = save(classes.select("digest", "least", "keys", F.monotonically_increasing_id().alias("node")), "classes")

    hung = _hung(classes)
    links = _links(hung, classes, base, shingle, num, den)
    roots = components(links)
    of_class = classes.join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    firsts = of_class.groupBy("root").agg(F.min("least").alias("first"))
    known = of_class.join(firsts, "root").select("digest", "first")
    own = F.struct("id", "uid")
    first = F.when(F.col("n") == 0, own).otherwise(F.col("first"))
    return (signed.join(known, "digest", "left").select("id", "uid", "n", first.alias("first"))
            .select(F.expr(f"nullif(id, {LAST_ID}L)").alias(id_col), F.col("n").alias("n_shingles"),
                    F.expr(f"nullif(first.id, {LAST_ID}L)").alias("component_id"),
                    (F.struct("id", "uid") == F.col("first")).alias("kept"), "uid",
                    F.col("first.uid").alias("component_uid")))


def _hung(classes: DataFrame) -> DataFrame:
    """(head, node, size): classes that share a bucket with a smaller class,
    and the head itself; size of the head's whole group."""
    banded = classes.select("node", F.explode("keys").alias("key"))
    heads = banded.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hung = save(banded.join(heads.select("key", "head"), "key").select("head", "node").distinct(), "hung")
    size = hung.groupBy("head").agg(F.count(F.lit(1)).alias("size"))
    return hung.join(size, "head")


def _links(hung: DataFrame, classes: DataFrame, base: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Links (a, b) among the classes hung on one head, by pairs of blocks."""
    n = F.ceil(F.col("size") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("node"), n)
    # A block meets itself and each other block once: the pair (i, j), i <= j.
    meets = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                  lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j"))))
    seats = hung.withColumn("pair", meets).select(
        "node", "head", "pair",
        ((F.col("pair.i") != F.col("pair.j")) & (mine == F.col("pair.j"))).cast("int").alias("side"))
    live = hung.select("node").distinct().join(classes.select("node", "least.id", "least.uid"), "node")

    @releasing
    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [press(x) for x in b.column(2).to_pylist()], pa.binary())], ["id", "uid", "body"])

    bodies = base.select("id", "uid", "text").mapInArrow(zipped, "id long, uid long, body binary") \
        .join(live, ["id", "uid"]) \
        .dropDuplicates(["node"]).select("node", "body")

    @releasing
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        now, held, out = None, [], []

        def settle() -> None:
            if len(held) > 1:
                sets = list(shingle_sets(pa.array([unzip(r[2]) for r in held], pa.binary()), shingle))
                out.extend((held[a][0], held[b][0])
                           for a, b in linked(sets, np.array([r[1] for r in held]), num, den))

        for b in small(batches, 2000):
            for head, i, j, node, side, body in zip(*(b.column(x).to_pylist() for x in range(6))):
                if (head, i, j) != now:
                    settle()
                    now, held = (head, i, j), []
                held.append((node, side, body))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
            out = []
        settle()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (seats.join(bodies, "node").select("head", "pair.i", "pair.j", "node", "side", "body")
            .repartition("head", "i", "j").sortWithinPartitions("head", "i", "j")
            .mapInArrow(compare, "a long, b long"))


def _addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the row's address in ``near_groups``: _row_id and _row_uid."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary")
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    return docs.withColumns({"_row_id": own, "_row_uid": _uid(own, text)})


def _addresses(id_col: str) -> list[Column]:
    """The same of the rows of ``near_groups``."""
    return [F.coalesce(F.col(id_col), F.lit(LAST_ID)).alias("_row_id"), F.col("uid").alias("_row_uid")]


def component_table(docs: DataFrame, name: str, shingle: int = 5, threshold: tuple[int, int] = (80, 100),
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` with each row's address in two columns, and a table of these
    two and a column ``name``, equal for all rows of one near-duplicate group
    (id and hash of its least row) and different for others. No text is in the
    table: it meets what is made from a row, not the row."""
    groups = near_groups(docs, shingle, threshold, id_col=id_col, text_col=text_col)
    first = F.struct("component_id", "component_uid")
    return _addressed(docs, id_col, text_col), groups.groupBy(_addresses(id_col)).agg(F.min(first).alias(name))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, threshold: tuple[int, int] = (80, 100),
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group (the least id), all
    columns unchanged; rows that repeat id and text stay once."""
    kept = near_groups(docs, shingle, threshold, id_col=id_col, text_col=text_col).filter("kept") \
        .select(*_addresses(id_col)).distinct()
    return _addressed(docs, id_col, text_col).join(kept, ["_row_id", "_row_uid"], "left_semi") \
        .dropDuplicates(["_row_id", "_row_uid"]).drop("_row_id", "_row_uid")
