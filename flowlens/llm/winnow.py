"""Document fingerprints: winnowing.

Method: rolling hashes of all runs of ``gram`` code points; of every
``window`` neighbouring hashes the least is picked, the rightmost of ties, and
kept with its position. Texts that share ``window + gram - 1`` code points
share a fingerprint entry. A text shorter than that has its one least gram; a
text shorter than a gram is one gram.

A fingerprint is written ``hash@position ...`` (40-bit hash in hex). The
likeness of two is the Dice coefficient of their sets of hashes.

``edited`` pairs each document with the next one (descending id) by sorting
id ranges, not the whole table in one task: quantiles of the id cut the table
into ranges, each range is sorted and streamed, and the first document of the
next range is sent along with each range (one row a range).

Defined results: null text is empty; empty texts have an empty fingerprint
(likeness 1 to each other, 0 to others); a null id comes after all others;
rows with equal ids are ordered by a hash of their text; one row is its own
next. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import repeats
from flowlens.llm.common import U64, gram_hashes, releasing, ship, small

NULL_ID = -(1 << 63)


def _places(hashes: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Places picked by the windows of neighbouring texts. ``picked`` holds
    places in the bits of ``_POS``: longer data goes in slices that overlap by
    a window less one, so each window is whole in one of them."""
    n, step = int(bounds[-1]), min(repeats.CHUNK * 4, int(repeats._POS))
    lo, out = 0, []
    while True:
        hi = min(n, lo + step)
        inner = np.clip(bounds, lo, hi) - lo
        out.append(repeats.picked(hashes[lo:max(lo, hi - gram + 1)], inner, window, gram)[0] + lo)
        if hi == n:
            return np.unique(np.concatenate(out))
        lo = hi - window + 1


def winnow(texts: list[str], gram: int = 10, window: int = 32) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of each text's fingerprint, in order of position."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    hashes = gram_hashes(data, gram) >> U64(24) << U64(24)
    place = _places(hashes, bounds, window + gram - 1, gram)
    cut = np.searchsorted(place, bounds)
    out = []
    for i in range(len(texts)):
        lo, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
        if n >= window + gram - 1:
            p = place[cut[i]:cut[i + 1]]
            out.append((hashes[p], p - lo))
        elif n >= gram:
            own = hashes[lo:lo + n - gram + 1]
            p = len(own) - 1 - int(np.argmin(own[::-1]))
            out.append((own[p:p + 1], np.array([p])))
        elif n:
            out.append((gram_hashes(data[lo:lo + n], n) >> U64(24) << U64(24), np.array([0])))
        else:
            out.append((np.zeros(0, U64), np.zeros(0, np.int64)))
    return out


def written(hashes: np.ndarray, positions: np.ndarray) -> str:
    return " ".join([f"{h:010x}@{p}" for h, p in zip((hashes >> U64(24)).tolist(), positions.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def _ranges(docs: DataFrame, count: int) -> DataFrame:
    """``docs`` (id, tie, text) with ``range``, ascending with id."""
    cuts = docs.filter(F.col("id") != NULL_ID).withColumn("x", F.col("id").cast("double")) \
        .approxQuantile("x", [i / count for i in range(1, count)], 0.2 / count) if count > 1 else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) == 2:
        return docs.withColumn("range", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol="x", outputCol="range") \
        .transform(docs.withColumn("x", F.col("id").cast("double"))).drop("x")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text), next in descending order of the id."""
    ship(docs)
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _ranges(rows.withColumn("tie", F.xxhash64("text")), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.select("range", "id", "tie", "text")
    # One row a range; the ranges are as many as shuffle partitions.
    firsts = sorted(rows.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("f")).collect(), reverse=True)
    to = [(above["range"], r["f"]["id"], r["f"]["tie"]) for above, r in zip(firsts[-1:] + firsts, firsts)]
    guests = spark.createDataFrame(to, "to double, id long, tie long")
    sent = rows.join(F.broadcast(guests), ["id", "tie"]).select(F.col("to").alias("range"), "id", "tie", "text") \
        .dropDuplicates(["range"]).withColumn("guest", F.lit(1))

    @releasing
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in small(batches):
            out = []
            for r, i, text, guest in zip(*(b.column(c).to_pylist() for c in ("range", "id", "text", "guest"))):
                if last is not None:
                    out.append((*last, text))
                last = None if guest else (i, text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64())] +
                [pa.array([x[k] for x in out], pa.string()) for k in (1, 2)], ["id", "text", "next_text"])

    return (rows.withColumn("guest", F.lit(0)).unionByName(sent).repartition("range")
            .sortWithinPartitions("range", "guest", F.desc("id"), F.desc("tie"))
            .mapInArrow(pairs, "id long, text string, next_text string"))


def fingerprints(docs: DataFrame, gram: int = 10, window: int = 32, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint, and the same of the edited text: the last
    half replaced by the next document's first code points."""
    pairs = with_next(docs, id_col, text_col)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 200):
            texts, after = b.column(1).to_pylist(), b.column(2).to_pylist()
            edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, after)]
            own, new, nxt = (winnow(x, gram, window) for x in (texts, edited, after))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(edited, pa.string()),
                 pa.array([written(*f) for f in own], pa.string()), pa.array([written(*f) for f in new], pa.string()),
                 pa.array([likeness(f[0], g[0]) for f, g in zip(own, new)], pa.float64()),
                 pa.array([likeness(f[0], g[0]) for f, g in zip(own, nxt)], pa.float64())],
                ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    out = pairs.mapInArrow(run, "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double")
    return out.withColumn("id", F.when(F.col("id") != NULL_ID, F.col("id"))).withColumnRenamed("id", id_col)
