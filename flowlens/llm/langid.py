"""Language identification: nearest centroid.

Method: a text is the normalised TF-IDF vector of its byte trigrams (letters
lower-cased, other ASCII as spaces; hashed to ``DIMS`` places). Each language
is ``clusters`` centroids found by spherical k-means over its sample; a text
goes to the language of the centroid with the largest cosine. It is rejected
if that cosine is below what nearly all (99.5 %) of the centroid language's
own sample reach, less a margin.

The fit uses a sample of at most ``sample`` documents, shared out evenly over
the languages (the least by a hash of the id; of rows that repeat an id and a
language, one); prediction reads whole texts in
one pass without a shuffle.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is every text when there is nothing to learn from. A row with a null
language is predicted, not learned from. ``rejected`` rows keep their nearest
language in ``lang_pred``. Other columns are passed on, those named as an
output column replaced. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import releasing, replace_columns, ship, small

DIMS = 4096
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[i for i in range(128) if not chr(i).isalpha()]] = 32


def trigrams(text: str) -> np.ndarray | None:
    """Counts of hashed byte trigrams; None without a letter."""
    if not any(map(str.isalpha, text)):
        return None
    data = _FOLD[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)].astype(np.uint32)
    key = data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)
    key = key[(data[:-2] != 32) | (data[1:-1] != 32)]
    return np.bincount((key ^ key >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(20), minlength=DIMS)


@dataclass(frozen=True)
class Centroids:
    langs: list[str]
    of: np.ndarray            # language of each centroid
    idf: np.ndarray
    centre: np.ndarray        # a row for each centroid
    least: np.ndarray         # rejection bound of each language

    def vector(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts, dtype=np.float32) * self.idf
        return x / max(float(np.linalg.norm(x)), 1e-9)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = trigrams(text) if text else None
        if counts is None or not len(self.langs):
            return UNKNOWN, 0.0, False
        cos = self.centre @ self.vector(counts)
        best = np.full(len(self.langs), -1.0)
        np.maximum.at(best, self.of, cos)
        i = int(np.argmax(best))
        share = np.exp(20 * (best - best[i]))
        return self.langs[i], float(1 / share.sum()), bool(best[i] < self.least[i])


def _clusters(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means: ``k`` unit centroids of unit rows (fewer rows: all)."""
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(12):
        near = np.argmax(x @ c.T, axis=1)
        for j in range(k):
            if (near == j).any():
                c[j] = x[near == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def learn_centroids(langs: list[str], counts: np.ndarray, clusters: int, margin: float = 0.1) -> Centroids:
    names = sorted(set(langs))
    of_row = np.array([names.index(x) for x in langs])
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = np.sqrt(counts, dtype=np.float32) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    rng, centres, of, least = np.random.default_rng(11), [], [], []
    for i in range(len(names)):
        own = x[of_row == i]
        c = _clusters(own, clusters, rng)
        centres.append(c)
        of += [i] * len(c)
        least.append(np.quantile((own @ c.T).max(axis=1), 0.005) - margin)
    return Centroids(names, np.array(of), idf, np.concatenate(centres), np.array(least))


def fit(docs: DataFrame, learn: Column, sample: int = 4000, clusters: int = 4, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Learn from the rows for which the column ``learn`` holds."""
    ship(docs)
    known = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("k"), F.col(lang_col).alias("lang")).distinct()
    langs = known.select("lang").distinct().count()
    each = max(1, sample // max(1, langs))
    # The limit goes below the shuffle: a task sends ``each`` rows of a language at most.
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("k", F.lit("sample")), "k"))
    picks = known.withColumn("r", rank).filter(F.col("r") <= each).select("k", F.col("lang").alias("y"))
    texts = docs.select(F.col(id_col).alias("k"), F.col(lang_col).alias("y"), F.col(text_col).alias("text")) \
        .join(F.broadcast(picks), ["k", "y"])
    # Rows that repeat an id and language are one row of the sample: the text least by hash.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.withColumn("h", F.xxhash64("text")).groupBy("k", "y").agg(F.min_by("text", "h").alias("text")).repartition(parts)

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 200):
            got = [(y, trigrams(t or "")) for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist())]
            got = [(y, np.minimum(x, 65535).astype("<u2").tobytes()) for y, x in got if x is not None]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in got], pa.string()),
                                              pa.array([x for _, x in got], pa.binary())], ["y", "x"])

    rows = texts.select("y", "text").mapInArrow(run, "y string, x binary").collect()
    if not rows:
        return Centroids([], np.zeros(0, int), np.ones(DIMS), np.zeros((0, DIMS)), np.zeros(0))
    return learn_centroids([r["y"] for r in rows], np.stack([np.frombuffer(r["x"], "<u2") for r in rows]), clusters)


def predict(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected."""
    ship(docs)
    fields = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            got = [model.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())], ["row", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema).select(
        replace_columns("row", fields, {c: F.col(c) for c in ("lang_pred", "score", "rejected")}))
