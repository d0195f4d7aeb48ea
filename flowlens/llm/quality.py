"""Quality classifier: Bradley-Terry pairwise ranking.

Method: a document's score is a weighted sum of its features; the weights are
learned from preference pairs (a document of label 1 beats one of label 0) by
logistic loss on the difference of their features, over all pairs of the
labelled rows. The cut between the classes is a quantile of the scores of all
of them: the share of label 0 among the labelled rows. The probability is the
logistic of the distance to the cut.

The fit: labelled texts become feature rows, written once. What all pairs ask
of a row is given by its score and the scores of the other class, so a step of
the descent (L-BFGS) is two passes over the rows: histograms of the scores at
several step lengths, then the gradient. A task returns sums of fixed size.

Features: byte and byte-pair shares, and shares that show repetition, layout
and case. They read the whole text. Every labelled row is learned from (of rows
that repeat an id and a label, one); label shares count all. Scoring is one
pass without a shuffle.

Defined results: a text without words (null, empty, blank) scores 0. Rows
without a label or with a null id are scored, not learned from; an id with
several labels counts with each. Without both labels to learn from every
score is 0.5. Other columns are passed on, those named ``score`` and
``predicted`` replaced. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import releasing, replace_columns, save, ship, small

PAIRS = 2048
STYLE = 10
SIZE = 256 + PAIRS + STYLE
# Scores of the fit in bins of 1/16 from -64 to 64 (the logistic is flat long
# before); step lengths tried at once; tasks of a pass, which bounds the driver.
BINS, WIDTH = 2048, 1 / 16
STEPS = np.array([4, 2, 1, 0.5, 0.25, 0.0625, 0.015625, 0])
TASKS = 128
BLOCK = 200                     # rows of a block of the written features


def features(text: str) -> np.ndarray | None:
    """Feature vector of a whole text; None if it has no word."""
    words = text.split()
    if not words:
        return None
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    x = np.zeros(SIZE, np.float32)
    x[:256] = np.sqrt(np.bincount(data, minlength=256) / len(data))
    if len(data) > 1:
        two = (data[:-1].astype(np.uint32) * 40503 + data[1:].astype(np.uint32) * 30011) >> 3 & (PAIRS - 1)
        x[256:-STYLE] = np.sqrt(np.bincount(two, minlength=PAIRS) / len(two))
    lines = [s for s in text.split("\n") if s.strip()]
    n, chars = len(words), len(text)
    x[-STYLE:] = (len(set(words)) / n, sum(map(eq, words, words[1:])) / n, np.log1p(n) / 10,
                  np.log1p(chars / n), len(set(lines)) / len(lines), np.log1p(n / len(lines)) / 5,
                  sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
                  sum(map(str.isalpha, words)) / n, len(set(words)) / np.sqrt(n) / 10)
    return x


@dataclass(frozen=True)
class Ranking:
    """weights . (x - mean) / scale, against ``cut``; ``slope`` per unit."""
    mean: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def score(self, x: np.ndarray | None) -> float:
        if x is None:
            return 0.0
        z = self.slope * (float((x - self.mean) @ self.weights) - self.cut)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Block:
    """Feature rows without their zeros: row and column of each value."""

    def __init__(self, sizes: np.ndarray, column: np.ndarray, value: np.ndarray, width: int):
        self.n, self.width = len(sizes), width
        self.row, self.column, self.value = np.repeat(np.arange(self.n), sizes), column, value

    @classmethod
    def of(cls, x: np.ndarray) -> Block:
        row, column = np.nonzero(x)
        return cls(np.bincount(row, minlength=len(x)), column, x[row, column].astype(float), x.shape[1])

    @classmethod
    def read(cls, sizes: bytes, packed: bytes) -> Block:
        sizes = np.frombuffer(sizes, np.uint16)
        both = np.frombuffer(zstandard.decompress(packed), np.uint16)
        half = len(both) // 2
        return cls(sizes, both[:half].astype(np.int64), both[half:].view(np.float16).astype(float), SIZE)

    def dot(self, w: np.ndarray) -> np.ndarray:
        """A sum for each row."""
        return np.bincount(self.row, self.value * w[self.column], self.n)

    def sum(self, weight: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
        """The weighted sum of the rows."""
        return np.bincount(self.column, (self.value if value is None else value) * weight[self.row], self.width)


class Rows:
    """Feature rows of a written table: blocks of ``n`` rows with their labels
    ``y`` (a byte each), ``sizes`` and ``packed`` values of :class:`Block`."""

    def __init__(self, table: DataFrame, n: int):
        self.table, self.n = table, n

    def __len__(self) -> int:
        return self.n

    def sums(self, part: Callable[[Block, np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``part(block, y)`` over all blocks."""
        @releasing
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for y, sizes, packed in zip(*(c.to_pylist() for c in b.columns)):
                    got = part(Block.read(sizes, packed), np.frombuffer(y, np.uint8).astype(np.int64))
                    total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

        parts = self.table.select("y", "sizes", "packed").coalesce(TASKS).mapInArrow(run, "v binary").collect()
        return sum(np.frombuffer(r["v"]) for r in parts)


def _bins(s: np.ndarray, low: float = -BINS * WIDTH / 2, width: float = WIDTH) -> np.ndarray:
    return np.clip((s - low) / width, 0, BINS - 1).astype(np.int64)


def _histogram(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row counts by class and score, each row shared out to the two nearest bin centres."""
    at = np.clip(s / WIDTH + (BINS - 1) / 2, 0, BINS - 1.001)
    i = at.astype(np.int64)
    up, key = at - i, i + BINS * y
    return np.bincount(key, 1 - up, 2 * BINS) + np.bincount(key + 1, up, 2 * BINS)


_APART = np.arange(1 - BINS, BINS) * WIDTH          # differences of two bin centres


def _pair_loss(good: np.ndarray, bad: np.ndarray) -> float:
    """Mean logistic loss of all pairs, from the classes' shares by bin."""
    return float(np.convolve(good, bad[::-1]) @ np.logaddexp(0, -_APART))


def _pulls(good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a row at each bin centre, its mean chance to lose (label 1) and to
    win (label 0) against all rows of the other class."""
    wins = 1 / (1 + np.exp(-_APART))                # of a row over one that scores that much less
    lose = np.convolve(bad, wins[::-1])[BINS - 1:2 * BINS - 1]
    win = np.convolve(good, wins)[BINS - 1:2 * BINS - 1]
    return lose, win


def _direction(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """L-BFGS: minus the gradient times the inverse curvature of past steps."""
    q, alphas = g.copy(), []
    for s, d in reversed(past):
        alphas.append((s @ q) / (s @ d))
        q -= alphas[-1] * d
    q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(float(np.linalg.norm(g)), 1e-12)
    for (s, d), a in zip(past, reversed(alphas)):
        q += (a - (d @ q) / (s @ d)) * s
    return -q


def bradley_terry(x: np.ndarray | Rows, label: np.ndarray | None, share0: float, steps: int = 25,
                  decay: float = 1e-2, least: float = 1e-2) -> Ranking:
    """Weights from all pairs of rows of label 1 and 0; ends when a step lowers
    the loss by less than the share ``least`` of it."""
    sums = x.sums if isinstance(x, Rows) else lambda part: part(Block.of(x), label)

    def moments(x, y):
        one = np.ones(len(y))
        return np.concatenate(([len(y), (y == 1).sum()], x.sum(one), x.sum(one, x.value * x.value)))

    n, n_good, *both = sums(moments)
    mean, square = np.split(np.array(both) / n, 2)
    scale = np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-3
    size = {1: n_good, 0: n - n_good}
    w, past, g = np.zeros(len(mean)), [], None
    hist = np.zeros((2, BINS))
    hist[:, BINS // 2 - 1:BINS // 2 + 1] = 0.5      # all scores 0
    for _ in range(steps):
        lose, win = _pulls(hist[1], hist[0])

        def gradient(x, y, w=w / scale, lose=lose, win=win):
            at = (x.dot(w) - mean @ w) / WIDTH + (BINS - 1) / 2
            place = np.arange(BINS)
            pull = np.where(y == 1, -np.interp(at, place, lose) / size[1], np.interp(at, place, win) / size[0])
            return np.append(x.sum(pull), pull.sum())

        got = sums(gradient)
        new = (got[:-1] - mean * got[-1]) / scale + decay * w
        if g is not None and moved @ (new - g) > 1e-12:
            past = [*past[-9:], (moved, new - g)]
        g = new
        to = _direction(g, past)

        def tried(x, y, w=w / scale, to=to / scale):
            s, d = x.dot(w) - mean @ w, x.dot(to) - mean @ to
            return np.concatenate([_histogram(s + a * d, y) for a in STEPS])

        hists = sums(tried).reshape(len(STEPS), 2, BINS) / np.array([[size[0]], [size[1]]])
        losses = [_pair_loss(h[1], h[0]) + decay / 2 * float((w + a * to) @ (w + a * to)) for a, h in zip(STEPS, hists)]
        best = int(np.argmin(losses))
        moved, hist = STEPS[best] * to, hists[best]
        w = w + moved
        if losses[-1] - losses[best] < least * losses[-1]:
            break
    w = w / scale
    cut, spread = _cut(sums, mean, w, np.array([share0 / size[0], (1 - share0) / size[1]]), share0)
    return Ranking(mean.astype(np.float32), w.astype(np.float32), cut, float(4 / (spread + 1e-9)))


def _cut(sums: Callable, mean: np.ndarray, w: np.ndarray, weight: np.ndarray, share0: float) -> tuple[float, float]:
    """(middle between the two neighbouring scores at which the weight of the
    rows below passes ``share0``, standard deviation of the scores). The scores
    are read off bins; the two bins that matter are counted again in finer ones."""
    def coarse(x, y):
        s = x.dot(w) - mean @ w
        return np.concatenate((np.bincount(_bins(s) + BINS * y, minlength=2 * BINS), [len(s), s.sum(), (s * s).sum()]))

    def passing(counts: np.ndarray, below: float) -> int:
        total = below + np.cumsum(weight @ counts)
        return int(np.argmax(total > share0 + 1e-9)) if total[-1] > share0 + 1e-9 else int(np.flatnonzero(counts.sum(axis=0))[-1])

    *counts, n, first, second = sums(coarse)
    counts = np.array(counts).reshape(2, BINS)
    at = passing(counts, 0.0)
    before = np.flatnonzero(counts[:, :at].sum(axis=0))
    lows = [(i - BINS / 2) * WIDTH for i in (at, *before[-1:])]
    fine = WIDTH / BINS

    def finer(x, y):
        s = x.dot(w) - mean @ w
        bins = _bins(s)
        return np.concatenate([np.bincount((_bins(s, low, fine) + BINS * y)[bins == i], minlength=2 * BINS)
                               for i, low in zip((at, *before[-1:]), lows)]).astype(float)

    here, *prior = sums(finer).reshape(-1, 2, BINS)
    i = passing(here, float((weight @ counts[:, :at]).sum()))
    upper = lower = lows[0] + (i + 0.5) * fine
    same = np.flatnonzero(here[:, :i].sum(axis=0))
    if len(same):
        lower = lows[0] + (same[-1] + 0.5) * fine
    elif prior:
        lower = lows[1] + (np.flatnonzero(prior[0].sum(axis=0))[-1] + 0.5) * fine
    return float((lower + upper) / 2), float(np.sqrt(max(second / n - (first / n) ** 2, 0)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, learn, id_col: str = "doc_id",
        text_col: str = "text") -> Ranking | None:
    """Learn from all rows of ``labels`` for which the column ``learn`` holds."""
    ship(docs)
    known = labels.filter(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)) \
        .select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    # Rows that repeat an id are one row to learn from: the text least by hash.
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text")).filter("k is not null") \
        .withColumn("h", F.xxhash64("text")).groupBy("k").agg(F.min_by("text", "h").alias("text"))

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, BLOCK):
            got = [(y, features(t or "")) for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist())]
            got = [(y, x.astype(np.float16)) for y, x in got if x is not None]
            if got:
                at = [np.flatnonzero(x) for _, x in got]
                values = np.concatenate([x[i] for i, (_, x) in zip(at, got)]).view(np.uint16)
                packed = zstandard.compress(np.concatenate([*at, values], dtype=np.uint16, casting="unsafe").tobytes(), 1)
                yield pa.RecordBatch.from_pydict({
                    "n": [len(got)], "good": [sum(y for y, _ in got)], "y": [bytes(y for y, _ in got)],
                    "sizes": [np.array([len(i) for i in at], np.uint16).tobytes()], "packed": [packed]}, schema=block)

    block = pa.schema([("n", pa.int64()), ("good", pa.int64()), ("y", pa.binary()), ("sizes", pa.binary()),
                       ("packed", pa.binary())])
    rows = save(texts.join(known.distinct(), "k").select("y", "text")
                .mapInArrow(run, "n long, good long, y binary, sizes binary, packed binary"), "quality-rows")
    n, good = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    if not 0 < good < n:
        return None
    return bradley_terry(Rows(rows, n), None, counts[0] / sum(counts.values()))


def score(docs: DataFrame, model: Ranking | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= 0.5)."""
    ship(docs)
    fields = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            s = [0.5 if model is None else model.score(features(t or "")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, schema).select(replace_columns(
        "row", fields, {"score": F.col("score"), "predicted": (F.col("score") >= 0.5).cast("int")}))
