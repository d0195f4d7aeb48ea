"""Spelling variant grouping: relational trie frontier.

Method: the words are a trie stored as an edge table (node, label, child; chains
without a branch are one edge, and an edge says which word ends at its child).
States (word, rest, node, edits) are joined with the edges level by level: an
edge is walked by reading its label exactly, or with one character inserted,
deleted or replaced. A state with one edit and nothing left at the end of a word
makes the two neighbours.

A word meets a neighbour with its first or its last half unchanged, so there are
two tries, of the words and of the words backwards. A word starts below the half
that stays (its own path, known without a join) and edits only behind it: no
state ever stands at the root, where all words would meet, and few edges are
tried. A node has an edge for each next character at most, so a state meets no
more edges than the alphabet has characters. Nodes are named by a 64-bit hash of
their path; a collision could only add states, and every pair found is confirmed
on the words.

A word's form is its neighbour of largest count (ties: the smallest in
code-point order) if that is at least ``ratio`` times its own; its root is where
the chain of forms ends, found by doubling.

Defined results: null texts have no words; a word shorter than ``min_length`` or
rarer than ``min_count`` is no word of the result and nobody's neighbour. Equal
words are one row. Nothing limits length or number of words; an empty table gives no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import U64, _powers, chunks, mix64, releasing, save, ship
from flowlens.session import work_dir

_END = -1                       # next character at the end of a word


# Latin-1 has one byte for each character to U+00FF: letters (A-Z lower-cased) stay, all else is a blank.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
Edit = Callable[[list, np.ndarray, pa.BinaryArray, np.ndarray], Iterator[tuple[int, bytes]]]


def _run_table(texts: list[str], min_length: int) -> tuple[np.ndarray, pa.BinaryArray]:
    """The runs of ``min_length`` letters and more: (place of the text, Latin-1 bytes)."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = np.frombuffer((" ".join(texts) + " ").encode("latin-1", "replace").translate(_RUNS), np.uint8)
    letter = data != 32
    turns = np.flatnonzero(np.diff(letter, prepend=False))      # starts and ends by turns; the last blank ends any run
    start, size = turns[0::2], turns[1::2] - turns[0::2]
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[letter])])
    long = size >= min_length
    return np.searchsorted(ends, start[long], side="right"), runs.filter(pa.array(long))


def count_words(docs: DataFrame, edit: Edit | None = None, id_col: str = "doc_id",
                text_col: str = "text", min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n): the maximal runs of Latin letters (to U+00FF) of whole texts,
    A-Z lower-cased, that have ``min_length`` characters and are met ``min_count``
    times in all. ``edit`` (ids of a batch, each run's place among them, the
    distinct runs as Latin-1 bytes, each run's place among those) yields (run, what
    it becomes) for the runs that change; it never makes one longer."""
    ship(docs)

    def flush(held: dict[bytes, int]) -> pa.RecordBatch:
        kept = [(w.decode("latin-1"), n) for w, n in held.items() if n > 0]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
                                          ["word", "n"])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}         # summed in the task before anything is shuffled
        for b in batches:
            if not b.num_rows:
                continue
            row, runs = _run_table(b.column(1).to_pylist(), min_length)
            coded = runs.dictionary_encode()
            words, of = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            counts = np.bincount(of, minlength=len(words))
            for i, new in edit(b.column(0).to_pylist(), row, words, of) if edit else ():
                counts[of[i]] -= 1
                if len(new) >= min_length:
                    held[new] = held.get(new, 0) + 1
            for word, n in zip(words.to_pylist(), counts.tolist()):
                held[word] = held.get(word, 0) + n
            if len(held) > 300_000:
                yield flush(held)
                held = {}
        yield flush(held)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_count)


@releasing
def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(wid, word) -> a row for each prefix, forwards and backwards, that a
    neighbour's path can meet: its node, the next character and whether the half
    that stays ends there."""
    mark = U64(0xD6E8FEB86659FD93)
    for b in batches:
        wid = np.array(b.column(0).to_pylist(), np.int64)
        words = b.column(1).to_pylist()
        n = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(n) - n
        for way in (0, 1):
            half, least = (n // 2, (n - 1) // 2) if way == 0 else (n - n // 2, n // 2)
            codes = np.frombuffer("".join(w[::-1] if way else w for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
            up, down = _powers(len(codes) + 1)
            pre = np.zeros(len(codes) + 1, U64)
            np.cumsum((codes.astype(U64) + U64(1)) * up[:len(codes)], out=pre[1:])
            for lo, hi in chunks(n, 50_000):
                rows = n[lo:hi] - least[lo:hi] + 1
                of = np.repeat(np.arange(lo, hi), rows)
                depth = np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows) + least[of]
                at, end = first[of], first[of] + depth
                node = mix64((pre[end] - pre[at]) * down[at] + (depth * 2 + way).astype(U64) * mark).view(np.int64)
                following = np.where(depth < n[of], codes[np.minimum(end, len(codes) - 1)].astype(np.int64), _END)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(depth.astype(np.int32)), pa.array(following.astype(np.int32)),
                     pa.array(depth == half[of]), pa.array(wid[of]), pa.array(np.full(len(of), way, np.int32))],
                    ["node", "depth", "next", "start", "wid", "way"])


def _prefixes(words: DataFrame) -> DataFrame:
    return save(words.select("wid", "word").mapInArrow(
        _paths, "node long, depth int, next int, start boolean, wid long, way int"), "variant-paths")


def _text() -> Column:
    return F.when(F.col("way") == 0, F.col("word")).otherwise(F.reverse("word"))


def _edges(paths: DataFrame, words: DataFrame) -> DataFrame:
    """(node, label, child, ends, nexts): the words' tries; ``ends`` is the id of
    the word that ends at the child (null: none), ``nexts`` the characters that
    can follow there."""
    # A node stays where paths part, where a word ends and where one starts.
    kept = paths.groupBy("node").agg(F.min("next").alias("a"), F.max("next").alias("b"), F.max("start").alias("start")) \
        .filter(F.col("start") | (F.col("a") != F.col("b")) | (F.col("a") == _END)).select("node")
    steps = paths.join(kept, "node", "left_semi").groupBy("wid", "way") \
        .agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("at"))
    pairs = steps.join(words, "wid").select(
        "wid", _text().alias("text"), F.element_at("at", -1)["depth"].alias("last"),
        F.explode(F.arrays_zip(F.expr("slice(at, 1, size(at) - 1)").alias("a"), F.expr("slice(at, 2, size(at))").alias("b"))).alias("p"))
    edges = save(pairs.select(
        F.col("p.a.node").alias("node"), F.expr("substring(text, p.a.depth + 1, p.b.depth - p.a.depth)").alias("label"),
        F.col("p.b.node").alias("child"),
        F.when(F.col("p.b.depth") == F.col("last"), F.col("wid")).alias("ends")).distinct(), "variant-edges")
    nexts = edges.groupBy(F.col("node").alias("child")).agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("nexts"))
    return edges.join(nexts, "child", "left").select("node", "label", "child", "ends", F.coalesce("nexts", F.lit("")).alias("nexts"))


def _steps(rows: DataFrame) -> DataFrame:
    """Each way to read ``label`` from the front of ``rest`` with at most one
    edit in all: the rows' columns, left and used. Without an edit so far the
    state is on its own word's path: an edge that is not the word's own differs
    in its first character, so an edit is made there or the edge is read exactly.
    Ways that neither end at a word nor can go on from the child are left out."""
    text = lambda c, at: F.substring(c, at, F.length(c))
    rest, tail, n = F.col("rest"), F.col("tail"), F.col("size")
    rows = rows.withColumns({"exact": F.startswith(rest, F.col("label")), "tail": text(F.col("label"), F.lit(2)),
                             "after": text(rest, F.lit(2)), "size": F.length("label"), "some": F.length(rest) > 0})
    one = (F.col("edits") == 0) & ~F.col("exact")

    def way(when: Column, skip: Column, used: Column) -> Column:
        left = text(rest, skip + 1)
        on = F.when(used == 0, F.lit(True)).when(F.length(left) == 0, F.col("ends").isNotNull()) \
            .otherwise(F.instr("nexts", F.substring(left, 1, 1)) > 0)
        return F.when(when & on, F.struct(left.alias("left"), used.alias("used")))

    ways = F.array(
        way(F.col("exact"), n, F.col("edits")),
        way(one & F.col("some") & F.startswith(F.col("after"), tail), n, F.lit(1)),                 # replaced
        way(one & F.col("some") & F.startswith(F.col("after"), F.col("label")), n + 1, F.lit(1)),   # one more in the word
        way(one & F.startswith(rest, tail), n - 1, F.lit(1)))                                       # one more on the edge
    return rows.withColumn("m", F.explode(ways)).filter("m IS NOT NULL") \
        .withColumns({"left": F.col("m.left"), "used": F.col("m.used")}).drop("m", "exact", "tail", "after", "size", "some")


def _walk(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: (wid, rest, node, edits, alive, near); ``near`` is the word met
    at the node, ``alive`` whether the state can go on from there."""
    met = states.join(edges.withColumnRenamed("node", "from"), (F.col("node") == F.col("from")) &
                      ((F.col("edits") == 0) | F.startswith("rest", "label")))
    out = _steps(met.select("wid", "rest", "edits", "label", "child", "ends", "nexts"))
    left, used = F.col("left"), F.col("used")
    ended = F.col("ends").isNotNull() & (F.col("ends") != F.col("wid")) & \
        F.when(used == 1, F.length(left) == 0).otherwise(F.length(left) == 1)
    alive = F.when(used == 0, F.length("nexts") > 0).otherwise(F.length(left) > 0)
    return out.select("wid", left.alias("rest"), F.col("child").alias("node"), used.alias("edits"), alive.alias("alive"),
                      F.when(ended, F.col("ends")).alias("near")).filter("alive OR near IS NOT NULL")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs, both ways round, that differ by one
    character inserted, deleted or replaced; ``words`` is a written table of
    (wid, word, n), ``wid`` and ``word`` distinct."""
    spark = ship(words)
    paths = _prefixes(words)
    # Every level joins the same edges: stored in buckets by node, they are not shuffled again.
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"variant_edges_{uuid.uuid4().hex[:12]}"
    (_edges(paths, words.select("wid", "word")).repartition(buckets, "node").write.bucketBy(buckets, "node").sortBy("node")
     .option("path", work_dir(spark, "llm-variant-edges") + "/t").saveAsTable(name))
    try:
        edges = spark.table(name)
        states = paths.filter("start").join(words.select("wid", "word"), "wid").select(
            "wid", F.expr("substring(IF(way = 0, word, reverse(word)), depth + 1)").alias("rest"), "node", F.lit(0).alias("edits"))
        found = []
        while True:
            step = save(_walk(states, edges), "variant-states")
            found.append(step.filter("near IS NOT NULL").select("wid", "near"))
            states = step.filter("alive").select("wid", "rest", "node", "edits")
            if states.isEmpty():
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")       # its files are a work folder's
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    other = words.select(F.col("wid").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return (pairs.distinct().join(words.select("wid", "word"), "wid").join(other, "near")
            .filter(F.levenshtein("word", "near_word", 1) == 1).select("word", F.col("near_word").alias("near"), "near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the ends of the chains of forms, which
    rise in count and so never close. Each pass doubles the steps taken."""
    now = save(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = save(now.join(ahead, "root", "left").select("word", "root", "further"), "variant-roots")
        now = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.filter("further IS NOT NULL").isEmpty():
            return now


def spelling_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``words`` (word, n) -> word, form, root, n, n_near, form_n."""
    # As many parts as a shuffle has: a word is few bytes but much work.
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = save(words.select("word", "n").repartition(parts, "word").withColumn("wid", F.monotonically_increasing_id()),
                 "variant-words")
    best = neighbours(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    known = save(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(strong, F.col("best.near")).alias("form"),
                              F.when(strong, -F.col("best.less")).alias("form_n")), "variant-forms")
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
