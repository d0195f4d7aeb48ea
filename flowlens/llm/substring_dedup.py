"""Substring dedup over words: prefix-partitioned suffix trees.

Method: suffixes of the word sequences are split into groups by a prefix (see
``repeats`` for how they are thinned and how the prefix of a crowded group is
lengthened up to the whole window, so that every group fits memory). Each
group gets its suffix tree, cut at ``window`` words and built from the sorted
suffixes and their longest common prefixes; the leaves under an internal node
of depth ``window`` or more are the places of one repeat. Every place in a
document after the smallest one is removed, overlaps included, judged on the
input texts.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

Defined results: null and empty texts have no words; texts shorter than a
window lose nothing; a repeat inside one document only is kept; a null id is
ordered after all others, and rows with equal ids count as one document (they
do not remove each other's words, and all are returned). Input columns named
like an output column are replaced by it. An empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import U64, mix64, releasing, replace_columns, small, span_hashes, word_spans
from flowlens.llm.repeats import SPANS, Tokens, all_spans, mark_repeats, unzipped

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_grams(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words, and the documents' bounds in words."""
    apart = np.full(len(data) + len(bounds) - 1, 32, np.uint8)      # a space between documents
    shift = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    apart[np.arange(len(data)) + shift] = data
    starts, ends = word_spans(apart)
    words = span_hashes(apart, starts, ends)
    grams = np.zeros(max(0, len(words) - k + 1), U64)
    for i in range(k):
        grams = mix64(grams + words[i:len(words) - k + 1 + i]) if len(grams) else grams
    return grams, np.searchsorted(starts, bounds + np.arange(len(bounds)))


def deep_nodes(suffixes: list[list], depth: int) -> Iterator[list[int]]:
    """Leaves of the shallowest internal nodes of at least ``depth`` in the
    suffix tree of ``suffixes`` (cut at ``depth``): its sorted leaves and the
    longest common prefix of neighbours are the tree."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    leaves = order[:1]
    for a, b in zip(order, order[1:]):
        x, y = suffixes[a], suffixes[b]
        common = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        if common < depth:
            if len(leaves) > 1:
                yield leaves
            leaves = []
        leaves.append(b)
    if len(leaves) > 1:
        yield leaves


def subtrees(depth: int):
    def equal(group: np.ndarray, words: list[list], run: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One tree for each group."""
        rows, sizes, own = [], [], group[run]
        edges = np.flatnonzero(np.diff(own)) + 1
        run, at = run.tolist(), at.tolist()
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(own)]):
            for node in deep_nodes([words[r][i:i + depth] for r, i in zip(run[lo:hi], at[lo:hi])], depth):
                rows += [lo + x for x in node]
                sizes.append(len(node))
        return np.array(rows, np.int64), np.repeat(np.arange(len(sizes)), sizes)
    return equal


def word_tokens(window: int) -> Tokens:
    gram = min(4, window)
    return Tokens(window, gram, lambda data, bounds: word_grams(data, bounds, gram), WORD.findall, b" ".join)


def _without(body: bytes, spans: list[list[int]], layout: bool) -> tuple[bytes, int, int]:
    """(text left, words, words removed). With ``layout`` the blanks around
    kept words stay as they were; else kept words are joined by one space."""
    if layout:
        at = [m.start() for m in WORD.finditer(body)] + [len(body)]
        ends = [0, *(at[e] for _, e in spans)]
        left = b"".join(body[a:at[s]] for a, (s, _) in zip(ends, spans)) + body[ends[-1]:]
        return left, len(at) - 1, sum(e - s for s, e in spans)
    words = WORD.findall(body)
    ends = [0, *(e for _, e in spans)]
    keep = [w for a, (s, _) in zip(ends, spans) for w in words[a:s]] + words[ends[-1]:]
    return b" ".join(keep), len(words), len(words) - len(keep)


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   layout: bool = False) -> DataFrame:
    """``docs`` without its text column and with kept_text, n_words,
    n_removed and removed (spans of words). kept_text is the kept words joined
    by one space or, with ``layout``, the text with the removed words cut out."""
    tokens = word_tokens(window)
    marked, fields = mark_repeats(docs, id_col, text_col, tokens, True, subtrees(window))
    schema = T.StructType([marked.schema["row"], T.StructField("kept_text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", SPANS)])

    @releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts, n_words, n_removed, removed = [], [], [], []
            for body, parts in zip(unzipped(b.column(1)), b.column(2)):
                spans = all_spans(parts).tolist()
                left, total, gone = _without(body, spans, layout)
                texts.append(left.decode("utf-8", "replace"))
                n_words.append(total)
                n_removed.append(gone)
                removed.append([{"start": s, "end": e} for s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["row", "kept_text", "n_words", "n_removed", "removed"])

    return marked.mapInArrow(cut, schema).select(
        replace_columns("row", fields, {c: F.col(c) for c in ("kept_text", "n_words", "n_removed", "removed")}))
