"""Suffix-array dedup over bytes: depth-limited radix sort.

Method: suffixes are ordered only through their first ``window`` bytes, by
most-significant-digit passes of eight bytes. A pass splits each group of
suffixes equal so far by the next digit; suffixes alone in their group are
done and leave. The groups left after the last pass are exactly the repeated
windows, and every place but the first (document, then start) is removed.
The first digit is taken across the cluster: ``repeats`` says how suffixes
are thinned before it and how a crowded digit is lengthened.

Defined results: a null text is empty; matches never cross documents; a null
id is ordered after all others, and rows with equal ids count as one document
(equal rows keep the same bytes, all are returned). Input columns named like
an output column are replaced by it. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import gram_hashes, releasing, replace_columns, small
from flowlens.llm.repeats import SPANS, Tokens, all_spans, mark_repeats, unzipped

GRAM, DIGIT = 24, 8


def byte_tokens(window: int) -> Tokens:
    gram = min(GRAM, window)
    return Tokens(window, gram, lambda data, bounds: (gram_hashes(data, gram), bounds), bytes, bytes)


def _sets(rows: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose keys, in order, a neighbour has too, and the number of the set of each."""
    new = np.ones(len(rows), bool)
    if len(rows):
        new[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
    ids = np.cumsum(new) - 1
    many = np.bincount(ids, minlength=1)[ids] > 1
    return rows[many], ids[many]


def radix_sets(text: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``starts`` whose ``depth`` bytes another row of the group has
    too, and the number of the set of equal ones, ascending. ``group``: what
    the suffixes were already split by."""
    text = np.concatenate((text, np.zeros(DIGIT, np.uint8)))
    digits = np.lib.stride_tricks.sliding_window_view(text, DIGIT)
    rows = np.argsort(group, kind="stable")
    rows, sets = _sets(rows, group[rows])
    for at in range(0, depth, DIGIT):
        digit = np.ascontiguousarray(digits[starts[rows] + at]).view(">u8").ravel()
        if depth - at < DIGIT:
            digit = digit >> np.uint64(8 * (DIGIT - depth + at))
        split = sets[1:][(digit[1:] != digit[:-1]) & (sets[1:] == sets[:-1])]
        if not len(split):
            continue
        # Only the rows of sets that this digit splits are put in order.
        part = np.flatnonzero(np.isin(sets, split, kind="table"))
        order = part[np.lexsort((digit[part], sets[part]))]
        rows[part], digit[part] = rows[order], digit[order]
        rows, sets = _sets(rows, sets, digit)
    return rows, sets


def radix_groups(text: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """The rows of ``radix_sets``, set by set."""
    rows, sets = radix_sets(text, starts, group, depth)
    if len(rows):
        yield from np.split(rows, np.flatnonzero(np.diff(sets)) + 1)


def passes(depth: int):
    def equal(group: np.ndarray, bodies: list[bytes], run: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in bodies])
        return radix_sets(np.frombuffer(b"".join(bodies), np.uint8), (np.cumsum(size) - size)[run] + at,
                          group[run], depth)
    return equal


def remove_repeats(docs: DataFrame, window: int = 100, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` without its text column and with kept (the remaining bytes), n_bytes, n_removed and
    removed (maximal spans of bytes)."""
    marked, fields = mark_repeats(docs, id_col, text_col, byte_tokens(window), False, passes(window))
    schema = T.StructType([marked.schema["row"], T.StructField("kept", T.BinaryType()),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", SPANS)])

    @releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            kept, sizes, gone, removed = [], [], [], []
            for body, parts in zip(unzipped(b.column(1)), b.column(2)):
                spans = all_spans(parts).tolist()
                ends = [0, *(e for _, e in spans)]
                kept.append(b"".join(body[a:s] for a, (s, _) in zip(ends, spans)) + body[ends[-1]:])
                sizes.append(len(body))
                gone.append(len(body) - len(kept[-1]))
                removed.append([{"start": s, "end": e} for s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["row", "kept", "n_bytes", "n_removed", "removed"])

    return marked.mapInArrow(cut, schema).select(
        replace_columns("row", fields, {c: F.col(c) for c in ("kept", "n_bytes", "n_removed", "removed")}))
