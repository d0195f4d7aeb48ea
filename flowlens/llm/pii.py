"""Personal data: skip-chain conditional random field.

Method: the tokens of a document that hold a digit or ``@`` are the nodes of a
random field over the labels none, email, ip, card and phone. A node's own
potential comes from its shape; neighbouring tokens share a chain potential by
what stands between them; tokens that repeat or resemble each other, however far
apart (same letters and digits, same last digits, same local part), share a skip
potential through a node of their own that stands for the value, so a value
repeated n times costs n links. Loopy sum-product passes messages along both, and
the labels come out consistent over the whole document.

Base matches (patterns with checks) are evidence: their tokens are fixed to their
kind and their spans always stay. A further span is a run of tokens of one kind
(marginal ``likely`` or more), one of which at least is ``sure`` and shares a value
with a base match of that kind in the same document. A document without base matches gets none.

Training is piecewise, by counting: each potential is the smoothed log-odds of
labels among the tokens of at most ``sample`` documents (the ids least by hash),
their labels being the base matches. As an unmatched token is no proof of
innocence, a shape's odds are kept within ``-TRUST`` and ``TRUST``. The driver
receives sums by shape and by gap only.

Defined results: null and empty texts have no spans. Offsets are code points, end
exclusive. Rows that repeat are marked alike; a null id is marked, not learned
from. Other columns are passed on, those named as an output column replaced. An
empty table gives no row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import releasing, replace_columns, ship, small

KINDS = ("email", "ip", "card", "phone")
TRUST = 2.5
Span = tuple[int, int, int]         # start, end, kind (place in KINDS)

_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NODE = re.compile(r"[0-9@]")
_PART = re.compile(r"[A-Za-z0-9._%+@-]*+")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits), 1))
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from the @ on: the local part is all that can stand before it."""
    done = 0
    for m in _HOST.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> list[Span]:
    """The matches of each kind, leftmost and not overlapping within it; sorted
    by start, then kind."""
    out: list[Span] = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
            out.append((*m.span(), 1))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


@dataclass
class Tokens:
    """The nodes of one document."""
    start: list[int]
    end: list[int]
    shape: list[str]
    keys: list[list[str]]           # values a token shares with others
    gap: list[str]                  # what stands before it ("": far away)
    base: np.ndarray                # label by the base matches, 0 for none


def _shape(part: str, before: str) -> str:
    """A token's class: digits, letters, marks and what stands in front."""
    digits = sum(map(str.isdigit, part))
    size = digits if digits < 6 else 6 if digits < 8 else 8 if digits < 14 else 14 if digits < 20 else 20
    return f"{size}{'@' if '@' in part else ''}{'a' if any(map(str.isalpha, part)) else ''}" \
           f"{'...' if part.count('.') == 3 else '.' if '.' in part else ''}{'-' if '-' in part else ''}" \
           f"{before if before in ('+', '(') else ''}"


def _keys(part: str) -> list[str]:
    """What says that two tokens are one value: all of it, the last digits, the
    local part. Values of under four characters say nothing."""
    folded = part.lower()
    plain = "".join(c for c in folded if c.isalnum() or c == "@")
    digits = "".join(filter(str.isdigit, folded))
    out = {plain, folded.split("@")[0]} if "@" in folded else {plain}
    if len(digits) >= 7 and len(digits) == len(plain):
        out.add(digits[-7:])
    return sorted(k for k in out if len(k) >= 4)


def tokens(text: str, spans: list[Span]) -> Tokens:
    out = Tokens([], [], [], [], [], np.zeros(0, np.int64))
    end, n = 0, len(text)
    for m in _NODE.finditer(text):
        if m.start() < end:
            continue
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        stop = _PART.match(text, m.start()).end()
        while stop > m.end() and text[stop - 1] in "._%+-":
            stop -= 1
        gap = text[end:start] if out.end and start - end <= 3 else None
        part = text[start:stop]
        out.shape.append(_shape(part, text[start - 1:start]))
        out.keys.append(_keys(part))
        out.gap.append("" if gap is None or not all(c in " ().-/" for c in gap) else "s" if gap.strip() == "" else "p")
        out.start.append(start)
        out.end.append(stop)
        end = stop if stop < n else n
    out.base = np.zeros(len(out.start), np.int64)
    starts = np.array(out.start, np.int64)
    for a, b, kind in reversed(spans):          # of kinds that overlap, the first listed
        lo = max(0, int(np.searchsorted(starts, a, "right")) - 1)
        for i in range(lo, int(np.searchsorted(starts, b, "left"))):
            if out.end[i] > a:
                out.base[i] = kind + 1
    return out


@dataclass(frozen=True)
class Field:
    """Log potentials: of a shape (label), of a gap and of a shared value (label, label)."""
    shape: dict[str, np.ndarray]
    chain: dict[str, np.ndarray]
    skip: np.ndarray

    def unary(self, shape: str) -> np.ndarray:
        return self.shape.get(shape, _NO_SHAPE)


_LABELS = len(KINDS) + 1
_NO_SHAPE = np.array([0.0] + [-TRUST] * len(KINDS))


def marginals(field: Field, t: Tokens, rounds: int = 12) -> tuple[np.ndarray, list[tuple[int, str]]]:
    """Label probabilities of each token, by loopy sum-product, and the links
    (token, value) of values met more than once. Evidence tokens keep their label."""
    n = len(t.start)
    met = Counter(k for keys in t.keys for k in keys)
    links = [(i, k) for i, keys in enumerate(t.keys) for k in keys if met[k] > 1]
    number = {k: n + j for j, k in enumerate(dict.fromkeys(k for _, k in links))}
    a = np.array([i for i in range(1, n) if t.gap[i]] + [i for i, _ in links], np.int64)
    b = np.array([i - 1 for i in range(1, n) if t.gap[i]] + [number[k] for _, k in links], np.int64)
    own = np.zeros((n + len(number), _LABELS))
    for i in range(n):
        own[i] = field.unary(t.shape[i])
        if t.base[i]:
            own[i] = -50.0
            own[i, t.base[i]] = 0.0
    if not len(a):
        p = np.exp(own - own.max(axis=1, keepdims=True))
        return (p / p.sum(axis=1, keepdims=True))[:n], links
    # Each link both ways; pot[e][x, y]: x at the sender, y at the receiver.
    pot = np.array([field.chain[t.gap[i]] for i in range(1, n) if t.gap[i]] + [field.skip] * len(links))
    src, dst = np.concatenate([b, a]), np.concatenate([a, b])
    pot = np.exp(np.concatenate([pot, pot.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
    msg = np.zeros((len(src), _LABELS))
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, dst, msg)
        send = belief[src] - msg[back]
        send -= send.max(axis=1, keepdims=True)
        new = np.log(np.einsum("ex,exy->ey", np.exp(send), pot) + 1e-300)
        msg = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
    belief = own.copy()
    np.add.at(belief, dst, msg)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return (p / p.sum(axis=1, keepdims=True))[:n], links


def added_spans(field: Field, text: str, base: list[Span], sure: float = 0.9, likely: float = 0.7) -> list[Span]:
    """Spans that the field adds to the base matches."""
    if not base:
        return []
    t = tokens(text, base)
    p, links = marginals(field, t)
    known = {(k, int(t.base[i])) for i, keys in enumerate(t.keys) if t.base[i] for k in keys}
    best = p.max(axis=1)
    label = np.where(best >= likely, p.argmax(axis=1), 0)
    tied = {i for i, k in links if not t.base[i] and best[i] >= sure and (k, int(label[i])) in known}
    out: list[Span] = []
    i, n = 0, len(label)
    while i < n:
        j = i + 1
        if label[i] and not t.base[i]:
            while j < n and label[j] == label[i] and not t.base[j] and t.gap[j]:
                j += 1
            if any(x in tied for x in range(i, j)):
                out.append((t.start[i], t.end[j - 1], int(label[i]) - 1))
        i = j
    return out


def _counts(text: str) -> Iterator[tuple[str, int, int]]:
    """What the fit sums: (shape, label, -1), (gap, label, label), ("", ...) of shared values."""
    t = tokens(text, base_spans(text))
    seen: dict[str, int] = {}
    for i, y in enumerate(t.base.tolist()):
        yield f"u{t.shape[i]}", y, -1
        if t.gap[i]:
            yield f"c{t.gap[i]}", int(t.base[i - 1]), y
        for k in t.keys[i]:
            if k in seen:
                yield "s", seen[k], y
            seen[k] = y


def learn(rows: list[tuple[str, int, int, int]]) -> Field:
    """Potentials from sums of ``_counts``."""
    shapes: dict[str, np.ndarray] = {}
    pairs = {k: np.full((_LABELS, _LABELS), 0.5) for k in ("cs", "cp", "s")}
    for what, x, y, n in rows:
        if what[0] == "u":
            # What stands in front says more where it is there, and nothing where it is not.
            for shape in {what[1:], what[1:].rstrip("+(")}:
                shapes.setdefault(shape, np.full(_LABELS, 0.5))[x] += n
        else:
            pairs[what][x, y] += n

    def agreement(c: np.ndarray) -> np.ndarray:
        """Log-odds of a pair of labels against chance, the same both ways."""
        p = (c + c.T) / (2 * c.sum())
        m = p.sum(axis=1)
        return np.clip(np.log(p / np.outer(m, m)), -3, 6)

    skip = agreement(pairs["s"])
    # Two mentions of one value are one kind at least as surely as shapes can say otherwise.
    skip = np.maximum(skip, np.where(np.eye(_LABELS, dtype=bool), 2 * TRUST, -np.inf))
    skip[0, 0] = 0.0
    return Field({s: np.clip(np.log(c) - np.log(c[0]), -TRUST, TRUST) for s, c in shapes.items()},
                 {k[1:]: agreement(c) for k, c in pairs.items() if k != "s"}, skip)


def fit(docs: DataFrame, sample: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> Field:
    ship(docs)
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("text")).filter("k IS NOT NULL AND text IS NOT NULL")
    picks = rows.select("k", F.xxhash64("k", F.lit("pii")).alias("h")).distinct().orderBy("h", "k").limit(sample).select("k")

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in small(batches, 200):
            for text in b.column(0).to_pylist():
                total.update(_counts(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()),
             pa.array([k[2] for k in total], pa.int32()), pa.array(list(total.values()), pa.int64())], ["what", "x", "y", "n"])

    sums = rows.join(F.broadcast(picks), "k").select("text").mapInArrow(run, "what string, x int, y int, n long") \
        .groupBy("what", "x", "y").agg(F.sum("n").alias("n"))
    return learn([tuple(r) for r in sums.collect()])        # shapes and gaps are few by their definition


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


_NEW = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans")


def mark(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base matches), base and
    spans (kind:start:end, comma-joined; all spans, base ones among them)."""
    ship(docs)
    fields = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in fields]).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(c, T.LongType()) for c in _NEW[:4]],
                           *[T.StructField(c, T.StringType()) for c in _NEW[4:]]])

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            base, full = [], []
            for text in b.column(1).to_pylist():
                found = base_spans(text)
                base.append(found)
                full.append(found + added_spans(field, text, found))
            counts = [[sum(s[2] == k for s in x) for x in base] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(list(map(joined, base)), pa.string()),
                 pa.array(list(map(joined, full)), pa.string())], ["row", *_NEW])

    return rows.mapInArrow(run, schema).select(replace_columns("row", fields, {c: F.col(c) for c in _NEW}))
