"""SentencePiece encoding and decoding: weighted finite-state transducer.

Method: the model's normaliser (blanks to the piece mark, mark in front), its
pieces and its byte fallback are compiled once per worker. A text is composed
with them segment by segment: the arcs of a segment are the pieces it can be
read as, from place to place, and the encoding is the shortest path in the
tropical semiring (weights add along a path, the least path wins).

* Unigram models: an arc weighs minus the piece's score.
* BPE models: merging decides, not a sum of scores. Two pieces may stand side
  by side in an encoding exactly if merging their joined text gives the two
  back, and the encoding is the one path all of whose neighbours may. So arcs
  weigh 0, and a state (the last piece) allows the next at 0 or not at all.

No piece has a mark after another character (checked when compiling), so no
path crosses the start of a word; segments are words, and short ones are kept
in a cache. Runs of blanks have pieces of equal score, for which the
side-by-side rule is not decisive: the last mark goes with its word as above, and
the marks before it are merged leftmost first, in one pass over them. That holds
where pieces of marks score below all others, as is checked when compiling;
otherwise such a segment is merged step by step, in n log n.

Defined results: null and empty texts have no ids and decode to the empty
text; a mark in a text reads as a blank; characters without a piece become
byte pieces, or the unknown piece without byte fallback. Models with a
precompiled character map are refused. Other columns are ignored, rows that
repeat are encoded alike, an empty table gives no row.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import releasing, ship, small

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_CACHE, _WORD = 600_000, 48
# Kinds of pieces and of models in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


class Transducer:
    """A compiled model: ``encode`` to ids, ``decode`` back to text."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        self.kind = model.trainer_spec.model_type
        if spec.precompiled_charsmap or self.kind not in (UNIGRAM, BPE) or \
                model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("only plain unigram and BPE models with marks in front of words are supported")
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        if any(MARK in p.lstrip(MARK) for p in self.pieces) or any(p.type == USER for p in model.pieces):
            raise ValueError("a piece crosses the start of a word")
        # The pieces' letter tree: character -> [next characters, the piece that ends here].
        self.tree: dict[str, list] = {}
        for p in self.pieces:
            level, entry = self.tree, None
            for c in p:
                entry = level.setdefault(c, [{}, None])
                level = entry[0]
            entry[1] = p
        self.score = [p.score for p in model.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = model.trainer_spec.unk_id
        # Pieces of marks only, and whether they are merged after all else.
        self.runs = {len(p): i for p, i in self.pieces.items() if not p.strip(MARK)}
        self.runs_last = not any(p.startswith(MARK * 2) and n not in self.runs.values() for p, n in self.pieces.items()) and \
            len({self.score[i] for n, i in self.runs.items() if n > 1}) <= 1 and \
            all(self.score[i] > self.score[j] for i in self.pieces.values() if i not in self.runs.values()
                for j in [i for n, i in self.runs.items() if n > 1][:1])
        self.least = min((self.score[i] for i in self.pieces.values()), default=0.0)
        self.longest = max(map(len, self.pieces), default=1)
        # What each id decodes to: a byte, a blank for a mark, nothing for a control piece.
        self.plain = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else " ⁇ ".encode() if p.type == UNKNOWN
                      else b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self.cache: dict[str, bytes] = {}
        self.beside: dict[str, dict[str, bool]] = {}
        self.known_pairs = 0

    # normaliser
    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", MARK)
        return MARK + text if self.prefix and text else text

    # pieces, composed with a segment
    def merged(self, segment: str) -> list[str]:
        """Merge the best-scored neighbours, the leftmost of ties, to the end."""
        if len(segment) > _WORD:
            return self._merged_long(segment)
        parts = list(segment)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.pieces.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or self.score[p] > best):
                    best, at = self.score[p], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_long(self, segment: str) -> list[str]:
        """The same with the pairs in a heap: n log n."""
        n = len(segment)
        end = list(range(1, n + 1))             # where the part that starts here ends; 0: merged into another
        before = list(range(-1, n - 1))         # start of the part before
        pairs: list[tuple[float, int, int]] = []

        def offer(at: int) -> None:
            mid = end[at]
            if mid < n:
                p = self.pieces.get(segment[at:end[mid]])
                if p is not None:
                    heappush(pairs, (-self.score[p], at, end[mid]))

        for i in range(n - 1):
            p = self.pieces.get(segment[i:i + 2])
            if p is not None:
                pairs.append((-self.score[p], i, i + 2))
        heapify(pairs)
        while pairs:
            _, at, stop = heappop(pairs)
            mid = end[at]
            if not mid or mid >= n or end[mid] != stop:     # one of the two has changed since
                continue
            end[at], end[mid] = stop, 0
            if stop < n:
                before[stop] = at
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return [segment[i:e] for i, e in enumerate(end) if e]

    def _marks(self, n: int) -> list[str]:
        """Pieces of ``n`` marks in a row: the leftmost two that a piece joins
        are merged, again and again."""
        runs, done = self.runs, []
        for _ in range(n):
            done.append(1)
            while len(done) > 1 and done[-1] + done[-2] in runs:
                done[-2:] = [done[-1] + done[-2]]
        return [MARK * k for k in done]

    def allowed(self, a: str, b: str) -> bool:
        """Whether ``b`` may follow ``a`` ("": stand first)."""
        if self.known_pairs > _CACHE:
            self.beside.clear()
            self.known_pairs = 0
        self.known_pairs += 1
        ok = self.beside.setdefault(a, {})[b] = self.merged(a + b) == ([a, b] if a else [b])
        return ok

    def shortest(self, segment: str) -> list[str]:
        """The least path from the segment's start to its end."""
        n, pieces, longest = len(segment), self.pieces, self.longest
        if self.kind == BPE:
            if segment.startswith(MARK * 2):
                if not self.runs_last:
                    return self.merged(segment)
                word = segment.lstrip(MARK)
                parts = self.shortest(MARK + word) if word else [MARK]
                k = n - len(word) - (parts[0] != MARK)
                return self._marks(k) + parts[parts[0] == MARK:]
            last: list[str | None] = ["", *[None] * n]
            tree, none = self.tree, {}
            for start in range(n):
                before = last[start]
                if before is None:
                    continue
                known = self.beside.get(before, none)
                entry, end = tree.get(segment[start]), start + 1
                if (entry is None or entry[1] is None) and last[end] is None:   # a character without a piece
                    part = segment[start]
                    ok = known.get(part)
                    if self.allowed(before, part) if ok is None else ok:
                        last[end] = part
                while entry is not None:
                    part = entry[1]
                    if part is not None and last[end] is None:
                        ok = known.get(part)
                        if self.allowed(before, part) if ok is None else ok:
                            last[end] = part
                    if end == n:
                        break
                    entry = entry[0].get(segment[end])
                    end += 1
        else:
            cost, last = [0.0] + [float("inf")] * n, [None] * (n + 1)
            for end in range(1, n + 1):
                for start in range(max(0, end - longest), end):
                    part = segment[start:end]
                    i = pieces.get(part)
                    if i is None and start < end - 1:
                        continue
                    c = cost[start] - (self.score[i] if i is not None else self.least - 10)
                    if c < cost[end]:
                        cost[end], last[end] = c, part
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _ids(self, segment: str) -> bytes:
        parts = self.shortest(segment)
        known = [self.pieces.get(part) for part in parts]
        if None not in known:
            return np.array(known, "<u4").tobytes()
        out: list[int] = []
        for part, i in zip(parts, known):
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[x] for x in part.encode("utf-8", "replace")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        known, out = self.cache, []
        for segment in _SEGMENT.findall(self.normalise(text)):
            ids = known.get(segment)
            if ids is None:
                ids = self._ids(segment)
                if len(segment) <= _WORD and len(known) < _CACHE:
                    known[segment] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids: pieces joined, bytes read as UTF-8, marks as blanks."""
        text = b"".join(map(self.plain.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=1)
def compiled(path: str) -> Transducer:
    return Transducer(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (uint32 LE), n_ids, decoded (the text of the ids) and round_trip
    (whether it is the row's text)."""
    ship(docs)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model_path)
        for b in small(batches, 200):
            texts = b.column(1).to_pylist()
            ids = [fst.encode(t) for t in texts]
            back = [fst.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array(back, pa.string()), pa.array([t == x for t, x in zip(texts, back)])],
                ["id", "ids", "n_ids", "decoded", "round_trip"])

    return rows.mapInArrow(run, f"id {id_type}, ids binary, n_ids long, decoded string, round_trip boolean") \
        .withColumnRenamed("id", id_col)
