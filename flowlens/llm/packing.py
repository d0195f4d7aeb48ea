"""Packing: concatenate and cut.

Method: two-pass prefix sums. Pass 1 tokenises each document once, beside a
running token total inside its partition, and writes ids and totals; the
partition totals (one row per input partition) are prefix-summed. Pass 2
turns (partition base + running total) into a global token offset and cuts
each document at the multiples of ``seq_len``. Every sequence but the last is
full, so padding is at most one sequence. No text or id is ever shuffled.

Defined results: null text is an empty document (just the end id); empty
documents are one piece of one id; a null id column value is carried through;
rows with equal ids are packed as separate documents; an empty table gives no
piece; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowlens.llm.common import chunks, releasing, save, ship, small, span_hashes

# The normaliser and pre-tokenizer for which words can be cut
# below; with any other the tokenizer reads every text itself.
_NORMALISER = ["NFC", "Replace", "Lowercase"]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Characters whose lower case, canonical form and class agree between Python
# and the tokenizer's own normaliser; texts with others go to it whole.
_PLAIN = "\t-\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027\u20ac"
_ODD = re.compile(f"[^{_PLAIN}]|<\\|")
_CACHE_WORDS = 400_000
_CHARS = 1 << 19                # characters of texts cut into words at once (one text at least)
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each plain character by code point."""
    out = np.full(0x20AD, _OTHER, np.uint8)
    for i in range(0x250):
        c = chr(i)
        out[i] = _LETTER if c.isalpha() else _DIGIT if c.isdecimal() else _SPACE if c.isspace() else _OTHER
    return out


def word_cuts(text: str, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of a lower-cased plain text: letter
    runs, single digits, other runs, and a lone quote with the ending after it."""
    cls = _classes()[cp]
    cut = np.concatenate(([True], (cls[1:] != cls[:-1]) | (cls[1:] == _DIGIT), [True]))
    if "'" in text:
        quote = np.flatnonzero((cp[:-1] == 39) & cut[:-2] & (cls[1:] == _LETTER)) if len(cp) > 1 else []
        for p in quote:
            size = 1 if text[p + 1] in "stmd" else 2 if text[p + 1:p + 3] in ("re", "ve", "ll") else 0
            if size:
                cut[p + 1] = False
                cut[p + 1 + size] = True
    at = np.flatnonzero(cut)
    words = cls[at[:-1]] != _SPACE
    return at[:-1][words], at[1:][words]


class WordIds:
    """Token ids of texts through a cache of pre-tokens.

    The vocabulary is word based (a pre-token's ids do not depend on its
    neighbours), so a text's ids are its words' ids in a row. A worker keeps
    the ids of the words it has met under a 64-bit hash of the word; new words
    are encoded by the tokenizer's own model. Texts outside the plain range
    above, or with a special token's brackets, are encoded by the tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = [x.get("type") for x in (spec["normalizer"] or {}).get("normalizers", [])] == _NORMALISER and \
            [x.get("type") for x in steps] == ["Split", "ByteLevel"] and \
            steps[0]["pattern"] == {"Regex": _SPLIT} and spec["model"].get("end_of_word_suffix") == "</w>"
        if self.by_word:
            spec |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"}, steps[1]]}}
            self.word_tok = Tokenizer.from_str(json.dumps(spec))
        self.path, self.tok = path, None            # the whole tokenizer: read for the first text that needs it
        tok = self.word_tok if self.by_word else self._tokenizer()
        self.ends = np.zeros(tok.get_vocab_size() + 1, bool)
        for piece, i in tok.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        self.dtype = "<u2" if len(self.ends) <= 1 << 16 else "<u4"
        self.known = np.zeros(0, np.uint64)         # sorted word hashes; beside them:
        self.start, self.size, self.hits = (np.zeros(0, np.int32) for _ in range(3))
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _tokenizer(self):
        if self.tok is None:
            from tokenizers import Tokenizer
            self.tok = Tokenizer.from_file(self.path)
        return self.tok

    def _forget(self) -> None:
        """Keep the words met in several calls; all go if those are too many."""
        keep = self.hits > 1
        if keep.sum() > _CACHE_WORDS // 2:
            keep[:] = False
        start, size = self.start[keep].astype(np.int64), self.size[keep].astype(np.int64)
        end = np.cumsum(size)
        self.used = int(end[-1]) if len(end) else 0
        self.pool[:self.used] = self.pool[np.repeat(start - (end - size), size) + np.arange(self.used)]
        self.known, self.start, self.size = self.known[keep], (end - size).astype(np.int32), self.size[keep]
        self.hits = np.zeros(len(self.known), np.int32)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, self.dtype).tobytes() for e in self._tokenizer().encode_batch(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode ``words`` (by ascending hash) as one text; each ends at its word-end piece."""
        ids = np.concatenate([np.asarray(self.word_tok.encode("\n".join(words[i:i + 8192]), add_special_tokens=False).ids,
                                         self.dtype) for i in range(0, len(words), 8192)])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("a word without an end piece")
        used = self.used
        while len(self.pool) < used + len(ids):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[used:used + len(ids)] = ids
        at, size = np.searchsorted(self.known, hashes), np.diff(ends, prepend=0)
        self.known = np.insert(self.known, at, hashes)
        self.start = np.insert(self.start, at, used + ends - size)
        self.size = np.insert(self.size, at, size)
        self.hits = np.insert(self.hits, at, 0)
        self.used += len(ids)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the known words, and whether each is known."""
        at = np.searchsorted(self.known, hashes)
        return at, np.append(self.known, np.uint64(0))[at] == hashes if len(self.known) else np.zeros(len(at), bool)

    def _plain(self, texts: list[str]) -> list[bytes]:
        text = "\n".join(texts).lower() + "\n"
        cp = np.frombuffer(text.encode("utf-32-le"), "<u4")
        starts, ends = word_cuts(text, cp)
        if not len(starts):
            return [b""] * len(texts)
        hashes, first, of = np.unique(span_hashes(cp, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > _CACHE_WORDS:
            self._forget()
        place, found = self._find(hashes)
        if not found.all():
            at = first[~found]
            self._learn(hashes[~found], [text[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())])
            place = np.searchsorted(self.known, hashes)
        self.hits[place] += 1
        word = place[of]
        size = self.size[word].astype(np.int64)
        total = np.cumsum(size)
        ids = self.pool[np.repeat(self.start[word] - (total - size), size) + np.arange(total[-1])].tobytes()
        width = np.dtype(self.dtype).itemsize
        after = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))       # words up to each text's end
        cuts = [0, *(width * np.concatenate(([0], total))[after]).tolist()]
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        odd = [not self.by_word or _ODD.search(t) is not None or not unicodedata.is_normalized("NFC", t) for t in texts]
        whole = iter(self._whole([t for t, o in zip(texts, odd) if o]))
        plain = iter(self._plain([t for t, o in zip(texts, odd) if not o]) if not all(odd) else [])
        return [next(whole if o else plain) for o in odd]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One tokenizer and cache for each Python worker."""
    return WordIds(path)


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", lists: bool = False) -> DataFrame:
    """Pieces of packed sequences: id, start, length, ids (uint32 LE bytes; with
    ``lists`` an array of int), doc_tokens, sequence_id, offset. ``start`` is the piece's place in its
    document, ``offset`` its place in the sequence."""
    ship(docs)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    @releasing
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part, at = word_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], ids.dtype).tobytes()
        width = len(end)
        for b in small(batches, 200):
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in chunks(np.array([len(t) for t in texts]), _CHARS):
                rows = b.slice(i, j - i)
                out = [x + end for x in ids(texts[i:j])]
                n = np.fromiter((len(x) // width for x in out), np.int64, len(out))
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(out, pa.binary()), pa.array(n), pa.array(before),
                     pa.array(np.full(len(out), part, np.int32))], ["id", "ids", "n", "before", "part"])

    @releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            at, take, pieces = b.column(3).to_pylist(), [], []
            for i, (ids, n, first) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), at)):
                start, ids = 0, np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()
                while start < n:
                    seq, offset = divmod(first + start, seq_len)
                    size = min(n - start, seq_len - offset)
                    take.append(i)
                    pieces.append((start, size, ids[4 * start:4 * (start + size)], n, seq, offset))
                    start += size
            cols = list(zip(*pieces)) if pieces else [[]] * 6
            arrays = [pa.array(c, pa.binary() if j == 2 else pa.int64()) for j, c in enumerate(cols)]
            if lists:
                ends = np.concatenate(([0], np.cumsum(cols[1], dtype=np.int32)))
                arrays[2] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                     pa.array(np.frombuffer(b"".join(cols[2]), "<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(take, pa.int64())), *arrays],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    tokens = save(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                  .mapInArrow(tokenize, f"id {id_type}, ids binary, n long, before long, part int"), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    # One row per input partition, known before the job: safe to hold and send.
    base = totals.select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("base"))
    return (tokens.join(F.broadcast(base), "part")
            .select("id", "ids", "n", (F.col("base") + F.col("before")).alias("at"))
            .mapInArrow(cut, f"id {id_type}, start long, length long, ids {'array<int>' if lists else 'binary'}, doc_tokens long, "
                             "sequence_id long, offset long")
            .withColumnRenamed("id", id_col))


@releasing
def crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: the ``ids`` column becomes its unsigned CRC-32."""
    for b in batches:
        crc = pa.array([zlib.crc32(x) for x in b.column("ids").to_pylist()], pa.int64())
        names = b.schema.names
        yield pa.RecordBatch.from_arrays([crc if n == "ids" else b.column(n) for n in names],
                                         ["ids_crc32" if n == "ids" else n for n in names])
