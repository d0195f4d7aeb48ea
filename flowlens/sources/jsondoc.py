"""One-document JSON in parallel: ``{"data": [ {...}, {...}, ... ]}`` of any size.

A JSON document has no line to cut at: whether a byte is structure or text
depends on everything before it. The file is cut into byte splits and read in
three jobs:

1. *states*: for each split, where each of the three ways to enter it (outside
   a string, inside one, inside one behind a backslash) leads: the way out, the
   change of depth and the backslash state. The few numbers per split are
   composed along a file, which gives every split its true entry.
2. *marks*: from its true entry each split finds the members of the top-level
   object and counts the records (objects directly in a top-level array) between
   them. Composed along the file this gives the byte range of the wanted array
   and the number of its first record in each split.
3. *records*: each split emits the text of the records that start in it, reading
   on past its end for the last one.

Only the numbers per split are grouped by file; record bytes stay in the task
of their split, held a block at a time (a single record is held whole).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_BYTES = 64 << 20          # of large inputs; small ones are cut for all task slots,
MIN_SPLIT_BYTES = 256 << 10     # but not below this
BLOCK = 4 << 20
OUT, IN, IN_ESCAPED = 0, 1, 2

_SPLITS = "uri STRING, size BIGINT, split BIGINT, lo BIGINT, hi BIGINT"
_STATES = f"{_SPLITS}, leave ARRAY<INT>, rise ARRAY<BIGINT>"
_ENTRIES = f"{_SPLITS}, state INT, depth BIGINT"
_MARKS = f"{_ENTRIES}, marks ARRAY<STRUCT<at: BIGINT, kind: STRING, n: BIGINT>>"
_RANGES = f"{_ENTRIES}, parts ARRAY<STRUCT<begin: BIGINT, stop: BIGINT, base: BIGINT>>"


def scan(data: bytes, state: int, depth: int):
    """(structural positions, their bytes, depth after each, string starts, string
    ends, state out, depth out) of a block entered in ``state`` at ``depth``.

    Positions are indexes into ``data``; a string start is the place of its
    opening quote, an end that of its closing one."""
    import numpy as np
    b = np.frombuffer(data, dtype=np.uint8)
    n = len(b)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return none, b, none, none, none, state, depth
    quote = np.flatnonzero(b == 0x22)
    slash = np.flatnonzero(b == 0x5C)
    if len(slash):
        # a run of backslashes escapes what follows it if its length is odd
        starts = np.flatnonzero(np.diff(slash, prepend=slash[0] - 2) != 1)
        begin = slash[starts]
        length = np.diff(np.append(starts, len(slash)))
        if state == IN_ESCAPED and begin[0] == 0:
            length = length.copy()
            length[0] -= 1              # the first one is itself escaped
            begin = begin.copy()
            begin[0] = 1
        odd = (length % 2 == 1)
        escaped = (begin + length)[odd]
    else:
        escaped = none
    if state == IN_ESCAPED and not (len(slash) and slash[0] == 0):
        escaped = np.append(escaped, 0)
    ends_escaped = bool((escaped == n).any())
    quote = quote[~np.isin(quote, escaped)]
    inside = state != OUT
    opens, closes = (quote[1::2], quote[0::2]) if inside else (quote[0::2], quote[1::2])
    structural = np.flatnonzero((b == 0x7B) | (b == 0x7D) | (b == 0x5B) | (b == 0x5D) | (b == 0x2C) | (b == 0x3A))
    before = np.searchsorted(quote, structural)
    structural = structural[(before % 2 == 0) != inside]
    kind = b[structural]
    step = ((kind == 0x7B) | (kind == 0x5B)).astype(np.int64) - ((kind == 0x7D) | (kind == 0x5D)).astype(np.int64)
    levels = depth + np.cumsum(step)
    out_inside = (len(quote) % 2 == 1) != inside
    out = (IN_ESCAPED if ends_escaped else IN) if out_inside else OUT
    return structural, kind, levels, opens, closes, out, int(levels[-1]) if len(levels) else depth


def _blocks(uri: str, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    from flowlens.sources.capture import _fs
    fs, p = _fs(uri)
    with fs.open_input_file(p) as f:
        while lo < hi:
            data = f.read_at(min(BLOCK, hi - lo), lo)
            if not data:
                raise ValueError(f"{uri}: ends at byte {lo}, before its listed size")
            yield lo, data
            lo += len(data)


def _states(batches):
    import pandas as pd
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            state, depth = [OUT, IN, IN_ESCAPED], [0, 0, 0]
            for _, data in _blocks(r.uri, r.lo, r.hi):
                for e in range(3):
                    *_, state[e], depth[e] = scan(data, state[e], depth[e])
            rows.append((*r, state, depth))
        yield pd.DataFrame(rows, columns=[*pdf.columns, "leave", "rise"])


def _entries(pdf):
    """States of one file's splits -> the true entry of each."""
    import pandas as pd
    rows, state, depth = [], OUT, 0
    for r in pdf.sort_values("split").itertuples(index=False):
        rows.append((r.uri, r.size, r.split, r.lo, r.hi, state, depth))
        depth += int(r.rise[state])
        state = int(r.leave[state])
    if state != OUT or depth:
        raise ValueError(f"{pdf['uri'].iloc[0]}: the document does not end (depth {depth})")
    return pd.DataFrame(rows, columns=["uri", "size", "split", "lo", "hi", "state", "depth"])


def _marks(batches):
    """Per split, in order: ``key`` (the opening quote of a string in the top-level
    object), ``open`` / ``close`` of a top-level array, ``colon``, ``comma`` and
    ``n`` records started since the mark before."""
    import numpy as np
    import pandas as pd
    names = {0x5B: "open", 0x5D: "close", 0x3A: "colon", 0x2C: "comma"}
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            state, depth, marks, n = int(r.state), int(r.depth), [], 0
            for at, data in _blocks(r.uri, r.lo, r.hi):
                pos, kind, level, opens, _, state, out = scan(data, state, depth)
                enter = np.concatenate(([depth], level[:-1])) if len(level) else level
                record = (kind == 0x7B) & (level == 3)
                top = (((kind == 0x3A) | (kind == 0x2C)) & (level == 1)
                       | (kind == 0x5B) & (level == 2) | (kind == 0x5D) & (enter == 2))
                lv = np.concatenate(([depth], level))[np.searchsorted(pos, opens)]
                events = [(int(p), names[int(k)]) for p, k in zip(pos[top], kind[top])]
                events += [(int(p), "key") for p in opens[lv == 1]]
                starts, seen = pos[record], 0
                for p, name in sorted(events):
                    upto = int(np.searchsorted(starts, p))
                    n, seen = n + upto - seen, upto
                    marks.append({"at": at + p, "kind": name, "n": n})
                    n = 0
                n += len(starts) - seen
                depth = out
            marks.append({"at": int(r.hi), "kind": "end", "n": n})
            rows.append((*r, marks))
        yield pd.DataFrame(rows, columns=[*pdf.columns, "marks"])


def _read_string(uri: str, at: int, size: int) -> str:
    """The JSON string whose opening quote is at byte ``at``."""
    text, state = b"", OUT
    for _, data in _blocks(uri, at, size):
        *_, closes, state, _ = scan(data, state, 0)
        if len(closes):
            return json.loads(text + data[:int(closes[0]) + 1])
        text += data
    raise ValueError(f"{uri}: string at byte {at} does not end")


def _ranges(member: str):
    """Marks of one file's splits -> the byte ranges of the array ``member`` in each
    split, with the number of the first record there. Of a repeated member the
    last one counts, as in most readers."""
    def fn(pdf):
        import pandas as pd
        pdf = pdf.sort_values("split")
        uri, size = pdf["uri"].iloc[0], int(pdf["size"].iloc[0])
        arrays, key, name, wanted = [], None, None, None    # wanted: [(split, from, to, first record)]
        count = 0
        for r in pdf.itertuples(index=False):
            begin = int(r.lo)
            for m in r.marks:
                if wanted is not None:
                    if m["kind"] in ("close", "end"):
                        wanted.append((r.split, begin, int(m["at"]), count))
                        count += int(m["n"])
                    if m["kind"] == "close":
                        arrays, wanted = [wanted], None
                elif m["kind"] == "key":
                    key = int(m["at"])
                elif m["kind"] == "colon":
                    name = _read_string(uri, key, size) if key is not None else None
                elif m["kind"] == "comma":
                    key = name = None
                elif m["kind"] == "open" and name == member:
                    wanted, count, begin = [], 0, int(m["at"]) + 1
        parts: dict[int, list] = {}
        for a in arrays:
            for split, lo, hi, base in a:
                parts.setdefault(split, []).append({"begin": lo, "stop": hi, "base": base})
        pdf = pdf.drop(columns=["marks"])
        pdf["parts"] = [parts.get(s, []) for s in pdf["split"]]
        return pd.DataFrame(pdf[["uri", "size", "split", "lo", "hi", "state", "depth", "parts"]])
    return fn


def _records(batches):
    """Texts of the records that start inside the split's part of the array."""
    import numpy as np
    import pandas as pd
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if not len(r.parts):
                continue
            part = r.parts[0]
            lo, hi, pos = int(part["begin"]), int(part["stop"]), int(part["base"])
            state, depth, open_text = int(r.state), int(r.depth), None
            size, out = int(r.size), []
            for at, data in _blocks(r.uri, int(r.lo), size):
                place, kind, level, _, _, state, depth_out = scan(data, state, depth)
                at_level = np.concatenate(([depth], level))
                begins = place[(kind == 0x7B) & (level == 3)]
                ends = place[(kind == 0x7D) & (level == 2)] + 1
                _only_records(r.uri, at, data, place, at_level, place[(kind == 0x5B) & (level == 3)], lo, hi)
                used = 0
                if open_text is not None:       # the record of the block before
                    if not len(ends):
                        open_text.append(data)
                        used = -1
                    else:
                        out.append((pos, b"".join(open_text) + data[:ends[0]]))
                        pos, open_text, used = pos + 1, None, int(ends[0])
                if used >= 0:
                    for b in begins[begins >= used]:
                        if not lo <= at + b < hi:
                            continue
                        done = np.searchsorted(ends, b, side="right")
                        if done == len(ends):
                            open_text = [data[b:]]
                            break
                        out.append((pos, data[b:ends[done]]))
                        pos += 1
                depth = depth_out
                if out:
                    yield pd.DataFrame({"_path": r.uri, "pos": [p for p, _ in out], "json": [t.decode() for _, t in out]})
                    out = []
                if open_text is None and at + len(data) >= hi:
                    break


def _only_records(uri, at, data, place, at_level, arrays, lo, hi):
    """Between records an array holds blanks and commas; any other element would
    have a position of its own, so it is an error rather than a gap."""
    import numpy as np
    a, b = max(lo - at, 0), min(hi - at, len(data))
    if a >= b:
        return
    bytes_ = np.frombuffer(data, dtype=np.uint8)
    odd = np.flatnonzero(~np.isin(bytes_[a:b], np.frombuffer(b" \t\r\n,{}", dtype=np.uint8))) + a
    # what belongs to a record lies deeper than the array, text in its strings too
    found = [*odd[at_level[np.searchsorted(place, odd, side="right")] == 2][:1], *arrays[(arrays >= a) & (arrays < b)][:1]]
    if found:
        raise ValueError(f"{uri}: element at byte {at + int(min(found))} is not an object")


def split_rows(files, split_bytes: int):
    return [(uri, size, k, lo, min(size, lo + split_bytes)) for uri, size in files
            for k, lo in enumerate(range(0, size, split_bytes))]


def read_json_array(spark: SparkSession, files: list[tuple[str, int]], member: str = "data",
                    split_bytes: int | None = None) -> DataFrame:
    """(``_path``, ``pos``, ``json``): the objects of the array ``member`` of each
    file's top-level object, in parallel over byte splits.

    A file without the member, an empty array or an empty file gives no row. A
    document that does not end, an element that is no object, and a compressed
    file (its bytes cannot be cut) are errors. Without ``split_bytes`` there are
    two splits for each task slot, of at most 64 MiB.
    """
    from flowlens.session import ship_package
    schema = "_path STRING, pos BIGINT, json STRING"
    packed = [uri for uri, _ in files if uri.endswith((".gz", ".bz2", ".zst", ".xz", ".lz4", ".snappy"))]
    if packed:
        raise ValueError(f"{packed[0]}: cannot be cut into byte splits; unpack it first")
    if split_bytes is None:
        even = sum(size for _, size in files) // (2 * spark.sparkContext.defaultParallelism)
        split_bytes = max(MIN_SPLIT_BYTES, min(SPLIT_BYTES, even))
    rows = split_rows(files, split_bytes)
    if not rows:
        return spark.createDataFrame([], schema)
    ship_package(spark)
    splits = spark.createDataFrame(rows, _SPLITS).repartition(len(rows))
    states = splits.mapInPandas(_states, _STATES)
    entries = states.groupBy("uri").applyInPandas(_entries, _ENTRIES).checkpoint()
    marks = entries.repartition(len(rows)).mapInPandas(_marks, _MARKS)
    ranges = marks.groupBy("uri").applyInPandas(_ranges(member), _RANGES).checkpoint()
    return ranges.filter(F.size("parts") > 0).repartition(len(rows)).mapInPandas(_records, schema)
