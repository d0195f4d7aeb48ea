"""Personal data: base matches against the patterns as worded, the field against
enumeration, repeated values planted in other forms."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import pii, queries

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2:
                twice = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])]
                if not 14 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            if k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((*m.span(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_matches_equal_patterns():
    rng = random.Random(1)
    for alphabet in ("a1.@-", "12. -+()", "0123456789 -", "@a.", "ä٣1.2+", "+0 -1234567"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == brute(text), text
    for text in ("4111111111111111 4111 1111 1111 1111 4111-1111-1111-1112", "x+1 (017) 555-7713.", "256.1.1.1 1.2.3.4.5.6.7.8",
                 "a@b.c.@d.e", "und.34@mail7.example.com###", "+" * 30 + "1 234 567 8901"):
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for c in ("a", "1", "@", ".", "+", "1.", "1 ", "a@", "+1 ", "12-", "+1"):
        text = c * (400_000 // len(c))
        pii.added_spans(pii.learn([]), text, pii.base_spans(text))


FIELD = pii.learn([("u3", 4, -1, 50), ("u6-", 4, -1, 50), ("u3", 0, -1, 10), ("u16", 3, -1, 5), ("cs", 4, 4, 90), ("cs", 0, 0, 300),
                   ("s", 4, 4, 9), ("s", 1, 1, 5), ("s", 2, 2, 5), ("s", 0, 0, 50)])


def exact(field, t, links):
    """Marginals by summing over all labellings."""
    keys = list(dict.fromkeys(k for _, k in links))
    n = len(t.start)
    p = np.zeros((n, 5))
    for y in itertools.product(range(5), repeat=n + len(keys)):
        s = 0.0
        for i in range(n):
            s += (0.0 if y[i] == t.base[i] else -50.0) if t.base[i] else field.unary(t.shape[i])[y[i]]
            if i and t.gap[i]:
                s += field.chain[t.gap[i]][y[i - 1], y[i]]
        for i, k in links:
            s += field.skip[y[i], y[n + keys.index(k)]]
        for i in range(n):
            p[i, y[i]] += np.exp(s)
    return p / p.sum(axis=1, keepdims=True)


def test_marginals_on_trees_are_exact_and_near_on_loops():
    for text, close in (("+1 (017) 555-7713", 1e-4), ("10.0.0.1 and 10.0.0.1 9", 1e-4), ("5551234 x 5551234 y 5551234", 1e-4),
                        ("+1 (017) 555-7713 or 017 555-7713", 0.05)):
        t = pii.tokens(text, pii.base_spans(text))
        p, links = pii.marginals(FIELD, t, rounds=60)
        assert np.abs(p - exact(FIELD, t, links)).max() < close, text


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_repeated_values_in_other_forms(spark, given):
    field = pii.fit(given)
    word = "lorem ipsum " * 200

    def added(text):
        return [text[a:b] for a, b, _ in pii.added_spans(field, text, pii.base_spans(text))]

    assert added(f"Call +1 (017) 555-7713 now. {word} Or 017 555-7713.") == ["017 555-7713"]
    assert added(f"Call +1 (017) 555-7713 now. {word} Or (017)555-7713!") == ["017)555-7713"]
    assert added(f"Mail und.34@mail7.example.com {word} to und.34@mail7 please") == ["und.34@mail7"]
    # Numbers of their own, licence versions and texts without a base match stay alone.
    assert added(f"Call +1 (017) 555-7713 now. {word} Version 3 of 2024, CC BY-NC 4.0, 018 444-1234.") == []
    assert added(f"{word} 017 555-7713 and again 017 555-7713") == []
    clean = [r["text"] for r in given.select("text").collect() if not brute(r["text"] or "")]
    assert clean and not any(map(added, clean))


def test_query(spark, given, tmp_path):
    rows = [tuple(r) for r in given.select("doc_id", "text").limit(60).collect()]
    rows += [(None, None), (None, "a@b.cd"), (7, ""), (7, "x " * 200_000 + "10.0.0.1"), (7, "a@b.cd"), (7, "a@b.cd")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "n_ip", "spans", "base", "k")}) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_pii(spark, str(tmp_path)).collect()
    assert got[0].asDict().keys() == {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"}
    want = []
    for d, t in rows:
        base = brute(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
        want.append((d, *[sum(s[2] == k for s in base) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((tuple(r[:6]) for r in got), key=str) == sorted(want, key=str)
    by_sha = {w[-1]: w for w in want}
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        assert len(spans) >= sum(by_sha[r["base_sha256"]][1:5])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.mark(docs, pii.fit(docs)).count() == 0
