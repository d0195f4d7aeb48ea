"""Spelling variants against all pairs compared one by one."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from flowlens.llm import queries, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    of = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, vs in of.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(of[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def brute_words(rows):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def run(spark, counts):
    df = spark.createDataFrame(list(counts.items()) or [("", 0)], "word string, n long").filter("n > 0")
    out = variants.spelling_groups(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, out.collect()), key=str)


def test_random_words(spark):
    """Few letters and repeated ones, so words are near in many ways."""
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(400)}
    counts = {w: rng.choice([5, 6, 25, 26, 125, 700, 4000]) for w in sorted(words)}
    got = run(spark, counts)
    assert got == brute(counts)
    assert any(r[1] and r[1] != r[2] for r in got)      # chains of forms


def test_near_words_of_long_and_equal_letters(spark):
    long = "ab" * 30_000
    counts = {long: 7, long + "c": 70, long[1:]: 700, "aaaaaa": 5, "aaaaaaa": 30, "aaaaaaaa": 160, "aaaaaa" * 9: 9}
    got = {r[0]: r for r in run(spark, counts)}
    assert got[long][1:] == (long[1:], long[1:], 7, 2, 700) and got[long + "c"][4] == 1
    assert got["aaaaaa"][1:] == ("aaaaaaa", "aaaaaaaa", 5, 1, 30) and got["aaaaaa" * 9][4] == 0


def test_no_words(spark):
    assert run(spark, {}) == []
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "short 12 -")], "doc_id long, text string")
    assert variants.count_words(docs).count() == 0


def test_moves_walk_every_alignment(spark):
    """An edge that differs in its first character, and exact reading."""
    rng = random.Random(4)
    text = lambda lo: "".join(rng.choice("ab") for _ in range(rng.randint(lo, 6)))
    rows = sorted({(text(0), text(1), e) for _ in range(1500) for e in (0, 1)})
    rows = [r for r in rows if r[0].startswith(r[1]) or r[0][:1] != r[1][:1]]
    df = spark.createDataFrame(rows, "rest string, label string, edits int")
    got = {r: set() for r in rows}
    for r in variants._steps(df.withColumns({"nexts": F.lit("ab"), "ends": F.lit(1)})).collect():
        got[r["rest"], r["label"], r["edits"]].add((r["left"], r["used"]))
    for (rest, label, edits), m in got.items():
        if rest.startswith(label):
            want = {(rest[len(label):], edits)}
        elif edits:
            want = set()
        else:
            want = {(x[len(label):], 1) for x in [label[0] + rest[1:]] if rest and x.startswith(label)}
            want |= {(x[len(label):], 1) for x in [rest[1:]] if rest and x.startswith(label)}
            want |= {(x[len(label):], 1) for x in [label[0] + rest] if x.startswith(label)}
        assert m == want, (rest, label, edits)


def test_query(spark, tmp_path):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 8))) for _ in range(30)]
    rows = [(i if i % 50 else None, " ".join(rng.choice(base).title() for _ in range(150)) + "." * (i % 3)) for i in range(400)]
    rows += [(1, None), (2, ""), (3, rows[3][1]), (3, rows[3][1])]
    spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("run", "word", "n", "node")}) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_spelling_variants(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(brute_words(rows))
    assert any(r[1] for r in got)


def test_runs_and_deletions_of_any_text(spark):
    rng = random.Random(5)
    letters = "aZé÷×ÿÀA" + "bcdefg" * 3 + " -1\u0101\u2192\U0001F600\n"
    rows = [(rng.choice([None, -3, 7, i, 10**15 + i]), "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 40, 4000]))))
            for i in range(300)]
    rows += [(5, "é" * 70 + "x"), (6, "q" * 5000), (7, None), (8, ("ab" * 40 + " ") * 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.word: r.n for r in variants.count_words(df, queries._deletion, min_count=1).collect()}
    want = Counter()
    for d, t in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{d}:{word}".encode())
            if d is not None and h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            want[word] += len(word) >= 6
    assert got == {w: n for w, n in want.items() if n}
