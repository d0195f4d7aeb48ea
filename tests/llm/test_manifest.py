"""The Merkle manifest against a plain tree built in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from flowlens.llm import manifest, queries

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    """Rows as the contract words it; ``rows`` in the columns' order."""
    def now(r):
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        return (*r[:4], lower(r[4])) if hit and r[4] is not None else r
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in order[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for t, x in enumerate(langs):
        for p, r in enumerate(order[x]):
            folded, proof = leaf(now(r)), []
            for tree, at in ((trees[x], p), (top, t)):
                for nodes in tree[:-1]:
                    lo = at // 8 * 8
                    run = nodes[lo:lo + 8]
                    proof += [d for i, d in enumerate(run) if lo + i != at]
                    folded = h(*(folded if lo + i == at else d for i, d in enumerate(run)))
                    at //= 8
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(df):
    fields = {c: F.col(c) for c in COLUMNS}
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                  queries.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    out = manifest.climb(manifest.build(df, fields, {"text": text}))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, out.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def hard_rows():
    rng = random.Random(3)
    rows = [(i, f"s{i % 3}", rng.choice(["de", "en", None, "é"]), i, rng.choice(["Same Text", "x", "", None]))
            for i in range(300)]
    return rows + [(7, "s", "solo", None, "LONG " * 40000), (None, None, None, None, None), (None, "a", "en", 1, "ID"),
                   (9, "a", "en", 1, "Twice"), (9, "a", "en", 1, "Twice"), (9, "b", "en", 1, "Other")]


def test_equals_plain_tree(spark):
    rows = hard_rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("leaf", "tree", "pos", "block", "node", "n", "g", "level", "root", "id", "now", "at")})
    got = run(df)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9])
def test_few_rows(spark, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_high_nodes_over_blocks(spark, monkeypatch):
    """Leaves of many blocks, so nodes above a block are stored for each."""
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(i, "s", "en" if i % 3 else f"l{i % 11}", i, f"Text {i}") for i in range(900)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_query_flags_the_changed_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, sf).collect()), key=str)
    assert got == brute([tuple(r[c] for c in COLUMNS) for r in docs])
