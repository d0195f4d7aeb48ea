"""Training-data operators against brute force, the given tables and hard cases."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowlens.llm import (
    exact,
    langid,
    lines,
    minhash,
    packing,
    quality,
    queries,
    repeats,
    sentencepiece_fst,
    substring_dedup,
    suffix_dedup,
    winnow,
)
from flowlens.llm.common import save, unpack_chunks
from flowlens.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def given():
    t = pq.read_table(f"{SF}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), (x or "" for x in t["text"].to_pylist())))


def hard_rows():
    """Nulls, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split())
                             + str(rng.randrange(40)) for _ in range(n))
    passage, long = say(60), say(9000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, say(30) + " " + passage + " " + say(20)),
            (6, passage), (7, say(25) + "\n" + passage), (8, long), (9, long), (9, long), (10, "a " * 700),
            (11, "Ünï " * 300), (None, passage + " tail"), (None, None), (12, "same id"), (12, passage + " end")]


@pytest.fixture()
def hard(spark):
    """The rows with columns that clash with the operators' own."""
    df = spark.createDataFrame(hard_rows(), "doc_id long, text string")
    return df.withColumns({c: F.lit(f"x{c}") for c in
                           ("row", "uid", "doc", "body", "n_words", "score", "id", "host", "bucket", "kept")})


def brute_words(rows, window=13):
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, t in sorted(rows, key=lambda r: order(r[0])):
        ws = WORD.findall(t or "")
        for i in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[i:i + window]), order(d))
    out = []
    for d, t in rows:
        ws = WORD.findall(t or "")
        gone = bytearray(len(ws))
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < order(d):
                gone[i:i + window] = b"\1" * window
        out.append((d, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return sorted(out, key=str)


def brute_bytes(rows, window=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if b[i:i + window] in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(b[i:i + window])
        out[d] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))),
                  hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_substring_dedup_hard_rows(hard):
    got = substring_dedup.remove_repeats(hard).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_words(hard_rows())


@pytest.mark.parametrize("hot", [2, 256])
def test_substring_dedup_hot_grams(spark, monkeypatch, hot):
    """Grams over the hot bound are keyed by whole windows: same result."""
    rng = random.Random(1)
    common = " ".join(f"c{i}" for i in range(20))
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(25))) + " " + common + f" t{i % 7}")
            for i in range(60)]
    monkeypatch.setattr(repeats, "HOT_BATCH", hot)
    tokens, groups = substring_dedup.word_tokens(13), substring_dedup.subtrees(13)
    marked, _ = repeats.mark_repeats(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text",
                                     tokens, True, groups)
    got = {r["row"]["doc_id"]: sum(e - s for s, e in np.frombuffer(r["spans"] or b"", "<i8").reshape(-1, 2).tolist())
           for r in marked.collect()}
    assert got == {d: gone for d, _, gone, _ in brute_words(rows)}


def test_substring_dedup_keeps_layout(spark):
    p = " ".join(f"p{i}" for i in range(14))
    df = spark.createDataFrame([(1, p), (2, f"a  b\n{p}\nc   d"), (3, "x  y\n")], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.remove_repeats(df, 13, layout=True).collect()}
    assert got == {1: p, 2: "a  b\nc   d", 3: "x  y\n"}


def test_suffix_dedup(spark, given, hard):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op5_suffix_dedup(spark, SF).collect()}
    assert got == brute_bytes(list(given.items()))
    rows = [r for r in hard_rows() if r[0] is not None][:9] + [(13, "z" * 3000)]
    some = suffix_dedup.remove_repeats(hard.sparkSession.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest())
           for r in some.collect()}
    assert got == brute_bytes(rows)
    assert suffix_dedup.remove_repeats(hard).count() == len(hard_rows())


def test_repeated_windows_leave_a_group_as_one_span():
    """Two different runs of one gram share 60 windows: one span is sent, not one for each window."""
    rng = np.random.default_rng(5)
    shared, ends = bytes(rng.integers(97, 123, 159).astype(np.uint8)), (b"ABC", b"XYZ")
    runs = [(9, doc, doc, [1000 * doc], len(shared) + 3 - 99, shared + end) for doc, end in enumerate(ends)]
    blobs = repeats._run_blobs(runs, 4)
    sent = repeats._resolve(suffix_dedup.byte_tokens(100), False, suffix_dedup.passes(100), 4)(iter([blobs]))
    spans = [np.frombuffer(unpack_chunks(x)[0], "<i8").tolist() for b in sent for x in b.column(1).to_pylist()]
    assert spans == [[1, 1, 1000, 1159]]


def test_radix_groups_against_dict():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(400 - 11)
    want = collections.defaultdict(list)
    for s in starts.tolist():
        want[bytes(text[s:s + 11])].append(s)
    got = sorted(sorted(g.tolist()) for g in suffix_dedup.radix_groups(text, starts, np.zeros(len(starts), int), 11))
    assert got == sorted(v for v in want.values() if len(v) > 1)


def test_deep_nodes_against_dict():
    rng = random.Random(4)
    words = [rng.choice("ab") for _ in range(300)]
    suffixes = [words[i:i + 6] for i in range(294)]
    want = collections.defaultdict(list)
    for i, s in enumerate(suffixes):
        want[tuple(s)].append(i)
    got = sorted(sorted(x) for x in substring_dedup.deep_nodes(suffixes, 6))
    assert got == sorted(v for v in want.values() if len(v) > 1)


def brute_near(docs, k, percent):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    sets = {}
    for d, t in docs.items():
        w = WORD.findall(low(t))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    at, root = collections.defaultdict(list), {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            at[x].append(d)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for d in sorted(sets):
        for e, n in collections.Counter(e for x in sets[d] for e in at[x] if e < d).items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_minhash(spark, given, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: tuple(r)[1:4] for r in minhash.near_groups(docs, k, (percent, 100)).collect()}
    assert got == brute_near(given, k, percent)


def test_minhash_blocks_and_hard_rows(spark, hard, monkeypatch):
    """Many near copies under one head, compared block by block, and odd rows."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    docs = {}
    for d in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 8)):
            w[rng.randrange(200)] = f"e{d}"
        docs[d] = " ".join(w)
    got = {r[0]: tuple(r)[1:4] for r in minhash.near_groups(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"), 3, (85, 100)).collect()}
    assert got == brute_near(docs, 3, 85)
    out = minhash.near_groups(hard, 3, (85, 100)).collect()
    assert len(out) == len(hard_rows())
    by = {r["doc_id"]: r for r in out}
    assert by[1]["n_shingles"] == 0 and by[1]["kept"] and by[9]["component_id"] == 8
    left = minhash.drop_near_duplicates(hard, 3, (85, 100))
    assert left.columns == hard.columns and left.filter("doc_id = 9").count() == 0


def test_rows_are_told_apart_when_hashes_collide(spark, given, monkeypatch):
    """Near-dedup with one uid for all rows; line dedup with one first hash."""
    some = dict(list(given.items())[:80])
    docs = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    monkeypatch.setattr(minhash, "_uid", lambda own, text: F.lit(7).cast("long"))
    got = {r["doc_id"] for r in minhash.drop_near_duplicates(docs, 5, (80, 100)).collect()}
    assert got == {d for d, v in brute_near(some, 5, 80).items() if v[2]}
    two = lines._address()["a2"]
    monkeypatch.setattr(lines, "_address", lambda: {"a1": F.lit(7).cast("long"), "a2": two})
    df = spark.createDataFrame([(i, "h", "menu\n" * (i % 2) + f"own {i}") for i in range(20)],
                               "id long, host string, text string")
    assert {r["text"] for r in lines.drop_boilerplate(df, "host").collect()} == {f"own {i}" for i in range(20)}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 130)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_exact_dedup_hard_rows(hard):
    got = exact.exact_groups(hard, block=7).collect()
    low = lambda t: (t or "").translate({i: i + 32 for i in range(65, 91)})
    groups = collections.defaultdict(list)
    for d, t in hard_rows():
        groups[low(t)].append(d)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text_sha256"], r["group_size"]) for r in got) == sorted(
        (d is None, d or 0, hashlib.sha256(t.encode()).hexdigest(), len(ds)) for t, ds in groups.items() for d in ds)
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact.drop_exact(hard).count() == len(groups)


def test_word_ids_match_the_tokenizer():
    ids = packing.WordIds(WORDS)
    rng = random.Random(6)
    texts = ["", "a²b İx Σας", "<|endoftext|> hi", "ét é don't they'll 's'", "日本🙂", "\x00\x1c", "'"] + [
        "".join(rng.choice("'stredvmlaAÉß 1.,\n") for _ in range(rng.randrange(40))) for _ in range(3000)]
    assert ids.by_word and ids(texts) == ids._whole(texts)


def test_packing(spark, hard, given):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    want = {d: e.ids + [1] for d, e in zip(given, tok.encode_batch(list(given.values()), add_special_tokens=False))}
    pieces, filled = collections.Counter(), collections.defaultdict(list)
    for r in queries.op9_packing(spark, SF).collect():
        ids = np.array(want[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(ids) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]] += r["length"]
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces == {d: len(x) for d, x in want.items()}
    full = 0
    for spans in filled.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        full += at == 2048
    assert full >= len(filled) - 1
    out = packing.pack(hard, WORDS, seq_len=64)
    assert out.filter("start = 0").count() == len(hard_rows())


def test_sentencepiece_equals_the_library():
    import sentencepiece as sp
    lib, fst = sp.SentencePieceProcessor(model_file=PIECES), sentencepiece_fst.Transducer(PIECES)
    rng = random.Random(3)
    texts = ["", " ", "  a", "é日🙂", "x" * 300] + [
        "".join(rng.choice("abcdehinorst   \n\t.,é日🙂'12  ") for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += [" " * n + w for n in (*range(60), 500, 1000) for w in ("", "a", "word", "é", "\n x")]
    for t in texts:
        ids = fst.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t)
        assert fst.decode(ids) == t
    for seg in ("▁" * 200, "▁" * 90 + "word" * 9, "x▁" * 60, "aaaa" * 40):
        slow = [list(seg)]
        while slow:
            parts = slow.pop()
            ranked = [(fst.score[fst.pieces[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in fst.pieces]
            if ranked:
                i = -max(ranked)[1]
                slow.append(parts[:i] + [parts[i] + parts[i + 1]] + parts[i + 2:])
        assert fst.merged(seg) == parts


def test_sentencepiece_blanks_take_linear_time():
    fst = sentencepiece_fst.Transducer(PIECES)
    for text in (" " * 1_000_000, " " * 1_000_000 + "word", "x" + " \n" * 300_000):
        began = time.process_time()
        assert fst.decode(fst.encode(text)) == text
        assert time.process_time() - began < 4


def test_sentencepiece_query(spark, hard):
    assert queries.op2_sentencepiece(spark, SF).filter("not round_trip").count() == 0
    out = sentencepiece_fst.encode(hard, PIECES).collect()
    assert len(out) == len(hard_rows()) and all(r["round_trip"] for r in out)
    assert sorted(r["decoded"] for r in out) == sorted(t or "" for _, t in hard_rows())


def test_quality_held_out(spark, hard):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op4_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["predicted"] == r["quality"] for r in got) >= 0.93 * len(got)
    scored = quality.score(hard, None)
    assert scored.count() == len(hard_rows()) and scored.filter("score <> 0.5").count() == 0
    none = labels.limit(0)
    assert quality.fit(hard, none, "quality", F.lit(True)) is None


def test_fits_take_one_row_of_those_that_repeat(spark, monkeypatch):
    """A hot id, in the labels and in the documents, is one row of the sample."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    hot = docs.join(labels, "doc_id").select("doc_id").first()[0]
    many = spark.range(2000).select()
    docs2 = docs.unionByName(docs.filter(F.col("doc_id") == hot).crossJoin(many))
    labels2 = labels.unionByName(labels.filter(F.col("doc_id") == hot).crossJoin(many))
    seen = []
    monkeypatch.setattr(quality, "bradley_terry", lambda x, y, s: seen.append(len(x)))
    monkeypatch.setattr(langid, "learn_centroids", lambda langs, x, clusters: seen.append(len(x)))
    for d, la in ((docs, labels), (docs2, labels2)):
        quality.fit(d, la, "quality", F.lit(True))
        langid.fit(d, F.lit(True))
    assert seen[:2] == seen[2:] and max(seen) <= 200


def test_many_dropped_lines_in_one_page(spark):
    page = "\n".join(f"line {i}" for i in range(200_000))
    rows = [(i, "h", page + f"\nown {i}") for i in range(4)]
    began = time.time()
    out = lines.drop_boilerplate(spark.createDataFrame(rows, "page_id long, host string, text string"), "host", min_pages=3)
    assert sorted((r["page_id"], r["text"], r["n_dropped"]) for r in out.collect()) == [(i, f"own {i}", 200_000) for i in range(4)]
    assert time.time() - began < 90


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = (x[:, 0] - x[:, 1] > 0.8).astype(int)
    m = quality.bradley_terry(x, y, float((y == 0).mean()))
    s = np.array([m.score(r) for r in x])
    assert ((s >= 0.5) == y).mean() > 0.95 and m.score(None) == 0.0


def test_quality_learns_from_every_label(spark, monkeypatch):
    """More labelled rows than the sample of old held: all are learned from, as from one array."""
    rng = np.random.default_rng(3)
    y = (rng.random(6400) < 0.7).astype(int)
    texts = [" ".join(rng.choice(["ab", "cd", "Ef", "gh."] if g else ["ab", "cd", "!!", "99"], 6)) for g in y]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(y)], "doc_id long, quality int")
    seen, real = [], quality.bradley_terry
    monkeypatch.setattr(quality, "bradley_terry", lambda *a: seen.append(len(a[0])) or real(*a))
    m = quality.fit(docs, labels, "quality", F.lit(True))
    assert seen == [6400]
    x = np.stack([quality.features(t).astype(np.float16).astype(np.float32) for t in texts])
    n = real(x, y, float((y == 0).mean()))
    assert np.allclose(m.mean, n.mean) and np.allclose(m.weights, n.weights, atol=1e-3, rtol=1e-3) and abs(m.cut - n.cut) < 1e-2


def test_quality_cut_is_a_quantile_of_all_scores():
    s = np.concatenate((np.linspace(-3, 0, 300), np.linspace(1, 4, 700)))
    y = np.array([0] * 300 + [1] * 700)
    block = quality.Block.of(s[:, None].astype(np.float32))
    cut, spread = quality._cut(lambda part: part(block, y), np.zeros(1), np.ones(1), np.array([0.3 / 300, 0.7 / 700]), 0.3)
    assert abs(cut - 0.5) < 1e-3 and abs(spread - s.std()) < 1e-4


def test_pair_loss_and_pulls_match_all_pairs():
    rng = np.random.default_rng(2)
    s, y = rng.normal(size=300) * 2, rng.integers(0, 2, 300)
    h = quality._histogram(s, y).reshape(2, -1)
    good, bad = h[1] / (y == 1).sum(), h[0] / (y == 0).sum()
    apart = s[y == 1][:, None] - s[y == 0]
    assert abs(quality._pair_loss(good, bad) - np.logaddexp(0, -apart).mean()) < 1e-3
    at, chance = s / quality.WIDTH + (quality.BINS - 1) / 2, 1 / (1 + np.exp(apart))
    lose, win = (np.interp(at, np.arange(quality.BINS), v) for v in quality._pulls(good, bad))
    assert np.allclose(lose[y == 1], chance.mean(axis=1), atol=1e-3) and np.allclose(win[y == 0], chance.mean(axis=0), atol=1e-3)


def test_language_held_out(spark, hard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.op6_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True))
    assert model.predict(None)[:2] == ("und", 0.0) and model.predict("12 34 ##")[0] == "und"
    assert model.predict("чжшщ " * 50)[2] and not model.predict("the of and that with this " * 9)[2]
    assert langid.predict(hard, model).count() == len(hard_rows())
    empty = langid.fit(hard.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert empty.predict("some text")[0] == "und"


def test_winnow_guarantee_and_pairs(spark, given, hard):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdef ") for _ in range(600))
    (a, pos), (b, _) = winnow.winnow([text, "zzz" + text[200:260] + "yyy"])
    assert set(a.tolist()) & set(b.tolist()) and pos.tolist() == sorted(pos.tolist())
    assert winnow.winnow(["", "ab"])[0][0].size == 0 and winnow.winnow(["ab"])[0][0].size == 1
    order = sorted(given, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for r in queries.op7_document_fingerprints(spark, SF).collect():
        t, n = given[r["doc_id"]], given[after[r["doc_id"]]]
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert winnow.fingerprints(hard).count() == len(hard_rows())


def brute_winnow(text, gram=10, window=32):
    """[(hash, place)] by one loop over the windows of one text."""
    n, k = len(text), min(gram, len(text))
    code = lambda s: np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")
    if not n:
        return []
    h = [int(winnow.gram_hashes(code(text[i:i + k]), k)[0]) >> 24 for i in range(n - k + 1)]
    wide = min(window, len(h))
    at = {min(range(i, i + wide), key=lambda p: (h[p], -p)) for i in range(len(h) - wide + 1)}
    return [(h[p], p) for p in sorted(at)]


@pytest.mark.parametrize("bits", [8, 24])
def test_winnow_long_texts_against_brute_force(monkeypatch, bits):
    """Data longer than the places ``picked`` can hold."""
    monkeypatch.setattr(repeats, "_POS", np.uint64((1 << bits) - 1))
    rng = random.Random(12)
    say = lambda n: "".join(rng.choice("abc é日") for _ in range(n))
    long = say(1500)
    texts = [say(300), "", "ab", say(20), long, "x" * 700, say(41), say(40), say(254), say(255), say(256), long]
    got = [list(zip((h >> np.uint64(24)).tolist(), p.tolist())) for h, p in winnow.winnow(texts)]
    assert got == [brute_winnow(t) for t in texts] and got[4] == got[-1]


def loop_prints(text):
    """(written fingerprint, set of its hashes) of one text by ``brute_winnow``."""
    prints = brute_winnow(text)
    return " ".join(f"{h:010x}@{p}" for h, p in prints), {h for h, _ in prints}


def brute_likeness(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def test_fingerprint_query_against_brute_force(spark, tmp_path):
    """All columns of the query: hashes, picks and likeness by loops over single texts."""
    rng = random.Random(21)
    say = lambda n: "".join(rng.choice("abcde é日\n") for _ in range(n))
    base = say(260)
    texts = {1: None, 2: "", 3: "é", 4: say(9), 5: say(10), 6: say(40), 7: say(41), 8: base, 9: base,
             10: base[:200] + say(60), 11: "x" * 150, 12: say(333), 40: say(77), 41: "", -3: say(120)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    want = {}
    for d, t in texts.items():
        t, n = t or "", texts[after[d]] or ""
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        own, new, nxt = map(loop_prints, (t, edited, n))
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), own[0], new[0],
                   brute_likeness(own[1], new[1]), brute_likeness(own[1], nxt[1]))
    rows = queries.op7_document_fingerprints(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(texts)
    assert want[8][2] == want[9][2] and 0 < want[10][5] < 1 and want[9][5] == 1.0


def test_gram_hashes_of_a_batch_equal_those_of_each_run():
    """A run's hash depends on its code points alone, not on where the run stands."""
    rng = random.Random(22)
    data = np.array([rng.choice((97, 98, 233, 0x65E5, 0x10FFFF)) for _ in range(400)], "<u4")
    for k in (1, 2, 10, 13):
        whole = winnow.gram_hashes(data, k)
        assert len(whole) == len(data) - k + 1
        seen = {}
        for i, h in enumerate(whole.tolist()):
            run = tuple(data[i:i + k].tolist())
            assert seen.setdefault(run, h) == h == int(winnow.gram_hashes(data[i:i + k].copy(), k)[0])
        assert len(set(seen.values())) == len(seen)


def test_line_dedup(spark, hard):
    rows = [(i, f"h{i % 2}" if i < 40 else None, f"menu\nown {i}\n\nmenu\nfoot {i % 20}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, host string, text string").withColumn("n_lines", F.lit("x"))
    got = {r["id"]: r for r in lines.drop_boilerplate(df, "host", ratio=0.5, min_pages=5).collect()}
    assert got[3]["text"] == "own 3\n\nfoot 3" and got[3]["n_lines"] == 4 and got[3]["n_dropped"] == 2
    assert got[50]["text"] == "own 50\n\nfoot 10"
    out = lines.drop_boilerplate(hard, "host", min_pages=2)
    assert out.count() == len(hard_rows()) and out.filter("text is null").count() == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for out in (substring_dedup.remove_repeats(docs), suffix_dedup.remove_repeats(docs), minhash.near_groups(docs),
                minhash.drop_near_duplicates(docs), exact.exact_groups(docs), packing.pack(docs, WORDS),
                sentencepiece_fst.encode(docs, PIECES), winnow.fingerprints(docs),
                lines.drop_boilerplate(docs, "source"),
                quality.score(docs, quality.fit(docs, labels, "quality", F.lit(True))),
                langid.predict(docs, langid.fit(docs, F.lit(True)))):
        assert out.count() == 0


def test_pipeline_stages(spark, given):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.filter("n_chars <> length(text)").count() == 0
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = save(out, f"test-{name}")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        counts[name] = len(after)
        if name == "near_dedup":
            assert set(after) == {d for d, v in brute_near({d: t or "" for d, t in before.items()}, 5, 80).items() if v[2]}
        if name == "substring_dedup":
            want = brute_words(list(before.items()), corpus_pipeline.PASSAGE)
            assert {d: " ".join(WORD.findall(t)) for d, t in after.items()} == {d: t for d, _, _, t in want}
    assert counts["quality"] < len(given) and counts["near_dedup"] < counts["line_dedup"] == counts["quality"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.filter("size(ids) <> length").count() == 0


def prose(rng, lines=8):
    return [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(12)) for _ in range(lines)]


def documents_of(spark, rows):
    """``documents`` of (doc_id, source, text)."""
    return spark.createDataFrame([(d, t, "en", s, len(t)) for d, s, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("edited", [False, True])
def test_pipeline_copies_do_not_cut_themselves(spark, edited):
    """Copies of one text, equal or each with a word of its own, fill a third
    of a source: one whole copy stays, and the source's menu line still goes."""
    rng = random.Random(11)
    one, rows = prose(rng), []
    for d in range(45):
        copy = list(one)
        if edited and d:
            copy[d % 8] = copy[d % 8].rsplit(" ", 1)[0] + f" edit{d}"
        rows.append((d, "s", "\n".join(copy)))
    for d in range(45, 135):
        rows.append((d, "s", "\n".join(prose(rng) + ["home about contact"] * (d % 2))))
    docs = documents_of(spark, rows)
    cut = save(corpus_pipeline.drop_lines(spark, docs, SF), "test-copies")
    assert cut.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_near_copies(spark, cut, SF).collect()}
    assert set(got) == {0, *range(45, 135)} and got[0] == "\n".join(one)
    assert all(got[d] == t.removesuffix("\nhome about contact") for d, _, t in rows if d >= 45)


def test_pipeline_line_dedup_moves_a_text_once(spark, monkeypatch):
    """Between documents and result no text is written, and one exchange takes it, not cut into lines."""
    rng, saved = random.Random(15), []
    monkeypatch.setattr(corpus_pipeline, "save", lambda df, name: saved.append(df.columns) or save(df, name))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = save(documents_of(spark, [(d, "s", "\n".join(prose(rng, 2))) for d in range(20)]), "test-once")
        out = corpus_pipeline.drop_lines(spark, docs, SF)
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert not any("text" in columns for columns in saved)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert moved and sum("text#" in x for x in moved) == 1 and not any("lines#" in x for x in moved), moved


def test_pipeline_cuts_planted_lines(spark):
    """Lines on 12 % and 5 % of a source go; one on 1 % and all others stay."""
    rng, rows = random.Random(13), []
    for d in range(400):
        text = prose(rng, 3)
        planted = [x for x, n in (("share this page", 48), ("read more", 20), ("Some License 1.0", 4)) if d < n]
        rows.append((d, "s", text, planted))
    docs = documents_of(spark, [(d, s, "\n".join(t + p)) for d, s, t, p in rows])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, docs, SF).collect()}
    assert got == {d: "\n".join(t + [x for x in p if "License" in x]) for d, _, t, p in rows}


def test_pipeline_cuts_lines_of_small_sources(spark):
    """Few documents to a source: a line on three of them goes, on two stays."""
    rng, rows = random.Random(14), []
    for source, n, on in (("five", 5, 5), ("nine", 9, 3), ("fifty", 50, 6), ("two", 2, 2), ("ten", 10, 2)):
        rows += [(len(rows) + i, source, prose(rng, 2), ["menu"] * (i < on)) for i in range(n)]
    docs = documents_of(spark, [(d, s, "\n".join(t + p)) for d, s, t, p in rows])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, docs, SF).collect()}
    assert got == {d: "\n".join(t + p * (s in ("two", "ten"))) for d, s, t, p in rows}


def test_pipeline_stages_hard_rows(spark):
    rows = [(d, t, "en", None if (d or 0) % 3 else "s", len(t or "")) for d, t in hard_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    from tools.oracle_check import compare, duck_connect
    got = compare(spark, name, queries.QUERIES[name], queries.SQL[name], SF, duck_connect(SF))
    assert got["ok"], got
