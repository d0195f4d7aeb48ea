"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (
    exact,
    langid,
    lines,
    manifest,
    minhash,
    packing,
    pii,
    quality,
    sentencepiece_fst,
    substring_dedup,
    suffix_dedup,
    variants,
    winnow,
)
from flowlens.llm.common import lower_ascii, table

DOCUMENTS = "documents"


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS).select("doc_id", "text")
    return (substring_dedup.remove_repeats(docs, window=13)
            .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_fst.encode(table(spark, sf_dir, DOCUMENTS), vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", F.crc32("ids").alias("ids_crc32"), "n_ids", F.sha2("decoded", 256).alias("decoded_sha256"),
                      "round_trip")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_groups(table(spark, sf_dir, DOCUMENTS), shingle=3, threshold=(85, 100))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def _fold(k: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % k


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS).select("doc_id", "text")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS).select("doc_id", "text")
    return (suffix_dedup.remove_repeats(docs, window=100)
            .select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS)
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = langid.fit(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text"), model) \
        .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = winnow.fingerprints(table(spark, sf_dir, DOCUMENTS))
    return prints.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                         "edited_fingerprint", "near_edited", "near_next")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, DOCUMENTS))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, DOCUMENTS), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", lines.url_host(F.col("url")).alias("host"),
                                                 lines.html_lines(F.col("html")).alias("text"))
    kept = lines.drop_boilerplate(pages, "host", ratio=0.1, min_pages=3)
    return kept.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_CRC_STEPS = 64             # longer runs are hashed one by one


def _deletion(ids: list, row: np.ndarray, words: pa.Array, of: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The runs that lose the code point that the contract names (null id: none).

    CRC-32 is linear: that of ``<id>:<run>`` is that of ``<id>:`` moved on by as
    many zero bytes as the run has, xor that of the run."""
    def utf8(run: bytes) -> bytes:
        return run if run.isascii() else run.decode("latin-1").encode()

    table = np.array([crc32(bytes([b])) for b in range(256)], np.uint32)
    table ^= table[0]                   # without the inversions of crc32: the step of one byte
    known = [utf8(w) for w in words.to_pylist()]
    size = np.array([len(w) for w in known], np.int64)
    tail = np.array([crc32(w) for w in known], np.uint32)
    moved = np.zeros((_CRC_STEPS + 1, len(ids)), np.uint32)
    moved[0] = [crc32(f"{i}:".encode()) for i in ids]
    for k in range(_CRC_STEPS):
        moved[k + 1] = table[moved[k] & 255] ^ (moved[k] >> 8)
    named = np.array([i is not None for i in ids], bool)
    h = moved[np.minimum(size[of], _CRC_STEPS), row] ^ tail[of]
    for i in np.flatnonzero(size[of] > _CRC_STEPS):
        h[i] = crc32(known[of[i]], int(moved[0, row[i]]))
    for i in np.flatnonzero((h % 199 == 0) & named[row]):
        run = words[int(of[i])].as_py()
        at = int(h[i]) % len(run)
        yield i, run[:at] + run[at + 1:]


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_groups(variants.count_words(table(spark, sf_dir, DOCUMENTS), _deletion))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS).select("doc_id", "text")
    return pii.mark(docs, pii.fit(docs)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                                                F.sha2("base", 256).alias("base_sha256"), "spans")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, DOCUMENTS)
    text = F.when(_fold(3) == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    return manifest.climb(manifest.build(docs, fields, now={"text": text}))


# A-Z only, as the contracts ask; DuckDB's lower() would also map other letters.
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP8 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256,
                  {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

_OP1 = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w),
     g AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY ws[i:i + 12]) AS first FROM p),
     x AS (SELECT doc_id, list(DISTINCT j) AS gone
           FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM g WHERE first < doc_id) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(list_aggregate([ws[j] FOR j IN range(1, len(ws) + 1) IF NOT list_contains(coalesce(gone, []), j)],
                             'string_agg', ' '), '')) AS kept_sha256
FROM w LEFT JOIN x USING (doc_id)
"""

_OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws
                     FROM documents),
     s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_distinct([ws[i:i + 2] FOR i IN range(1, len(ws) - 1)])
                                      WHEN len(ws) > 0 THEN [ws] ELSE [] END) AS g FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
           GROUP BY a.doc_id, b.doc_id),
     l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
     r AS (SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# Bytes as hex text (two characters each); a window is 200 of them.
_OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
     p AS (SELECT doc_id, unnest(range(1, length(h) // 2 - 98)) AS i,
                  unnest([md5_number(h[2 * j - 1:2 * j + 198]) FOR j IN range(1, length(h) // 2 - 98)]) AS m FROM d),
     r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS n FROM p),
     s AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new
           FROM r WHERE n > 1),
     k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM s),
     x AS (SELECT doc_id, min(i) AS a, max(i) + 99 AS b FROM k GROUP BY doc_id, k),
     l AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM x),
     t AS (SELECT doc_id, max(b) AS b, count(*) AS n_spans, sum(b - a + 1) AS n_removed FROM x GROUP BY doc_id),
     y AS (SELECT l.doc_id, a AS o, substr(h, 2 * c + 1, 2 * (a - c - 1)) AS piece FROM l JOIN d ON d.doc_id = l.doc_id
           UNION ALL SELECT d.doc_id, 9000000000000, substr(h, 2 * coalesce(b, 0) + 1)
           FROM d LEFT JOIN t ON t.doc_id = d.doc_id),
     z AS (SELECT doc_id, sha256(unhex(string_agg(piece, '' ORDER BY o))) AS kept_sha256 FROM y GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, kept_sha256
FROM d JOIN z ON z.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

_OP10 = f"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host,
                  list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html,
                      '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'),
                      '(?i)</?({lines.BLOCK_TAGS})( [^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)),
                      lambda x: trim(x)), lambda x: x <> '') AS ls FROM pages),
     t AS (SELECT host, count(*) AS total FROM p GROUP BY host),
     u AS (SELECT host, unnest(list_distinct(ls)) AS line FROM p),
     b AS (SELECT host, list(line) AS bad FROM (SELECT u.host, line FROM u JOIN t ON t.host = u.host
           GROUP BY u.host, line, total HAVING count(*) >= 3 AND count(*) > 0.1 * total) GROUP BY host),
     k AS (SELECT page_id, p.host, len(ls) AS n, list_filter(ls, lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
           FROM p LEFT JOIN b ON b.host = p.host)
SELECT page_id, host, n AS n_lines, n - len(kept) AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256
FROM k
"""

# CRC-32 in SQL: the table of a byte's remainders, then a walk over the bytes of ``s`` (hex text ``h``).
_CRC_TABLE = """crc_steps(i, k, c) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
                 SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8),
     crc AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""
_CRC = """xor(list_reduce([CAST('0x' || substr({h}, 2 * crc_i + 1, 2) AS BIGINT) FOR crc_i IN range(length({h}) // 2)],
                   lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT)), 4294967295)"""


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


_SIBLINGS = "[xs[j] FOR j IN range(8 * (p // 8) + 1, least(8 * (p // 8) + 8, len(xs)) + 1) IF j <> p + 1]"
_FOLD = "sha256(array_to_string([CASE WHEN j = p + 1 THEN folded ELSE xs[j] END " \
        "FOR j IN range(8 * (p // 8) + 1, least(8 * (p // 8) + 8, len(xs)) + 1)], ''))"
_UP = "[sha256(array_to_string(xs[8 * i + 1:8 * i + 8], '')) FOR i IN range((len(xs) + 7) // 8)]"

# Each level of a tree as a list of digests; a leaf then walks its group's lists and the lists over the subroots.
_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
     d AS (SELECT *, hex(encode(CAST(doc_id AS VARCHAR))) AS h FROM documents),
     l AS (SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
                  CASE WHEN {_CRC.format(h="h")} % 3 = 0 THEN {_leaf_sql(_LOWER.format("text"))}
                       ELSE {_leaf_sql("text")} END AS now FROM d, crc),
     g AS (SELECT lang, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS xs FROM l GROUP BY lang),
     t(lang, k, xs) AS (SELECT lang, 0, xs FROM g UNION ALL SELECT lang, k + 1, {_UP} FROM t WHERE len(xs) > 1),
     s AS (SELECT lang, xs[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM t WHERE len(xs) = 1),
     m AS (SELECT list(subroot ORDER BY tree) AS xs FROM s),
     u(k, xs) AS (SELECT 0, xs FROM m UNION ALL SELECT k + 1, {_UP} FROM u WHERE len(xs) > 1),
     a(doc_id, lang, leaf, now, o, k, p, folded, proof) AS (
       SELECT doc_id, lang, leaf, now, o, 0, o, now, '' FROM (
         SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS o FROM l)
       UNION ALL
       SELECT a.doc_id, a.lang, leaf, now, o, a.k + 1, p // 8, {_FOLD}, proof || array_to_string({_SIBLINGS}, '')
       FROM a JOIN t ON t.lang IS NOT DISTINCT FROM a.lang AND t.k = a.k WHERE len(xs) > 1),
     b(doc_id, lang, leaf, o, k, p, folded, proof) AS (
       SELECT doc_id, a.lang, leaf, o, 0, tree, folded, proof
       FROM (SELECT *, max(k) OVER (PARTITION BY lang) AS top FROM a) a JOIN s ON s.lang IS NOT DISTINCT FROM a.lang WHERE k = top
       UNION ALL
       SELECT doc_id, lang, leaf, o, b.k + 1, p // 8, {_FOLD}, proof || array_to_string({_SIBLINGS}, '')
       FROM b JOIN u ON u.k = b.k WHERE len(xs) > 1)
SELECT doc_id, leaf, subroot, (SELECT xs[1] FROM u WHERE len(xs) = 1) AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = (SELECT xs[1] FROM u WHERE len(xs) = 1) AS verified
FROM b JOIN s ON s.lang IS NOT DISTINCT FROM b.lang WHERE b.k = (SELECT max(k) FROM u)
"""

# Neighbours by deletion: equal after the same place of both goes (replaced), or one equal to the other less a place.
_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
     r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-zÀ-ÿ]+')) AS w
           FROM documents),
     g AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR) || ':', '') || w)) AS h
           FROM r GROUP BY doc_id, w),
     c AS (SELECT w, n, CASE WHEN doc_id IS NULL THEN 1 ELSE {_CRC.format(h="h")} END AS h FROM g, crc),
     e AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w
           FROM c),
     v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
     x AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d
           FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v)),
     p AS (SELECT a.w, b.w AS near, b.n AS near_n FROM x a JOIN x b ON a.d = b.d AND a.i = b.i AND a.w <> b.w
           UNION SELECT x.w, v.w, v.n FROM x JOIN v ON x.d = v.w UNION SELECT v.w, x.w, x.n FROM x JOIN v ON x.d = v.w),
     b AS (SELECT w, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
           FROM p GROUP BY w),
     f AS (SELECT v.w, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
                  CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN b ON b.w = v.w),
     s(w, now, k) AS (SELECT w, w, 0 FROM f UNION ALL SELECT s.w, f.form, k + 1 FROM s JOIN f ON f.w = s.now WHERE f.form IS NOT NULL)
SELECT f.w AS word, form, (SELECT first(now ORDER BY k DESC) FROM s WHERE s.w = f.w) AS root, n, n_near, form_n
FROM f
"""

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language": op6_language,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_pii": op12_pii,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL = {
    "op1_substring_dedup": _OP1,
    "op3_minhash_near_dedup": _OP3,
    "op10_line_dedup": _OP10,
    "op5_suffix_dedup": _OP5,
    "op8_exact_dedup": _OP8,
    "op11_spelling_variants": _OP11,
    "op13_merkle_manifest": _OP13,
}
