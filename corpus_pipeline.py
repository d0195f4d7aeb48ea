"""Corpus pipeline: raw documents to packed training sequences.

``STAGES`` names five steps in order; each takes (spark, docs, sf_dir), works
on all that the step before it kept, and returns the columns of ``documents``
(the last one packed pieces). Between steps the rows are written and reread.

1. quality: documents scored below ``MIN_SCORE`` go. The ranking learns from
   all rows of ``labels``; a document needs no label to be scored.
2. line dedup: lines on more than 2 % of a source's documents (and three
   at least) are cut from them; ``n_chars`` follows the text. A text and its near
   copies (as in 3.) count as one document, so copies do not cut themselves.
3. near-dedup: one document of each group of near copies stays (five-word
   shingles, similarity 0.8 or more), the one with the least id.
4. substring dedup: runs of ``PASSAGE`` words that a document of smaller id
   also has are cut out; what is left keeps its layout.
5. packing: tokens of all that is left, cut into sequences of 2048.

Null texts and rows are handled as each operator's docstring says; a stage
keeps documents whose text becomes empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import lines, minhash, packing, quality, substring_dedup
from flowlens.llm.common import save, table
from flowlens.llm.queries import vocabulary

MIN_SCORE, PASSAGE = 0.5, 30
LINE_SHARE, LINE_PAGES = 0.02, 3    # from line shares over distinct texts, see README; floor as in op10
NEAR = (5, (80, 100))               # words of a shingle, least similarity


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """``columns`` of documents, their text replaced and ``n_chars`` recounted."""
    new = {"text": F.col(text).alias("text"), "n_chars": F.length(F.col(text)).cast("long").alias("n_chars")}
    return docs.select([new.get(c, F.col(f"`{c}`")) for c in columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", F.lit(True))
    scored = quality.score(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.filter(F.col("score") >= MIN_SCORE).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, pages = minhash.component_table(docs, "_page", *NEAR)
    kept = lines.drop_boilerplate(rows, "source", ratio=LINE_SHARE, min_pages=LINE_PAGES, page_col="_page",
                                  page_table=save(pages, "pipeline-pages"))
    return _with_text(kept, docs.columns, "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, *NEAR)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(substring_dedup.remove_repeats(docs, window=PASSAGE, layout=True), docs.columns, "kept_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), seq_len=2048, lists=True)


STAGES = [("quality", keep_quality), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies),
          ("substring_dedup", drop_passages), ("packing", pack)]

# A learned ranking has no SQL; tests/llm holds near and substring dedup against brute force, lines against planted
# cases, quality and packing by counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
