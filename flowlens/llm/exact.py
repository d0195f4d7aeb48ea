"""Exact dedup: deterministic block naming.

Method: each text is cut into blocks of ``block`` bytes. The distinct blocks
are sorted and numbered: equal blocks get one integer name. Then adjacent
names are paired and the distinct pairs numbered again, level by level, until
each document is left with one name. Two texts of the same level share that
name only if all their blocks agree, so the identity is free of collisions: a
SHA-256 digest is only the address by which a block finds its name, and the
job stops if two distinct blocks ever share one.

A common block or pair is reduced to one row per task before it is shuffled.

Defined results: null text counts as empty; texts equal after lower-casing
A-Z are one group, all empty texts among them. A null id counts as smaller
than any other (a group of null ids keeps null). Rows that repeat both id
and text are all returned and counted; one of them has ``kept`` true. Other
columns are ignored, whatever their names. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import lower_ascii, save


def _named(distinct: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number the rows of ``distinct`` in sorted order inside each hash
    partition; written once, so a name never changes."""
    return save(distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())
                .select("addr" if "addr" in distinct.columns else F.struct(*by).alias("pair"), "name"), name)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = 16384) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    base = docs.select(F.col(id_col).alias("id"),
                       lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("b"))
    base = base.select("id", "b", F.sha2("b", 256).alias("sha"),
                       F.greatest(F.ceil(F.octet_length("b") / block), F.lit(1)).cast("long").alias("n"))
    cut = base.select(
        "id", "sha", "n", F.posexplode(F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
            lambda i: F.substring(F.col("b"), (i * block + 1).cast("int"), F.lit(block)))).alias("i", "block"))
    cut = cut.select("id", "sha", "n", F.col("i").cast("long").alias("i"), "block",
                     F.unhex(F.sha2("block", 256)).alias("addr"))

    blocks = cut.groupBy("addr", "block").agg(F.lit(1).alias("one"))
    names = _named(blocks, ["block"], "block-names")
    if not names.groupBy("addr").count().filter("count > 1").isEmpty():
        raise ValueError("two distinct blocks share a SHA-256 digest")

    # Rows that repeat id and text are one row with a count while naming. The
    # digest below is only a row's address; the text's identity is its name.
    pieces = (cut.select("id", "sha", "n", "i", "addr")
              .groupBy("id", "sha", "n", "i", "addr").agg(F.count(F.lit(1)).alias("times"))
              .join(names, "addr").select("id", "sha", "n", "i", "times", "name"))
    pieces = save(pieces, "named-blocks")
    longest = pieces.agg(F.max("n")).first()[0] or 1
    done, level = pieces.filter("n = 1").select("id", "sha", "times", F.lit(0).alias("level"), "name"), 0
    rest = pieces.filter("n > 1")
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        half = F.floor(F.col("i") / 2)
        pairs = (rest.groupBy("id", "sha", "times", ((F.col("n") + 1) / 2).cast("long").alias("n"), half.alias("i"))
                 .agg(F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
                 .withColumn("pair", F.struct("a", "b")))
        pairs = save(pairs, f"pairs-{level}")
        known = _named(pairs.select("a", "b").distinct(), ["a", "b"], f"pair-names-{level}")
        named = save(pairs.join(known, "pair").select("id", "sha", "times", "n", "i", "name"), f"named-{level}")
        done = done.unionByName(named.filter("n = 1").select("id", "sha", "times", F.lit(level).alias("level"), "name"))
        rest = named.filter("n > 1")

    groups = done.groupBy("level", "name").agg(F.max("id").alias("keep_id"), F.sum("times").alias("group_size"))
    return (done.join(groups, ["level", "name"])
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that an equal text outlives: one row of each
    group stays, the one with the largest id."""
    kept = exact_groups(docs, id_col, text_col).filter("kept") \
        .select(F.col(id_col).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    sha = F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn("_sha", sha)
    return (rows.join(kept, rows[id_col].eqNullSafe(F.col("_kept_id")) & (F.col("_sha") == F.col("_kept_sha")), "left_semi")
            .dropDuplicates([id_col, "_sha"]).drop("_sha"))
