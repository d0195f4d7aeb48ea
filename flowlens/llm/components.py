"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import save


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: hang each node's larger neighbours on the least of it and
    its neighbours. Small star: the same for its smaller neighbours and itself."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if large:
        hung = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m")) \
            .select(F.col("x").alias("a"), F.col("m").alias("b"))
    return hung.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long); root is the least
    node of its component. Each pass is written, and only its two checksums
    come to the driver. Repeated, reversed and own links do no harm."""
    now = save(links.select("a", "b").filter("a <> b").distinct(), "links")
    nodes = now.select(F.col("a").alias("node")).union(now.select("b")).distinct()
    seen = None
    while True:
        now = save(_star(_star(now, True), False), "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left") \
        .select("node", F.coalesce("root", "node").alias("root"))
