"""Merkle dataset manifest: a recursive query climbs from every leaf.

Method: each row is a leaf digest. The leaves of a group, in order, are a tree
of runs of ``ARITY`` nodes, and the groups' roots are the leaves of one more
tree. The built levels are stored as parent-linked node rows (a node's child
digests, its parent, its place there). A recursive query starts at every leaf
with the digest recomputed from the row as it is now, and ascends: each step
appends the siblings met there (as a row) and folds the digest with them, until no
parent is left. The rows of a leaf then give its proof and the root it leads to.

Places come from one range sort with prefix sums, so a group of a third of all
rows is dealt over many tasks. High nodes are met by every leaf; they are stored
once for each block of ``BLOCK`` leaves below, so no join key has more rows than
a block. Only counts and the root come to the driver.

Digests: H is lower-case hex SHA-256 of its inputs joined, digests as hex text.
A leaf's inputs are its fields: ``-`` for null, else UTF-8 byte count, ``:`` and
the value as text.

Defined results: a null group is a group of its own, before all others; a null id
comes first in its group; rows of one id are ordered by their digest, repeated
rows are leaves each. A lone leaf is its group's root, a lone group's root is
the root. Other columns are ignored, whatever their names. An empty table
gives no row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import save
from flowlens.operators.index import sorted_dense_index

ARITY, BLOCK = 8, 4096              # BLOCK is a power of ARITY
_TOP, _LEVEL = 1 << 62, 56          # a node number: top tree bit, level, place in the level
_ROWS = "spark.sql.cteRecursionRowLimit"


def field_text(c: Column) -> Column:
    """A field inside a leaf's digest."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def row_digest(fields: list[Column]) -> Column:
    """Leaf digest (32 bytes) of a row."""
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256))


def _run_digest(children: Column) -> Column:
    return F.unhex(F.sha2(F.lower(F.hex(children)).cast("binary"), 256))


def _node(level: int, start: Column, top: bool) -> Column:
    """Number of a node, so that one column links children to parents: its
    level, and where it starts (the first leaf below, or a place in the top tree)."""
    return (F.lit((_TOP if top else 0) + (level << _LEVEL)).cast("long") + start).cast("long")


@dataclass(frozen=True)
class Manifest:
    leaves: DataFrame       # id, leaf, now, tree, at, node, slot
    nodes: DataFrame        # seg, node, digests, parent, slot
    groups: DataFrame       # tree, subroot
    root: str | None        # None for an empty table


def _levels(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Build upwards from (tree, first, total, pos, digest, n): the runs of each
    level (tree, first, total, place, digests, digest, n: runs of that level)
    and, from the leaves up, the nodes alone on their level (tree, digest)."""
    runs, alone, level = [], [nodes.filter("n = 1").select("tree", "digest")], 0
    while most > 1:
        run = (nodes.filter("n > 1")
               .groupBy("tree", "first", "total", "n", F.floor(F.col("pos") / ARITY).cast("long").alias("place"))
               .agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("c"))
               .select("tree", "first", "total", "place",
                       F.expr("aggregate(c.digest, X'', (a, x) -> concat(a, x))").alias("digests"),
                       F.ceil(F.col("n") / ARITY).cast("long").alias("n")))
        run = save(run.withColumn("digest", _run_digest(F.col("digests"))), f"manifest-{name}-{level}")
        runs.append(run)
        nodes = run.select("tree", "first", "total", F.col("place").alias("pos"), "digest", "n")
        alone.append(nodes.filter("n = 1").select("tree", "digest"))
        most, level = -(-most // ARITY), level + 1
    return runs, alone


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build(docs: DataFrame, fields: dict[str, Column], now: dict[str, Column], id_col: str = "doc_id",
          group_col: str = "lang") -> Manifest:
    """The manifest of ``docs``: ``fields`` names what a leaf covers, in
    order; ``now`` replaces some of them by what they hold at checking time."""
    # A group's key in the order wanted: null, then by bytes.
    group = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    leaves = save(docs.select(F.col(f"`{id_col}`").alias("id"), group.alias("g"),
                              row_digest(list(fields.values())).alias("leaf"),
                              row_digest(list((fields | now).values())).alias("now")), "manifest-leaves")
    placed = save(sorted_dense_index(leaves, ["g", "id", "leaf"], "at"), "manifest-placed")
    groups = placed.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    groups = save(sorted_dense_index(groups, ["g"], "tree"), "manifest-groups")
    size = groups.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("most")).first()
    trees, most = size["trees"], size["most"] or 0
    leaves = placed.join(groups, "g").select("id", "leaf", "now", "tree", "at", (F.col("at") - F.col("first")).alias("pos"),
                                             "n", "first", F.col("n").alias("total"))

    runs, alone = _levels(leaves.withColumnRenamed("leaf", "digest"), most, "runs")
    subroots = save(_union(alone), "manifest-subroots")
    zero, count = F.lit(0).cast("long"), F.lit(trees).cast("long")
    tops, last = _levels(subroots.select(zero.alias("tree"), zero.alias("first"), count.alias("total"),
                                         F.col("tree").alias("pos"), "digest", count.alias("n")), trees, "top")
    root = _union(last).first()

    # Where a group's root hangs in the top tree.
    none = F.lit(None).cast("long")
    above = _node(0, F.floor(F.col("tree") / ARITY) * ARITY, True) if trees > 1 else none

    def linked(level: int, place: Column, top: bool) -> list[Column]:
        """Parent and place there of a node that is at ``place`` on its level."""
        span = ARITY ** (level + 1)
        start = F.floor(place / ARITY) * span + (zero if top else F.col("first"))
        end, end_slot = (none, zero) if top else (above, F.col("tree") % ARITY)
        return [F.when(F.col("n") == 1, end).otherwise(_node(level, start, top)).alias("parent"),
                F.when(F.col("n") == 1, end_slot).otherwise(place % ARITY).cast("int").alias("slot")]

    def segments(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / BLOCK).cast("long"), F.floor((end - 1) / BLOCK).cast("long")))

    place, parts = F.col("place"), []
    for level, run in enumerate(runs):
        span = ARITY ** (level + 1)
        start = F.col("first") + place * span
        seg = segments(start, F.col("first") + F.least((place + 1) * span, F.col("total")))
        parts.append(run.select(seg.alias("seg"), _node(level, start, False).alias("node"), "digests",
                                *linked(level + 1, place, False)))
    reach = groups.select("tree", segments(F.col("first"), F.col("first") + F.col("n")).alias("seg"))
    for level, run in enumerate(tops):
        span = ARITY ** (level + 1)
        rows = run.select("place", "digests", "n").join(
            reach.select("seg", F.floor(F.col("tree") / span).cast("long").alias("place")).distinct(), "place")
        parts.append(rows.select("seg", _node(level, place * span, True).alias("node"), "digests",
                                 *linked(level + 1, place, True)))
    starts = leaves.select("id", "leaf", "now", "tree", "at", *linked(0, F.col("pos"), False)).withColumnRenamed("parent", "node")
    nodes = save(_union(parts), "manifest-nodes") if parts else None
    return Manifest(save(starts, "manifest-starts"), nodes, subroots.select("tree", F.col("digest").alias("subroot")),
                    root["digest"].hex() if root else None)


# The part of a node's digests before and after the child one comes from.
_LEFT, _RIGHT = "substring(n.digests, 1, 32 * c.slot)", "substring(n.digests, 32 * c.slot + 33)"


def _climb_sql() -> str:
    return f"""
WITH RECURSIVE climb(at, node, slot, level, folded, siblings, id, leaf, tree) AS (
  SELECT at, node, slot, 0, now, X'', id, leaf, tree FROM {{starts}}
  UNION ALL
  SELECT c.at, n.parent, n.slot, c.level + 1,
         unhex(sha2(CAST(lower(hex(concat({_LEFT}, c.folded, {_RIGHT}))) AS BINARY), 256)),
         concat({_LEFT}, {_RIGHT}), NULL, NULL, NULL
  FROM climb c JOIN {{nodes}} n ON c.at DIV {BLOCK} = n.seg AND c.node = n.node)
SELECT at, level, folded, siblings, id, leaf, tree FROM climb
"""


def _proofs(steps: DataFrame) -> DataFrame:
    """A leaf's rows as one: its proof and the root they lead to."""
    met = F.transform(F.array_sort(F.collect_list(F.struct("level", "siblings"))), lambda x: F.lower(F.hex(x["siblings"])))
    return steps.groupBy("at").agg(
        F.max("id").alias("id"), F.max("leaf").alias("leaf"), F.max("tree").alias("tree"),
        F.sha2(F.array_join(met, "").cast("binary"), 256).alias("proof"),
        F.max(F.struct("level", "folded"))["folded"].alias("folded"))


def climb(m: Manifest, id_col: str = "doc_id") -> DataFrame:
    """One row a leaf: id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark = m.leaves.sparkSession
    if m.nodes is None:                 # one leaf or none: nothing to climb
        rows = _proofs(m.leaves.select("at", F.lit(0).alias("level"), F.col("now").alias("folded"),
                                       F.lit(b"").alias("siblings"), "id", "leaf", "tree"))
    else:
        before = spark.conf.get(_ROWS, None)
        spark.conf.set(_ROWS, "-1")     # rows grow with the table; the step count is a tree's height
        try:
            rows = save(_proofs(spark.sql(_climb_sql(), starts=m.leaves, nodes=m.nodes)), "manifest-climb")
        finally:
            spark.conf.unset(_ROWS) if before is None else spark.conf.set(_ROWS, before)
    rows = rows.join(m.groups, "tree")
    text = lambda c: F.lower(F.hex(c))
    return rows.select(F.col("id").alias(id_col), text("leaf").alias("leaf"), text("subroot").alias("subroot"),
                       F.lit(m.root).alias("root"), F.col("proof").alias("proof_sha256"),
                       text("folded").alias("folded_root"), (text("folded") == F.lit(m.root)).alias("verified"))
