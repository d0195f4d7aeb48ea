"""Wide-column "cell" tables as DataFrames.

A cell is ``(rowkey BINARY, cf STRING, cq BINARY, version BIGINT, value
BINARY)``: the reference's ``(row, family, qualifier) -> bytes`` store, with
the version stamp as epoch microseconds. A put is an append of a newer
version; a read resolves versions (B14). No store, no in-place update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.index import MAX_BROADCAST_BLOCKS
from flowlens.session import work_dir

CELL_COLUMNS = ["rowkey", "cf", "cq", "version", "value"]

# Fixed value: the text the reference's rewrite job writes before the row key.
REWRITE_TEMPLATE = "just not test haha at "


def _bytes(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.encode(c.cast("string"), "UTF-8")


def to_cells(df: DataFrame, key: str | Column, cf: str, cols: list[str], version: Column | int = 0,
             key_is_binary: bool = False) -> DataFrame:
    """One cell per (row, column) in family ``cf``; qualifier = column name.

    A narrow ``stack`` (unpivot): no shuffle. Values are stored as the UTF-8
    text of the column (cast to STRING first), like ``Bytes.toBytes(String)``.
    """
    k = (F.col(key) if isinstance(key, str) else key)
    k = k if key_is_binary else _bytes(k)
    ver = version if isinstance(version, Column) else F.lit(version).cast("bigint")
    base = df.select(k.alias("rowkey"), ver.alias("version"),
                     *[F.col(c).cast("string").alias(c) for c in cols])
    long = base.unpivot(["rowkey", "version"], cols, "cq", "v")
    return long.select("rowkey", F.lit(cf).alias("cf"), F.encode("cq", "UTF-8").alias("cq"),
                       "version", F.encode("v", "UTF-8").alias("value"))


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest version of every (rowkey, cf, cq).

    ``max(struct(version, value))`` is a partial-aggregatable max: a cell with
    many versions is reduced map-side before the shuffle. Equal versions are
    broken by the larger value so the result is deterministic.
    """
    top = F.max(F.struct("version", "value")).alias("_top")
    return (cells.groupBy("rowkey", "cf", "cq").agg(top)
                 .select("rowkey", "cf", "cq", F.col("_top.version").alias("version"),
                         F.col("_top.value").alias("value")))


def first_cells(cells: DataFrame) -> DataFrame:
    """The first cell of a column's version list is the newest one."""
    return latest_cells(cells)


MAX_CELLS_PER_RECORD = 10_000


# Keys of wide rows are broadcast up to this many bytes (and rows of 16 bytes more).
MAX_WIDE_KEY_BYTES = 8 << 20


def rows_to_nested(cells: DataFrame, max_cells: int = MAX_CELLS_PER_RECORD, spread: bool = False) -> DataFrame:
    """Rowkey -> sorted ARRAY<STRUCT<cf, cq, value>> of its latest cells,
    as records ``(rowkey, part, cells)``.

    Versions are resolved first (B14), so a list holds one entry per column,
    not per version. A row wider than ``max_cells`` columns is emitted as
    several records (``part`` 0, 1, ...) of at most ``max_cells`` cells in
    (cf, cq) order, so no group is unbounded: the numbering is a streaming
    window over the row (sorted, spillable), and the collect runs per part.
    Rows up to ``max_cells`` columns are one record with ``part`` 0. The
    grouping reuses the window's partitioning by rowkey (no extra shuffle).
    ``spread``: rows that need several records are numbered by many tasks
    (see ``spread_parts``; the latest cells are written once for that).
    """
    latest = latest_cells(cells)
    if spread:
        ranked = spread_parts(latest, max_cells)
    else:
        w = Window.partitionBy("rowkey").orderBy("cf", "cq")
        ranked = latest.withColumn("part", F.floor((F.row_number().over(w) - 1) / max_cells).cast("int"))
    return ranked.groupBy("rowkey", "part").agg(
        F.array_sort(F.collect_list(F.struct("cf", "cq", "value"))).alias("cells"))


def spread_parts(latest: DataFrame, max_cells: int) -> DataFrame:
    """``latest`` (one version of a cell) with ``part``, no task numbering a whole wide row.

    Cells of a row are counted with partial aggregates; rows of at most
    ``max_cells`` cells are part 0 as they are. The others are numbered by
    ``number_in_segments``. Their keys are broadcast only up to
    ``MAX_WIDE_KEY_BYTES``; beyond that all rows are numbered in segments,
    which gives the same parts. A null row key is a row like any other.
    """
    spark = latest.sparkSession
    base = work_dir(spark, "wide-rows")
    latest.write.parquet(f"{base}/latest")
    stored = spark.read.schema(latest.schema).parquet(f"{base}/latest")
    (stored.groupBy("rowkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_cells)
        .select(F.col("rowkey").alias("_wide")).write.parquet(f"{base}/wide"))
    wide = spark.read.schema("_wide BINARY").parquet(f"{base}/wide")
    size = wide.agg(F.sum(F.coalesce(F.octet_length("_wide"), F.lit(0)) + 16).alias("b")).first().b
    if size is None:
        return stored.withColumn("part", F.lit(0))
    if size > MAX_WIDE_KEY_BYTES:
        return number_in_segments(stored, max_cells, base)
    same = F.col("rowkey").eqNullSafe(F.col("_wide"))
    narrow = stored.join(F.broadcast(wide), same, "left_anti").withColumn("part", F.lit(0))
    return narrow.unionByName(number_in_segments(stored.join(F.broadcast(wide), same, "left_semi"), max_cells, base))


def number_in_segments(latest: DataFrame, max_cells: int, base: str) -> DataFrame:
    """``part`` of each cell: ranges of (rowkey, cf, cq) are written as segments, cells are
    numbered inside their segment, and a segment that starts within a row adds the
    cells of that row before it.

    Only the first row of a segment can have begun earlier, so at most one offset
    a segment is above zero: the broadcast table has no more rows than segments.
    """
    spark = latest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = latest.repartitionByRange(n, "rowkey", "cf", "cq").withColumn("_seg", F.spark_partition_id())
    placed.write.parquet(f"{base}/segments")
    cells = spark.read.schema(placed.schema).parquet(f"{base}/segments")
    before = Window.partitionBy("rowkey").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cells.groupBy("rowkey", "_seg").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("_off", F.sum("n").over(before)).filter(F.col("_off") > 0)
                    .select(F.col("rowkey").alias("_key"), F.col("_seg").alias("_at"), "_off"))
    if n <= MAX_BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    w = Window.partitionBy("_seg", "rowkey").orderBy("cf", "cq")
    place = F.row_number().over(w) - 1
    here = F.col("rowkey").eqNullSafe(F.col("_key")) & (F.col("_seg") == F.col("_at"))
    return (cells.withColumn("_place", place).join(offsets, here, "left")
                 .withColumn("part", F.floor((F.col("_place") + F.coalesce("_off", F.lit(0))) / max_cells).cast("int"))
                 .select(*latest.columns, "part"))


def rows_to_bytes(cells: DataFrame, max_cells: int = MAX_CELLS_PER_RECORD, spread: bool = False) -> DataFrame:
    """Rowkey -> latest cells concatenated as cf|cq|value bytes, per
    record part (see ``rows_to_nested``)."""
    nested = rows_to_nested(cells, max_cells, spread)
    joined = F.aggregate("cells", F.unhex(F.lit("")),
                         lambda acc, x: F.concat(acc, F.encode(x["cf"], "UTF-8"), x["cq"], x["value"]))
    return nested.select("rowkey", "part", joined.alias("bytes"))


def render_nested(nested: DataFrame) -> DataFrame:
    """Text rendering of ``rows_to_nested`` (what the reference prints)."""
    txt = F.transform("cells", lambda x: F.concat(x["cf"], F.lit(":"), x["cq"].cast("string"),
                                                  F.lit("="), x["value"].cast("string")))
    return nested.select(F.col("rowkey").cast("string").alias("row"), "part",
                         F.size("cells").alias("n_cells"),
                         F.array_join(txt, ";").alias("cells"))


def template_value(row: Column, template: str = REWRITE_TEMPLATE) -> Column:
    """Value text built from the row key."""
    return F.concat(F.lit(template), row)


def rewrite_versions(cells: DataFrame, cf: str, cq: str, new_version: int,
                     template: str = REWRITE_TEMPLATE) -> DataFrame:
    """New cells for (cf, cq) of every row, one version newer."""
    cur = latest_cells(cells.filter((F.col("cf") == cf) & (F.col("cq") == F.encode(F.lit(cq), "UTF-8"))))
    return cur.select("rowkey", "cf", "cq", F.lit(new_version).cast("bigint").alias("version"),
                      F.encode(template_value(F.col("rowkey").cast("string"), template), "UTF-8")
                      .alias("value"))


def old_and_new(cells: DataFrame, cf: str, cq: str, since_version: int) -> DataFrame:
    """A12 report: per row, the value before ``since_version`` and the newest
    value, in one aggregate (no join, no re-read of a snapshot)."""
    sel = cells.filter((F.col("cf") == cf) & (F.col("cq") == F.encode(F.lit(cq), "UTF-8")))
    before = F.col("version") < since_version
    return sel.groupBy("rowkey").agg(
        F.max(F.when(before, F.struct("version", "value"))).alias("_old"),
        F.max(F.struct("version", "value")).alias("_new"),
    ).select(F.col("rowkey").cast("string").alias("row"),
             F.col("_old.value").cast("string").alias("old_value"),
             F.col("_new.value").cast("string").alias("new_value"))


def scan_family(cells: DataFrame, families: list[str]) -> DataFrame:
    """A3: full scan limited to column families (partition pruning when the
    cell table is partitioned by ``cf``)."""
    return cells.filter(F.col("cf").isin(*families))


def scan_column(cells: DataFrame, cf: str, cq: str) -> DataFrame:
    """A4: row key + one named column (newest version)."""
    col = cells.filter((F.col("cf") == cf) & (F.col("cq") == F.encode(F.lit(cq), "UTF-8")))
    return latest_cells(col).select("rowkey", "value")


def dump_table(cells: DataFrame) -> DataFrame:
    """A5: all latest cells in row-key order (BINARY sorts unsigned, like the
    store). A global sort: range exchange, then per-partition sort."""
    return latest_cells(cells).orderBy("rowkey", "cf", "cq")


def sort_by_key(df: DataFrame, key: str) -> DataFrame:
    """G1: ascending sort on the key (range-partitioned, sorted)."""
    return df.orderBy(key)


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order`` (top-k: per-partition
    TakeOrdered, then a merge of n rows per partition)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """A bounded preview of any result, as a DataFrame."""
    return df.limit(n)


def cells_as_text(cells: DataFrame) -> DataFrame:
    """Display form: row and qualifier as text, value as text."""
    return cells.select(F.col("rowkey").cast("string").alias("row"), "cf",
                        F.col("cq").cast("string").alias("cq"), "version",
                        F.col("value").cast("string").alias("value"))
