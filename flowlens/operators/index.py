"""Dense 0-based row index without funnelling rows through one task.

``row_number()`` over an un-partitioned window moves every row into a single
task. Instead rows get ``monotonically_increasing_id`` (partition id in the
high bits, position in the low bits); a tiny per-block table (one row per
input split or shuffle partition) supplies each block's starting offset via a
running sum, and is joined back. That table's size is bounded by the number
of partitions, which is known before the job runs, so it is broadcast only
when that bound is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.session import work_dir

# Blocks (input splits / shuffle partitions) up to which the offset table is
# broadcast; ~40 bytes per block, so 200k blocks is ~8 MB.
MAX_BROADCAST_BLOCKS = 200_000

_MID, _PID, _CNT, _M0, _OFF = "_ix_mid", "_ix_pid", "_ix_cnt", "_ix_m0", "_ix_off"


def dense_index(df: DataFrame, block_cols: list[str] | None = None, name: str = "idx",
                n_blocks: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row.

    Position order is block order, then read order inside a block. Blocks are
    ``block_cols`` (e.g. file path and split start, for file order) or, when
    omitted, Spark partitions (partition order; use after a global sort).
    The input must be deterministic per partition (a file scan or a sort on a
    unique key), since it is evaluated once for the offsets and once for the
    rows. ``n_blocks`` is an upper bound on the number of blocks; when not
    given it is the partition count of a plan without exchanges.
    """
    d = df.withColumn(_MID, F.monotonically_increasing_id())
    if block_cols:
        blocks = list(block_cols)
    else:
        d = d.withColumn(_PID, F.shiftright(F.col(_MID), 33))
        blocks = [_PID]
    stats = d.groupBy(*blocks).agg(F.count(F.lit(1)).alias(_CNT), F.min(_MID).alias(_M0))
    # Running sum over a table with one row per block (bounded by the
    # partition count); an un-partitioned window is fine at that size.
    w = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(*blocks, _M0, F.coalesce(F.sum(_CNT).over(w), F.lit(0)).alias(_OFF))
    if n_blocks is None:
        n_blocks = df.rdd.getNumPartitions()
    if n_blocks <= MAX_BROADCAST_BLOCKS:
        offs = F.broadcast(offs)
    out = d.join(offs, on=blocks, how="inner")
    out = out.withColumn(name, F.col(_OFF) + F.col(_MID) - F.col(_M0))
    return out.drop(_MID, _PID, _M0, _OFF)


def index_in_order(df: DataFrame, name: str = "idx") -> DataFrame:
    """Index by the order ``df`` already has (partition order, then row order).

    A range sort samples its input, so two evaluations of the same sorted
    plan may cut it differently: counting rows in one and numbering them in
    the other gives duplicate and missing indexes. The rows are therefore
    written once, with their partition and position, under the shared work
    folder, and both the offsets and the rows are read from there."""
    spark = df.sparkSession
    path = work_dir(spark, "ordered") + "/t"
    placed = df.withColumn(_MID, F.monotonically_increasing_id())
    placed.write.parquet(path)
    d = spark.read.schema(placed.schema).parquet(path).withColumn(_PID, F.shiftright(F.col(_MID), 33))
    stats = d.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT), F.min(_MID).alias(_M0))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    offs = stats.select(_PID, _M0, F.coalesce(F.sum(_CNT).over(w), F.lit(0)).alias(_OFF))
    if stats.count() <= MAX_BROADCAST_BLOCKS:
        offs = F.broadcast(offs)
    return d.join(offs, _PID).withColumn(name, F.col(_OFF) + F.col(_MID) - F.col(_M0)).drop(_MID, _PID, _M0, _OFF)


def sorted_dense_index(df: DataFrame, order_cols: list[str], name: str = "idx") -> DataFrame:
    """Index by a global order on ``order_cols``, all columns kept:
    range-partition and sort (one shuffle), then ``index_in_order``.

    The scan position of each row is appended as a last sort key: rows that
    tie on ``order_cols`` (even a third of the table) can then be split by
    the range boundaries over several partitions instead of landing in one
    task, and the order among ties is deterministic on retry (the input is a
    deterministic scan)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order_cols, "_ix_tie"]
    s = (df.withColumn("_ix_tie", F.monotonically_increasing_id())
           .repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_ix_tie"))
    return index_in_order(s, name)


def file_order_index(df: DataFrame, name: str = "idx") -> DataFrame:
    """Index in file order (path, then split start, then row) of a file scan."""
    d = df.select("*", F.col("_metadata.file_path").alias("_ix_path"),
                  F.col("_metadata.file_block_start").alias("_ix_blk"))
    return dense_index(d, ["_ix_path", "_ix_blk"], name).drop("_ix_path", "_ix_blk")
