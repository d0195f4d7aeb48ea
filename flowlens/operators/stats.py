"""Aggregations: protocol counts (E1), session counts (E2), row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.decode import five_tuple_cols

# Fixed value: session bucket = slot mod 100 (the reference's key salt).
SESSION_BUCKETS = 100


def count_protocols(pk: DataFrame) -> DataFrame:
    """TCP, TCP over IPv4, UDP, UDP over IPv4 counts in ONE scan.

    The reference runs four filtered counts (four scans and four parses);
    here one aggregate with four conditional counts: partial counts per
    task, a single-row final merge.
    """
    return pk.agg(
        F.count_if(F.col("has_tcp")).alias("tcp"),
        F.count_if(F.col("has_tcp") & F.col("has_ipv4")).alias("tcp_ipv4"),
        F.count_if(F.col("has_udp")).alias("udp"),
        F.count_if(F.col("has_udp") & F.col("has_ipv4")).alias("udp_ipv4"),
    )


def count_unread(pk: DataFrame) -> DataFrame:
    """Frames whose headers were not read to the end, beside all frames: too
    short for Ethernet, or nested deeper than the decoder walks. One scan."""
    return pk.agg(F.count(F.lit(1)).alias("frames"),
                  F.count_if(~F.col("decodable")).alias("undecodable"),
                  F.count_if(F.col("depth_exceeded")).alias("depth_exceeded"))


def time_slot(ts_sec: str, width_s: int) -> Column:
    """floor(ts_sec / width) with integer arithmetic (exact for any
    BIGINT, and a negative time does not share slot 0)."""
    return F.expr(f"(`{ts_sec}` - pmod(`{ts_sec}`, {int(width_s)})) div {int(width_s)}")


def slot_bucket(slot: Column, buckets: int = SESSION_BUCKETS) -> Column:
    """Non-negative bucket of a slot."""
    return F.pmod(slot, F.lit(buckets)).cast("int")


def session_counts(pk: DataFrame, dense: int = 60, ts_col: str = "ts_sec") -> DataFrame:
    """Packets per (bucket, slot, directional 5-tuple).

    ``groupBy().count()`` gets a map-side partial aggregate, so a hot flow
    (even a third of all packets) reaches the shuffle as one row per task.
    The bucket is a function of the slot, so it is derived after the
    aggregate instead of widening the grouping key.
    """
    keyed = pk.select(time_slot(ts_col, dense).alias("slot"), *five_tuple_cols())
    counts = keyed.groupBy("slot", "sip", "dip", "sport", "dport", "proto").agg(F.count(F.lit(1)).alias("c"))
    return counts.select(slot_bucket(F.col("slot")).alias("bucket"), "slot", "sip", "dip",
                         "sport", "dport", "proto", "c")


def count_rows(df: DataFrame) -> DataFrame:
    """Total rows as a one-row DataFrame (stays lazy, unlike ``count()``)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def write_sessions(sessions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """E2 sink: session counts -> table partitioned by bucket.

    Rows are range-partitioned on (bucket, slot, 5-tuple) first, so each task
    writes a contiguous run of buckets (a file or two) instead of up to 100
    small files, a slot-range scan of one bucket reads few row groups, and a
    busy slot is cut over several tasks by its flows."""
    n = max(1, int(sessions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["bucket", "slot", "sip", "dip", "sport", "dport", "proto"]
    (sessions.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
             .write.mode(mode).partitionBy("bucket").parquet(path))
