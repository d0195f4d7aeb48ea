"""Plan shapes: shuffles, pruning, codegen, broadcasts, zone independence."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import compare, duck_connect


def executed(df) -> str:
    """The final adaptive plan after running the query."""
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


def count(s, token):
    return s.count(token)


def test_count_protocols_one_scan_partial_agg(spark):
    p = executed(E.queries()["count_protocols"](spark, SF_SMALL))
    assert count(p, "Exchange") == 1 and "SinglePartition" in p
    assert "partial_count" in p
    assert count(p, "FileScan") == 1 and "ReadSchema: struct<raw:binary>" in p
    assert "BroadcastExchange" not in p


def test_session_counts_single_hash_exchange(spark):
    p = executed(E.queries()["session_counts"](spark, SF_SMALL))
    assert count(p, "Exchange hashpartitioning") == 1
    assert "partial_count" in p
    assert "ReadSchema: struct<ts_sec:bigint,raw:binary>" in p


def test_packet_features_no_shuffle_and_codegen(spark):
    df = E.queries()["packet_features"](spark, SF_SMALL)
    p = executed(df)
    assert "Exchange" not in p
    assert "*(" in p and "Generate inline" in p


@pytest.mark.parametrize("name", ["import_keys", "cells_latest", "merge_points", "session_counts"])
def test_no_broadcast(spark, name):
    p = executed(E.queries()[name](spark, SF_SMALL))
    assert "BroadcastExchange" not in p


@pytest.mark.parametrize("name", ["with_index", "flow_cells"])
def test_dense_index_broadcast_is_offsets_only(spark, name):
    """The only broadcast is the per-block offset table (one row per input
    block / partition, bounded before the job runs)."""
    p = executed(E.queries()[name](spark, SF_SMALL))
    assert count(p, "BroadcastExchange") == 1 and "_ix_off" in p


@pytest.mark.parametrize("name", ["import_keys", "timeslot_keys", "cells_latest", "capture_roundtrip",
                                  "stream_minute_counts", "session_counts"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    con = duck_connect(SF_SMALL)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r


def test_packet_table_region_pruning(spark, tmp):
    from pyspark.sql import functions as F
    from flowlens.sources.tables import read_packets, write_packets
    df = spark.range(0, 2000, 1, 4).select(
        F.unhex(F.md5(F.col("id").cast("string"))).alias("rowkey"),
        F.unhex(F.lit("00")).alias("raw"), F.lit(1).alias("orig_len"))
    write_packets(df, tmp)
    pruned = read_packets(spark, tmp, [3, 4])
    p = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in p and "IN (3,4)" in p
    total = read_packets(spark, tmp).count()
    assert total == 2000
    assert pruned.count() == read_packets(spark, tmp).filter(F.col("key_bucket").isin(3, 4)).count()
