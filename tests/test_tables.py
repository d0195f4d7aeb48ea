import os

from pyspark.sql import functions as F

from flowlens.sources.tables import derived_table, derived_table_path, spread


def test_derived_table_built_once_and_reused(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(0, 100, 1, 3)
    fp = f"test-{os.getpid()}-reuse"
    a = derived_table(spark, "t", fp, build)
    b = derived_table(spark, "t", fp, build)
    assert a.count() == b.count() == 100 and len(calls) == 1
    c = derived_table(spark, "t", fp + "-changed", build)
    assert c.count() == 100 and len(calls) == 2


def test_broken_leftover_is_replaced(spark):
    fp = f"test-{os.getpid()}-leftover"
    path = derived_table_path(spark, "u", fp, lambda: spark.range(0, 10))
    local = path.replace("file:", "")
    os.remove(os.path.join(local, "_SUCCESS"))          # simulate a partial/legacy folder
    path2 = derived_table_path(spark, "u", fp, lambda: spark.range(0, 20))
    assert path2 == path
    assert spark.read.parquet(path).count() == 20
    assert not [d for d in os.listdir(local) if ".tmp-" in d]


def test_spread_only_when_under_partitioned(spark, tmp):
    big = spark.range(0, 400_000, 1, 1).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    big.coalesce(1).write.parquet(tmp + "/big")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        df = spark.read.parquet(tmp + "/big")
        assert df.rdd.getNumPartitions() == 1
        assert spread(df).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    spark.range(0, 10, 1, 1).write.parquet(tmp + "/small")
    small = spark.read.parquet(tmp + "/small")
    assert spread(small).rdd.getNumPartitions() == 1


def test_clean_work_removes_only_old_work_folders(spark):
    import time
    from flowlens.session import clean_work, work_dir
    p = work_dir(spark, "janitor-test").replace("file:", "")
    open(os.path.join(p, "x"), "w").close()
    old = time.time() - 48 * 3600
    os.utime(p, (old, old))
    fresh = work_dir(spark, "janitor-fresh").replace("file:", "")
    deleted = clean_work(spark, older_than_hours=24)
    assert any(d.endswith(os.path.basename(p)) for d in deleted)
    assert not os.path.exists(p) and os.path.exists(fresh)


def test_fingerprint_sees_nested_files(spark, tmp_path):
    from flowlens.sources.tables import input_fingerprint
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("1")
    before = input_fingerprint(spark, str(tmp_path))
    (tmp_path / "a" / "x").write_text("22")
    assert input_fingerprint(spark, str(tmp_path)) != before


def test_declared_packet_table_has_the_rows(spark, tmp):
    from flowlens.sources.tables import create_packet_table, write_packets
    create_packet_table(spark, "declared_test.packets", tmp + "/p")
    try:
        df = spark.range(200).selectExpr("unhex(md5(cast(id as string))) rowkey", "binary('x') raw", "1 orig_len")
        write_packets(df, tmp + "/p", table="declared_test.packets")
        assert spark.table("declared_test.packets").count() == 200
    finally:
        spark.sql("DROP DATABASE declared_test CASCADE")


def _keyed(spark, n, hot=0):
    """n rows under MD5 keys; the last ``hot`` share one prefix."""
    md5 = F.when(F.col("id") < n - hot, F.md5(F.col("id").cast("string"))).otherwise(F.md5(F.lit("hot")))
    return spark.range(0, n, 1, 4).select(
        F.unhex(F.concat(md5, F.lpad(F.hex("id"), 8, "0"))).alias("rowkey"), F.lit(b"x").alias("raw"),
        F.lit(1).alias("orig_len"))


def test_range_scan_equals_filter_and_prunes(spark, tmp):
    from flowlens.sources.tables import read_packets, write_packets
    df = _keyed(spark, 3000)
    write_packets(df, tmp + "/p")
    keys = sorted(bytes(r.rowkey) for r in df.select("rowkey").collect())
    some = keys[700]
    for start, stop in [(b"\x20", b"\x90"), (None, b"\x33"), (b"\xf0", None), (some, some + b"\0"), (b"\x01\x01\x01\x01", b"\x12\x12"),
                        (b"\x90", b"\x20"), (b"\xff\xff\xff\xff\xff", None), (b"", b"")]:
        got = sorted(bytes(r.rowkey) for r in read_packets(spark, tmp + "/p", start=start, stop=stop).collect())
        assert got == [k for k in keys if (not start or k >= start) and (not stop or k < stop)], (start, stop)
    p = read_packets(spark, tmp + "/p", start=b"\x20", stop=b"\x40")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in p and "IN (1,2,3)" in p
    assert "GreaterThanOrEqual(rowkey" in p and "LessThan(rowkey" in p


def test_single_keys(spark, tmp):
    from flowlens.sources.tables import get_packets, write_packets
    df = _keyed(spark, 500)
    write_packets(df, tmp + "/p")
    keys = [bytes(r.rowkey) for r in df.select("rowkey").limit(3).collect()]
    assert sorted(bytes(r.rowkey) for r in get_packets(spark, tmp + "/p", [*keys, b"absent"]).collect()) == sorted(keys)
    assert get_packets(spark, tmp + "/p", []).count() == 0


def test_placement_spreads_a_hot_flow_without_sampling(spark):
    from flowlens.sources.tables import place_by_key
    df = _keyed(spark, 6000, hot=2000)
    placed = place_by_key(df, 15, 8)
    assert "rangepartitioning" not in placed._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 6000 / 10
    odd = spark.createDataFrame([(None,), (b"",), (b"\xff" * 4,), (b"\x01",)], "rowkey BINARY")
    assert place_by_key(odd, 15, 2).count() == 4


def test_cell_rows_in_range(spark, tmp):
    from flowlens.operators.cells import to_cells
    from flowlens.sources.tables import put_cells, read_cells
    df = spark.range(300).select("id", F.col("id").alias("a"), F.col("id").alias("b"))
    put_cells(to_cells(df, "id", "f", ["a"]), tmp + "/c")
    put_cells(to_cells(df, "id", "g", ["b"]), tmp + "/c")
    scan = read_cells(spark, tmp + "/c", ["f"], b"12", b"2")
    rows = sorted(bytes(r.rowkey).decode() for r in scan.collect())
    assert rows == sorted(str(i) for i in range(300) if "12" <= str(i) < "2")
    p = scan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(rowkey" in p and "cf" in p.split("PartitionFilters")[1]
    assert read_cells(spark, tmp + "/c", None, b"12", b"2").count() == 2 * len(rows)
