from pyspark.sql import functions as F

from flowlens.operators import cells as C
from flowlens.operators.index import dense_index, file_order_index, sorted_dense_index
from flowlens.sources.tables import compact_cells, demo_rows, put_bucketed, put_cells, read_cells


def cells_df(spark):
    rows = [("r1", "f", "a", 1, "old"), ("r1", "f", "a", 5, "new"), ("r1", "f", "b", 2, "x"),
            ("r2", "f", "a", 3, "p"), ("r2", "f", "a", 3, "q"), ("r2", "g", "z", 1, "w")]
    df = spark.createDataFrame(rows, "rowkey STRING, cf STRING, cq STRING, version BIGINT, value STRING")
    return df.select(F.encode("rowkey", "UTF-8").alias("rowkey"), "cf", F.encode("cq", "UTF-8").alias("cq"),
                     "version", F.encode("value", "UTF-8").alias("value"))


def test_latest_cells(spark):
    got = {(r.row, r.cf, r.cq): (r.version, r.value) for r in C.cells_as_text(C.latest_cells(cells_df(spark))).collect()}
    assert got == {("r1", "f", "a"): (5, "new"), ("r1", "f", "b"): (2, "x"),
                   ("r2", "f", "a"): (3, "q"), ("r2", "g", "z"): (1, "w")}


def test_nested_and_bytes(spark):
    nested = {r.row: r.cells for r in C.render_nested(C.rows_to_nested(cells_df(spark))).collect()}
    assert nested == {"r1": "f:a=new;f:b=x", "r2": "f:a=q;g:z=w"}
    b = {bytes(r.rowkey): bytes(r.bytes) for r in C.rows_to_bytes(cells_df(spark)).collect()}
    assert b[b"r1"] == b"fanew" + b"fbx"


def test_wide_row_is_split_into_bounded_parts(spark):
    wide = spark.range(0, 2500, 1, 4).select(
        F.encode(F.lit("hot"), "UTF-8").alias("rowkey"), F.lit("f").alias("cf"),
        F.encode(F.format_string("%05d", "id"), "UTF-8").alias("cq"), F.lit(1).cast("bigint").alias("version"),
        F.encode(F.col("id").cast("string"), "UTF-8").alias("value"))
    parts = C.rows_to_nested(wide, max_cells=1000).select("part", F.size("cells").alias("n"),
                                                           F.col("cells")[0]["cq"].cast("string").alias("first"))
    got = sorted((r.part, r.n, r.first) for r in parts.collect())
    assert got == [(0, 1000, "00000"), (1, 1000, "01000"), (2, 500, "02000")]


def mixed_rows(spark):
    """A row with a third of all cells, a null row key, narrow rows, older versions, null values."""
    k = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)) \
         .otherwise(F.concat(F.lit("r"), (F.col("id") % 40).cast("string")))
    base = spark.range(0, 3000, 1, 6).select(
        F.encode(k, "UTF-8").alias("rowkey"), F.when(F.col("id") % 2 == 0, "f").otherwise("g").alias("cf"),
        F.encode(F.format_string("%04d", "id"), "UTF-8").alias("cq"), F.lit(1).cast("bigint").alias("version"),
        F.when(F.col("id") % 7 > 0, F.encode(F.col("id").cast("string"), "UTF-8")).alias("value"))
    return base.unionByName(base.filter("substr(cq, 4) = '5'").withColumn("version", F.lit(0).cast("bigint")))


def records(df):
    return sorted((str(r.rowkey), r.part, [tuple(c) for c in r.cells]) for r in df.collect())


def test_spread_rows_equal_numbered_rows(spark, monkeypatch):
    cells = mixed_rows(spark)
    want = records(C.rows_to_nested(cells, 37))
    assert len([w for w in want if w[1] > 0]) > 25
    assert records(C.rows_to_nested(cells, 37, spread=True)) == want
    monkeypatch.setattr(C, "MAX_WIDE_KEY_BYTES", 0)      # too many wide rows to broadcast their keys
    assert records(C.rows_to_nested(cells, 37, spread=True)) == want
    assert records(C.rows_to_nested(cells, 5000, spread=True)) == records(C.rows_to_nested(cells, 5000))
    assert records(C.rows_to_nested(cells.limit(0), 37, spread=True)) == []


def test_wide_row_is_numbered_by_many_tasks(spark, tmp):
    cells = mixed_rows(spark).filter("rowkey = X'686f74'")
    C.number_in_segments(C.latest_cells(cells), 100, tmp).collect()
    per_segment = spark.read.parquet(tmp + "/segments").groupBy("_seg").count().collect()
    assert len(per_segment) == 8 and max(r["count"] for r in per_segment) < 300


def test_newest_of_bucketed_cells_needs_no_exchange(spark, tmp):
    cells = mixed_rows(spark)
    name = "flowlens_test.cells_b"
    spark.sql("DROP TABLE IF EXISTS flowlens_test.cells_b")
    spark.sql("DROP TABLE IF EXISTS flowlens_test.cells_n")
    put_bucketed(cells.filter("version = 0"), name, tmp + "/v", 4)
    put_bucketed(cells.filter("version = 1"), name, tmp + "/v", 4)
    newest = C.latest_cells(spark.table(name))
    rows = sorted(map(str, newest.collect()))
    assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    assert rows == sorted(map(str, C.latest_cells(cells).collect()))
    compact_cells(spark, tmp + "/v", "flowlens_test.cells_n", tmp + "/n", 4)
    kept = spark.table("flowlens_test.cells_n")
    assert sorted(map(str, kept.select(*newest.columns).collect())) == rows
    assert len(kept.inputFiles()) == 4
    assert "Exchange" not in C.latest_cells(kept)._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE flowlens_test.cells_b")
    spark.sql("DROP TABLE flowlens_test.cells_n")


def test_rewrite_keeps_old_values(spark, tmp):
    base = demo_rows(spark, 20).select(F.col("row"), F.col("name").cast("string").alias("name"))
    put_cells(C.to_cells(base, "row", "f1", ["name"], 1), tmp)
    put_cells(C.rewrite_versions(read_cells(spark, tmp, ["f1"]), "f1", "name", 2), tmp)
    got = {r.row: (r.old_value, r.new_value) for r in C.old_and_new(read_cells(spark, tmp), "f1", "name", 2).collect()}
    assert len(got) == 20
    assert got["7"] == ("8", C.REWRITE_TEMPLATE + "7")


def test_dump_is_sorted_unsigned(spark):
    rows = [(bytes([b]), "c", b"q", 0, b"v") for b in (0x80, 0x01, 0xFF, 0x7F)]
    df = spark.createDataFrame(rows, "rowkey BINARY, cf STRING, cq BINARY, version BIGINT, value BINARY")
    assert [bytes(r.rowkey)[0] for r in C.dump_table(df).collect()] == [0x01, 0x7F, 0x80, 0xFF]


def test_dense_index_sorted_matches_brute_force(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"))
    got = sorted_dense_index(df, ["k"]).select("k", "idx").collect()
    assert sorted((r.k, r.idx) for r in got) == [(k, k) for k in range(5000)]


def test_file_order_index(spark, tmp):
    spark.range(0, 3000, 1, 5).write.parquet(tmp + "/ids")
    df = spark.read.parquet(tmp + "/ids")
    got = file_order_index(df).collect()
    idx = sorted(r.idx for r in got)
    assert idx == list(range(3000))
    # positions follow file order: files are written in id order per partition
    by_idx = [r.id for r in sorted(got, key=lambda r: r.idx)]
    assert by_idx == sorted(by_idx)


def test_dense_index_partition_order(spark):
    df = spark.range(0, 1000, 1, 4)
    got = sorted((r.idx, r.id) for r in dense_index(df, n_blocks=4).collect())
    assert [i for i, _ in got] == list(range(1000)) and [v for _, v in got] == list(range(1000))


def test_sorted_index_splits_a_hot_key(spark):
    """A third of the rows share one order key: the range exchange must not
    put them all in one partition, and the index stays dense."""
    n = 9000
    df = spark.range(0, n, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    ix = sorted_dense_index(df, ["k"])
    got = sorted((r.idx, r.k) for r in ix.collect())
    assert [i for i, _ in got] == list(range(n))
    assert [k for _, k in got] == sorted(k for _, k in got)
    per_part = ix.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in per_part) < n / 3


def test_dense_index_keeps_columns(spark):
    """Many partitions, a key with many ties and a payload column."""
    df = spark.range(0, 20_000, 1, 9).select((F.col("id") % 13).alias("k"), "id", F.md5(F.col("id").cast("string")).alias("p"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = sorted_dense_index(df, ["k", "id"], "idx").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = {(k, i): n for n, (k, i) in enumerate(sorted((i % 13, i) for i in range(20_000)))}
    assert {(r.k, r.id): r.idx for r in got} == want and len({r.p for r in got}) == 20_000
