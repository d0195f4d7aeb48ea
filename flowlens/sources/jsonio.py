"""JSON inputs: the flow dataset (A7, B12, B13) and JSON puts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.bytesx import be_bytes_exact
from flowlens.functions.keys import record_key, record_salt
from flowlens.operators.index import file_order_index
from flowlens.sources.capture import list_captures
from flowlens.sources.jsondoc import read_json_array

FLOW_SCHEMA = T.StructType([
    T.StructField("sparse", T.BooleanType()),
    T.StructField("values", T.ArrayType(T.StringType())),
    T.StructField("weight", T.FloatType()),
])

PUT_SCHEMA = T.StructType([
    T.StructField("row", T.StringType()),
    T.StructField("vpair", T.ArrayType(T.StructType([
        T.StructField("cf", T.StringType()),
        T.StructField("cl", T.StringType()),
        T.StructField("v", T.StringType()),
    ]))),
])


def read_flow_json(spark: SparkSession, path: str, multi_line: bool = False,
                   split_bytes: int | None = None) -> DataFrame:
    """Flow records -> (idx, sparse, values, weight).

    ``multi_line=True`` reads the reference's format: one JSON document per
    file, ``{"data": [ {sparse, values, weight}, ... ]}``; the index is the
    position in the ``data`` array, files in path order. A document is cut into
    byte splits and read by many tasks (``jsondoc``). ``multi_line=False``
    reads JSON Lines: the index is the record's position in file order.
    """
    if multi_line:
        rec = read_json_array(spark, list_captures(path), "data", split_bytes)
        rec = rec.select("_path", "pos", F.from_json("json", FLOW_SCHEMA).alias("r")).select("_path", "pos", "r.*")
        return _index_over_files(rec).select("idx", "sparse", "values", "weight")
    rec = spark.read.schema(FLOW_SCHEMA).json(path)
    return file_order_index(rec, "idx").select("idx", "sparse", "values", "weight")


def _index_over_files(rec: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    counts = rec.groupBy("_path").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_path", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return rec.join(offs, "_path").withColumn("idx", F.col("_off") + F.col("pos"))


def flow_values_to_cells(flows: DataFrame, cf: str = "i") -> DataFrame:
    """B12 + B13: one cell per value position; row key = salt | index,
    qualifier = 2-byte position, value = UTF-8 text."""
    ex = flows.select("idx", F.posexplode("values").alias("pos", "v"))
    return ex.select(record_key(F.col("idx")).alias("rowkey"), F.lit(cf).alias("cf"),
                     be_bytes_exact(F.col("pos"), 2).alias("cq"), F.lit(0).cast("bigint").alias("version"),
                     F.encode("v", "UTF-8").alias("value"), record_salt(F.col("idx")).alias("salt"))


def puts_from_json(json_df: DataFrame, col: str = "json") -> tuple[DataFrame, DataFrame]:
    """JSON put text ``{row, vpair: [{cf, cl, v}]}`` -> (cells, rejects).

    ``from_json`` in permissive mode yields NULL fields for malformed text or
    a wrong shape; such rows go to ``rejects`` with the text, instead of the
    reference's empty default record.
    """
    p = json_df.select(F.col(col).alias("json"), F.from_json(col, PUT_SCHEMA).alias("p"))
    ok = F.col("p.row").isNotNull() & F.col("p.vpair").isNotNull()
    # The validity test sits inside the generator (explode of NULL emits no
    # row) rather than in a Filter, which Catalyst would push below the
    # projection and so parse every document twice.
    cells = (p.select(F.col("p.row").alias("row"), F.explode(F.when(ok, F.col("p.vpair"))).alias("s"))
              .select(F.encode("row", "UTF-8").alias("rowkey"), F.col("s.cf").alias("cf"),
                      F.encode("s.cl", "UTF-8").alias("cq"), F.lit(0).cast("bigint").alias("version"),
                      F.encode("s.v", "UTF-8").alias("value")))
    rejects = p.filter(~ok).select("json")
    return cells, rejects
