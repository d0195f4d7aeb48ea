import json
import os

from pyspark.sql import functions as F

from flowlens.sources.jsonio import flow_values_to_cells, puts_from_json, read_flow_json


def test_one_document_flow_format(spark, tmp):
    docs = {"a.json": [["1", "x"], ["2", "y", "z"]], "b.json": [["3"], [], ["4", "w"]]}
    for name, vals in docs.items():
        with open(os.path.join(tmp, name), "w") as f:
            json.dump({"header": {"relation": "flows"},
                       "data": [{"sparse": False, "weight": 1.0, "values": v} for v in vals]}, f, indent=2)
    flows = read_flow_json(spark, tmp, multi_line=True)
    got = sorted((r.idx, list(r["values"])) for r in flows.collect())
    assert got == [(0, ["1", "x"]), (1, ["2", "y", "z"]), (2, ["3"]), (3, []), (4, ["4", "w"])]
    cells = flow_values_to_cells(flows).select(F.hex("rowkey").alias("k"), F.hex("cq").alias("q"),
                                               F.col("value").cast("string").alias("v")).collect()
    assert ("000000000004", "0001", "w") in [(r.k, r.q, r.v) for r in cells]
    assert len(cells) == 8


def test_json_lines_flow_format_keeps_file_order(spark, tmp):
    with open(os.path.join(tmp, "part-00000.json"), "w") as f:
        for i in range(5):
            f.write(json.dumps({"sparse": False, "values": [str(i)], "weight": 1.0}) + "\n")
    with open(os.path.join(tmp, "part-00001.json"), "w") as f:
        for i in range(5, 8):
            f.write(json.dumps({"sparse": False, "values": [str(i)], "weight": 1.0}) + "\n")
    got = sorted((r.idx, r["values"][0]) for r in read_flow_json(spark, tmp).collect())
    assert got == [(i, str(i)) for i in range(8)]


def test_puts_rejects(spark):
    df = spark.createDataFrame([('{"row":"r1","vpair":[{"cf":"c","cl":"a","v":"1"}]}',),
                                ('{"row":"r2","vpair":"oops"}',), ('{"row":"r3"',), ('{"vpair":[]}',)], "json STRING")
    cells, rejects = puts_from_json(df)
    assert [(bytes(r.rowkey), r.cf, bytes(r.cq), bytes(r.value)) for r in cells.collect()] == [(b"r1", "c", b"a", b"1")]
    assert rejects.count() == 3
