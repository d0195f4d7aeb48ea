"""The one-document JSON reader against ``json.loads``, at every cut."""

import json
import os
import random

import pandas as pd
import pytest

from flowlens.sources import jsondoc
from flowlens.sources.jsonio import read_flow_json


def read(path, split_bytes, member="data"):
    """The three jobs as plain calls over one file's splits."""
    rows = jsondoc.split_rows([(path, os.path.getsize(path))], split_bytes)
    pdf = pd.DataFrame(rows, columns=["uri", "size", "split", "lo", "hi"])
    if not len(pdf):
        return []
    pdf = jsondoc._entries(pd.concat(jsondoc._states(iter([pdf]))))
    pdf = jsondoc._ranges(member)(pd.concat(jsondoc._marks(iter([pdf]))))
    out = list(jsondoc._records(iter([pdf])))
    got = pd.concat(out) if out else pd.DataFrame({"pos": [], "json": []})
    assert got["pos"].tolist() == list(range(len(got)))
    return [json.loads(t) for t in got["json"]]


def put(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


TRICKY = ['"', "\\", '\\"', "{", "}", "[", "]", '{"data": [', "\\\\", "é☃", " ", "a\nb", ",", ":", '"}]', "\\u0022", ""]


def _document(rng):
    def text():
        return "".join(rng.choice(TRICKY) for _ in range(rng.randrange(5)))

    def value(d):
        k = rng.randrange(6 if d < 4 else 3)
        if k == 3:
            return [value(d + 1) for _ in range(rng.randrange(4))]
        if k == 4:
            return {text(): value(d + 1) for _ in range(rng.randrange(4))}
        return [text(), rng.randrange(100), None][k % 3]
    doc = {text() + "x": value(0), "other": [{"values": [1]}, {"a": {}}], "header": {"data": [{"no": {}}]}}
    data = [{text(): value(1) for _ in range(rng.randrange(4))} for _ in range(rng.randrange(8))]
    items = [*doc.items(), ("data", data), ("last", "data")]
    rng.shuffle(items)
    return dict(items)


@pytest.mark.parametrize("seed", range(12))
def test_every_cut_gives_the_records(tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    doc = _document(rng)
    path = put(str(tmp_path / "d.json"), json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=seed % 2 == 0))
    for split, block in [(1, 1), (2, 3), (3, 2), (7, 5), (13, 64), (64, 7), (1 << 20, 11), (1 << 20, 1 << 20)]:
        monkeypatch.setattr(jsondoc, "BLOCK", block)
        assert read(path, split) == doc["data"], (split, block)


def test_empty_missing_and_repeated_members(tmp_path):
    for text, want in [("", []), ("  \n", []), ("{}", []), ('{"data": []}', []), ('{"x": [{"a": 1}]}', []),
                       ('{"data": null}', []), ('[{"data": [{"a": 1}]}]', []), ('{"data": [{"a": 1}], "data": [{"b": 2}, {}]}', [{"b": 2}, {}]),
                       ('{"d\\u0061ta": [{"a": 1}]}', [{"a": 1}])]:
        path = put(str(tmp_path / "e.json"), text)
        for split in (1, 4, 100):
            assert read(path, split) == want, (text, split)


def test_what_cannot_be_read_whole_is_an_error(tmp_path):
    for text in ['{"data": [{"a": 1}', '{"data": [{"a": "1}]}', '{"data": [{"a": 1}, null]}', '{"data": [[1], {"a": 1}]}',
                 '{"data": ["x"]}', '{"data": [{"a": 1}, 5, {}]}']:
        path = put(str(tmp_path / "f.json"), text)
        for split in (2, 100):
            with pytest.raises(ValueError):
                read(path, split)


def test_one_file_is_read_by_many_tasks(spark, tmp):
    vals = [[str(i), 'q"\\' * (i % 3), "é" * (i % 5)] for i in range(3000)]
    put(tmp + "/a.json", json.dumps({"data": [{"sparse": False, "weight": 1.0, "values": v} for v in vals[:2900]]}))
    put(tmp + "/b.json", json.dumps({"data": [{"sparse": False, "weight": 1.0, "values": v} for v in vals[2900:]]}))
    flows = read_flow_json(spark, tmp, multi_line=True, split_bytes=8 << 10)
    records = jsondoc.read_json_array(spark, [(tmp + "/a.json", os.path.getsize(tmp + "/a.json"))], split_bytes=8 << 10)
    assert records.selectExpr("spark_partition_id() p").distinct().count() >= 16
    assert [list(r["values"]) for r in flows.orderBy("idx").collect()] == vals
    assert [r.idx for r in flows.select("idx").orderBy("idx").collect()] == list(range(3000))
    assert jsondoc.read_json_array(spark, []).count() == 0
    with pytest.raises(ValueError):
        jsondoc.read_json_array(spark, [("x.json.gz", 10)])
