import hashlib

import pytest
from pyspark.sql import functions as F

from flowlens.functions.keys import (
    import_key, key_range_bucket, lineage_suffix, record_key, split_key, split_points, timeslot_key, tuple_bytes,
)


def _tuple_df(spark):
    return spark.createDataFrame([(1, 3232267012, 4026531834, 57055, 1900, 17, 1704067200, 123456)],
                                 "id BIGINT, sip BIGINT, dip BIGINT, sport INT, dport INT, proto INT, "
                                 "ts_sec BIGINT, ts_usec INT")


def _tup(legacy=False):
    return tuple_bytes(F.col("sip"), F.col("dip"), F.col("sport"), F.col("dport"), F.col("proto"), legacy)


def test_tuple_bytes_and_golden_md5(spark):
    r = _tuple_df(spark).select(F.hex(_tup()).alias("t"), F.md5(_tup()).alias("m"),
                                F.hex(_tup(True)).alias("lt"), F.md5(_tup(True)).alias("lm")).collect()[0]
    assert r.t.lower() == "c0a87b04effffffadedf076c11"
    assert r.m == "2595fc713122bf4b1d137a545065b129"
    assert r.lt.lower() == "c0a87b04effffffadfde076c11"
    assert r.lm == "28fd10eaab8d3f0322f72ac46b815f29"


def test_import_key_roundtrip(spark):
    df = _tuple_df(spark)
    key = import_key(_tup(), F.lit(7), F.col("ts_sec"), F.col("ts_usec"), lineage_suffix("id"))
    r = df.select(F.octet_length(key).alias("n"), split_key(key, "import").alias("k")).collect()[0]
    assert r.n == 43
    k = r.k
    assert (k.dataset_id, k.ts_sec, k.ts_usec, k.sip, k.dip, k.sport, k.dport, k.proto) == \
        (7, 1704067200, 123456, 3232267012, 4026531834, 57055, 1900, 17)
    assert k.salt == "2595fc713122bf4b1d137a545065b129"
    assert k.suffix == hashlib.md5(b"1").hexdigest()[:8]


def test_timeslot_key_roundtrip(spark):
    df = _tuple_df(spark)
    ms = F.col("ts_sec") * 1000 + 123
    key = timeslot_key(_tup(), ms, F.lit(3), 60, lineage_suffix("id"))
    k = df.select(split_key(key, "timeslot").alias("k")).collect()[0].k
    assert (k.ts_ms, k.source_id, k.sport) == (1704067200123, 3, 57055)
    slot = (1704067200123 // 1000) // 60
    want = hashlib.md5(bytes.fromhex("c0a87b04effffffadedf076c11") + slot.to_bytes(4, "big")).hexdigest()
    assert k.salt == want


def test_key_range_bucket_matches_brute_force(spark):
    lo, hi, n = 0x01010101, 0xFFFFFFFF, 15
    splits = [int(s, 16) for s in split_points(lo, hi, n, 4)]
    vals = [0, 1, lo - 1, lo, lo + 1, splits[0] - 1, splits[0], splits[5], hi, 0x80000000, 0x7FFFFFFF]
    df = spark.createDataFrame([(v.to_bytes(4, "big") + b"rest",) for v in vals], "key BINARY")
    got = [r[0] for r in df.select(key_range_bucket(F.col("key"), lo, hi, n, 4)).collect()]
    want = [sum(1 for s in splits if s <= v) for v in vals]
    assert got == want


def test_record_key(spark):
    df = spark.createDataFrame([(0,), (1199,), (1200,), (18000,), (123456,)], "idx BIGINT")
    got = [r[0] for r in df.select(F.lower(F.hex(record_key(F.col("idx"))))).collect()]
    want = [(((i // 1200) % 15).to_bytes(2, "big") + i.to_bytes(4, "big")).hex() for i in (0, 1199, 1200, 18000, 123456)]
    assert got == want


def test_bytes_to_int_widths_and_sign(spark):
    from flowlens.functions.bytesx import be_bytes, bytes_to_int
    vals = [0, 1, 255, 65535, 2**32 - 1, 2**62, -1, -750000, -(2**63)]
    df = spark.createDataFrame([(v,) for v in vals], "v BIGINT")
    got = [r[0] for r in df.select(bytes_to_int(be_bytes(F.col("v"), 8))).collect()]
    assert got == vals
    got4 = [r[0] for r in df.filter("v >= 0 AND v < 4294967296")
            .select(bytes_to_int(be_bytes(F.col("v"), 4))).collect()]
    assert got4 == [0, 1, 255, 65535, 2**32 - 1]
    neg = spark.createDataFrame([(b"\xff\xff\xff\xff",)], "b BINARY").select(bytes_to_int(F.col("b"))).collect()
    assert neg[0][0] == 2**32 - 1


def test_two_byte_presplit_matches_record_salt(spark):
    """The 15-region split over 2-byte keys 0..16 puts each record salt
    (0..14) in its own region."""
    df = spark.createDataFrame([(i,) for i in range(0, 15 * 1200 * 2, 599)], "idx BIGINT")
    got = df.select(key_range_bucket(record_key(F.col("idx")), 0, 16, 15, 2).alias("b"),
                    ((F.col("idx") / 1200).cast("bigint") % 15).alias("salt")).collect()
    assert all(r.b == r.salt for r in got)


def test_record_key_never_wraps(spark):
    import pytest
    ok = spark.range(1).select(record_key(F.lit((1 << 32) - 1).cast("bigint")).alias("k"))
    assert bytes(ok.first().k)[2:] == b"\xff" * 4
    for bad in (1 << 32, (1 << 32) + 5, -1):
        with pytest.raises(Exception, match="does not fit"):
            spark.range(1).select(record_key(F.lit(bad).cast("bigint")).alias("k")).collect()


@pytest.mark.parametrize("dataset,sec,usec", [(65536, 5, 0), (-1, 5, 0), (7, 1 << 32, 0), (7, -1, 0), (7, 5, 1 << 32)])
def test_import_key_never_wraps(spark, dataset, sec, usec):
    key = import_key(F.unhex(F.lit("00" * 13)), F.lit(dataset), F.lit(sec), F.lit(usec), F.unhex(F.lit("00" * 4)))
    with pytest.raises(Exception, match="does not fit"):
        spark.range(1).select(key.alias("k")).collect()


@pytest.mark.parametrize("ms,source", [(1000, 65536), (1000, -1), (-1000, 3), ((1 << 32) * 60_000, 3)])
def test_timeslot_key_never_wraps(spark, ms, source):
    key = timeslot_key(F.unhex(F.lit("00" * 13)), F.lit(ms).cast("bigint"), F.lit(source), 60, F.unhex(F.lit("00" * 4)))
    with pytest.raises(Exception, match="does not fit"):
        spark.range(1).select(key.alias("k")).collect()
