import os
import struct

import pytest
from pyspark.sql import functions as F

from flowlens.sources.capture import read_capture, write_capture

PKTS = [(1700000000 + i, 1000 * i, bytes([i % 256]) * (40 + 7 * i)) for i in range(10)]


def write_file(path, order="<", nanos=False, packets=PKTS, truncate=0, snap=None):
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, 1)
    for s, us, raw in packets:
        frac = us * 1000 if nanos else us
        body = raw if snap is None else raw[:snap]
        out += struct.pack(order + "IIII", s, frac, len(body), len(raw)) + body
    if truncate:
        out = out[:-truncate]
    with open(path, "wb") as f:
        f.write(out)


def rows(df):
    return sorted((r.ts_sec, r.ts_usec, r.orig_len, bytes(r.raw)) for r in df.collect())


WANT = sorted((s, us, len(raw), raw) for s, us, raw in PKTS)


@pytest.mark.parametrize("order,nanos", [("<", False), (">", False), ("<", True), (">", True)])
def test_endianness_and_resolution(spark, tmp, order, nanos):
    p = os.path.join(tmp, "a.pcap")
    write_file(p, order, nanos)
    assert rows(read_capture(spark, p, 0)) == WANT


@pytest.mark.parametrize("chunk", [0, 1, 40, 100, 47 * 3, 10_000, 1 << 20])
def test_chunked_equals_unchunked(spark, tmp, chunk):
    p = os.path.join(tmp, "a.pcap")
    write_file(p)
    df = read_capture(spark, p, chunk)
    assert rows(df) == WANT
    ords = sorted(r.ordinal for r in df.select("ordinal").collect())
    assert ords == list(range(len(PKTS)))


def test_budget_partitions(spark, tmp):
    p = os.path.join(tmp, "a.pcap")
    write_file(p, packets=[(1, 0, b"x" * 42)] * 10)
    # running total reaches 100 on the 3rd packet: chunks of 3,3,3,1
    assert read_capture(spark, p, 100).rdd.getNumPartitions() == 4
    # one packet larger than the budget: one packet per chunk
    assert read_capture(spark, p, 10).rdd.getNumPartitions() == 10
    # total exactly equal to the budget: a single chunk
    assert read_capture(spark, p, 420).rdd.getNumPartitions() == 1


def test_header_only_and_truncated(spark, tmp):
    p = os.path.join(tmp, "h.pcap")
    write_file(p, packets=[])
    assert read_capture(spark, p, 0).count() == 0
    p2 = os.path.join(tmp, "t.pcap")
    write_file(p2, truncate=5)
    for chunk in (0, 64):
        assert rows(read_capture(spark, p2, chunk)) == WANT[:-1]
    with pytest.raises(Exception):
        read_capture(spark, p2, 64, failfast=True).count()


def test_snapped_packets(spark, tmp):
    p = os.path.join(tmp, "s.pcap")
    write_file(p, snap=30)
    got = read_capture(spark, p, 0).select("orig_len", F.octet_length("raw").alias("n")).collect()
    assert all(r.n == 30 for r in got)
    assert sorted(r.orig_len for r in got) == sorted(len(raw) for _, _, raw in PKTS)


def test_write_then_read_folder(spark, tmp):
    df = spark.createDataFrame([(s, us, len(raw), raw) for s, us, raw in PKTS],
                               "ts_sec BIGINT, ts_usec INT, orig_len INT, raw BINARY").repartition(3)
    out = os.path.join(tmp, "caps")
    write_capture(df, out)
    files = sorted(f for f in os.listdir(out) if f.endswith(".pcap"))
    assert len(files) == 3 and not [f for f in os.listdir(out) if f.startswith("_temporary")]
    assert rows(read_capture(spark, out, 64)) == WANT


@pytest.mark.parametrize("chunk", [1, 100, 10_000])
def test_spark_indexed_read_equals_driver_read(spark, tmp, chunk):
    for i in range(3):
        write_file(os.path.join(tmp, f"f{i}.pcap"), "<" if i % 2 else ">", nanos=(i == 2))
    a = read_capture(spark, tmp, chunk, index="spark")
    b = read_capture(spark, tmp, chunk, index="driver")
    key = lambda r: (r.capture, r.ordinal)
    ra = sorted(((r.capture, r.ordinal, r.ts_sec, r.ts_usec, r.orig_len, bytes(r.raw)) for r in a.collect()))
    rb = sorted(((r.capture, r.ordinal, r.ts_sec, r.ts_usec, r.orig_len, bytes(r.raw)) for r in b.collect()))
    assert ra == rb and len(ra) == 3 * len(PKTS)


def _random_packets(seed, n=300):
    import random
    rnd = random.Random(seed)
    return [(1700000000 + i, rnd.randrange(1_000_000), bytes(rnd.randrange(256) for _ in range(rnd.randrange(0, 200))))
            for i in range(n)]


def _rows_with_ordinals(df):
    return sorted((r.capture, r.ordinal, r.ts_sec, r.ts_usec, r.orig_len, bytes(r.raw)) for r in df.collect())


@pytest.mark.parametrize("split_bytes,chunk", [(1000, 1), (1000, 500), (3000, 100_000), (777, 64)])
def test_large_files_indexed_in_parallel_splits(spark, tmp, split_bytes, chunk):
    from flowlens.sources.capture import read_capture_indexed
    for i in range(2):
        write_file(os.path.join(tmp, f"f{i}.pcap"), "<" if i else ">", packets=_random_packets(i))
    a = read_capture_indexed(spark, tmp, chunk, split_bytes=split_bytes)
    b = read_capture(spark, tmp, 0, index="driver")
    ra, rb = _rows_with_ordinals(a), _rows_with_ordinals(b)
    assert len(ra) == 600 and ra == rb


def test_wrong_split_boundary_is_corrected(spark, tmp):
    """A split that synchronised on a wrong boundary is re-walked from the
    previous split's exit, so the result stays exact."""
    from flowlens.sources.capture import read_capture_indexed
    p = os.path.join(tmp, "f.pcap")
    write_file(p, packets=_random_packets(7))
    bad = {(p, 1): 24 + 1000 + 3, (p, 3): 24 + 3000 + 1}
    a = read_capture_indexed(spark, tmp, 200, split_bytes=1000, _forced=bad)
    b = read_capture(spark, tmp, 0, index="driver")
    assert _rows_with_ordinals(a) == _rows_with_ordinals(b)


def test_file_uri_paths(spark, tmp):
    p = os.path.join(tmp, "u.pcap")
    write_file(p)
    for uri in (f"file:{p}", f"file://{p}"):
        assert rows(read_capture(spark, uri, 100)) == WANT


def test_append_keeps_earlier_files(spark, tmp):
    df = read_rows(spark, PKTS[:4])
    write_capture(df, tmp + "/cap", "overwrite")
    write_capture(read_rows(spark, PKTS[4:]), tmp + "/cap", "append")
    assert rows(read_capture(spark, tmp + "/cap", 0)) == WANT
    write_capture(df, tmp + "/cap", "overwrite")
    assert len(rows(read_capture(spark, tmp + "/cap", 0))) == 4


def read_rows(spark, packets):
    return spark.createDataFrame([(s, us, len(raw), raw) for s, us, raw in packets],
                                 "ts_sec long, ts_usec long, orig_len long, raw binary") \
        .selectExpr("ts_sec", "ts_usec", "cast(orig_len as int) orig_len", "raw").coalesce(1)


def test_failfast_accepts_a_valid_file_read_in_splits(spark, tmp):
    """Payloads full of zeros and of look-alike headers: a split may sync on
    them, but only the proven chain is judged."""
    from flowlens.sources.capture import read_capture_indexed
    decoy = struct.pack("<IIII", 1700000000, 0, 60, 60) + b"\0" * 44
    packets = [(1700000000 + i, i, (decoy if i % 2 else b"\0" * 60) * 5) for i in range(300)]
    p = os.path.join(tmp, "a.pcap")
    write_file(p, packets=packets)
    got = rows(read_capture_indexed(spark, p, 4096, failfast=True, split_bytes=20_000))
    assert got == sorted((s, us, len(raw), raw) for s, us, raw in packets)
    write_file(p, packets=packets, truncate=7)
    with pytest.raises(Exception, match="truncated"):
        read_capture_indexed(spark, p, 4096, failfast=True, split_bytes=20_000).count()


def damaged_file(path, at=100, n=1000, link=1):
    """``n`` records, the length field of one overwritten; -> (packets, byte span of the damage)."""
    packets = [(1700000000 + i, i, struct.pack("<I", i * 2654435761 % (1 << 32)) * (12 + i % 17)) for i in range(n)]
    write_file(path, packets=packets)
    start = 24 + sum(16 + len(p[2]) for p in packets[:at])
    data = bytearray(open(path, "rb").read())
    data[start + 8:start + 12] = b"\xff\xff\xff\x7f"
    data[20:24] = struct.pack("<I", link)
    with open(path, "wb") as f:
        f.write(data)
    return packets, (start, start + 16 + len(packets[at][2]))


@pytest.mark.parametrize("how", ["whole", "driver", "spark", "splits"])
def test_reading_goes_on_after_damage(spark, tmp, how):
    from flowlens.sources.capture import capture_gaps, read_capture_indexed
    p = os.path.join(tmp, "a.pcap")
    packets, gap = damaged_file(p)
    df = {"whole": lambda: read_capture(spark, p, 0), "driver": lambda: read_capture(spark, p, 4096),
          "spark": lambda: read_capture(spark, p, 4096, index="spark"),
          "splits": lambda: read_capture_indexed(spark, p, 4096, split_bytes=7000)}[how]()
    got = rows(df)
    assert got == sorted((s, us, len(raw), raw) for i, (s, us, raw) in enumerate(packets) if i != 100)
    assert sorted(r.ordinal for r in df.select("ordinal").collect()) == list(range(999))
    for split_bytes in (1 << 30, 7000):
        assert [tuple(r)[1:3] for r in capture_gaps(spark, p, split_bytes).collect()] == [gap]


def test_gap_table_of_sound_and_cut_files(spark, tmp):
    from flowlens.sources.capture import capture_gaps
    write_file(os.path.join(tmp, "a.pcap"))
    write_file(os.path.join(tmp, "b.pcap"), truncate=3)
    got = capture_gaps(spark, tmp).collect()
    size = os.path.getsize(os.path.join(tmp, "b.pcap"))
    assert [(os.path.basename(r.capture), r.start, r.end, r.reason) for r in got] == \
        [("b.pcap", size - 16 - len(PKTS[-1][2]) + 3, size, "truncated record")]


@pytest.mark.parametrize("index", ["driver", "spark"])
def test_other_link_types_are_refused(spark, tmp, index):
    p = os.path.join(tmp, "a.pcap")
    packets, _ = damaged_file(p, link=113)
    with pytest.raises(Exception, match="link type 113"):
        read_capture(spark, p, 4096, index=index).count()
    assert read_capture(spark, p, 4096, index=index, any_link=True).count() == len(packets) - 1
