"""Property tests (hypothesis): capture chunking, decoder fields, sessions."""

import os
import struct
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators.decode import decode_packets
from flowlens.sources.capture import plan_chunks, read_chunk
from frames_util import eth, ipv4, ipv6, tcp, udp

packets = st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 999_999), st.binary(min_size=0, max_size=300)),
                   min_size=0, max_size=40)


@settings(max_examples=60, deadline=None)
@given(packets, st.integers(1, 2000), st.sampled_from(["<", ">"]))
def test_chunks_cover_every_record_once(pk, budget, order):
    with tempfile.TemporaryDirectory() as d:
        p = os.path.join(d, "x.pcap")
        out = struct.pack(order + "IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
        for s, us, raw in pk:
            out += struct.pack(order + "IIII", s, us, len(raw), len(raw)) + raw
        with open(p, "wb") as f:
            f.write(out)
        chunks = plan_chunks(p, len(out), budget)
        got = []
        for c in chunks:
            rows = []
            for b in read_chunk(c):
                d_ = b.to_pydict()
                rows += list(zip(d_["ordinal"], d_["ts_sec"], d_["ts_usec"], d_["raw"]))
            assert len(rows) == c.count
            sizes = [len(r[3]) for r in rows]
            if c is not chunks[-1]:
                assert sum(sizes) >= budget and sum(sizes[:-1]) < budget
            got += rows
        assert [g[0] for g in got] == list(range(len(pk)))
        assert [(g[1], g[2], g[3]) for g in got] == [(s, us, raw) for s, us, raw in pk]


frame_spec = st.fixed_dictionaries({
    "l3": st.sampled_from(["v4tcp", "v4udp", "v6tcp", "v6udp", "v4frag"]),
    "tags": st.integers(0, 2),
    "src": st.integers(0, 2**32 - 1), "dst": st.integers(0, 2**32 - 1),
    "sport": st.integers(0, 65535), "dport": st.integers(0, 65535),
    "ttl": st.integers(0, 255), "ident": st.integers(0, 65535),
    "ihl": st.integers(5, 8), "doff": st.integers(5, 10),
    "payload": st.binary(max_size=40),
})


def build(sp):
    opts4 = bytes(4 * (sp["ihl"] - 5))
    t = tcp(sport=sp["sport"], dport=sp["dport"], doff=sp["doff"], opts=bytes(4 * (sp["doff"] - 5)),
            payload=sp["payload"])
    u = udp(sport=sp["sport"], dport=sp["dport"], payload=sp["payload"])
    if sp["l3"] == "v4tcp":
        l3, et = ipv4(6, t, src=sp["src"], dst=sp["dst"], ihl=sp["ihl"], opts=opts4, ttl=sp["ttl"],
                      ident=sp["ident"]), 0x0800
    elif sp["l3"] == "v4udp":
        l3, et = ipv4(17, u, src=sp["src"], dst=sp["dst"], ihl=sp["ihl"], opts=opts4, ttl=sp["ttl"],
                      ident=sp["ident"], flags_frag=0), 0x0800
    elif sp["l3"] == "v4frag":
        l3, et = ipv4(17, u, src=sp["src"], dst=sp["dst"], ihl=sp["ihl"], opts=opts4, ttl=sp["ttl"],
                      ident=sp["ident"], flags_frag=0x2000), 0x0800
    elif sp["l3"] == "v6tcp":
        l3, et = ipv6(6, t), 0x86DD
    else:
        l3, et = ipv6(17, u), 0x86DD
    tags = [(0x88A8, 1), (0x8100, 2)][2 - sp["tags"]:] if sp["tags"] else []
    return eth(et, l3, tags=tags)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture,
                                                                 HealthCheck.data_too_large])
@given(st.lists(frame_spec, min_size=50, max_size=120))
def test_decoder_fields_match_generator(spark, specs):
    rows = [(i, build(sp)) for i, sp in enumerate(specs)]
    df = decode_packets(spark.createDataFrame(rows, "id BIGINT, raw BINARY"))
    got = {r.id: r for r in df.collect()}
    for i, sp in enumerate(specs):
        r = got[i]
        v4 = sp["l3"].startswith("v4")
        assert r.has_ipv4 == v4 and r.has_ipv6 == (not v4)
        assert r.eth.vlan_tags == sp["tags"]
        if v4:
            assert (r.ipv4.src, r.ipv4.dst, r.ipv4.ttl, r.ipv4.identification, r.ipv4.ihl) == \
                (sp["src"], sp["dst"], sp["ttl"], sp["ident"], sp["ihl"])
        is_tcp = sp["l3"] in ("v4tcp", "v6tcp")
        is_udp = sp["l3"] in ("v4udp", "v6udp")
        assert (r.has_tcp, r.has_udp) == (is_tcp, is_udp)
        layer = r.tcp if is_tcp else r.udp if is_udp else None
        if layer is not None:
            assert (layer.sport, layer.dport) == (sp["sport"], sp["dport"])
        if is_tcp:
            assert r.tcp.header_length == 4 * sp["doff"]


def test_session_counts_sum_to_packets(spark):
    from flowlens.plans import jobs
    from conftest import SF_SMALL
    s = jobs.session_counts(spark, SF_SMALL).agg(F.sum("c")).collect()[0][0]
    assert s == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    for dense in (1, 7, 3600):
        s = jobs.session_counts(spark, SF_SMALL, dense).agg(F.sum("c")).collect()[0][0]
        assert s == 1000


def test_session_table_roundtrip(spark, tmp):
    import os
    from flowlens.operators.stats import write_sessions
    from flowlens.plans import jobs
    from conftest import SF_SMALL
    s = jobs.session_counts(spark, SF_SMALL)
    write_sessions(s, tmp + "/sessions")
    back = spark.read.parquet(tmp + "/sessions").select(*s.columns)
    assert sorted(back.collect()) == sorted(s.collect())
    buckets = [d for d in os.listdir(tmp + "/sessions") if d.startswith("bucket=")]
    files = sum(len([f for f in os.listdir(os.path.join(tmp, "sessions", b)) if f.endswith(".parquet")])
                for b in buckets)
    assert files <= len(buckets) + 8      # contiguous bucket runs per task
