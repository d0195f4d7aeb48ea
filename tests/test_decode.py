import pytest
from pyspark.sql import functions as F

from flowlens.operators.decode import decode_packets, five_tuple, five_tuple_fixed_cols
from frames_util import eth, ipv4, ipv6, tcp, udp

GOLDEN = ("01|00|5e|7f|ff|fa|74|29|af|35|61|93|08|00|45|00|00|9d|30|42|00|00|04|11|5a|67|c0|a8|7b|04|ef|ff|"
          "ff|fa|de|df|07|6c|00|89|a1|1a|4d|2d|53|45|41|52|43|48|20|2a|20|48|54|54|50|2f|31|2e|31|0d|0a|48|4f|"
          "53|54|3a|20|32|33|39|2e|32|35|35|2e|32|35|35|2e|32|35|30|3a|31|39|30|30|0d|0a|4d|41|4e|3a|20|22|73|"
          "73|64|70|3a|64|69|73|63|6f|76|65|72|22|0d|0a|4d|58|3a|20|35|0d|0a|53|54|3a|20|75|72|6e|3a|73|63|68|"
          "65|6d|61|73|2d|75|70|6e|70|2d|6f|72|67|3a|64|65|76|69|63|65|3a|4d|65|64|69|61|52|65|6e|64|65|72|65|"
          "72|3a|31|0d|0a|0d|0a")


def decode_one(spark, raw: bytes):
    df = spark.createDataFrame([(1, raw)], "id BIGINT, raw BINARY")
    return decode_packets(df).collect()[0]


def test_golden_packet(spark):
    raw = bytes.fromhex(GOLDEN.replace("|", ""))
    assert len(raw) == 171
    r = decode_one(spark, raw)
    assert r.decodable and r.has_ipv4 and r.has_udp and not r.has_tcp
    assert r.eth.ethertype == 2048
    v4 = r.ipv4
    assert (v4.ihl, v4.total_length, v4.identification, v4.df, v4.mf, v4.ttl, v4.protocol) == \
        (5, 157, 12354, False, False, 4, 17)
    assert (v4.src, v4.dst) == (3232267012, 4026531834)
    assert (r.udp.sport, r.udp.dport, r.udp.length) == (57055, 1900, 137)


def test_golden_fixed_offsets_signed(spark):
    raw = bytes.fromhex(GOLDEN.replace("|", ""))
    df = spark.createDataFrame([(raw,)], "raw BINARY")
    r = df.select(*five_tuple_fixed_cols()).collect()[0]
    assert (r.saddr, r.sport, r.proto) == (-1062700284, -8481, 17)


CASES = {
    # name: (frame, has_ipv4, has_ipv6, has_tcp, has_udp)
    "ipv4_tcp_opts": (eth(0x0800, ipv4(6, tcp(doff=8, opts=bytes.fromhex("020405b401010402"
                                                                             "01030307")))), 1, 0, 1, 0),
    "ipv4_ihl6_udp": (eth(0x0800, ipv4(17, udp(), ihl=6, opts=bytes.fromhex("94040000"))), 1, 0, 0, 1),
    "vlan1_tcp": (eth(0x0800, ipv4(6, tcp()), tags=[(0x8100, 5)]), 1, 0, 1, 0),
    "vlan2_udp": (eth(0x0800, ipv4(17, udp()), tags=[(0x88A8, 5), (0x8100, 7)]), 1, 0, 0, 1),
    "vlan3_udp": (eth(0x0800, ipv4(17, udp()), tags=[(0x88A8, 5), (0x8100, 7), (0x8100, 9)]), 0, 0, 0, 0),
    "ipv6_tcp": (eth(0x86DD, ipv6(6, tcp())), 0, 1, 1, 0),
    "ipv6_hbh_udp": (eth(0x86DD, ipv6(0, bytes.fromhex("1100010400000000") + udp())), 0, 1, 0, 1),
    "ipv6_frag_udp": (eth(0x86DD, ipv6(44, bytes.fromhex("1100000100000001") + udp())), 0, 1, 0, 0),
    "ipv6_atomic_frag_udp": (eth(0x86DD, ipv6(44, bytes.fromhex("1100000000000001") + udp())), 0, 1, 0, 1),
    "arp": (eth(0x0806, bytes(28)), 0, 0, 0, 0),
    "icmp": (eth(0x0800, ipv4(1, bytes.fromhex("0800000000010001"))), 1, 0, 0, 0),
    "first_fragment": (eth(0x0800, ipv4(17, udp(), flags_frag=0x2000)), 1, 0, 0, 0),
    "later_fragment": (eth(0x0800, ipv4(17, udp(), flags_frag=185)), 1, 0, 0, 0),
    "ten_bytes": (bytes(10), 0, 0, 0, 0),
    "ipv4_cut_short": (eth(0x0800, ipv4(6, tcp()))[:30], 0, 0, 0, 0),
    "tcp_cut_short": (eth(0x0800, ipv4(6, tcp(payload=b""), total=40))[:14 + 20 + 12], 1, 0, 0, 0),
    "tcp_opts_cut_short": (eth(0x0800, ipv4(6, tcp(doff=8, opts=b"", payload=b"")))[:14 + 20 + 24], 1, 0, 0, 0),
    "ieee_802_3_length": (eth(0x0100, bytes(46)), 0, 0, 0, 0),
    "empty": (b"", 0, 0, 0, 0),
    "total_length_zero": (eth(0x0800, ipv4(6, tcp(), total=0)), 1, 0, 1, 0),
    "ipv4_bad_version": (eth(0x0800, b"\x65" + ipv4(6, tcp())[1:]), 0, 0, 0, 0),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_edge_frames(spark, name):
    raw, v4, v6, t, u = CASES[name]
    r = decode_one(spark, raw)
    assert (r.has_ipv4, r.has_ipv6, r.has_tcp, r.has_udp) == (bool(v4), bool(v6), bool(t), bool(u)), name
    assert (r.ipv4 is not None) == bool(v4)
    assert (r.tcp is not None) == bool(t)
    assert (r.udp is not None) == bool(u)
    assert r.decodable == (len(raw) >= 14)


HOP, AUTH = "{:02x}00010400000000", "{:02x}04000000000001000000010102030405060708090a0b0c"


def ext(*types: int, last: int) -> bytes:
    """IPv6 extension headers of the given types in a row, before ``last``."""
    return b"".join(bytes.fromhex((AUTH if t == 51 else HOP).format(nxt))
                    for t, nxt in zip(types, (*types[1:], last)))


def test_deep_frames_are_marked(spark):
    """Frames beyond the walk's depth say so; an authentication header is walked."""
    from flowlens.operators.stats import count_unread
    tags = [(0x88A8, 5), (0x8100, 7), (0x8100, 9)]
    deep = {"vlan3": eth(0x0800, ipv4(17, udp()), tags=tags),
            "ext4": eth(0x86DD, ipv6(0, ext(0, 60, 43, 60, last=17) + udp()))}
    flat = {"vlan2": eth(0x0800, ipv4(17, udp()), tags=tags[:2]),
            "auth": eth(0x86DD, ipv6(51, ext(51, last=17) + udp())),
            "ext3": eth(0x86DD, ipv6(0, ext(0, 51, 60, last=17) + udp()))}
    other = {"short": bytes(10), "fragment": CASES["ipv6_frag_udp"][0],
             "cut": eth(0x86DD, ipv6(0, ext(0, 60, 43, 60, last=17)))[:14 + 40 + 8 + 3]}
    rows = [(n, f) for part in (deep, flat, other) for n, f in part.items()]
    pk = decode_packets(spark.createDataFrame(rows, "name STRING, raw BINARY"), mark_depth=True)
    got = {r.name: (r.depth_exceeded, r.has_udp) for r in pk.collect()}
    assert got == {n: (n in deep, n in flat) for n, _ in rows}
    assert tuple(count_unread(pk).first()) == (8, 1, 2)


def test_field_values(spark):
    r = decode_one(spark, eth(0x0800, ipv4(6, tcp(sport=65000, dport=443, doff=8, b12_low=1, flags=0x02,
                                                   opts=bytes.fromhex("020405b401010402" "01030307")),
                                           src=0xC0A80001, dst=0xFFFFFFFE, ident=0xBEEF, ttl=200, tos=0x10),
                                 tags=[(0x8100, 1)]))
    assert r.eth.vlan_tags == 1 and r.ipv4.src == 0xC0A80001 and r.ipv4.dst == 0xFFFFFFFE
    assert (r.ipv4.identification, r.ipv4.ttl, r.ipv4.tos, r.ipv4.df) == (0xBEEF, 200, 0x10, True)
    assert (r.tcp.sport, r.tcp.dport, r.tcp.flags, r.tcp.reserved) == (65000, 443, 2, 4)
    assert r.tcp.options.hex() == "020405b40101040201030307"
    r = decode_one(spark, eth(0x0800, ipv4(17, udp(), ihl=6, opts=bytes.fromhex("94040000"))))
    assert r.ipv4.options.hex() == "94040000" and r.udp.dport == 53


def test_five_tuple_fallbacks(spark):
    rows = [(1, eth(0x86DD, ipv6(6, tcp(sport=1, dport=2)))),
            (2, eth(0x0800, ipv4(17, udp(sport=3, dport=4), src=5, dst=6))),
            (3, eth(0x0806, bytes(28))),
            (4, bytes(5))]
    df = spark.createDataFrame(rows, "id BIGINT, raw BINARY")
    got = {r.id: tuple(r)[1:] for r in five_tuple(decode_packets(df), ["id"]).collect()}
    assert got == {1: (0, 0, 1, 2, 0), 2: (5, 6, 3, 4, 17), 3: (0, 0, 0, 0, 0), 4: (0, 0, 0, 0, 0)}


def test_filter_on_flags_stays_small(spark):
    """A filter on decoded flags must not be rewritten into the offset chain
    (it would blow up the plan); it has to sit above the flag generator."""
    from flowlens.sources.frames import event_frames
    pk = decode_packets(event_frames(spark, "/root/testdata/sf0.001")).filter(F.col("has_tcp"))
    plan = pk._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000
    assert pk.count() == 550


def test_layer_filters_and_feature_tables(spark):
    """C1-C6, B2-B4, B7 on the event frames (sf0.001: 1000 frames; the layout
    gives 550 TCP (500 over IPv4), 350 UDP (300 over IPv4), 850 IPv4)."""
    from flowlens.functions.bytesx import ipv4_text
    from flowlens.operators import decode as D
    from flowlens.operators.features import ipv4_features, tcp_features, udp_features
    from flowlens.sources.frames import event_frames
    pk = D.decode_packets(event_frames(spark, "/root/testdata/sf0.001"))
    counts = {
        "decodable": D.drop_undecodable(pk).count(),
        "tcp": D.has_tcp(pk).count(), "ipv4_tcp": D.has_ipv4_tcp(pk).count(),
        "udp": D.has_udp(pk).count(), "ipv4_udp": D.has_ipv4_udp(pk).count(),
        "ipv4": D.with_layer(pk, "ipv4").count(), "ipv6": D.with_layer(pk, "ipv6").count(),
    }
    assert counts == {"decodable": 975, "tcp": 550, "ipv4_tcp": 500, "udp": 350, "ipv4_udp": 300,
                      "ipv4": 850, "ipv6": 100}
    assert ipv4_features(pk, ["pkt_id"]).count() == 850
    assert tcp_features(pk, ["pkt_id"]).count() == 550
    assert udp_features(pk, ["pkt_id"]).count() == 350
    r = ipv4_features(pk, ["pkt_id"]).filter("pkt_id = 1").select(ipv4_text(F.col("dst")).alias("d")).collect()
    assert r[0].d == "192.168.1.1"
    t5 = D.with_tuple5(event_frames(spark, "/root/testdata/sf0.001")).filter("pkt_id = 0").collect()[0].tuple5
    assert (t5.proto, t5.dport) == (6, 0)
