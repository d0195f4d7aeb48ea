"""Packet decoding as a DataFrame job (B1-B7) and layer filters.

``decode_packets`` adds header columns to any DataFrame with a BINARY frame
column. It is a chain of narrow projections made of built-in expressions:
no Python per row, no shuffle. Variable offsets (802.1Q/802.1ad tags, IPv4
options, IPv6 extension headers) are columns computed in their own
projection, so every later field refers to them instead of recomputing them
(Catalyst keeps a non-trivial expression that is referenced several times in
its own Project rather than inlining it).

Layer rules (our spec):

* Ethernet needs 14 bytes; shorter frames are undecodable (all layers NULL).
* Up to two VLAN tags (0x8100, 0x88a8, 0x9100) are skipped; a third tag, or
  any EtherType other than IPv4/IPv6 (e.g. an 802.3 length), leaves no
  network layer.
* IPv4: EtherType 0x0800, version 4, IHL >= 5 and the whole header present.
  A fragment (MF set or offset != 0) has no TCP/UDP layer.
* IPv6: EtherType 0x86dd, version 6, 40 bytes present; up to three
  extension headers (hop-by-hop 0, routing 43, destination options 60,
  authentication 51, fragment 44) are walked; a non-atomic fragment has no
  TCP/UDP layer.
* ``depth_exceeded`` marks frames with a third VLAN tag or a fourth extension
  header, whose inner layers are not read.
* The transport header must fit inside the IP payload (IPv4 total length /
  IPv6 payload length when non-zero, else the captured bytes).
* TCP: protocol 6, data offset >= 5, full header incl. options.
  UDP: protocol 17, 8 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.bytesx import signed, u8, u16, u32

# Fixed protocol numbers (IEEE / IANA).
VLAN_ETHERTYPES = (0x8100, 0x88A8, 0x9100)
ETHERTYPE_IPV4 = 0x0800
ETHERTYPE_IPV6 = 0x86DD
IPPROTO_TCP = 6
IPPROTO_UDP = 17
IPV6_EXT_HEADERS = (0, 43, 60)
IPV6_FRAGMENT = 44
IPV6_AUTH = 51
MAX_IPV6_EXT = 3

_TMP = "_d_"
PAD_BYTES = 64   # zero tail so fixed-size reads never come back short


def _rd(off: str, n: int, p: str = "_d_p") -> str:
    """SQL: unsigned big-endian read of ``n`` bytes at 0-based ``off`` from
    the zero-padded frame. It references ``off`` once, so expressions stay
    linear in size however Catalyst inlines them (a guarded read would double
    the tree at every level)."""
    return f"CAST(conv(hex(substr({p}, ({off}) + 1, {n})), 16, 10) AS {'BIGINT' if n > 2 else 'INT'})"


def _in(col: str, values) -> str:
    return f"{col} IN ({', '.join(str(v) for v in values)})"


def decode_packets(df: DataFrame, raw: str = "raw", mark_depth: bool = False) -> DataFrame:
    """Frame column -> ``eth``, ``ipv4``, ``ipv6``, ``tcp``, ``udp`` structs
    (NULL when the layer is absent) plus ``decodable``, ``has_ipv4``,
    ``has_ipv6``, ``has_tcp``, ``has_udp``, ``fragment`` flags. With
    ``mark_depth`` also ``depth_exceeded``: frames with more VLAN tags or IPv6
    headers than are walked. It is computed only where asked for: together with
    the header walk it takes the stage past what the JVM compiles well.

    Reads go to the frame padded with ``PAD_BYTES`` zeros; every layer is
    accepted only after an explicit length check against the real length, so
    padding never leaks into a field. Each stage is one ``selectExpr`` (SQL
    text): one call into the JVM per stage instead of one per expression
    node.
    """
    b = f"`{raw}`"
    pad = "00" * PAD_BYTES
    d = df.selectExpr("*", f"octet_length({b}) AS _d_n", f"concat({b}, unhex('{pad}')) AS _d_p")
    # 1. skip up to two VLAN tags -> EtherType and network-layer offset.
    d = d.selectExpr("*", f"{_rd('12', 2)} AS _d_e12", f"{_rd('16', 2)} AS _d_e16", f"{_rd('20', 2)} AS _d_e20")
    vl = VLAN_ETHERTYPES
    d = d.selectExpr("*", f"""CASE WHEN _d_n < 14 THEN NULL
        WHEN NOT {_in('_d_e12', vl)} THEN 0
        WHEN NOT {_in('_d_e16', vl)} AND _d_n >= 18 THEN 1
        WHEN NOT {_in('_d_e20', vl)} AND _d_n >= 22 THEN 2 END AS _d_tags""")
    d = d.selectExpr("*", "element_at(array(_d_e12, _d_e16, _d_e20), _d_tags + 1) AS _d_etype",
                     "14 + _d_tags * 4 AS _d_l3")
    # 2. network layer: version/IHL byte and the fields later steps need.
    d = d.selectExpr("*", f"{_rd('_d_l3', 1)} AS _d_b0")
    d = d.selectExpr(
        "*",
        f"coalesce(_d_etype = {ETHERTYPE_IPV4} AND shiftright(_d_b0, 4) = 4 AND (_d_b0 & 15) >= 5 "
        f"AND _d_n >= _d_l3 + (_d_b0 & 15) * 4, false) AS _d_v4",
        f"coalesce(_d_etype = {ETHERTYPE_IPV6} AND shiftright(_d_b0, 4) = 6 AND _d_n >= _d_l3 + 40, false) AS _d_v6",
        "(_d_b0 & 15) * 4 AS _d_hl",
        f"{_rd('_d_l3 + 2', 2)} AS _d_tot",
        f"{_rd('_d_l3 + 6', 2)} AS _d_ff",
        f"{_rd('_d_l3 + 9', 1)} AS _d_proto",
        f"{_rd('_d_l3 + 4', 2)} AS _d_plen6",
        f"{_rd('_d_l3 + 6', 1)} AS _d_nh0",
        "_d_l3 + 40 AS _d_off0",
        "false AS _d_frag0",
    )
    # 3. IPv6 extension-header walk, one projection per step.
    for i in range(MAX_IPV6_EXT):
        nh, off, fr = f"_d_nh{i}", f"_d_off{i}", f"_d_frag{i}"
        is_ext, is_frag, is_auth = _in(nh, IPV6_EXT_HEADERS), f"{nh} = {IPV6_FRAGMENT}", f"{nh} = {IPV6_AUTH}"
        d = d.selectExpr(
            "*",
            f"CASE WHEN {is_ext} OR {is_frag} OR {is_auth} THEN {_rd(off, 1)} ELSE {nh} END AS _d_nh{i + 1}",
            f"{off} + CASE WHEN {is_ext} THEN ({_rd(off + ' + 1', 1)} + 1) * 8 WHEN {is_frag} THEN 8 "
            f"WHEN {is_auth} THEN ({_rd(off + ' + 1', 1)} + 2) * 4 ELSE 0 END AS _d_off{i + 1}",
            f"{fr} OR ({is_frag} AND ({_rd(off + ' + 2', 2)} & {0xFFF9}) != 0) AS _d_frag{i + 1}",
        )
    last = MAX_IPV6_EXT
    nh_l, off_l = f"_d_nh{last}", f"_d_off{last}"
    walked = IPV6_EXT_HEADERS + (IPV6_FRAGMENT, IPV6_AUTH)
    # 4. transport-layer protocol, offset and end bound.
    d = d.selectExpr(
        "*",
        f"CASE WHEN _d_v4 THEN _d_proto WHEN _d_v6 AND NOT {_in(nh_l, walked)} "
        f"AND {off_l} <= _d_n THEN {nh_l} END AS _d_l4p",
        f"CASE WHEN _d_v4 THEN _d_l3 + _d_hl WHEN _d_v6 THEN {off_l} END AS _d_l4",
        "CASE WHEN _d_v4 THEN least(_d_n, CASE WHEN _d_tot >= _d_hl THEN _d_l3 + _d_tot ELSE _d_n END) "
        "WHEN _d_v6 THEN least(_d_n, CASE WHEN _d_plen6 > 0 THEN _d_l3 + 40 + _d_plen6 ELSE _d_n END) "
        "END AS _d_l4end",
        f"CASE WHEN _d_v4 THEN (_d_ff & {0x3FFF}) != 0 WHEN _d_v6 THEN _d_frag{last} ELSE true END AS _d_frag",
    )
    d = d.selectExpr("*", f"{_rd('_d_l4 + 12', 1)} AS _d_tb12", f"{_rd('_d_l4 + 13', 1)} AS _d_tb13")
    depth = f""",
        'depth_exceeded', coalesce(_d_n >= 22 AND {_in('_d_e12', vl)} AND {_in('_d_e16', vl)}
                                   AND {_in('_d_e20', vl)}, false)
                          OR coalesce(_d_v6 AND NOT _d_frag AND {off_l} < _d_n AND {_in(nh_l, walked)}, false)""" if mark_depth else ""
    # The layer flags leave through a one-row generator: a predicate on them
    # (has_tcp, ...) then stays above it instead of being rewritten through
    # every offset projection down to the scan, which would duplicate the
    # whole offset chain into one Filter (too big for codegen).
    d = d.selectExpr("*", f"""inline(array(named_struct(
        'decodable', _d_n >= 14,
        'has_ipv4', _d_v4,
        'has_ipv6', _d_v6,
        'has_tcp', coalesce(NOT _d_frag AND _d_l4p = {IPPROTO_TCP} AND shiftright(_d_tb12, 4) >= 5
                            AND _d_l4end >= _d_l4 + shiftright(_d_tb12, 4) * 4, false),
        'has_udp', coalesce(NOT _d_frag AND _d_l4p = {IPPROTO_UDP} AND _d_l4end >= _d_l4 + 8, false),
        'fragment', _d_frag AND (_d_v4 OR _d_v6){depth})))""")
    # 5. layer structs; fields a job does not use are pruned by Catalyst.
    d = d.selectExpr(
        "*",
        f"""CASE WHEN has_ipv4 THEN named_struct(
            'src', {_rd('_d_l3 + 12', 4)},
            'dst', {_rd('_d_l3 + 16', 4)},
            'version', 4,
            'ihl', shiftright(_d_hl, 2),
            'tos', {_rd('_d_l3 + 1', 1)},
            'total_length', _d_tot,
            'identification', {_rd('_d_l3 + 4', 2)},
            'df', (_d_ff & {0x4000}) != 0,
            'mf', (_d_ff & {0x2000}) != 0,
            'frag_offset', _d_ff & {0x1FFF},
            'ttl', {_rd('_d_l3 + 8', 1)},
            'protocol', _d_proto,
            'options', substr({b}, _d_l3 + 21, _d_hl - 20)) END AS ipv4""",
        f"""CASE WHEN has_ipv6 THEN named_struct(
            'src', lower(hex(substr({b}, _d_l3 + 9, 16))),
            'dst', lower(hex(substr({b}, _d_l3 + 25, 16))),
            'next_header', _d_nh0,
            'hop_limit', {_rd('_d_l3 + 7', 1)},
            'payload_length', _d_plen6) END AS ipv6""",
        f"""CASE WHEN has_tcp THEN named_struct(
            'sport', {_rd('_d_l4', 2)},
            'dport', {_rd('_d_l4 + 2', 2)},
            'seq', {_rd('_d_l4 + 4', 4)},
            'reserved', shiftleft(_d_tb12 & 15, 2) | shiftright(_d_tb13, 6),
            'flags', _d_tb13,
            'header_length', shiftright(_d_tb12, 4) * 4,
            'options', substr({b}, _d_l4 + 21, shiftright(_d_tb12, 4) * 4 - 20)) END AS tcp""",
        f"""CASE WHEN has_udp THEN named_struct(
            'sport', {_rd('_d_l4', 2)},
            'dport', {_rd('_d_l4 + 2', 2)},
            'length', {_rd('_d_l4 + 4', 2)}) END AS udp""",
        f"""CASE WHEN decodable THEN named_struct(
            'dst', lower(hex(substr({b}, 1, 6))),
            'src', lower(hex(substr({b}, 7, 6))),
            'ethertype', _d_etype,
            'vlan_tags', _d_tags) END AS eth""",
    )
    return d.drop(*[c for c in d.columns if c.startswith(_TMP)])


# --- C1-C6: layer filters -------------------------------------------------

def drop_undecodable(pk: DataFrame) -> DataFrame:
    """Keep frames with an Ethernet layer."""
    return pk.filter(F.col("decodable"))


def has_tcp(pk: DataFrame) -> DataFrame:
    """C2."""
    return pk.filter(F.col("has_tcp"))


def has_ipv4_tcp(pk: DataFrame) -> DataFrame:
    """C3."""
    return pk.filter(F.col("has_ipv4") & F.col("has_tcp"))


def has_udp(pk: DataFrame) -> DataFrame:
    """C4."""
    return pk.filter(F.col("has_udp"))


def has_ipv4_udp(pk: DataFrame) -> DataFrame:
    """C5."""
    return pk.filter(F.col("has_ipv4") & F.col("has_udp"))


def with_layer(pk: DataFrame, layer: str) -> DataFrame:
    """Rows where header ``layer`` (ipv4, ipv6, tcp, udp) exists."""
    return pk.filter(F.col(layer).isNotNull())


# --- B5-B7: 5-tuples -------------------------------------------------------

def five_tuple_cols() -> list[Column]:
    """Sip, dip, proto from IPv4 (else 0); ports from TCP, else UDP, else 0.

    IP and port parts fall back separately, so IPv6/TCP has zero IPs but
    real ports. Columns are unsigned in wider types.
    """
    return [
        F.coalesce(F.col("ipv4.src"), F.lit(0).cast("bigint")).alias("sip"),
        F.coalesce(F.col("ipv4.dst"), F.lit(0).cast("bigint")).alias("dip"),
        F.coalesce(F.col("tcp.sport"), F.col("udp.sport"), F.lit(0)).alias("sport"),
        F.coalesce(F.col("tcp.dport"), F.col("udp.dport"), F.lit(0)).alias("dport"),
        F.coalesce(F.col("ipv4.protocol"), F.lit(0)).alias("proto"),
    ]


def five_tuple(pk: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded packets -> ``keep`` columns + sip, dip, sport, dport, proto."""
    return pk.select(*(keep or []), *five_tuple_cols())


def five_tuple_fixed_cols(raw: str = "raw") -> list[Column]:
    """Blind fixed offsets, no layer checks, signed values as the JVM
    reads them: saddr 26-29, daddr 30-33, sport 34-35, dport 36-37,
    proto 23. Short frames give NULL fields."""
    b = F.col(raw)
    return [
        signed(u32(b, 26), 32).cast("int").alias("saddr"),
        signed(u16(b, 34), 16).cast("short").alias("sport"),
        signed(u32(b, 30), 32).cast("int").alias("daddr"),
        signed(u16(b, 36), 16).cast("short").alias("dport"),
        signed(u8(b, 23), 8).cast("byte").alias("proto"),
    ]


def with_tuple5(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the fixed-offset tuple as a struct column beside the frame."""
    return df.withColumn("tuple5", F.struct(*five_tuple_fixed_cols(raw)))
