"""Ethernet frames derived from the driver's tables.

The reference reads packets from capture files and a broker; the test tables
hold none, so every packet job here starts from frames that Spark builds from
table rows with SQL expressions (hex text -> ``unhex``). The layout is a pure
function of the row, so the expected decode of every frame can be written as
plain SQL over the source table (see ``flowlens.plans.oracle``), independent
of our decoder.

Frame kinds, by ``pkt_id``:

* ``k = pkt_id % 10``: 0-4 IPv4/TCP, 5-7 IPv4/UDP, 8 IPv6, 9 rare kinds.
* ``v = pkt_id % 20`` picks variants: 2 IPv4 options (IHL 6), 3 TCP options
  (data offset 8), 4 one 802.1Q tag, 7 two tags (802.1ad + 802.1Q),
  8 IPv6/TCP, 18 IPv6 + hop-by-hop header + UDP.
* ``r = (pkt_id div 10) % 4`` for kind 9: 0 ARP, 1 IPv4/ICMP, 2 a 10-byte
  frame snapped from 60 bytes, 3 IPv4/UDP fragment (``(pkt_id div 40) % 2``:
  0 first fragment with MF set, 1 later fragment at offset 185).

Fields: sip 10.0.(host>>8).(host&255), dip 192.168.(pkt_id%4).1,
sport 1024 + pkt_id % 60000, TTL 32 + pkt_id % 200, identification
pkt_id % 65536, ToS (pkt_id % 8) * 4; TCP seq = pkt_id, flags SYN when
pkt_id % 7 = 0 else PSH|ACK, one reserved bit when pkt_id % 50 = 0; the
payload is the row's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.timex import epoch_micros

# Fixed values of the synthetic layout (part of the test contract).
ETH_DST = "020000000002"
ETH_SRC = "020000000001"
TCP_OPTIONS = "020405b40101040201030307"   # MSS 1460, NOP, NOP, SACK-ok, NOP, wscale 7
IPV4_OPTIONS = "94040000"                  # router alert
IPV6_HOP_BY_HOP = "1100010400000000"       # next=UDP, len 0, PadN(4)
TRUNCATED_FRAME = "02000000000202000000"   # first 10 bytes of an Ethernet header
# Destination port per event type, for frames made from `events`.
EVENT_PORTS = {"view": 80, "click": 443, "purchase": 8443, "signup": 53, "error": 0}


def _h(expr: str, n: int) -> str:
    mask = (1 << (8 * n)) - 1
    return f"lpad(hex(({expr}) & {mask}), {2 * n}, '0')"


def _frame_hex_sql() -> str:
    """SQL expression: the frame as lower/upper-case hex text.

    Expects columns pkt_id, host, dport, payload (STRING, may be NULL).
    """
    k, v = "(pkt_id % 10)", "(pkt_id % 20)"
    r, fr = "((pkt_id div 10) % 4)", "((pkt_id div 40) % 2)"
    sip = "(167772160 + ((host >> 8) & 255) * 256 + (host & 255))"
    dip = "(3232235521 + (pkt_id % 4) * 256)"
    sport = "(1024 + pkt_id % 60000)"
    ttl, ident, tos = "(32 + pkt_id % 200)", "(pkt_id % 65536)", "((pkt_id % 8) * 4)"
    pay = "coalesce(hex(payload), '')"
    plen = "coalesce(octet_length(payload), 0)"

    doff = f"(CASE WHEN {v} = 3 THEN 8 ELSE 5 END)"
    topts = f"(CASE WHEN {v} = 3 THEN '{TCP_OPTIONS}' ELSE '' END)"
    b12 = f"({doff} * 16 + CASE WHEN pkt_id % 50 = 0 THEN 1 ELSE 0 END)"
    flags = "(CASE WHEN pkt_id % 7 = 0 THEN 2 ELSE 24 END)"
    tcp = (f"concat({_h(sport, 2)}, {_h('dport', 2)}, {_h('pkt_id', 4)}, '00000000', "
           f"{_h(b12, 1)}, {_h(flags, 1)}, 'ffff', '0000', '0000', {topts}, {pay})")
    tcp_len = f"({doff} * 4 + {plen})"
    udp = f"concat({_h(sport, 2)}, {_h('dport', 2)}, {_h('8 + ' + plen, 2)}, '0000', {pay})"
    udp_len = f"(8 + {plen})"
    icmp = f"concat('0800', '0000', {_h(ident, 2)}, '0001', {pay})"

    ihl = f"(CASE WHEN {v} = 2 THEN 6 ELSE 5 END)"
    iopts = f"(CASE WHEN {v} = 2 THEN '{IPV4_OPTIONS}' ELSE '' END)"

    def ipv4(proto: int, l4: str, l4len: str, ff: str) -> str:
        return (f"concat({_h('64 + ' + ihl, 1)}, {_h(tos, 1)}, {_h(ihl + ' * 4 + ' + l4len, 2)}, "
                f"{_h(ident, 2)}, {_h(ff, 2)}, {_h(ttl, 1)}, {_h(str(proto), 1)}, '0000', "
                f"{_h(sip, 4)}, {_h(dip, 4)}, {iopts}, {l4})")

    src6 = f"concat('fd00', '00000000000000000000', {_h('host', 4)})"
    dst6 = f"concat('fd00', '000000000000000000000000', {_h('pkt_id % 4 + 1', 2)})"

    def ipv6(nh: int, l4: str, l4len: str) -> str:
        return f"concat('60000000', {_h(l4len, 2)}, {_h(str(nh), 1)}, {_h(ttl, 1)}, {src6}, {dst6}, {l4})"

    arp = f"concat('0001', '0800', '06', '04', '0001', '{ETH_SRC}', {_h(sip, 4)}, '000000000000', {_h(dip, 4)})"
    eth = f"'{ETH_DST}{ETH_SRC}'"
    vlan1 = f"CASE WHEN {v} = 4 THEN concat('8100', {_h('host % 4096', 2)}) ELSE '' END"
    vlan2 = (f"CASE WHEN {v} = 7 THEN concat('88a8', {_h('host % 4096', 2)}, '8100', "
             f"{_h('pkt_id % 4096', 2)}) ELSE '' END")
    frag = (f"CASE WHEN {fr} = 0 THEN {ipv4(17, udp, udp_len, '8192')} "
            f"ELSE {ipv4(17, 'concat(' + repr('0' * 16) + ', ' + pay + ')', '8 + ' + plen, '185')} END")
    return f"""CASE
      WHEN {k} <= 4 THEN concat({eth}, {vlan1}, '0800', {ipv4(6, tcp, tcp_len, '16384')})
      WHEN {k} <= 7 THEN concat({eth}, {vlan2}, '0800', {ipv4(17, udp, udp_len, '0')})
      WHEN {v} = 8 THEN concat({eth}, '86dd', {ipv6(6, tcp, tcp_len)})
      WHEN {k} = 8 THEN concat({eth}, '86dd', {ipv6(0, "concat('" + IPV6_HOP_BY_HOP + "', " + udp + ")",
                                                   '8 + ' + udp_len)})
      WHEN {r} = 0 THEN concat({eth}, '0806', {arp})
      WHEN {r} = 1 THEN concat({eth}, '0800', {ipv4(1, icmp, '8 + ' + plen, '0')})
      WHEN {r} = 2 THEN '{TRUNCATED_FRAME}'
      ELSE concat({eth}, '0800', {frag})
    END"""


def frames_from_rows(rows: DataFrame) -> DataFrame:
    """(pkt_id, ts NTZ, host, dport, payload) -> packet rows.

    Output: ``pkt_id BIGINT, ts_sec BIGINT, ts_usec INT, orig_len INT, raw BINARY``.
    A narrow projection: no shuffle, one pass, partitioning of ``rows`` kept.
    """
    us = epoch_micros(F.col("ts"))
    framed = rows.select(
        "pkt_id",
        us.alias("_us"),
        F.unhex(F.expr(_frame_hex_sql())).alias("raw"),
        F.expr("pkt_id % 10 = 9 AND (pkt_id div 10) % 4 = 2"),
    ).toDF("pkt_id", "_us", "raw", "_snapped")
    return framed.select(
        "pkt_id",
        F.floor(F.col("_us") / 1_000_000).cast("bigint").alias("ts_sec"),
        F.pmod(F.col("_us"), F.lit(1_000_000)).cast("int").alias("ts_usec"),
        F.when(F.col("_snapped"), F.lit(60)).otherwise(F.octet_length("raw")).cast("int").alias("orig_len"),
        "raw",
    )


def event_frame_rows(events: DataFrame) -> DataFrame:
    """`events` -> frame inputs: host = user_id, port by event type, payload = props."""
    port = F.lit(0)
    for name, p in reversed(list(EVENT_PORTS.items())):
        port = F.when(F.col("event_type") == name, F.lit(p)).otherwise(port)
    return events.select(
        F.col("event_id").alias("pkt_id"),
        F.col("ts"),
        F.col("user_id").alias("host"),
        port.alias("dport"),
        F.col("props").alias("payload"),
    )


def lineitem_frame_rows(lineitem: DataFrame) -> DataFrame:
    """`lineitem` -> frame inputs (the larger frame set used by the bench)."""
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pkt_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_suppkey").alias("host"),
        (F.lit(1024) + F.col("l_partkey") % 1000).cast("int").alias("dport"),
        F.concat_ws("|", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("payload"),
    )


def _layout_version() -> str:
    """Hash of this module's source: part of the packet table fingerprint."""
    import hashlib
    with open(__file__, "rb") as f:
        return hashlib.sha1(f.read()).hexdigest()[:12]


def _packet_table(spark, sf_dir: str, table: str, cols: list[str], to_rows) -> DataFrame:
    from flowlens.sources.tables import derived_table, input_fingerprint, read_table
    fp = f"{input_fingerprint(spark, f'{sf_dir}/{table}.parquet')}|{_layout_version()}"
    return derived_table(spark, f"packets-{table}", fp,
                         lambda: frames_from_rows(to_rows(read_table(spark, sf_dir, table, cols))))


def event_frames(spark, sf_dir: str) -> DataFrame:
    """Packet table made from `events` (built once per input, then scanned)."""
    cols = ["event_id", "ts", "user_id", "event_type", "props"]
    return _packet_table(spark, sf_dir, "events", cols, event_frame_rows)


def lineitem_frames(spark, sf_dir: str) -> DataFrame:
    """Packet table made from `lineitem` (built once per input, then scanned)."""
    cols = ["l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"]
    return _packet_table(spark, sf_dir, "lineitem", cols, lineitem_frame_rows)
