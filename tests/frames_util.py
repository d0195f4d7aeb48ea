"""Hand-built frames for decoder tests (FIXTURES.md section 4)."""

import struct

ETH = bytes.fromhex("020000000002" "020000000001")


def ipv4(proto, payload, src=0x0A000001, dst=0xC0A80101, ihl=5, opts=b"", flags_frag=0x4000, total=None,
         ttl=64, ident=0x1234, tos=0):
    hl = ihl * 4
    tot = hl + len(payload) if total is None else total
    h = struct.pack(">BBHHHBBHII", 0x40 | ihl, tos, tot, ident, flags_frag, ttl, proto, 0, src, dst)
    return h + opts + payload


def tcp(sport=1234, dport=80, doff=5, opts=b"", flags=0x18, b12_low=0, payload=b"x"):
    return struct.pack(">HHIIBBHHH", sport, dport, 7, 0, (doff << 4) | b12_low, flags, 65535, 0, 0) + opts + payload


def udp(sport=5353, dport=53, payload=b"abc"):
    return struct.pack(">HHHH", sport, dport, 8 + len(payload), 0) + payload


def ipv6(nh, payload, src=b"\xfd" + b"\x00" * 14 + b"\x01", dst=b"\xfd" + b"\x00" * 14 + b"\x02", plen=None):
    pl = len(payload) if plen is None else plen
    return struct.pack(">IHBB", 0x60000000, pl, nh, 64) + src + dst + payload


def eth(etype, l3, tags=()):
    out = ETH
    for tpid, tci in tags:
        out += struct.pack(">HH", tpid, tci)
    return out + struct.pack(">H", etype) + l3
