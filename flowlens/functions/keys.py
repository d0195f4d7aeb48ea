"""Row keys (B8, B9, B11, B13, B16, B17, B19) as BINARY column expressions.

Key layouts (byte offsets, big-endian integers):

* import key, 43 B: MD5(tuple) 0-15 | dataset id 16-17 | seconds 18-21 |
  microseconds 22-25 | tuple 26-38 | suffix 39-42
* time-slot key, 43 B: MD5(tuple | slot) 0-15 | milliseconds 16-23 |
  source id 24-25 | tuple 26-38 | suffix 39-42
* tuple, 13 B: sip 4 | dip 4 | sport 2 | dport 2 | proto 1

The reference ends both keys with 4 random bytes, so a retried task writes
duplicate rows. Here the suffix is the first 4 bytes of MD5 over the row's
lineage (e.g. packet id, or capture file + ordinal): retries rewrite the same
key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.functions.bytesx import be_bytes, be_bytes_exact, bytes_to_int, hex_field, reverse_bytes

IMPORT_LAYOUT = {"salt": (0, 16), "dataset_id": (16, 2), "ts_sec": (18, 4), "ts_usec": (22, 4),
                 "tuple": (26, 13), "suffix": (39, 4)}
TIMESLOT_LAYOUT = {"salt": (0, 16), "ts_ms": (16, 8), "source_id": (24, 2),
                   "tuple": (26, 13), "suffix": (39, 4)}
TUPLE_LAYOUT = {"sip": (0, 4), "dip": (4, 4), "sport": (8, 2), "dport": (10, 2), "proto": (12, 1)}
KEY_LENGTH = 43


def tuple_bytes(sip, dip, sport, dport, proto, legacy_sport: bool = False) -> Column:
    """13-byte 5-tuple. ``legacy_sport`` stores the source port byte-reversed,
    as the reference importer does (quirk Q3); off by default."""
    sp = be_bytes(sport, 2)
    if legacy_sport:
        sp = reverse_bytes(sp, 2)
    return F.concat(be_bytes(sip, 4), be_bytes(dip, 4), sp, be_bytes(dport, 2), be_bytes(proto, 1))


def md5_bytes(b: Column) -> Column:
    return F.unhex(F.md5(b))


def lineage_suffix(*cols) -> Column:
    """Deterministic 4-byte key suffix from the row's lineage columns."""
    return F.unhex(F.substring(F.md5(F.concat_ws("/", *[F.col(c).cast("string") if isinstance(c, str)
                                                        else c.cast("string") for c in cols])), 1, 8))


def import_key(tuple13: Column, dataset_id, ts_sec, ts_usec, suffix: Column) -> Column:
    """MD5(tuple) | dataset id | seconds | microseconds | tuple | suffix.
    A field outside its bytes is an error: two packets never share a key by wrapping."""
    return F.concat(md5_bytes(tuple13), be_bytes_exact(dataset_id, 2), be_bytes_exact(ts_sec, 4),
                    be_bytes_exact(ts_usec, 4), tuple13, suffix)


def slot_of_millis(ts_ms: Column, width_s: int) -> Column:
    """B9 slot: (ms / 1000) / width with floor division."""
    sec = F.floor(ts_ms / 1000).cast("bigint")
    return F.floor(sec / width_s).cast("bigint")


def timeslot_key(tuple13: Column, ts_ms: Column, source_id, width_s: int, suffix: Column) -> Column:
    """MD5(tuple | slot) | time ms | source id | tuple | suffix. A slot or
    source id outside its bytes is an error."""
    slot = slot_of_millis(ts_ms, width_s)
    return F.concat(md5_bytes(F.concat(tuple13, be_bytes_exact(slot, 4))), be_bytes(ts_ms, 8),
                    be_bytes_exact(source_id, 2), tuple13, suffix)


def key_part(key: Column, layout: dict, name: str) -> Column:
    off, n = layout[name]
    return key.substr(off + 1, n)


def split_key(key: Column, layout: str = "import") -> Column:
    """Slice a key into a struct of typed parts. ``layout`` is
    ``import`` or ``timeslot`` (the two layouts place time differently)."""
    lay = IMPORT_LAYOUT if layout == "import" else TIMESLOT_LAYOUT
    tup = key_part(key, lay, "tuple")
    fields = [F.lower(F.hex(key_part(key, lay, "salt"))).alias("salt")]
    for name in lay:
        if name in ("salt", "tuple", "suffix"):
            continue
        fields.append(bytes_to_int(key_part(key, lay, name)).alias(name))
    for name, (off, n) in TUPLE_LAYOUT.items():
        v = bytes_to_int(tup.substr(off + 1, n))
        fields.append((v if name in ("sip", "dip") else v.cast("int")).alias(name))
    fields.append(F.lower(F.hex(key_part(key, lay, "suffix"))).alias("suffix"))
    return F.struct(*fields)


# Fixed values (the reference's record key): salt = (index div 1200) mod 15.
RECORD_SALTS = 15
RECORD_SALT_SPAN = 1200


def record_salt(idx: Column) -> Column:
    """B13 salt: (index div 1200) mod 15, a 2-byte prefix."""
    return F.pmod(F.floor(idx / RECORD_SALT_SPAN).cast("bigint"), F.lit(RECORD_SALTS)).cast("int")


def record_key(idx: Column) -> Column:
    """Salt (2 B) | index (4 B). An index of 2^32 or more is an error."""
    return F.concat(be_bytes(record_salt(idx), 2), be_bytes_exact(idx, 4))


def key_range_bucket(key: Column, lo: int, hi: int, n: int, width: int | None = None) -> Column:
    """Region of a fixed-width key among n-1 equal-width split points.

    Split points are lo + inc * (i + 1), i = 0..n-2, inc = (hi - lo) div n,
    compared as unsigned big-endian numbers of ``width`` bytes (the key
    prefix). Returns 0..n-1: the number of split points <= the key prefix.
    """
    if width is None:
        width = max(1, (max(hi, 1).bit_length() + 7) // 8)
    if width > 7:
        raise ValueError("key_range_bucket supports prefixes up to 7 bytes")
    inc = (hi - lo) // n
    v = bytes_to_int(key.substr(1, width))
    # exact integer division (a double quotient would round above 2**53)
    b = F.floor((v - F.lit(lo)).cast("decimal(20,0)") / F.lit(inc).cast("decimal(20,0)")).cast("bigint")
    return F.when(v < lo, 0).otherwise(F.least(b, F.lit(n - 1))).cast("int")


def split_points(lo: int, hi: int, n: int, width: int) -> list[str]:
    """The n-1 split keys of ``key_range_bucket`` as zero-padded hex (for a
    table's pre-split metadata or ``repartitionByRange`` boundaries)."""
    inc = (hi - lo) // n
    return [format(lo + inc * (i + 1), f"0{2 * width}x") for i in range(n - 1)]


def index_text(idx: Column, digits: int = 6) -> Column:
    """Zero-padded decimal key text ('%06d')."""
    return F.format_string(f"%0{digits}d", idx)


def key_as_bytes(text: Column) -> Column:
    """Text key -> UTF-8 key bytes."""
    return F.encode(text, "UTF-8")


def key_as_text(key: Column) -> Column:
    """Key bytes -> lower-case hex text (safe for any bytes; UTF-8
    decoding would fail on arbitrary binary keys)."""
    return F.lower(F.hex(key))


__all__ = [
    "tuple_bytes", "import_key", "timeslot_key", "split_key", "record_key", "record_salt",
    "key_range_bucket", "split_points", "index_text", "key_as_bytes", "key_as_text",
    "lineage_suffix", "hex_field", "KEY_LENGTH",
]
