"""Column helpers for big-endian byte fields inside a BINARY column.

All helpers build Catalyst expressions; nothing runs in Python per row.
Offsets are 0-based byte offsets and may be ints or integer Columns (for
variable header positions after VLAN tags, IP options, extension headers).
A read that would run past the end of the value yields NULL instead of a
short, wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def slice_bytes(b: Column, off, n) -> Column:
    """``n`` bytes at 0-based ``off`` (shorter or empty past the end)."""
    return _c(b).substr(_c(off) + 1, _c(n))


def uint(b: Column, off, n: int) -> Column:
    """Unsigned big-endian integer of ``n`` (1..7) bytes at ``off``; NULL if short."""
    v = F.conv(F.hex(slice_bytes(b, off, n)), 16, 10).cast("bigint")
    return F.when(F.octet_length(b) >= _c(off) + n, v)


def u8(b, off) -> Column:
    return uint(b, off, 1).cast("int")


def u16(b, off) -> Column:
    return uint(b, off, 2).cast("int")


def u32(b, off) -> Column:
    return uint(b, off, 4)


def signed(x: Column, bits: int) -> Column:
    """Two's-complement view of an unsigned ``bits``-wide value."""
    half = 1 << (bits - 1)
    return x.bitwiseXOR(F.lit(half)) - F.lit(half)


def hex_lower(b: Column) -> Column:
    """Portable text form of bytes (lower-case hex)."""
    return F.lower(F.hex(b))


def hex_field(x, nbytes: int) -> Column:
    """Big-endian hex text of the low ``nbytes`` of an integer column."""
    if nbytes >= 8:
        return F.lpad(F.hex(_c(x).cast("bigint")), 16, "0")
    mask = (1 << (8 * nbytes)) - 1
    return F.lpad(F.hex(_c(x).cast("bigint").bitwiseAND(F.lit(mask))), 2 * nbytes, "0")


def be_bytes(x, nbytes: int) -> Column:
    """Integer column -> ``nbytes`` big-endian bytes (two's complement)."""
    return F.unhex(hex_field(x, nbytes))


def be_bytes_exact(x, nbytes: int) -> Column:
    """``be_bytes`` of an integer that must fit: a value outside 0 ..
    256^nbytes - 1 is an error, since a wrapped key would meet another's."""
    c = _c(x).cast("bigint")
    fits = c.isNull() | c.between(0, (1 << (8 * nbytes)) - 1)
    bad = F.raise_error(F.concat(F.lit(f"does not fit {nbytes} bytes: "), c.cast("string"))).cast("binary")
    return F.when(fits, be_bytes(c, nbytes)).otherwise(bad)


def reverse_bytes(b: Column, n: int) -> Column:
    """Byte order reversal of a fixed ``n``-byte value."""
    return F.concat(*[slice_bytes(b, i, 1) for i in range(n - 1, -1, -1)])


def bytes_to_int(b: Column) -> Column:
    """Big-endian value of a BINARY value of up to 8 bytes: unsigned below 8
    bytes, two's complement at 8 (like a JVM long), so a negative 8-byte key
    (a time before 1970) reads back instead of overflowing BIGINT."""
    return F.conv(F.hex(b), 16, -10).cast("bigint")


def ipv4_text(x: Column) -> Column:
    """Dotted-quad text of an unsigned 32-bit address column."""
    parts = [F.shiftright(x, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *parts)
