"""Byte, key and clock scalars (all Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bytes(s) -> Column:
    """UTF-8 encode."""
    return F.encode(_c(s), "UTF-8")


def from_bytes(b) -> Column:
    """UTF-8 decode."""
    return F.decode(_c(b), "UTF-8")


def concat_bytes(*parts) -> Column:
    """byte concatenation (``concat`` on BINARY stays BINARY)."""
    return F.concat(*[_c(p) for p in parts])


def int_key(i) -> Column:
    """a 32-bit int as 4 big-endian bytes (two's complement for < 0)."""
    return F.unhex(F.substring(F.lpad(F.hex(_c(i).cast("int")), 16, "0"), -8, 8))


KEY_DIGITS = 19


def text_key(n) -> Column:
    """A non-negative integer as zero-padded text: ``KEY_DIGITS`` digits hold
    any BIGINT, so no key is ever cut and text order is number order."""
    return F.lpad(_c(n).cast("string"), KEY_DIGITS, "0")


def padded_key(n) -> Column:
    """``text_key`` as bytes."""
    return F.encode(text_key(n), "UTF-8")


def cell_size(row="row", family="family", qualifier="qualifier", value="value") -> Column:
    """payload bytes of a cell (key parts + 8-byte ts + 1-byte op + value)."""
    return (
        F.octet_length(_c(row))
        + F.octet_length(_c(family))
        + F.octet_length(_c(qualifier))
        + F.lit(9)
        + F.coalesce(F.octet_length(_c(value)), F.lit(0))
    ).cast("bigint")


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ value, independent of the
    session time zone (wall clock read as UTC, sub-millisecond truncated)."""
    c = _c(ts)
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000)
        + F.hour(c).cast("bigint") * F.lit(3_600_000)
        + F.minute(c).cast("bigint") * F.lit(60_000)
        + (F.date_part(F.lit("SECOND"), c) * F.lit(1000)).cast("bigint")
    )


def epoch_micros(ts) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ value, wall clock read as UTC."""
    c = _c(ts)
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(c).cast("bigint") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint")
    )


def ntz_to_instant(ts) -> Column:
    """A TIMESTAMP_NTZ as the TIMESTAMP whose UTC wall clock it is --
    independent of the session time zone (a plain cast is not)."""
    return F.timestamp_micros(epoch_micros(ts))


def now_millis() -> Column:
    """the clock, one value per query."""
    return F.unix_millis(F.current_timestamp())


def hex_str(b) -> Column:
    return F.hex(_c(b))
