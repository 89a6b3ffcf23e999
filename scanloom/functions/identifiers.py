"""Deterministic identifiers: digests, name-based UUIDs and remapped UIDs, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, blank_to_null, col, let

# Root of UIDs derived from a UUID; 2^64 written as HIGH * 10^10 + LOW.
UUID_ROOT = "2.25."
TWO64_HIGH = 1844674407
TWO64_LOW = 3709551616


def uid_digest(value: ColumnOrName) -> Column:
    """MD5 of a UID as 32 hex digits."""
    return F.md5(col(value))


def _name_uuid_hex(value: Column) -> Column:
    """32 hex digits of the name-based (version 3) UUID of a text."""
    def patched(h):
        variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        return F.concat(F.substring(h, 1, 12), F.lit("3"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))

    return let(F.md5(value), patched)


def name_uuid(value: ColumnOrName) -> Column:
    """Name-based UUID in its usual dashed form."""
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return let(_name_uuid_hex(col(value)), lambda h: F.concat_ws("-", *[F.substring(h, start, size) for start, size in spans]))


def _decimal_text(h: Column) -> Column:
    """Decimal digits of a 128-bit number given as 32 hex digits.

    The number exceeds DECIMAL(38), so it is built as head * 10^10 + rest:
    H * 2^64 + L = H * 1844674407 * 10^10 + (H * 3709551616 + L).
    """
    half = [F.conv(F.substring(h, start, 16), 16, 10).cast("decimal(20,0)") for start in (1, 17)]
    ten = F.lit(10**10).cast("decimal(11,0)")

    def split(n):
        return F.struct(n["high"].alias("high"), n["tail"].alias("tail"), (n["tail"] % ten).cast("decimal(10,0)").alias("rest"))

    def digits(n):
        carry = ((n["tail"] - n["rest"]) / ten).cast("bigint").cast("decimal(20,0)")  # below 6.9e18
        head = n["high"] * F.lit(TWO64_HIGH).cast("decimal(10,0)") + carry
        return F.concat(head.cast("decimal(38,0)").cast("string"), F.lpad(n["rest"].cast("string"), 10, "0"))

    pair = F.struct(half[0].alias("high"), (half[0] * F.lit(TWO64_LOW).cast("decimal(10,0)") + half[1]).alias("tail"))
    return let(let(pair, split), digits)


def remap_uid(value: ColumnOrName) -> Column:
    """``2.25.`` plus the decimal form of the UID's name-based UUID; NULL stays NULL."""
    return F.concat(F.lit(UUID_ROOT), let(_name_uuid_hex(col(value)), _decimal_text))


def remap_uids(values: ColumnOrName) -> Column:
    """Remap each value of a multi-valued UID element."""
    return F.transform(col(values), remap_uid)


def event_id(existing: Column | None, *parts: ColumnOrName) -> Column:
    """A stored id is reused; otherwise a UUID derived from the event's natural key.

    A random UUID would change whenever a lost task is run again; a derived one does not.
    """
    derived = name_uuid(F.concat_ws("|", *[F.coalesce(col(p), F.lit("")) for p in parts]))
    return derived if existing is None else F.coalesce(blank_to_null(existing), derived)
