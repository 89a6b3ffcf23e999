"""Scalars for pixel masking: region lists, fill colours, colour space, compression bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, col, is_blank, trimmed

REGION = r"\[\s*(\d+)\s*,\s*(\d+)\s*,\s*(-?\d+)\s*,\s*(\d+)\s*\]"
_REGION_LIST = r"\A\s*,?\s*(?:\[\s*\d+\s*,\s*\d+\s*,\s*-?\d+\s*,\s*\d+\s*\]\s*,?\s*)+\z"


def region_list(text: ColumnOrName) -> Column:
    """``[x,y,w,h],...`` -> ARRAY<STRUCT<x,y,width,height>>; NULL when any part is invalid.

    Only blanks and at most one comma may stand between regions. Width 0 and height 0 are
    invalid; a negative width means the full image width.
    """
    c = col(text)
    groups = [F.regexp_extract_all(c, F.lit(REGION), g) for g in (1, 2, 3, 4)]
    zipped = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("x", "y", "width", "height"))])
    regions = F.transform(zipped, lambda z: F.struct(*[z[n].try_cast("int").alias(n) for n in ("x", "y", "width", "height")]))
    valid = F.forall(
        regions,
        lambda r: r["x"].isNotNull() & r["y"].isNotNull() & F.coalesce(r["width"] != 0, F.lit(False)) & F.coalesce(r["height"] > 0, F.lit(False)))
    return F.when(~is_blank(c) & c.rlike(_REGION_LIST) & valid, regions)


def fill_colour(text: ColumnOrName, leading_zero_is_octal: bool = False) -> Column:
    """Decimal, ``0x..`` or ``#..`` colour in 0..0xFFFFFF; NULL when invalid.

    ``leading_zero_is_octal`` gives the single-image variant, which applies ``010`` as 8.
    """
    t = trimmed(text)
    digits = F.when(t.startswith("#"), F.substring(t, 2, 2147483647)).when(F.lower(F.left(t, F.lit(2))) == "0x", F.substring(t, 3, 2147483647))
    hexa = F.when(digits.rlike(r"\A(\+?0*[0-9a-fA-F]{1,6}|-0+)\z"), F.conv(F.regexp_replace(digits, r"^[+-]", ""), 16, 10).cast("bigint"))
    number = F.when(t.rlike(r"\A[+-]?[0-9]+\z"), t.try_cast("bigint"))
    if leading_zero_is_octal:
        octal = F.when(t.rlike(r"\A0[0-7]{1,10}\z"), F.conv(t, 8, 10).cast("bigint"))
        number = F.when(t.rlike(r"\A0[0-9]+\z"), octal).otherwise(number)
    value = F.when(digits.isNotNull(), hexa).otherwise(number)
    return F.when(value.between(0, 0xFFFFFF), value.cast("int"))


def rgb_to_ybr_full(rgb: ColumnOrName) -> Column:
    """0xRRGGBB -> 0xYYCBCR in single precision, rounded half up and clamped to a byte."""
    c = col(rgb)
    r, g, b = [F.shiftright(c, s).bitwiseAND(255).cast("float") for s in (16, 8, 0)]

    def f(x):
        return F.lit(x).cast("float")

    def byte(x):
        return F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") + 0.5).cast("int")))

    y = byte(f(0.299) * r + f(0.587) * g + f(0.114) * b)
    cb = byte(f(-0.168736) * r - f(0.331264) * g + f(0.5) * b + f(128))
    cr = byte(f(0.5) * r - f(0.418688) * g - f(0.081312) * b + f(128))
    return F.shiftleft(y, 16).bitwiseOR(F.shiftleft(cb, 8)).bitwiseOR(cr)


def mask_value(colour: ColumnOrName, samples: ColumnOrName, photometric: ColumnOrName) -> Column:
    """Fill value in the colour space of the frame; NULL when the space is not supported."""
    c, s, p = col(colour), col(samples), col(photometric)
    return F.when(s != 3, c).when(p == "RGB", c).when(p == "YBR_FULL", rgb_to_ybr_full(c))


def uncompressed_bytes(rows, columns, samples, bits_allocated, frames) -> Column:
    """rows * columns * samples * bytes per sample * frames, with the usual defaults for NULL."""
    d = [F.coalesce(col(c), F.lit(v)).cast("bigint") for c, v in
         ((rows, 0), (columns, 0), (samples, 1), (bits_allocated, 8), (frames, 1))]
    return d[0] * d[1] * d[2] * F.floor((d[3] + 7) / 8) * d[4]


def compression_ratio(uncompressed: ColumnOrName, compressed: ColumnOrName) -> Column:
    """Ratio with two decimals as text; NULL when either size is not positive."""
    u, c = col(uncompressed), col(compressed)
    return F.when((u > 0) & (c > 0), F.format_string("%.2f", u.cast("double") / c.cast("double")))


def lossy_method(transfer_syntax: ColumnOrName) -> Column:
    """Lossy compression method term of a transfer syntax, NULL for any other."""
    c = col(transfer_syntax)
    return (F.when(c.isin("1.2.840.10008.1.2.4.50", "1.2.840.10008.1.2.4.51"), "ISO_10918_1")
            .when(c == "1.2.840.10008.1.2.4.81", "ISO_14495_1").when(c == "1.2.840.10008.1.2.4.91", "ISO_15444_1"))
