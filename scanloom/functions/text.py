"""Text helpers. All are plain Catalyst expressions, so scans, codegen and pushdown stay intact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters removed by a control-character trim (U+0000..U+0020).
TRIM_CHARS = "".join(chr(code) for code in range(0x21))

# Full-match patterns of delivery fields.
AET_PATTERN = r"[A-Za-z0-9._-]{1,16}"
HOST_PATTERN = r"[A-Za-z0-9]([A-Za-z0-9.-]{0,253}[A-Za-z0-9])?"
PORT_PATTERN = r"[0-9]{1,5}"
DIRECTORY_PATTERN = r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}"
FOLDER_PATTERN = r"[A-Za-z0-9]([A-Za-z0-9._-]{0,98}[A-Za-z0-9_-])?"
RESERVED_NAME_PATTERN = r"(?i)(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])(\..*)?"
UUID_PATTERN = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
STATUS_PATTERN = r"[0-9A-F]{4}"
SHA256_PATTERN = r"[0-9a-f]{64}"


def col(value: ColumnOrName) -> Column:
    """A name means a column; a Column is passed on, so parameters may be per-row expressions."""
    return F.col(value) if isinstance(value, str) else value


def lit_or_col(value) -> Column:
    """A plain Python value means a constant; a Column is evaluated per row."""
    return value if isinstance(value, Column) else F.lit(value)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, which may use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trimmed(value: ColumnOrName) -> Column:
    return F.trim(col(value), F.lit(TRIM_CHARS))


def is_blank(value: ColumnOrName) -> Column:
    """True for NULL, empty and whitespace-only text (never NULL)."""
    return F.coalesce(trimmed(value) == "", F.lit(True))


def blank_to_null(value: ColumnOrName) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(trimmed(value), F.lit(""))


def full_match(value: ColumnOrName, pattern: str) -> Column:
    """Whole-value regex match; NULL counts as no match."""
    return F.coalesce(col(value).rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def truncated(value: ColumnOrName, limit: int) -> Column:
    return F.left(col(value), F.lit(limit))


def abbreviated(value: ColumnOrName, limit: int) -> Column:
    c = col(value)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.left(c, F.lit(limit)), F.lit("...")))


def normalised_code(value: ColumnOrName, limit: int = 50) -> Column:
    """Upper case, anything outside A-Z 0-9 _ becomes _, at most ``limit`` characters."""
    return F.left(F.regexp_replace(F.upper(trimmed(value)), "[^A-Z0-9_]", "_"), F.lit(limit))


def joined_messages(*parts: Column, separator: str = " | ", limit: int = 1000, default: str | None = None) -> Column:
    """Non-blank parts joined by a separator, cut to ``limit``; ``default`` when none is left."""
    kept = [F.when(~is_blank(p), p) for p in parts]
    text = F.nullif(F.left(F.concat_ws(separator, *kept), F.lit(limit)), F.lit(""))
    return text if default is None else F.coalesce(text, F.lit(default))


def first_error(*checks: tuple[Column, Column | str]) -> Column:
    """Message of the first violated rule; each check is ``(violated, message)``."""
    return F.coalesce(*[F.when(bad, lit_or_col(message)) for bad, message in checks], F.lit(None).cast("string"))


def capitalised(value: ColumnOrName) -> Column:
    """First letter upper case, the rest unchanged (unlike ``initcap``)."""
    c = col(value)
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substring(c, 2, 2147483647))


def hl7_unescaped(value: ColumnOrName) -> Column:
    r"""Decode \S\ \T\ \R\ \E\ \F\ in one left-to-right pass.

    The text is cut into escapes and plain runs first, so an escape produced by decoding
    (``\E\S\E\``) is never decoded again. Other escapes stay as they are.
    """
    c = col(value)
    tokens = F.regexp_extract_all(c, F.lit(r"(\\[STREF]\\|[^\\]+|\\)"), 1)
    decoded = F.transform(
        tokens,
        lambda t: F.when(t == "\\S\\", "^").when(t == "\\T\\", "&").when(t == "\\R\\", "~")
        .when(t == "\\E\\", "\\").when(t == "\\F\\", "|").otherwise(t))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(decoded, "")).otherwise(c)


def study_series_key(value: ColumnOrName) -> Column:
    """``study[,series]`` text -> struct(study, series), both trimmed; a missing part is NULL."""
    parts = F.split(col(value), ",")
    return F.struct(trimmed(F.get(parts, F.lit(0))).alias("study"), trimmed(F.get(parts, F.lit(1))).alias("series"))


def delivery_port_ok(value: ColumnOrName) -> Column:
    number = col(value).try_cast("int")
    return full_match(value, PORT_PATTERN) & F.coalesce(number.between(1, 65535), F.lit(False))


def directory_ok(value: ColumnOrName) -> Column:
    return full_match(value, DIRECTORY_PATTERN) & ~F.contains(col(value), F.lit(".."))


def folder_ok(value: ColumnOrName) -> Column:
    return full_match(value, FOLDER_PATTERN) & ~F.contains(col(value), F.lit(".."))


def path_segment_ok(value: ColumnOrName, pattern: str) -> Column:
    """Directory or folder name that is also no reserved device name."""
    return (full_match(value, pattern) & ~F.contains(col(value), F.lit("..")) & ~full_match(value, RESERVED_NAME_PATTERN))


def day_shift_error(value: ColumnOrName) -> Column:
    """NULL when the text is absent or a whole number of days within +/-36500."""
    v = blank_to_null(value)
    return first_error(
        (v.isNotNull() & ~full_match(v, r"[+-]?[0-9]{1,5}"), "Invalid DATE_SHIFT_DAYS: not a whole number"),
        (F.coalesce(F.abs(v.try_cast("int")) > 36500, F.lit(False)), "Invalid DATE_SHIFT_DAYS: outside +/-36500 days"))


def day_shift(value: ColumnOrName) -> Column:
    """Days as INT; NULL when absent, zero or invalid."""
    v = blank_to_null(value)
    return F.when(full_match(v, r"[+-]?[0-9]{1,5}") & day_shift_error(v).isNull(), F.nullif(v.try_cast("int"), F.lit(0)))


def json_error(value: ColumnOrName, missing: str, invalid: str) -> Column:
    """Typed error of a JSON payload: blank -> ``missing``; unparsable -> ``invalid`` with its length."""
    c = col(value)
    return first_error(
        (is_blank(c), missing),
        (F.try_parse_json(c).isNull(), F.format_string(invalid, F.length(c))))
