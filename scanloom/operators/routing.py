"""Routing predicates. Each returns a Column; :func:`routed` turns a condition into a route.

Routes are values of a column, so one pass over the data serves every outcome and filters on the
route still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions import vocabulary as V
from scanloom.functions.text import ColumnOrName, UUID_PATTERN, blank_to_null, col, full_match, is_blank, lit_or_col

SUCCESS, FAILURE, UNSUPPORTED, NOT_FOUND = "success", "failure", "unsupported", "not found"


def routed(condition: Column) -> Column:
    """success / failure; an unknown condition is a failure."""
    return F.when(condition, SUCCESS).otherwise(FAILURE)


def same_text(value: ColumnOrName, expected) -> Column:
    """Case-insensitive equality, never NULL."""
    return F.coalesce(F.lower(col(value)) == F.lower(lit_or_col(expected)), F.lit(False))


def called_title_route(title, called_aet: ColumnOrName = "called_aet") -> Column:
    return routed(same_text(called_aet, title))


def calling_title_route(title, calling_aet: ColumnOrName = "calling_aet") -> Column:
    return routed(same_text(calling_aet, title))


def is_video(transfer_syntax: ColumnOrName = "transfer_syntax_uid") -> Column:
    return F.coalesce(col(transfer_syntax).isin(V.MPEG2_SYNTAXES + V.MPEG4_SYNTAXES), F.lit(False))


def object_type(sop_class: ColumnOrName = "sop_class_uid", transfer_syntax: ColumnOrName = "transfer_syntax_uid",
                bits_allocated: ColumnOrName = "bits_allocated", frames: ColumnOrName = "number_of_frames") -> Column:
    """One of 16 object types.

    An image has BitsAllocated and is no RT dose. Only the two little-endian native syntaxes
    count as uncompressed here; big endian and deflated count as compressed.
    """
    c, ts = col(sop_class), col(transfer_syntax)
    image = col(bits_allocated).isNotNull() & ~c.eqNullSafe(F.lit(V.RT_DOSE))
    multi = F.coalesce(col(frames), F.lit(1)) > 1
    kind = F.when(multi, "MultiFrameImage").otherwise("SingleFrameImage")
    native = F.coalesce(ts.isin(V.IMPLICIT_LE, V.EXPLICIT_LE), F.lit(False))
    image_type = (F.when(ts.isin(V.MPEG2_SYNTAXES), "MPEG2Video").when(ts.isin(V.MPEG4_SYNTAXES), "MPEG4Video")
                  .when(native, F.concat(F.lit("Uncompressed"), kind)).otherwise(F.concat(F.lit("Compressed"), kind)))
    report = c.isin(V.REPORT_CLASSES) & ts.isin(V.REPORT_SYNTAXES)
    document = V.pick(c, [(uid, name) for uid, name, _ in V.ENCAPSULATED])
    return F.when(image, image_type).otherwise(F.coalesce(document, F.when(report, "SRDocument"), F.lit("Other")))


def sop_class_route(mode: str, value=None, sop_class: ColumnOrName = "sop_class_uid", readable: ColumnOrName | None = None, **type_columns) -> Column:
    """``*`` passes all; ``Value`` compares the SOP class (``*`` again passes all); any other
    mode is an object type. Unreadable content fails first, whatever the mode."""
    if mode == "*":
        accepted = F.lit(True)
    elif mode == "Value":
        if value is None:
            accepted = F.lit(False)
        else:
            accepted = (lit_or_col(value) == "*") | same_text(sop_class, value)
    else:
        accepted = object_type(sop_class, **type_columns) == mode
    return routed(accepted if readable is None else F.coalesce(col(readable), F.lit(False)) & accepted)


def transfer_syntax_route(mode: str, value=None, transfer_syntax: ColumnOrName = "transfer_syntax_uid") -> Column:
    """``Uncompressed`` (big endian included) or ``Value``; an empty syntax always fails."""
    ts = col(transfer_syntax)
    if mode == "Uncompressed":
        accepted = ts.isin(V.NATIVE_SYNTAXES)
    elif mode == "Value" and value is not None:
        accepted = (lit_or_col(value) == "*") | same_text(ts, value)
    else:
        accepted = F.lit(False)
    return routed((F.coalesce(ts, F.lit("")) != "") & accepted)


def thin_slice_route(thickness: ColumnOrName, limit: float = 1.0) -> Column:
    """Positive thickness up to ``limit``, compared in single precision; unreadable counts as 0."""
    t = F.coalesce(col(thickness).cast("string").try_cast("float"), F.lit(0.0).cast("float"))
    return routed((t > 0) & (t <= F.lit(limit).cast("float")))


def message_type_route(msg_type: str = "*", trigger: str = "*", type_column: ColumnOrName = "msh_9_1", trigger_column: ColumnOrName = "msh_9_2") -> Column:
    """Message type and trigger event, ``*`` accepts anything."""
    def matches(value, wanted):
        return F.lit(True) if wanted == "*" else F.coalesce(col(value) == wanted, F.lit(False))

    return routed(matches(type_column, msg_type) & matches(trigger_column, trigger))


def multiframe_ultrasound_reason(sop_class: ColumnOrName = "sop_class_uid", frames: ColumnOrName = "number_of_frames") -> Column:
    """Why an instance is not eligible for multi-frame masking; NULL when it is."""
    c = col(sop_class)
    return (F.when(~c.eqNullSafe(F.lit(V.US_MULTIFRAME)),
                   F.concat(F.lit("SOP Class "), F.coalesce(c, F.lit("null")), F.lit(" ist keine Ultrasound Multi-frame Image Storage")))
            .when(F.coalesce(col(frames), F.lit(1)) <= 1, "Ultraschall-Single-Frame"))


def maskable_error(transfer_syntax: ColumnOrName = "transfer_syntax_uid", has_pixels: ColumnOrName = "has_pixels") -> Column:
    """NULL when the syntax is accepted for masking and a pixel element exists. A missing syntax
    means implicit little endian."""
    ts = F.coalesce(col(transfer_syntax), F.lit(V.IMPLICIT_LE))
    return (F.when(~ts.isin(V.MASKABLE_SYNTAXES), F.concat(F.lit("Nicht freigegebene Transfer-Syntax für Ultraschall-Multiframe: "), ts))
            .when(~F.coalesce(col(has_pixels), F.lit(False)), "DICOM-Instanz enthält kein PixelData-Element"))


def masking_route(**columns) -> Column:
    """unsupported (not eligible), failure (eligible but not maskable) or success."""
    reason = multiframe_ultrasound_reason(columns.get("sop_class", "sop_class_uid"), columns.get("frames", "number_of_frames"))
    error = maskable_error(columns.get("transfer_syntax", "transfer_syntax_uid"), columns.get("has_pixels", "has_pixels"))
    return F.when(reason.isNotNull(), UNSUPPORTED).when(error.isNotNull(), FAILURE).otherwise(SUCCESS)


def missing_attribute_errors(required: dict[str, ColumnOrName], uuids: dict[str, ColumnOrName] | None = None) -> Column:
    """All violated rules as an array of messages: blank required attributes, malformed UUIDs."""
    checks = [F.when(is_blank(c), f"Missing required attribute: {name}") for name, c in required.items()]
    checks += [F.when(~is_blank(c) & ~full_match(blank_to_null(c), UUID_PATTERN), f"Invalid UUID: {name}") for name, c in (uuids or {}).items()]
    return F.array_compact(F.array(*checks))


def with_route(df: DataFrame, route: Column, name: str = "route") -> DataFrame:
    return df.withColumn(name, route)


def select_where(df: DataFrame, attribute: str, value) -> DataFrame:
    """Only the records whose attribute has the value (a session filter); pushed to the scan."""
    return df.filter(F.col(attribute) == lit_or_col(value))


def name_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).like(pattern))
