"""Fixed vocabularies (public DICOM registry values) and small lookup expressions over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, col

# Transfer syntaxes (uid, short name, native, lossy, media type).
TRANSFER_SYNTAXES = [
    ("1.2.840.10008.1.2", "ImplicitVRLittleEndian", True, False, "application/octet-stream"),
    ("1.2.840.10008.1.2.1", "ExplicitVRLittleEndian", True, False, "application/octet-stream"),
    ("1.2.840.10008.1.2.1.99", "DeflatedExplicitVRLittleEndian", False, False, None),
    ("1.2.840.10008.1.2.2", "ExplicitVRBigEndian", True, False, None),
    ("1.2.840.10008.1.2.4.50", "JPEGBaseline8Bit", False, True, "image/jpeg"),
    ("1.2.840.10008.1.2.4.51", "JPEGExtended12Bit", False, True, "image/jpeg"),
    ("1.2.840.10008.1.2.4.57", "JPEGLossless", False, False, "image/jpeg"),
    ("1.2.840.10008.1.2.4.70", "JPEGLosslessSV1", False, False, "image/jpeg"),
    ("1.2.840.10008.1.2.4.80", "JPEGLSLossless", False, False, "image/jls"),
    ("1.2.840.10008.1.2.4.81", "JPEGLSNearLossless", False, True, "image/jls"),
    ("1.2.840.10008.1.2.4.90", "JPEG2000Lossless", False, False, "image/jp2"),
    ("1.2.840.10008.1.2.4.91", "JPEG2000", False, True, "image/jp2"),
    ("1.2.840.10008.1.2.4.92", "JPEG2000MCLossless", False, False, "image/jpx"),
    ("1.2.840.10008.1.2.4.93", "JPEG2000MC", False, True, "image/jpx"),
    ("1.2.840.10008.1.2.4.100", "MPEG2MPML", False, True, "video/mpeg"),
    ("1.2.840.10008.1.2.4.100.1", "MPEG2MPMLF", False, True, None),
    ("1.2.840.10008.1.2.4.101", "MPEG2MPHL", False, True, "video/mpeg"),
    ("1.2.840.10008.1.2.4.101.1", "MPEG2MPHLF", False, True, None),
    ("1.2.840.10008.1.2.4.102", "MPEG4HP41", False, True, "video/mp4"),
    ("1.2.840.10008.1.2.4.102.1", "MPEG4HP41F", False, True, None),
    ("1.2.840.10008.1.2.4.103", "MPEG4HP41BD", False, True, "video/mp4"),
    ("1.2.840.10008.1.2.4.103.1", "MPEG4HP41BDF", False, True, None),
    ("1.2.840.10008.1.2.4.104", "MPEG4HP422D", False, True, None),
    ("1.2.840.10008.1.2.4.104.1", "MPEG4HP422DF", False, True, None),
    ("1.2.840.10008.1.2.4.105", "MPEG4HP423D", False, True, None),
    ("1.2.840.10008.1.2.4.105.1", "MPEG4HP423DF", False, True, None),
    ("1.2.840.10008.1.2.4.106", "MPEG4HP42STEREO", False, True, None),
    ("1.2.840.10008.1.2.4.106.1", "MPEG4HP42STEREOF", False, True, None),
    ("1.2.840.10008.1.2.4.107", "HEVCMP51", False, True, None),
    ("1.2.840.10008.1.2.4.108", "HEVCM10P51", False, True, None),
    ("1.2.840.10008.1.2.4.201", "HTJ2KLossless", False, False, "image/jphc"),
    ("1.2.840.10008.1.2.4.202", "HTJ2KLosslessRPCL", False, False, "image/jphc"),
    ("1.2.840.10008.1.2.4.203", "HTJ2K", False, True, "image/jphc"),
    ("1.2.840.10008.1.2.5", "RLELossless", False, False, "image/dicom-rle"),
]
_BY_NAME = {name: uid for uid, name, *_ in TRANSFER_SYNTAXES}

IMPLICIT_LE = _BY_NAME["ImplicitVRLittleEndian"]
EXPLICIT_LE = _BY_NAME["ExplicitVRLittleEndian"]
DEFLATED_LE = _BY_NAME["DeflatedExplicitVRLittleEndian"]
RLE = _BY_NAME["RLELossless"]
NATIVE_SYNTAXES = [uid for uid, _, native, *_ in TRANSFER_SYNTAXES if native]
LOSSY_SYNTAXES = [uid for uid, _, _, lossy, _ in TRANSFER_SYNTAXES if lossy]
MPEG2_SYNTAXES = [uid for uid, name, *_ in TRANSFER_SYNTAXES if name.startswith("MPEG2")]
MPEG4_SYNTAXES = [uid for uid, name, *_ in TRANSFER_SYNTAXES if name.startswith(("MPEG4", "HEVC"))]

# Syntaxes whose frames the multi-frame masking accepts.
MASKABLE_SYNTAXES = [
    _BY_NAME[name] for name in (
        "ImplicitVRLittleEndian", "ExplicitVRLittleEndian", "ExplicitVRBigEndian", "JPEGBaseline8Bit",
        "JPEGExtended12Bit", "JPEGLossless", "JPEGLosslessSV1", "JPEGLSLossless", "JPEGLSNearLossless",
        "JPEG2000Lossless", "JPEG2000", "RLELossless")
]

# Choices of the conversion target; any other name means implicit little endian.
CONVERSION_TARGETS = [
    "ImplicitVRLittleEndian", "ExplicitVRLittleEndian", "DeflatedExplicitVRLittleEndian", "JPEGBaseline8Bit",
    "JPEGLosslessSV1", "JPEGLSLossless", "JPEGLSNearLossless", "JPEG2000Lossless", "JPEG2000",
]

# SOP classes with a rule of their own.
CT_IMAGE = "1.2.840.10008.5.1.4.1.1.2"
US_MULTIFRAME = "1.2.840.10008.5.1.4.1.1.3.1"
PET_IMAGE = "1.2.840.10008.5.1.4.1.1.128"
RT_DOSE = "1.2.840.10008.5.1.4.1.1.481.2"

# Encapsulated document classes (uid, object type, file extension).
ENCAPSULATED = [
    ("1.2.840.10008.5.1.4.1.1.104.1", "EncapsulatedPDF", ".pdf"),
    ("1.2.840.10008.5.1.4.1.1.104.2", "EncapsulatedCDA", ".xml"),
    ("1.2.840.10008.5.1.4.1.1.104.3", "EncapsulatedSTL", ".stl"),
    ("1.2.840.10008.5.1.4.1.1.104.4", "EncapsulatedOBJ", ".obj"),
    ("1.2.840.10008.5.1.4.1.1.104.5", "EncapsulatedMTL", ".mtl"),
    ("1.2.40.0.13.1.5.1.4.1.1.104.1", "EncapsulatedGenozip", ".genozip"),
    ("1.2.40.0.13.1.5.1.4.1.1.104.2", "EncapsulatedVCFBzip2", ".vcfbz2"),
    ("1.2.40.0.13.1.5.1.4.1.1.104.3", "EncapsulatedBzip2", ".bz2"),
]

# Structured report classes.
REPORT_CLASSES = [
    "1.2.840.10008.5.1.4.1.1.78.6",
    "1.2.840.10008.5.1.4.1.1.79.1",
    "1.2.840.10008.5.1.4.1.1.88.11",
    "1.2.840.10008.5.1.4.1.1.88.22",
    "1.2.840.10008.5.1.4.1.1.88.33",
    "1.2.840.10008.5.1.4.1.1.88.34",
    "1.2.840.10008.5.1.4.1.1.88.35",
    "1.2.840.10008.5.1.4.1.1.88.40",
    "1.2.840.10008.5.1.4.1.1.88.50",
    "1.2.840.10008.5.1.4.1.1.88.59",
    "1.2.840.10008.5.1.4.1.1.88.65",
    "1.2.840.10008.5.1.4.1.1.88.67",
    "1.2.840.10008.5.1.4.1.1.88.68",
    "1.2.840.10008.5.1.4.1.1.88.69",
    "1.2.840.10008.5.1.4.1.1.88.70",
    "1.2.840.10008.5.1.4.1.1.88.71",
    "1.2.840.10008.5.1.4.1.1.88.72",
    "1.2.840.10008.5.1.4.1.1.88.73",
    "1.2.840.10008.5.1.4.1.1.88.74",
    "1.2.840.10008.5.1.4.1.1.88.75",
    "1.2.840.10008.5.1.4.1.1.88.76",
    "1.2.840.10008.5.1.4.1.1.88.77",
]
REPORT_SYNTAXES = [IMPLICIT_LE, EXPLICIT_LE, DEFLATED_LE]

# De-identification method codes (code value -> meaning), scheme DCM.
METHOD_CODES = {
    "113100": "Basic Application Confidentiality Profile",
    "113101": "Clean Pixel Data Option",
    "113106": "Retain Longitudinal Temporal Information Full Dates Option",
    "113107": "Retain Longitudinal Temporal Information Modified Dates Option",
    "113109": "Retain Device Identity Option",
    "113110": "Retain UIDs Option",
    "113112": "Retain Institution Identity Option",
}


def pick(key: ColumnOrName, pairs: list[tuple], default=None) -> Column:
    """CASE over a short fixed table; stays inside code generation, needs no join."""
    c, out = col(key), None
    for known, value in pairs:
        out = F.when(c == known, F.lit(value)) if out is None else out.when(c == known, F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out


def transfer_syntax_uid(name: ColumnOrName) -> Column:
    """Conversion choice -> UID, unknown names mean implicit little endian."""
    return pick(name, [(n, _BY_NAME[n]) for n in CONVERSION_TARGETS], IMPLICIT_LE)


def media_type(transfer_syntax: ColumnOrName) -> Column:
    """Media type of the pixel data, NULL for a syntax without one."""
    return pick(transfer_syntax, [(uid, m) for uid, _, _, _, m in TRANSFER_SYNTAXES if m])


def is_lossy(transfer_syntax: ColumnOrName) -> Column:
    return F.coalesce(col(transfer_syntax).isin(LOSSY_SYNTAXES), F.lit(False))


def transfer_syntaxes(spark: SparkSession) -> DataFrame:
    """The syntax table as a dimension DataFrame (fixed size)."""
    return spark.createDataFrame(TRANSFER_SYNTAXES, "uid string, name string, native boolean, lossy boolean, media_type string")
