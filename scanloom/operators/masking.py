"""Masking of native pixel frames and the attributes that record it.

Frames are rows, so frames of one object are masked in parallel anywhere. Everything that can be
decided from the header is decided in Catalyst first; only valid frames reach Python, in small
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.functions import vocabulary as V
from scanloom.functions.pixels import compression_ratio, lossy_method, mask_value
from scanloom.functions.text import first_error
from scanloom.operators.deid import ELEMENT_COLUMNS, ITEM_PATH
from scanloom.operators.keyed import small_join
from scanloom.operators.routing import FAILURE, SUCCESS

FRAME_SCHEMA = ("sop_instance_uid string, frame_no int, rows int, columns int, samples int, bits_allocated int, planar int, photometric string, "
                "big_endian boolean, pixels binary")
CLEAN_CODE = "113101"
METHODS = ("00120064", "DeidentificationMethodCodeSequence")


def effective_spans(regions: Column, columns: Column) -> Column:
    """Regions with a negative width widened to the full image width."""
    return F.transform(regions, lambda r: F.struct(
        F.when(r["width"] < 0, 0).otherwise(r["x"]).alias("x"), r["y"].alias("y"),
        F.when(r["width"] < 0, columns).otherwise(r["width"]).alias("width"), r["height"].alias("height")))


def frame_error() -> Column:
    """First reason why a frame cannot be masked. Needs the frame columns, _spans and _value."""
    rows, columns, samples, bits = (F.col(c) for c in ("rows", "columns", "samples", "bits_allocated"))

    def positive(name):
        c = F.coalesce(F.col(name), F.lit(0))
        return c <= 0, F.concat(F.lit(f"Missing or invalid {name}: "), c.cast("string"))

    def outside(r):
        return (r["x"] + r["width"] > columns) | (r["y"] + r["height"] > rows)

    need = rows.cast("bigint") * columns * samples * (bits / 8).cast("int")
    return first_error(
        positive("rows"), positive("columns"), positive("bits_allocated"),
        (~samples.isin(1, 3), F.concat(F.lit("SamplesPerPixel not supported: "), samples.cast("string"))),
        (~bits.isin(8, 16), F.concat(F.lit("BitsAllocated not supported: "), bits.cast("string"))),
        ((samples == 3) & (bits != 8), "colour frames need 8 BitsAllocated"),
        (F.col("_spans").isNull(), "invalid regions"), (F.exists("_spans", outside), "region outside the image"),
        (F.col("_value").isNull(), F.concat(F.lit("photometric interpretation not supported: "), F.coalesce("photometric", F.lit("null")))),
        (F.length("pixels") < need, "pixel data shorter than expected"))


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill the spans of each valid frame; bytes beyond the frame stay as they are."""
    for batch in batches:
        names = batch.schema.names
        get = {n: batch.column(names.index(n)).to_pylist() for n in ("rows", "columns", "samples", "bits_allocated", "planar", "big_endian", "pixels", "_spans", "_value", "frame_error")}
        out = []
        for rows, columns, samples, bits, planar, big, pixels, spans, value, error in zip(*get.values()):
            if error is not None:
                out.append(pixels)
                continue
            data = np.frombuffer(pixels, dtype=np.uint8).copy()
            plane = rows * columns
            if samples == 3:
                fill = np.array([value >> 16 & 255, value >> 8 & 255, value & 255], dtype=np.uint8)
                body = data[:plane * 3]
                view = body.reshape(3, rows, columns).transpose(1, 2, 0) if planar else body.reshape(rows, columns, 3)
            elif bits == 16:
                fill = np.frombuffer((value & 0xFFFF).to_bytes(2, "big" if big else "little"), dtype=np.uint8)
                view = data[:plane * 2].reshape(rows, columns, 2)
            else:
                fill = np.uint8(value & 255)
                view = data[:plane].reshape(rows, columns)
            for s in spans:
                view[s["y"]:s["y"] + s["height"], s["x"]:s["x"] + s["width"]] = fill
            out.append(data.tobytes())
        at = names.index("pixels")
        yield batch.set_column(at, "pixels", pa.array(out, pa.binary()))


def mask_frames(frames: DataFrame, regions: Column, colour: Column | int = 0, colour_aware: bool = True, whole_objects: bool = True) -> DataFrame:
    """Fill the regions in every frame; adds route and frame_error.

    ``regions``: array of (x, y, width, height), a constant or a per-row column. ``colour_aware``
    converts the colour to the frame's space. ``whole_objects``: one bad frame fails its object,
    so a partly masked object never counts as masked. That joins frames by instance: keep them in a
    table bucketed by ``sop_instance_uid``, or pass False where every frame stands for itself.
    """
    c = colour if isinstance(colour, Column) else F.lit(colour)
    value = mask_value(c, "samples", "photometric") if colour_aware else c
    checked = (frames.withColumn("_spans", effective_spans(regions, F.col("columns"))).withColumn("_value", value.cast("int"))
               .withColumn("frame_error", frame_error()))
    if whole_objects:
        bad = (checked.filter("frame_error is not null").groupBy("sop_instance_uid").agg(F.min("frame_error").alias("_object_error")))
        checked = (checked.join(bad, "sop_instance_uid", "left")
                   .withColumn("frame_error", F.coalesce("frame_error", "_object_error")).drop("_object_error"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in checked.schema.fields])
    return (checked.mapInArrow(_fill, schema).withColumn("route", F.when(F.col("frame_error").isNull(), SUCCESS).otherwise(FAILURE)).drop("_spans", "_value"))


def join_regions(frames: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the regions of a rule (by SOP class, device, …) to every frame; pixels stay in place."""
    return small_join(frames, rules, keys, F.concat_ws(":", "sop_instance_uid", F.col("frame_no").cast("string")))


def mark_clean_pixels(elements: DataFrame, masked: DataFrame) -> DataFrame:
    """BurnedInAnnotation = NO and the clean-pixel code, once, for the instances in ``masked``."""
    in_methods = (F.size("item_path") == 1) & (F.get("item_path", F.lit(0))["tag"] == METHODS[0])
    first = F.get("values", F.lit(0))
    items = elements.filter(in_methods).groupBy("sop_instance_uid", F.get("item_path", F.lit(0))["item"].alias("item")).agg(
        F.max(F.when(F.col("keyword") == "CodeValue", first)).alias("code"), F.max(F.when(F.col("keyword") == "CodingSchemeDesignator", first)).alias("scheme"))
    state = items.groupBy("sop_instance_uid").agg(
        F.max(F.coalesce((F.col("code") == CLEAN_CODE) & (F.col("scheme") == "DCM"), F.lit(False))).alias("_marked"), (F.max("item") + 1).alias("_item"))
    todo = masked.select("sop_instance_uid").distinct().withColumn("_todo", F.lit(True))
    kept = (elements.hint("merge").join(todo, "sop_instance_uid", "left")
            .filter(F.col("_todo").isNull() | ~((F.size("item_path") == 0) & F.col("tag").isin("00280301", METHODS[0]))).select(*ELEMENT_COLUMNS))
    path = F.array(F.struct(F.lit(METHODS[0]).alias("tag"), F.lit(METHODS[1]).alias("keyword"), F.coalesce("_item", F.lit(0)).alias("item"))).cast(ITEM_PATH)
    root = F.array().cast(ITEM_PATH)

    def row(p, tag, keyword, vr, *values):
        return F.struct(p.alias("item_path"), F.lit(tag).alias("tag"), F.lit(keyword).alias("keyword"), F.lit(vr).alias("vr"),
                        F.array(*[F.lit(v) for v in values]).cast("array<string>").alias("values"))

    code = [row(path, "00080100", "CodeValue", "SH", CLEAN_CODE), row(path, "00080102", "CodingSchemeDesignator", "SH", "DCM"),
            row(path, "00080104", "CodeMeaning", "LO", V.METHOD_CODES[CLEAN_CODE])]
    unmarked = ~F.coalesce("_marked", F.lit(False))
    rows = F.array(row(root, "00280301", "BurnedInAnnotation", "CS", "NO"), row(root, *METHODS, "SQ"), *[F.when(unmarked, r) for r in code])
    added = (todo.join(state, "sop_instance_uid", "left").select("sop_instance_uid", F.explode(F.array_compact(rows)).alias("r"))
             .select("sop_instance_uid", "r.item_path", "r.tag", "r.keyword", "r.vr", F.lit(None).cast("string").alias("private_creator"), "r.values",
                     F.lit(None).cast("binary").alias("bin"), F.lit(0).alias("ord")))
    return kept.unionByName(added)


def output_syntax(source: Column, lossy_output: str = "RLE_LOSSLESS") -> Column:
    """Syntax of the masked object: lossless input keeps its own, lossy input takes the choice."""
    choices = {"RLE_LOSSLESS": V.RLE, "JPEG_LS_LOSSLESS": "1.2.840.10008.1.2.4.80", "EXPLICIT_VR_LITTLE_ENDIAN": V.EXPLICIT_LE, "ORIGINAL": None}
    target = choices[lossy_output]
    return F.when(V.is_lossy(source), source if target is None else F.lit(target)).otherwise(source)


def lossy_history(df: DataFrame, uncompressed: Column, compressed: Column, again: Column | None = None, again_bytes: Column | None = None) -> DataFrame:
    """Lossy compression attributes after masking: flag, ratios and methods.

    Input: transfer_syntax_uid, lossy_flag, ratios, methods (arrays). A lossy source keeps 01 and
    completes a missing ratio or method; ``again`` (the syntax of a renewed lossy coding, NULL
    otherwise) appends one step.
    """
    none = F.array().cast("array<string>")

    def clean(c):
        return F.filter(F.coalesce(c, none), lambda v: F.coalesce(v, F.lit("")) != "")

    lossy = V.is_lossy("transfer_syntax_uid")

    def completed(values, current):
        return F.when((F.size(values) == 0) & current.isNotNull(), F.array(current)).otherwise(values)

    out = df.withColumn("_r", completed(clean(F.col("ratios")), compression_ratio(uncompressed, compressed))).withColumn("_m", completed(clean(F.col("methods")), lossy_method("transfer_syntax_uid")))
    ratios, methods, flagged = F.col("_r"), F.col("_m"), lossy
    if again is not None:
        ratio, method = compression_ratio(uncompressed, again_bytes), lossy_method(again)
        ratios = F.when(again.isNotNull() & ratio.isNotNull(), F.array_append(ratios, ratio)).otherwise(ratios)
        methods = F.when(again.isNotNull() & method.isNotNull(), F.array_append(methods, method)).otherwise(methods)
        flagged = lossy | again.isNotNull()
    return (out.withColumn("lossy_flag", F.when(flagged, "01").otherwise(F.col("lossy_flag"))).withColumn("ratios", F.when(flagged, ratios).otherwise(F.col("ratios")))
            .withColumn("methods", F.when(flagged, methods).otherwise(F.col("methods"))).drop("_r", "_m"))
