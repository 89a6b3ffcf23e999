"""Repair of series references nested in radiotherapy structure sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions.identifiers import remap_uid
from scanloom.operators.deid import ELEMENT_COLUMNS, ITEM_PATH
from scanloom.operators.routing import FAILURE, SUCCESS

# Path to the first referenced series.
REFERENCE_PATH = [("30060010", "ReferencedFrameOfReferenceSequence"), ("30060012", "RTReferencedStudySequence"), ("30060014", "RTReferencedSeriesSequence")]
SERIES_TAG = "0020000E"


def _at_path() -> Column:
    p = F.col("item_path")
    out = F.size(p) == len(REFERENCE_PATH)
    for i, (tag, _) in enumerate(REFERENCE_PATH):
        out = out & (F.get(p, F.lit(i))["tag"] == tag) & (F.get(p, F.lit(i))["item"] == 0)
    return F.coalesce(out, F.lit(False))


def reference_routes(elements: DataFrame) -> DataFrame:
    """Per instance: does the nested reference exist, and its current series UID."""
    here = _at_path()
    value = F.max(F.when(here & (F.col("tag") == SERIES_TAG), F.get("values", F.lit(0))))
    found = F.max(here.cast("int"))
    return (elements.groupBy("sop_instance_uid").agg(found.alias("_found"), value.alias("referenced_series"))
            .withColumn("route", F.when(F.col("_found") == 1, SUCCESS).otherwise(FAILURE)).drop("_found"))


def _references(elements: DataFrame) -> DataFrame:
    """Instances with the nested reference and its current series UID; only rows at the path are grouped."""
    value = F.max(F.when(F.col("tag") == SERIES_TAG, F.get("values", F.lit(0))))
    return elements.filter(_at_path()).groupBy("sop_instance_uid").agg(value.alias("referenced_series"), F.count_if(F.col("tag") == SERIES_TAG).alias("_rows"))


def _with_reference(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """Elements of the instances in ``targets(sop_instance_uid, _new, _rows)`` with the nested series
    UID replaced in place, in one join; an instance whose path lacks the attribute gets a row for it."""
    path = F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(k).alias("keyword"), F.lit(0).alias("item")) for t, k in REFERENCE_PATH]).cast(ITEM_PATH)
    fixed = {"item_path": path, "tag": F.lit(SERIES_TAG), "keyword": F.lit("SeriesInstanceUID"), "vr": F.lit("UI"), "private_creator": F.lit(None).cast("string"),
             "values": F.array("_new"), "bin": F.lit(None).cast("binary"), "ord": F.lit(0)}
    here = _at_path() & (F.col("tag") == SERIES_TAG)
    joined = elements.hint("merge").join(targets.select("sop_instance_uid", "_new"), "sop_instance_uid").withColumn("_here", F.coalesce(here, F.lit(False)))
    changed = joined.select(*[F.when(F.col("_here"), fixed[c]).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c) for c in ELEMENT_COLUMNS])
    added = targets.filter("_rows = 0").select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in ELEMENT_COLUMNS])
    return changed.unionByName(added)


def set_reference(elements: DataFrame, series: DataFrame) -> DataFrame:
    """Nested series UID := the record's own (``series(sop_instance_uid, series_uid)``). Instances
    without the path or without a series UID are failures and drop out (:func:`reference_routes`)."""
    good = _references(elements).join(series.filter(F.coalesce("series_uid", F.lit("")) != ""), "sop_instance_uid")
    return _with_reference(elements, good.select("sop_instance_uid", F.col("series_uid").alias("_new"), "_rows"))


def remap_reference(elements: DataFrame) -> DataFrame:
    """Nested series UID := the deterministic remap of itself."""
    good = _references(elements).filter(F.col("referenced_series").isNotNull())
    return _with_reference(elements, good.select("sop_instance_uid", remap_uid("referenced_series").alias("_new"), "_rows"))
