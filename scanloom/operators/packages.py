"""Delivery packages: manifest correlation, completeness, entry-name digests, targets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.functions.text import (
    DIRECTORY_PATTERN, FOLDER_PATTERN, SHA256_PATTERN, UUID_PATTERN, first_error, full_match, is_blank, json_error, path_segment_ok, truncated)
from scanloom.operators.keyed import numbered
from scanloom.operators.routing import FAILURE, SUCCESS

FRAGMENT_INVALID, VALIDATION_FAILED = "ZIP_FRAGMENT_INVALID", "ZIP_VALIDATION_FAILED"
INVALID_TARGET = "EXTERNAL_DRIVE_INVALID_TARGET"


def fragment_error(entry: str, original: str, pseudonym: str, group: str) -> Column:
    """First violated rule of a manifest entry (struct column) against its instance."""
    e = F.col(entry)
    index, count = e["fragmentIndex"], e["fragmentCount"]
    return first_error(
        (is_blank(original) | is_blank(pseudonym) | is_blank(group), "Missing DICOM ZIP correlation attributes"),
        (~e["originalSopInstanceUid"].eqNullSafe(F.col(original)), "Original SOP Instance UID mismatch"),
        (~e["pseudonymSopInstanceUid"].eqNullSafe(F.col(pseudonym)), "Pseudonym SOP Instance UID mismatch"),
        (index.isNull() | count.isNull(), "Missing ZIP fragment index/count"),
        ((count <= 0) | (index < 0) | (index >= count), "Invalid ZIP fragment index/count"),
        (~e["zipEntryName"].eqNullSafe(F.concat(F.col(pseudonym), F.lit(".dcm"))), "ZIP filename does not match pseudonym SOP UID"))


ENTRY_SCHEMA = "originalSopInstanceUid string, pseudonymSopInstanceUid string, fragmentIndex int, fragmentCount int, zipEntryName string"


def assign_fragments(df: DataFrame, entry_json: str = "manifest_entry", original: str = "original_sop_uid",
                     pseudonym: str = "sop_instance_uid", group: str = "package_group") -> DataFrame:
    """Fragment columns from the manifest entry (JSON text) of each instance; violations fail."""
    parsed = df.withColumn("_e", F.from_json(entry_json, ENTRY_SCHEMA))
    error = F.coalesce(json_error(entry_json, "Missing manifest entry", "manifest entry is not valid JSON (length %d)"),
                       fragment_error("_e", original, pseudonym, group))
    out = parsed.withColumn("error_message", truncated(error, 2000))
    ok = F.col("error_message").isNull()
    return (out.withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)).withColumn("error_code", F.when(~ok, FRAGMENT_INVALID))
            .withColumn("fragment_identifier", F.when(ok, F.col(group))).withColumn("fragment_index", F.when(ok, F.col("_e.fragmentIndex")))
            .withColumn("fragment_count", F.when(ok, F.col("_e.fragmentCount"))).withColumn("filename", F.when(ok, F.col("_e.zipEntryName"))).drop("_e"))


def join_manifest(instances: DataFrame, manifest: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Instances with their manifest row, matched on order, retrieval and original instance UID.

    ``manifest`` follows the package manifest table; an instance without a row fails.
    """
    keys = keys or ["order_id", "retrieve_id", "original_sop_uid"]
    entry = manifest.select(*keys, F.struct(
        F.col("original_sop_uid").alias("originalSopInstanceUid"), F.col("pseudonym_sop_uid").alias("pseudonymSopInstanceUid"),
        F.col("fragment_index").alias("fragmentIndex"), F.col("fragment_count").alias("fragmentCount"), F.col("zip_entry_name").alias("zipEntryName")).alias("_e"))
    group = F.concat_ws(":", "order_id", "retrieve_id")
    joined = instances.join(entry, keys, "left").withColumn("_group", group)
    error = F.when(F.col("_e").isNull(), "Missing manifest entry").otherwise(fragment_error("_e", "original_sop_uid", "sop_instance_uid", "_group"))
    out = joined.withColumn("error_message", error)
    ok = F.col("error_message").isNull()
    return (out.withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)).withColumn("error_code", F.when(~ok, FRAGMENT_INVALID))
            .withColumn("fragment_index", F.when(ok, F.col("_e.fragmentIndex"))).withColumn("fragment_count", F.when(ok, F.col("_e.fragmentCount")))
            .withColumn("filename", F.when(ok, F.col("_e.zipEntryName"))).drop("_e", "_group"))


def numbered_fragments(entries: DataFrame, group: list[str], tie: str) -> DataFrame:
    """Fragment index (0-based) and count of each entry of a package."""
    return numbered(entries, group, tie, "fragment_index", "fragment_count")


def _digest_sorted(keys: list[str], name: str):
    """Digest and count of each run of equal keys in a sorted stream; keys keep their Arrow type."""
    def finished(rows: pa.RecordBatch, counts: list[int], digests: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(counts, pa.int64()), pa.array(digests, pa.string())], names=[*keys, "entry_count", "names_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, state, count = None, None, None, 0  # held: the key columns of the open run
        for batch in batches:
            rows = batch.select(keys)
            begun, counts, digests, begin = [], [], [], None
            for at, (*key, value) in enumerate(zip(*[c.to_pylist() for c in rows.columns], batch.column(name).to_pylist())):
                if state is not None and key == current:
                    state.update(b"\n" + value.encode())
                    count += 1
                    continue
                if state is not None and begin is None:
                    yield finished(held, [count], [state.hexdigest()])
                elif state is not None:
                    begun.append(begin)
                    counts.append(count)
                    digests.append(state.hexdigest())
                current, begin, state, count = key, at, hashlib.sha256(value.encode()), 1
            if begun:
                yield finished(rows.take(pa.array(begun)), counts, digests)
            if begin is not None:
                held = rows.slice(begin, 1)
        if state is not None:
            yield finished(held, [count], [state.hexdigest()])

    return run


def _digests(names: DataFrame, keys: list[str], name: str) -> DataFrame:
    schema = T.StructType([*names.select(*keys).schema.fields, T.StructField("entry_count", T.LongType()), T.StructField("names_sha256", T.StringType())])
    return names.select(*keys, name).repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, name).mapInArrow(_digest_sorted(keys, name), schema)


def entry_name_digest(entries: DataFrame, keys: list[str], name: str = "entry_name") -> DataFrame:
    """Number and SHA-256 of the sorted distinct names of each package, joined by line feeds.

    Names are made distinct first, an evenly spread step; then one sorted stream of each package is
    hashed name by name, in constant memory whatever its size. (One digest is sequential by
    definition, so one package is never split.) NULL names do not count; keys may have any type, and
    a NULL key is a package of its own.
    """
    return _digests(entries.select(*keys, name).filter(F.col(name).isNotNull()).distinct(), keys, name)


def _flagged(expected: DataFrame, actual: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per package and name with its number of times on both sides, in one even grouping."""
    sides = expected.select(*keys, name, F.lit(1).alias("_e"), F.lit(0).alias("_a")).unionAll(actual.select(*keys, name, F.lit(0), F.lit(1)))
    return sides.groupBy(*keys, name).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))


def _compared(both: DataFrame, keys: list[str], name: str, shown: int) -> DataFrame:
    missing, unexpected = (F.col("_e") > 0) & (F.col("_a") == 0), (F.col("_a") > 0) & (F.col("_e") == 0)
    totals = both.groupBy(*keys).agg(
        F.sum("_e").alias("expected_entries"), F.count_if(F.col("_e") > 0).alias("expected_names"), F.count_if(F.col("_a") > 0).alias("actual_names"),
        F.count_if(missing).alias("missing"), F.count_if(unexpected).alias("unexpected"),
        F.min(F.when(F.col("_a") > 1, F.col(name))).alias("duplicate_name"),
        F.min(F.when((F.col("_a") > 0) & F.col(name).endswith("/"), F.col(name))).alias("directory_name"))
    # The rank limit is pushed below the shuffle: a map task sends at most ``shown`` names per package and side.
    rank = F.row_number().over(Window.partitionBy(*keys, "_missing").orderBy(name))
    ranked = both.filter(missing | unexpected).withColumn("_missing", missing).withColumn("_rank", rank).filter(F.col("_rank") <= shown)

    def names(side):
        return F.array_sort(F.collect_list(F.when(side, F.col(name))))

    lists = ranked.groupBy(*keys).agg(names(F.col("_missing")).alias("missing_names"), names(~F.col("_missing")).alias("unexpected_names"))
    none = F.array().cast("array<string>")
    return (totals.join(lists, keys, "left").withColumn("missing_names", F.coalesce("missing_names", none))
            .withColumn("unexpected_names", F.coalesce("unexpected_names", none)))


def compare_entries(expected: DataFrame, actual: DataFrame, keys: list[str], name: str = "entry_name", shown: int = 20) -> DataFrame:
    """Per package: counts and first names missing, unexpected, duplicated or directories.

    The names meet on (package, name), which is even; a package only ever gathers its counters
    and at most ``shown`` names per list.
    """
    return _compared(_flagged(expected, actual, keys, name), keys, name, shown)


def duplicate_entries(actual: DataFrame, keys: list[str], name: str = "entry_name") -> DataFrame:
    return actual.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") > 1)


def entry_difference(left: DataFrame, right: DataFrame, keys: list[str], name: str = "entry_name") -> DataFrame:
    """Names of ``left`` that ``right`` lacks."""
    return left.select(*keys, name).distinct().join(right.select(*keys, name).distinct(), [*keys, name], "left_anti")


def validate_packages(packages: DataFrame, expected: DataFrame, actual: DataFrame, keys: list[str], name: str = "entry_name") -> DataFrame:
    """Check each package against its manifest; adds validated, error_code and error_message.

    ``packages``: one row per package with keys, manifest_order_id, manifest_retrieve_id, order_id,
    retrieve_id, fragment_count and entry_names_sha256 (NULL: compare with the ``expected`` names).
    """
    both = _flagged(expected, actual, keys, name)
    compared = _compared(both, keys, name, 20)
    # Both counts are asked for, so that the grouping is the same plan in every use and its shuffle is done once.
    present = both.filter((F.col("_a") > 0) & (F.col("_e") >= 0) & F.col(name).isNotNull())
    digests = _digests(present, keys, name).select(*keys, "names_sha256")
    df = packages.join(compared, keys, "left").join(digests, keys, "left")
    df = df.fillna(0, ["expected_entries", "expected_names", "actual_names", "missing", "unexpected"])
    digest = F.nullif(F.lower("entry_names_sha256"), F.lit(""))
    summary = digest.isNotNull()
    count = F.col("fragment_count")
    none = F.array().cast("array<string>")

    def listed(c):
        return F.concat(F.lit("["), F.array_join(F.coalesce(F.col(c), none), ", "), F.lit("]"))

    error = first_error(
        (is_blank("order_id") | is_blank("retrieve_id"), "Missing orderId or retrieveId"),
        (~F.col("manifest_order_id").eqNullSafe(F.col("order_id")) | ~F.col("manifest_retrieve_id").eqNullSafe(F.col("retrieve_id")), "Manifest order/retrieval mismatch"),
        (summary & (F.coalesce(count <= 0, F.lit(True)) | ~full_match(digest, SHA256_PATTERN)), "Invalid ZIP manifest summary"),
        (~summary & (F.coalesce(count <= 0, F.lit(True)) | (F.col("expected_entries") != count) | (F.col("expected_names") != count)), "Invalid ZIP manifest entries"),
        (F.col("directory_name").isNotNull(), F.concat(F.lit("Unexpected ZIP directory: "), F.col("directory_name"))),
        (F.col("duplicate_name").isNotNull(), F.concat(F.lit("Duplicate ZIP entry: "), F.col("duplicate_name"))),
        (F.col("actual_names") != count, F.concat(F.lit("ZIP entry count mismatch: expected="), count.cast("string"), F.lit(", actual="), F.col("actual_names").cast("string"))),
        (summary & ~digest.eqNullSafe(F.col("names_sha256")),
         F.concat(F.lit("ZIP entry names do not match manifest (SHA-256 mismatch, "), F.col("actual_names").cast("string"), F.lit(" entries)"))),
        (~summary & ((F.col("missing") > 0) | (F.col("unexpected") > 0)),
         F.concat(F.lit("ZIP contents do not match manifest. Missing="), listed("missing_names"), F.lit(", Unexpected="), listed("unexpected_names"))))
    out = df.withColumn("error_message", truncated(error, 1000))
    ok = F.col("error_message").isNull()
    return out.withColumn("validated", ok).withColumn("error_code", F.when(~ok, VALIDATION_FAILED)).withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE))


TARGET_SCHEMA = "orderId string, retrieveId string, deliveryType string, directory string, folder string, subfolder string, fileName string"


def correlated(left_order, left_retrieve, right_order, right_retrieve, ignore_case: bool = False) -> Column:
    """True when payload and record name the same order and retrieval."""
    def same(a, b):
        x, y = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
        return F.coalesce((F.lower(x) == F.lower(y)) if ignore_case else (x == y), F.lit(False))

    return same(left_order, right_order) & same(left_retrieve, right_retrieve)


def delivery_targets(df: DataFrame, target_json: str = "target") -> DataFrame:
    """Check the delivery target (JSON text) of each package and resolve its relative folder.

    Needs order_id and retrieve_id. DOWNLOAD passes through without a folder.
    """
    t = "_t"
    parsed = df.withColumn(t, F.from_json(target_json, TARGET_SCHEMA))
    directory = F.col("_t.deliveryType") == "DIRECTORY"
    checks = [
        (~full_match("order_id", UUID_PATTERN) | ~full_match("retrieve_id", UUID_PATTERN), "Missing or invalid order or retrieval id"),
        (is_blank(target_json), "Missing delivery target"),
        (F.try_parse_json(target_json).isNull(), "delivery target is not valid JSON"),
        (~F.startswith(F.ltrim(target_json), F.lit("{")), "delivery target is not a JSON object"),
        (~correlated("order_id", "retrieve_id", "_t.orderId", "_t.retrieveId", True), "zip-target belongs to another order or retrieval"),
        (~F.coalesce(F.col("_t.deliveryType").isin("DOWNLOAD", "DIRECTORY"), F.lit(False)),
         F.concat(F.lit("Unsupported deliveryType in zip-target: "), F.coalesce(F.col("_t.deliveryType"), F.lit("null"))))]
    for field, pattern in (("directory", DIRECTORY_PATTERN), ("folder", FOLDER_PATTERN), ("subfolder", FOLDER_PATTERN)):
        checks.append((directory & ~F.coalesce(path_segment_ok(F.col(f"_t.{field}"), pattern), F.lit(False)), f"Invalid {field} in zip-target"))
    named = full_match("_t.fileName", UUID_PATTERN + r"\.zip") & F.coalesce(F.lower("_t.fileName") == F.lower(F.concat("retrieve_id", F.lit(".zip"))), F.lit(False))
    checks.append((directory & ~named, "Invalid fileName in zip-target"))
    out = parsed.withColumn("error_message", first_error(*checks))
    ok = F.col("error_message").isNull()
    return (out.withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)).withColumn("error_code", F.when(~ok, INVALID_TARGET))
            .withColumn("delivery", F.when(ok, F.col("_t.deliveryType")))
            .withColumns({c: F.when(ok & directory, F.col(f"_t.{c}")) for c in ("directory", "folder", "subfolder")})
            .withColumn("file_name", F.when(ok & directory, F.lower("_t.fileName"))).drop(t))
