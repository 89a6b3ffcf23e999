"""Workflow events as structs; JSON text only where a sink needs it (``event_json``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions.identifiers import event_id
from scanloom.functions.text import (
    STATUS_PATTERN, UUID_PATTERN, blank_to_null, first_error, full_match, is_blank, joined_messages, normalised_code, trimmed, truncated)
from scanloom.operators.keyed import batched
from scanloom.operators.outcomes import strict_gate
from scanloom.operators.routing import FAILURE, SUCCESS

CORRELATION = ["order_id", "retrieve_id", "study_uid", "series_uid"]


def event_json(event: str = "event") -> Column:
    """JSON text of an event struct; NULL members are written."""
    return F.to_json(event, {"ignoreNullFields": "false"})


def batch_key(order: str = "order_id", retrieve: str = "retrieve_id") -> Column:
    return F.concat_ws(":", order, retrieve)


def _optional(df: DataFrame, name: str) -> Column:
    return blank_to_null(name) if name in df.columns else F.lit(None).cast("string")


def _stored_id(df: DataFrame, name: str) -> Column | None:
    return F.col(name) if name in df.columns else None


def correlation_error(required: list[str], uuids: tuple[str, ...] = ("order_id", "retrieve_id")) -> Column:
    return first_error(*[(is_blank(n), f"Missing required attribute: {n}") for n in required],
                       *[(~full_match(trimmed(n), UUID_PATTERN), F.concat(F.lit("Invalid UUID string: "), trimmed(n))) for n in uuids])


def series_retrieved(df: DataFrame) -> DataFrame:
    """SERIES_RETRIEVED event of each retrieval that passes the strict gate; others fail."""
    gated = strict_gate(df)
    eid = event_id(_stored_id(df, "event_id"), "order_id", "retrieve_id", F.lit("SERIES_RETRIEVED"))
    event = F.struct(
        eid.alias("eventId"), F.lit("SERIES_RETRIEVED").alias("eventType"), trimmed("study_uid").alias("studyInstanceUid"),
        trimmed("series_uid").alias("seriesInstanceUid"), trimmed("retrieve_id").alias("retrieveId"), F.col("expected_instances").alias("expectedInstances"),
        *[trimmed(c).try_cast("int").alias(n) for c, n in (("completed", "retrievedInstances"),)], F.lit(0).alias("completedInstances"),
        trimmed("failed").try_cast("int").alias("failedInstances"), trimmed("warning").try_cast("int").alias("warningInstances"), F.upper(trimmed("status")).alias("cgetStatus"))
    return gated.withColumn("event", F.when(F.col("route") == SUCCESS, event))


def series_retrieve_failed(df: DataFrame) -> DataFrame:
    """SERIES_RETRIEVE_FAILED event; tells find failures from retrieve failures.

    Optional input columns: retrieve_source, find_count, find_error, get_error, error_comment,
    result_error, expected, find_count_instances, failure_event_id.
    """
    rid = blank_to_null("retrieve_id")
    read_find = rid.isNull() | F.coalesce(F.col("retrieve_source") == "C-FIND", F.lit(False)) if "retrieve_source" in df.columns else rid.isNull()
    find_count, find_error = F.when(read_find, _optional(df, "find_count")), F.when(read_find, _optional(df, "find_error"))
    from_find = F.coalesce(find_count == "0", F.lit(False)) | find_error.isNotNull()
    out = df.withColumn("_from_find", from_find).withColumn("_count", find_count).withColumn("_error", find_error)
    # A retrieval that never started has no id yet; it gets one derived from its series.
    new_id = event_id(None, "order_id", "study_uid", "series_uid", F.lit("C-FIND"))
    out = out.withColumn("_rid", F.coalesce(rid, F.when(F.col("_from_find"), new_id)))

    def count(name):
        n = _optional(df, name).try_cast("int")
        return F.when(n >= 0, n)

    status = F.upper(_optional(df, "status"))
    message = joined_messages(
        F.when(F.col("_count") == "0", "C-FIND: series not found in PACS (0 matches)"), F.when(F.col("_error").isNotNull(), F.concat(F.lit("C-FIND failed: "), F.col("_error"))),
        *[F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("get_error", "error_comment", "result_error")], default="C-GET failed without details")
    eid = event_id(_stored_id(df, "failure_event_id"), "order_id", "_rid", F.lit("SERIES_RETRIEVE_FAILED"))
    zero = F.lit(0)
    event = F.struct(
        eid.alias("eventId"), F.lit("SERIES_RETRIEVE_FAILED").alias("eventType"), trimmed("study_uid").alias("studyInstanceUid"),
        trimmed("series_uid").alias("seriesInstanceUid"), F.col("_rid").alias("retrieveId"), F.coalesce(count("expected"), count("find_count_instances")).alias("expectedInstances"),
        F.coalesce(count("completed"), zero).alias("retrievedInstances"), F.coalesce(count("failed"), zero).alias("failedInstances"),
        F.coalesce(count("warning"), zero).alias("warningInstances"), F.when(full_match(status, STATUS_PATTERN), status).alias("cgetStatus"), message.alias("message"))
    error = first_error(*[(is_blank(n), f"Missing required attribute: {n}") for n in ("order_id", "study_uid", "series_uid")],
                        (F.col("_rid").isNull(), "Missing required attribute: retrieve_id"),
                        (~full_match(trimmed("order_id"), UUID_PATTERN), F.concat(F.lit("Invalid UUID string: "), trimmed("order_id"))),
                        (~full_match(F.col("_rid"), UUID_PATTERN), F.concat(F.lit("Invalid UUID string: "), F.col("_rid"))))
    out = out.withColumn("event_error", error).withColumn("route", F.when(F.col("event_error").isNull(), SUCCESS).otherwise(FAILURE))
    return (out.withColumn("event", F.when(F.col("route") == SUCCESS, event)).withColumn("failed_source", F.when(F.col("_from_find"), "C-FIND").otherwise("C-GET"))
            .drop("_from_find", "_count", "_error", "_rid"))


def _instance_event(df: DataFrame, kind: str, original: Column, pseudonym: Column, required: list[str], extra: list[Column], uuids=()) -> DataFrame:
    eid = event_id(None, "order_id", "retrieve_id", original, F.lit(kind))
    event = F.struct(
        eid.alias("eventId"), F.lit(kind).alias("eventType"), trimmed("retrieve_id").alias("retrieveId"), trimmed("study_uid").alias("studyInstanceUid"),
        trimmed("series_uid").alias("seriesInstanceUid"), original.alias("originalSopInstanceUid"), pseudonym.alias("pseudonymSopInstanceUid"), *extra)
    out = df.withColumn("event_error", correlation_error(required, uuids)).withColumn("route", F.when(F.col("event_error").isNull(), SUCCESS).otherwise(FAILURE))
    ok = F.col("route") == SUCCESS
    return out.withColumn("event", F.when(ok, event)).withColumn("batch_group", F.when(ok, batch_key())).withColumn("callback_type", F.when(ok, "instance-event"))


def instance_completed(df: DataFrame, pass_on: bool = True) -> DataFrame:
    """INSTANCE_COMPLETED event per instance; ``pass_on`` also emits the object itself (1 -> 2 rows).

    Needs original_sop_uid and sop_instance_uid (the pseudonym). Both rows come out of one pass.
    """
    out = _instance_event(df, "INSTANCE_COMPLETED", trimmed("original_sop_uid"), trimmed("sop_instance_uid"),
                          [*CORRELATION, "original_sop_uid", "sop_instance_uid"], [])
    if not pass_on:
        return out
    kinds = F.when(F.col("route") == SUCCESS, F.array(F.lit("instance-event"), F.lit("dicom"))).otherwise(F.array(F.lit("original")))
    out = out.withColumn("callback_type", F.explode(kinds))
    is_event = F.col("callback_type") == "instance-event"
    return out.withColumn("event", F.when(is_event, F.col("event"))).withColumn("batch_group", F.when(is_event, F.col("batch_group")))


def instance_failed(df: DataFrame) -> DataFrame:
    """INSTANCE_FAILED event with one cause, by priority: store, mask unsupported, mask,
    pseudonymise, other. The object itself is not passed on."""
    def o(name):
        return _optional(df, name)

    def tail(prefix, c):
        return F.coalesce(F.concat(F.lit(prefix), c), F.lit(""))

    store, unsupported, mask, pseudo, script = o("store_error_code"), o("mask_unsupported"), o("mask_error"), o("pseudonymizer_error"), o("script_error")
    code = (F.when(store.isNotNull(), "STORE_FAILED").when(unsupported.isNotNull(), "MASK_UNSUPPORTED").when(mask.isNotNull(), "MASK_FAILED")
            .when(pseudo.isNotNull(), "PSEUDONYMIZE_FAILED").otherwise("PROCESSING_FAILED"))
    # Message texts of the callback.
    store_text = F.concat(F.lit("DICOM C-STORE"), tail(" an ", o("delivery_aet")), F.lit(" fehlgeschlagen ("), store, tail(", Status ", o("store_status")), F.lit(")"), tail(": ", o("store_error")))
    message = (F.when(store.isNotNull(), store_text).when(unsupported.isNotNull(), F.concat(F.lit("Pixelmaskierung nicht anwendbar: "), unsupported))
               .when(mask.isNotNull(), F.concat(F.lit("Pixelmaskierung fehlgeschlagen: "), mask))
               .when(pseudo.isNotNull(), F.concat(F.lit("Pseudonymisierung fehlgeschlagen: "), pseudo))
               .otherwise(F.concat(F.lit("Instanzverarbeitung fehlgeschlagen"), tail(": ", script))))
    original = F.coalesce(o("original_sop_uid"), trimmed("sop_instance_uid"))
    named = df.withColumn("_original", original)
    return _instance_event(named, "INSTANCE_FAILED", F.col("_original"), F.lit(None).cast("string"), [*CORRELATION, "_original"],
                           [code.alias("errorCode"), truncated(message, 1000).alias("errorMessage")], ("order_id", "retrieve_id")).drop("_original")


def instance_skipped(df: DataFrame) -> DataFrame:
    """INSTANCE_SKIPPED event of instances excluded by their SOP class; nothing is passed on."""
    return _instance_event(df, "INSTANCE_SKIPPED", trimmed("sop_instance_uid"), F.lit(None).cast("string"), [*CORRELATION, "sop_class_uid", "sop_instance_uid"], [])


def package_failures(df: DataFrame) -> DataFrame:
    """Report of a package failure; a record without any error sign is not reported but fails."""
    def o(name):
        return _optional(df, name)

    code, http, exception, fragments = o("zip_error_code"), o("http_status"), o("exception_class"), o("fragment_count")
    http_error = http.isNotNull() & ~F.startswith(http, F.lit("2"))
    url = [F.lit("ZIP manifest request failed"), o("http_message"), o("http_url")]
    error_code = (F.when(code.isNotNull(), normalised_code(code)).when(http_error, F.concat(F.lit("MANIFEST_HTTP_"), F.regexp_replace(http, "[^0-9]", "")))
                  .when(exception.isNotNull(), "MANIFEST_UNREACHABLE").when(fragments.isNotNull(), "ZIP_INCOMPLETE"))
    incomplete = F.concat(F.lit("Series ZIP not created: not all "), fragments, F.lit(" fragments arrived within Max Bin Age (Create Series ZIP)"))
    message = (F.when(code.isNotNull(), o("zip_error_message")).when(http_error, F.concat_ws(": ", *url))
               .when(exception.isNotNull(), F.concat_ws(": ", exception, o("exception_message"))).when(fragments.isNotNull(), incomplete))
    reason = F.concat(F.lit("No error indicator on record (http status="), F.coalesce(http, F.lit("none")),
                      F.lit(", no error code, no fragment count): probably connected from a non-error relationship, not reported"))
    out = df.withColumn("event_error", F.coalesce(correlation_error(CORRELATION), F.when(error_code.isNull(), reason)))
    ok = F.col("event_error").isNull()
    report = F.struct(trimmed("study_uid").alias("studyInstanceUid"), trimmed("series_uid").alias("seriesInstanceUid"),
                      F.left(error_code, F.lit(50)).alias("errorCode"), truncated(message, 1000).alias("errorMessage"))
    return out.withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)).withColumn("event", F.when(ok, report))


def event_batches(events: DataFrame, size: int = 100, keys: tuple[str, ...] = ("order_id", "retrieve_id")) -> DataFrame:
    """``{"events":[…]}`` bodies of at most ``size`` events per order and retrieval.

    ``events``: the keys and an ``event`` struct. Only a batch, never a whole group, is gathered.
    """
    if not 1 <= size <= 100:
        raise ValueError("batch size must be 1..100")
    numbered_events = batched(events.withColumn("_eid", F.col("event.eventId")), list(keys), "_eid", size)
    entries = F.transform(F.array_sort(F.collect_list(F.struct("_eid", "event"))), lambda e: e["event"])
    grouped = numbered_events.groupBy(*keys, "batch_no").agg(entries.alias("events"))
    return grouped.withColumn("event_count", F.size("events")).withColumn("body", F.to_json(F.struct("events"), {"ignoreNullFields": "false"}))


BATCH_KEYS = ["eventId", "eventType", "retrieveId", "studyInstanceUid", "seriesInstanceUid", "originalSopInstanceUid"]


def batch_error(events: str = "events", order: str = "order_id", retrieve: str = "retrieve_id") -> Column:
    """Why an already merged batch (array of event structs) is not accepted; NULL when it is."""
    e = F.col(events)
    incomplete = F.exists(e, lambda x: ~F.forall(F.array(*[x[k] for k in BATCH_KEYS]), lambda v: F.coalesce(v != "", F.lit(False))))
    foreign = F.exists(e, lambda x: x["retrieveId"] != F.col(retrieve))
    return first_error((e.isNull(), "Expected a JSON array of events"), (~F.size(e).between(1, 100), F.concat(F.lit("Invalid batch size: "), F.size(e).cast("string"))),
                       (is_blank(order) | is_blank(retrieve), "Missing order or retrieval id"), (incomplete, "Invalid instance event in batch"),
                       (foreign, "Batch contains different retrieveIds"))
