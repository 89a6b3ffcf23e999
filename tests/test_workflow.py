"""Routing, find, retrieve, store, package and event goldens."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from scanloom.operators import events as E
from scanloom.operators import find, keyed, outcomes, packages, projections
from scanloom.operators import routing as R

O, RID = "3fa85f64-5717-4562-b3fc-2c963f66afa6", "7c9e6679-7425-40de-944b-e07fc1f90ae7"


def test_routes(spark):
    df = spark.createDataFrame([("STORE_SCU", "1.2.840.10008.5.1.4.1.1.2", "1.2.840.10008.1.2", 16, None), (None, "1.2.840.10008.5.1.4.1.1.88.11", "1.2.840.10008.1.2.1", None, None),
                                ("x", "1.2.840.10008.5.1.4.1.1.104.1", "1.2.840.10008.1.2.1", None, None), ("y", "1.2.840.10008.5.1.4.1.1.3.1", "1.2.840.10008.1.2.2", 8, 5),
                                ("z", "1.2.840.10008.5.1.4.1.1.481.2", "1.2.840.10008.1.2.4.108", 8, 1)],
                               "calling_aet string, sop_class_uid string, transfer_syntax_uid string, bits_allocated int, number_of_frames int")
    got = df.select(R.calling_title_route("store_scu").alias("c"), R.object_type().alias("t"), R.transfer_syntax_route("Uncompressed").alias("u"),
                    R.sop_class_route("UncompressedSingleFrameImage").alias("s"), R.transfer_syntax_route("Value", "1.2.840.10008.1.2.99").alias("v"),
                    R.multiframe_ultrasound_reason().alias("m"), R.is_video().alias("video"), R.sop_class_route("*").alias("a")).collect()
    assert [r["c"] for r in got] == ["success", "failure", "failure", "failure", "failure"]
    assert [r["t"] for r in got] == ["UncompressedSingleFrameImage", "SRDocument", "EncapsulatedPDF", "CompressedMultiFrameImage", "Other"]
    assert [r["u"] for r in got] == ["success"] * 4 + ["failure"]
    assert [r["s"] for r in got][:2] == ["success", "failure"] and {r["v"] for r in got} == {"failure"}
    assert got[3]["m"] is None and "keine Ultrasound" in got[0]["m"] and got[4]["video"] and {r["a"] for r in got} == {"success"}


def test_thin_slices(spark):
    df = spark.createDataFrame([("0.5",), ("1.0",), ("1.01",), ("0",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(R.thin_slice_route("t")).collect()] == ["success", "success", "failure", "failure", "failure", "failure"]


def test_numbering_is_gapless(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 3000, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), "id")
    out = keyed.numbered(df, ["g"], "id", "i", "n")
    bad = out.groupBy("g").agg(F.count_distinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.max("n").alias("n")).filter("d <> n or lo <> 0 or hi <> n - 1")
    assert out.count() == 5000 and bad.count() == 0
    sizes = keyed.batched(df, ["g"], "id", 100).groupBy("g", "batch_no").count()
    assert sizes.agg(F.max("count")).first()[0] == 100


def test_salted_lookup_is_exact(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert keyed.lookup_join(left, right, ["k"], "id", how).count() == left.join(right, "k", how).count()


def test_find_answers(spark):
    req = spark.createDataFrame([("r1", "s1"), ("r2", "s1,b"), ("r3", "nope"), ("r4", " ")], "request_id string, content string")
    inst = spark.createDataFrame([("p", "s1", "a", "1", "c", "CT"), ("p", "s1", "a", "2", "c", "CT"), ("p", "s1", "b", "3", "c", "MR")],
                                 "patient_id string, study_uid string, series_uid string, sop_instance_uid string, sop_class_uid string, modality string")
    parsed = find.parsed_requests(req, find.SERIES)
    assert [r["route"] for r in parsed.orderBy("request_id").collect()] == ["success", "success", "success", "failure"]
    rows = find.answered(parsed, find.series_matches(inst), ["study_uid"], "series_uid", "series_uid").collect()
    by = {}
    for r in rows:
        by.setdefault(r["request_id"], []).append(r)
    assert sorted(r["match_index"] for r in by["r1"]) == [0, 1] and {r["match_count"] for r in by["r1"]} == {2}
    assert by["r2"][0]["series_related_instances"] == 1 and by["r3"][0]["route"] == "not found" and by["r3"][0]["match_count"] == 0
    study = find.study_matches(inst).first()
    assert study["modalities_in_study"] == ["CT", "MR"] and study["study_related_series"] == 2


def test_store_outcomes_and_summary(spark):
    codes = [0, 1, 0x0107, 0x0116, 0xB000, 0xBFFF, 0xA700, 0x0110, 0xC000]
    df = spark.createDataFrame([(c,) for c in codes], "s int")
    assert [r[0] for r in df.select(outcomes.store_outcome("s")).collect()] == ["SUCCESS"] + ["WARNING"] * 5 + ["FAILED"] * 3
    assert df.select(outcomes.status_hex("s")).collect()[4][0] == "B000"
    rows = [("b", 0, "SUCCESS", None, None), ("b", 1, "FAILED", "STORE_REJECTED", "C-STORE status A700: Out of resources"), ("b", 2, "FAILED", "STORE_REJECTED", "second"),
            ("b", 3, "FAILED", "NO_PRESENTATION_CONTEXT", "SOP Class 1.2.3 not accepted by X"), ("b", 4, "FAILED", None, None), ("ok", 0, "SUCCESS", None, None),
            ("long", 0, "FAILED", "ASSOCIATION_ABORTED", "x" * 1000)]
    got = {r["k"]: r["failure_summary"] for r in outcomes.failure_summary(spark.createDataFrame(rows, "k string, pos int, outcome string, error_code string, message string"), ["k"]).collect()}
    assert got["b"] == "STORE_REJECTED x2 (C-STORE status A700: Out of resources); NO_PRESENTATION_CONTEXT x1 (SOP Class 1.2.3 not accepted by X); UNKNOWN x1"
    assert got["ok"] is None and got["long"] == "ASSOCIATION_ABORTED x1 (" + "x" * 300 + "...)"


RETRIEVAL = dict(order_id=O, study_uid="1", series_uid="2", retrieve_id=RID, status="0000", finished="true", completed="5", failed="0", warning="0", remaining=None, expected=None, find_count_instances="5")


def retrievals(spark, *changes, extra=()):
    names = [*RETRIEVAL, *extra]
    return spark.createDataFrame([(i, *[{**RETRIEVAL, **c}.get(n) for n in names]) for i, c in enumerate(changes)], "i int, " + ", ".join(f"{n} string" for n in names))


def test_strict_gate(spark):
    cases = [({}, None), ({"status": " b000 "}, "C-GET not successful: status=B000, completed=5, failed=0, warning=0, remaining=-1"), ({"order_id": "x"}, "Invalid UUID string: x"),
             ({"finished": "no"}, "C-GET has no final response"), ({"completed": "0"}, "C-GET not successful: status=0000, completed=0, failed=0, warning=0, remaining=-1"),
             ({"remaining": "-2"}, "Invalid C-GET remaining counter: -2"), ({"expected": "-1"}, "Invalid expected instance count: -1"), ({"series_uid": " "}, "Missing required attribute: series_uid"),
             ({"failed": "x"}, 'For input string: "x"')]
    got = outcomes.strict_gate(retrievals(spark, *[c for c, _ in cases])).orderBy("i").collect()
    assert [r["gate_error"] for r in got] == [e for _, e in cases]
    assert got[0]["expected_instances"] == 5


def test_series_events(spark):
    ok = E.series_retrieved(retrievals(spark, {})).withColumn("j", E.event_json()).first()
    event = json.loads(ok["j"])
    assert list(event) == ["eventId", "eventType", "studyInstanceUid", "seriesInstanceUid", "retrieveId", "expectedInstances", "retrievedInstances", "completedInstances", "failedInstances", "warningInstances", "cgetStatus"]
    assert event["retrievedInstances"] == 5 and event["completedInstances"] == 0
    bad = [{"retrieve_id": None, "find_count": "0"}, {"get_error": "boom", "status": "zz", "completed": "-1", "error_comment": " ", "result_error": "late"}, {"retrieve_id": None}, {}]
    got = E.series_retrieve_failed(retrievals(spark, *bad, extra=["find_count", "find_error", "get_error", "error_comment", "result_error", "retrieve_source"])).orderBy("i").collect()
    assert got[0]["event"]["message"] == "C-FIND: series not found in PACS (0 matches)" and got[0]["failed_source"] == "C-FIND" and len(got[0]["event"]["retrieveId"]) == 36
    assert got[1]["event"]["message"] == "boom | late" and got[1]["event"]["cgetStatus"] is None and got[1]["event"]["retrievedInstances"] == 0
    assert got[2]["route"] == "failure" and got[3]["event"]["message"] == "C-GET failed without details"


def test_instance_events(spark):
    base = spark.createDataFrame([("a", O, RID, "1", "2", "orig", "STORE_REJECTED", "A700", "Out of resources", None), ("b", O, RID, "1", "2", None, None, None, None, "bad"), ("c", O, "x", "1", "2", None, None, None, None, None)],
                                 "sop_instance_uid string, order_id string, retrieve_id string, study_uid string, series_uid string, original_sop_uid string, store_error_code string, store_status string, store_error string, pseudonymizer_error string")
    got = {r["sop_instance_uid"]: r for r in E.instance_failed(base).collect()}
    assert got["a"]["event"]["errorMessage"] == "DICOM C-STORE fehlgeschlagen (STORE_REJECTED, Status A700): Out of resources" and got["a"]["event"]["errorCode"] == "STORE_FAILED"
    assert got["b"]["event"]["errorCode"] == "PSEUDONYMIZE_FAILED" and got["b"]["event"]["originalSopInstanceUid"] == "b"
    assert got["c"]["route"] == "failure" and got["a"]["batch_group"] == f"{O}:{RID}"
    rows = E.instance_completed(base).collect()
    assert sorted((r["sop_instance_uid"], r["callback_type"]) for r in rows) == [("a", "dicom"), ("a", "instance-event"), ("b", "original"), ("c", "original")]
    assert E.instance_completed(base, False).filter("event is not null").first()["event"]["eventId"] == E.instance_completed(base, False).filter("event is not null").first()["event"]["eventId"]


def test_package_failure_report(spark):
    cols = "i int, order_id string, retrieve_id string, study_uid string, series_uid string, zip_error_code string, zip_error_message string, http_status string, http_message string, http_url string, exception_class string, fragment_count string"
    rows = [(0, O, RID, "1", "2", "bad code", "m", "500", None, None, None, None), (1, O, RID, "1", "2", None, None, "404", "Not Found", "http://x", None, "3"), (2, O, RID, "1", "2", None, None, None, None, None, "java.X", None),
            (3, O, RID, "1", "2", None, None, "200", None, None, None, "7"), (4, O, RID, "1", "2", None, None, None, None, None, None, None)]
    got = E.package_failures(spark.createDataFrame(rows, cols)).orderBy("i").collect()
    assert [r["event"]["errorCode"] if r["event"] else None for r in got] == ["BAD_CODE", "MANIFEST_HTTP_404", "MANIFEST_UNREACHABLE", "ZIP_INCOMPLETE", None]
    assert got[1]["event"]["errorMessage"] == "ZIP manifest request failed: Not Found: http://x" and got[4]["route"] == "failure"


def test_event_batches(spark):
    ev = spark.range(250).select(F.lit(O).alias("order_id"), F.lit(RID).alias("retrieve_id"), F.struct(F.col("id").cast("string").alias("eventId"), F.lit(None).cast("string").alias("x")).alias("event"))
    got = E.event_batches(ev).collect()
    assert sorted(r["event_count"] for r in got) == [50, 100, 100]
    assert sum(len(json.loads(r["body"])["events"]) for r in got) == 250
    with pytest.raises(ValueError):
        E.event_batches(ev, 101)


def test_package_validation(spark):
    names = ["b.dcm", "a.dcm"]
    digest = hashlib.sha256("a.dcm\nb.dcm".encode()).hexdigest()
    pk = [("p1", O, 2, digest.upper()), ("p2", O, 2, None), ("p3", O, 2, "0" * 64), ("p4", "other", 2, None), ("p5", O, 2, None), ("p6", O, 3, None), ("p7", O, 2, None), ("p8", O, 2, None)]
    packs = spark.createDataFrame([(p, m, RID, O, RID, n, h) for p, m, n, h in pk], "package string, manifest_order_id string, manifest_retrieve_id string, order_id string, retrieve_id string, fragment_count int, entry_names_sha256 string")
    expected = spark.createDataFrame([(p[0], n) for p in pk for n in names] + [("p6", "c.dcm")], "package string, entry_name string")
    actual = {p[0]: names for p in pk} | {"p5": ["a.dcm", "a.dcm", "b.dcm"], "p7": ["a.dcm", "z.dcm"], "p8": ["a.dcm", "d/"]}
    act = spark.createDataFrame([(p, n) for p, ns in actual.items() for n in ns], "package string, entry_name string")
    got = {r["package"]: r for r in packages.validate_packages(packs, expected, act, ["package"]).collect()}
    assert got["p1"]["validated"] and got["p2"]["validated"]
    assert got["p3"]["error_message"] == "ZIP entry names do not match manifest (SHA-256 mismatch, 2 entries)"
    assert got["p4"]["error_message"] == "Manifest order/retrieval mismatch" and got["p5"]["error_message"] == "Duplicate ZIP entry: a.dcm"
    assert got["p6"]["error_message"] == "ZIP entry count mismatch: expected=3, actual=2"
    assert got["p7"]["error_message"] == "ZIP contents do not match manifest. Missing=[b.dcm], Unexpected=[z.dcm]" and got["p8"]["error_message"] == "Unexpected ZIP directory: d/"
    assert got["p7"]["error_code"] == "ZIP_VALIDATION_FAILED"


def test_name_digests_over_batches_and_key_types(spark):
    from datetime import date
    from decimal import Decimal
    rows = [(date(2024, 1, 1 + i % 3) if i % 4 else None, Decimal(i % 2), f"n{i % 90:03d}.dcm" if i % 50 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "day date, part decimal(5,1), entry_name string")
    want: dict = {}
    for day, part, entry in rows:
        if entry is not None:
            want.setdefault((day, part), set()).add(entry)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = packages.entry_name_digest(df, ["day", "part"]).collect()
            assert {(r["day"], r["part"]): (r["entry_count"], r["names_sha256"]) for r in got} == {
                k: (len(v), hashlib.sha256("\n".join(sorted(v)).encode()).hexdigest()) for k, v in want.items()}
            assert len(got) == len(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert packages.entry_name_digest(df.limit(0), ["day"]).count() == 0


def test_fragments_and_targets(spark):
    good = dict(originalSopInstanceUid="o", pseudonymSopInstanceUid="p", fragmentIndex=0, fragmentCount=2, zipEntryName="p.dcm")
    cases = [(good, None), ({**good, "originalSopInstanceUid": "x"}, "Original SOP Instance UID mismatch"), ({**good, "pseudonymSopInstanceUid": "x"}, "Pseudonym SOP Instance UID mismatch"),
             ({**good, "fragmentIndex": None}, "Missing ZIP fragment index/count"), ({**good, "fragmentIndex": 2}, "Invalid ZIP fragment index/count"), ({**good, "zipEntryName": "q.dcm"}, "ZIP filename does not match pseudonym SOP UID")]
    df = spark.createDataFrame([(i, json.dumps(c), "o", "p", "g") for i, (c, _) in enumerate(cases)], "i int, manifest_entry string, original_sop_uid string, sop_instance_uid string, package_group string")
    assert [r["error_message"] for r in packages.assign_fragments(df).orderBy("i").collect()] == [e for _, e in cases]
    target = dict(orderId=O.upper(), retrieveId=RID, deliveryType="DIRECTORY", directory="disk", folder="f", subfolder="s", fileName=RID + ".zip")
    cases = [(target, None), ({**target, "deliveryType": "DOWNLOAD"}, None), ({**target, "folder": "CON"}, "Invalid folder in zip-target"), ({**target, "directory": "a..b"}, "Invalid directory in zip-target"),
             ({**target, "fileName": O + ".zip"}, "Invalid fileName in zip-target"), ({**target, "orderId": RID}, "zip-target belongs to another order or retrieval"), ({**target, "deliveryType": "X"}, "Unsupported deliveryType in zip-target: X")]
    df = spark.createDataFrame([(i, O, RID, json.dumps(c)) for i, (c, _) in enumerate(cases)], "i int, order_id string, retrieve_id string, target string")
    assert [r["error_message"] for r in packages.delivery_targets(df).orderBy("i").collect()] == [e for _, e in cases]


def test_documents_and_projections(spark):
    df = spark.createDataFrame([("1.2.840.10008.5.1.4.1.1.104.1", bytearray(b"%PDF\0")), ("1.2.840.10008.5.1.4.1.1.104.2", bytearray(b"<x/>")), ("1.2", bytearray(b"z"))], "sop_class_uid string, bin binary")
    got = projections.extracted_documents(df).collect()
    assert [(r["extension"], bytes(r["document"]) if r["document"] else None, r["mime_type"], r["route"]) for r in got] == [
        (".pdf", b"%PDF", "application/pdf", "success"), (".xml", b"<x/>", "application/xml", "success"), (None, None, None, "failure")]
    assert projections.extracted_documents(df, dotted_mime=True).first()["mime_type"] == "application/.pdf"
    csv = spark.createDataFrame([("a", "b", "john o", "doe")], "c1 string, c2 string, c3 string, c4 string")
    assert projections.csv_columns_capitalised(csv, "c3", "c4").first()["line"] == "John o Doe"


def test_rows_without_a_tie_are_numbered_too(spark):
    from scanloom.operators import keyed

    df = spark.createDataFrame([("g", "a"), ("g", None), ("g", None), (None, "b")], "grp string, tie string")
    got = keyed.numbered(df, ["grp"], "tie", "n", "total").collect()
    assert sorted((r["grp"] or "", r["n"], r["total"]) for r in got) == [("", 0, 1), ("g", 0, 3), ("g", 1, 3), ("g", 2, 3)]
    assert all(r["tie"] is None for r in got if r["grp"] == "g" and r["n"] < 2)


def test_copies_of_the_right_side_are_never_broadcast_unseen(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2MB")
    try:
        left = spark.range(1000, numPartitions=2).select((F.col("id") % 7).alias("k"), "id")
        plan = keyed.lookup_join(left, spark.range(100_000).select(F.col("id").alias("k")), ["k"], "id")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    asked = spark.createDataFrame([("r1", "s1", None), ("r2", "s1", "b"), ("r3", None, None)], "request_id string, study_uid string, series_uid string")
    found = spark.createDataFrame([("s1", "a", 1), ("s1", "b", 2), (None, "c", 3)], "study_uid string, series_uid string, n int")
    out = find.matched(asked, found, ["study_uid"], "series_uid")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.request_id, r.n) for r in out.collect()) == [("r1", 1), ("r1", 2), ("r2", 2)]
