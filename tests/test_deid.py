"""De-identification goldens: profile actions, nested rules, retain, shift, markers."""

import pytest
from pyspark.sql import functions as F

from scanloom.operators import deid as D

TRACER = ("00540016", "RadiopharmaceuticalInformationSequence", 0)
SOP = "2.25.503"

SAMPLE = [
    ((), "00080016", "SOPClassUID", "UI", ["1.2.840.10008.5.1.4.1.1.20"]),
    ((), "00080018", "SOPInstanceUID", "UI", [SOP]),
    ((), "0020000D", "StudyInstanceUID", "UI", ["2.25.501"]),
    ((), "0020000E", "SeriesInstanceUID", "UI", ["2.25.502"]),
    ((), "00100010", "PatientName", "PN", ["Marsh^Lee"]),
    ((), "00100020", "PatientID", "LO", ["K-77"]),
    ((), "00100040", "PatientSex", "CS", ["O"]),
    ((), "00101030", "PatientWeight", "DS", ["71"]),
    ((), "00080020", "StudyDate", "DA", ["20231005"]),
    ((), "00080021", "SeriesDate", "DA", ["20231006"]),
    ((), "00080030", "StudyTime", "TM", ["080000"]),
    ((), "00400244", "PerformedProcedureStepStartDate", "DA", ["20231007"]),
    ((), "00080022", "AcquisitionDate", "DA", ["20231008"]),
    ((), "00080023", "ContentDate", "DA", ["20231008"]),
    ((), "0008002A", "AcquisitionDateTime", "DT", ["20231008070605-0330"]),
    ((), "00080201", "TimezoneOffsetFromUTC", "SH", ["-0330"]),
    ((), "0018700A", "DetectorID", "SH", ["D9"]),
    ((), "00540016", "RadiopharmaceuticalInformationSequence", "SQ", []),
    ((TRACER,), "00181078", "RadiopharmaceuticalStartDateTime", "DT", ["20231009113000"]),
]


def elements(spark, rows, sop=SOP, binary=None):
    data = [(sop, [{"tag": t, "keyword": k, "item": i} for t, k, i in path], tag, kw, vr, None, values,
             (binary or {}).get(kw), n) for n, (path, tag, kw, vr, values) in enumerate(rows)]
    return spark.createDataFrame(data, D.ELEMENT_SCHEMA)


def run(df, days=None, retain=None, plan=None, identity=True):
    header = D.header_of(df).withColumn("days", F.lit(days).cast("int"))
    if identity:
        header = header.withColumn("pseudonym_pid", F.lit("PS-1")).withColumn("pseudonym_name", F.lit("PS^1"))
    out = D.deidentify(df, header, plan, retain, "SITE").collect()
    return {(tuple((p["keyword"], p["item"]) for p in r["item_path"]), r["keyword"]): r for r in out}, out


def value(result, keyword, path=()):
    row = result.get((path, keyword))
    return None if row is None else list(row["values"])


def test_shift_keeps_and_moves_dates(spark):
    r, _ = run(elements(spark, SAMPLE), 100)
    moved = {"StudyDate": "20240113", "SeriesDate": "20240114", "PerformedProcedureStepStartDate": "20240115", "AcquisitionDate": "20240116",
             "ContentDate": "20240116", "AcquisitionDateTime": "20240116070605-0330", "StudyTime": "080000"}
    assert {k: value(r, k)[0] for k in moved} == moved
    assert value(r, "RadiopharmaceuticalStartDateTime", (("RadiopharmaceuticalInformationSequence", 0),)) == ["20240117113000"]
    assert value(r, "PatientSex") == [] and value(r, "PatientWeight") is None
    assert value(r, "TimezoneOffsetFromUTC") is None and value(r, "DetectorID") == ["REMOVED"]
    assert value(r, "PatientID") == ["PS-1"] and value(r, "PatientName") == ["PS^1"] and value(r, "IssuerOfPatientID") == ["SITE"]
    assert value(r, "SeriesInstanceUID")[0].startswith("2.25.") and value(r, "SeriesInstanceUID") != ["2.25.502"]
    assert value(r, "LongitudinalTemporalInformationModified") == ["MODIFIED"]
    assert sorted(x["values"][0] for k, x in r.items() if k[1] == "CodeValue") == ["113100", "113107"]


@pytest.mark.parametrize("days", [0, None])
def test_without_shift_dates_go(spark, days):
    r, _ = run(elements(spark, SAMPLE), days)
    assert value(r, "StudyDate") == [] and value(r, "AcquisitionDate") == [] and value(r, "StudyTime") == []
    assert value(r, "SeriesDate") is None and value(r, "PerformedProcedureStepStartDate") is None and value(r, "PatientWeight") is None
    assert value(r, "ContentDate") == ["19991111"] and value(r, "AcquisitionDateTime") == ["19991111111111"]
    assert value(r, "LongitudinalTemporalInformationModified") == ["REMOVED"]
    assert [x["values"][0] for k, x in r.items() if k[1] == "CodeValue"] == ["113100"]


def test_retained_values(spark):
    r, _ = run(elements(spark, SAMPLE), 100, "AcquisitionDate")
    assert value(r, "AcquisitionDate") == ["20240116"]
    r, _ = run(elements(spark, SAMPLE), 100, "PatientWeight")
    assert value(r, "PatientWeight") == ["71"] and value(r, "PatientSex") == []
    r, _ = run(elements(spark, SAMPLE), 0, "AcquisitionDate, SOPInstanceUID, NoSuchKeyword, StudyInstanceUID")
    assert value(r, "AcquisitionDate") == ["20231008"] and value(r, "SOPInstanceUID") == [SOP]
    assert value(r, "StudyInstanceUID")[0].startswith("2.25.") and value(r, "StudyInstanceUID") != ["2.25.501"]  # always remapped


def test_basic_profile_actions(spark):
    device = ("30100080", "PrescriptionNotesSequence", 0)
    request = ("00400275", "RequestAttributesSequence", 0)
    rows = [
        ((), "00081195", "TransactionUID", "UI", ["2.25.88"]), ((), "0040A13A", "ReferencedDateTime", "DT", ["20220202020202"]),
        ((), "30100080", "PrescriptionNotesSequence", "SQ", []), ((device,), "00080104", "CodeMeaning", "LO", ["Okafor"]),
        ((), "00400275", "RequestAttributesSequence", "SQ", []), ((request,), "00400007", "ScheduledProcedureStepDescription", "LO", ["Okafor"]),
        ((), "0072006D", "SelectorUNValue", "UN", []), ((), "00420011", "EncapsulatedDocument", "OB", []),
        ((), "00131010", None, "LO", ["OWN"]), ((), "50003000", "CurveData", "OW", []), ((), "00280004", "PhotometricInterpretation", "CS", ["RGB"]),
    ]
    r, out = run(elements(spark, rows, binary={"EncapsulatedDocument": bytearray(b"x"), "SelectorUNValue": bytearray(b"yz")}), identity=False)
    assert value(r, "ReferencedDateTime") == ["19991111111111"]
    assert value(r, "TransactionUID")[0] not in (None, "2.25.88")
    assert value(r, "PrescriptionNotesSequence") == [] and value(r, "RequestAttributesSequence") is None
    assert not any("Okafor" in (x["values"] or []) for x in out)
    assert {bytes(r[((), k)]["bin"]) for k in ("EncapsulatedDocument", "SelectorUNValue")} == {bytes(8)}
    assert not any(x["tag"] in ("00131010", "50003000") for x in out)
    assert value(r, "PhotometricInterpretation") == ["RGB"]
    r, _ = run(elements(spark, rows[1:2]), plan=D.ActionPlan.default(D.Profile(dates="modified")), identity=False)
    assert value(r, "ReferencedDateTime") == ["20220202020202"]


def test_retained_sequences_and_first_value(spark):
    frame = ("30060010", "ReferencedFrameOfReferenceSequence", 0)
    study = ("30060012", "RTReferencedStudySequence", 0)
    rows = [
        ((), "30060010", "ReferencedFrameOfReferenceSequence", "SQ", []),
        ((frame,), "00200052", "FrameOfReferenceUID", "UI", ["1.9"]),
        ((frame,), "30060012", "RTReferencedStudySequence", "SQ", []),
        ((frame, study), "00081155", "ReferencedSOPInstanceUID", "UI", ["1.7"]),
        ((frame, study), "00091001", None, "LO", ["private kept inside a restored sequence"]),
        ((), "00080008", "ImageType", "CS", ["A", "B"]),
    ]
    df = elements(spark, rows)
    r, out = run(df, 0, "RTReferencedStudySequence, ImageType", identity=False)
    inner = (("ReferencedFrameOfReferenceSequence", 0), ("RTReferencedStudySequence", 0))
    assert value(r, "ReferencedSOPInstanceUID", inner) == ["1.7"]
    assert any(x["tag"] == "00091001" for x in out)
    assert value(r, "FrameOfReferenceUID", inner[:1])[0].startswith("2.25.")
    assert value(r, "ImageType") == ["A"]
    r, _ = run(df, 0, "ReferencedFrameOfReferenceSequence", identity=False)
    assert value(r, "FrameOfReferenceUID", inner[:1])[0].startswith("2.25.")  # no action: items are processed
    assert value(r, "ReferencedSOPInstanceUID", inner) is None


def test_pet_correction_and_options(spark):
    rows = [((), "00080016", "SOPClassUID", "UI", ["1.2.840.10008.5.1.4.1.1.128"]), ((), "00080021", "SeriesDate", "DA", ["20200101"]),
            ((), "00080080", "InstitutionName", "LO", ["Clinic"]), ((), "00181000", "DeviceSerialNumber", "LO", ["9"]),
            ((), "00100020", "PatientID", "LO", ["P"]), ((), "00080018", "SOPInstanceUID", "UI", ["1.2.3"])]
    df = elements(spark, rows)
    r, _ = run(df, None, "SeriesDate", identity=False)
    assert value(r, "SeriesDate") == ["19991111"] and value(r, "SeriesTime") == ["111111"]
    assert value(r, "InstitutionName") == ["REMOVED"] and value(r, "DeviceSerialNumber") == ["REMOVED"] and value(r, "PatientID") == []
    full = D.ActionPlan.default(D.Profile(True, True, True, "full", True))
    r, out = run(df, None, plan=full, identity=False)
    assert value(r, "SeriesDate") == ["20200101"] and value(r, "InstitutionName") == ["Clinic"]
    assert value(r, "DeviceSerialNumber") == ["9"] and value(r, "SOPInstanceUID") == ["1.2.3"]
    assert len(value(r, "PatientID")[0]) == 36
    assert value(r, "LongitudinalTemporalInformationModified") == ["UNMODIFIED"]
    assert [x["values"][0] for x in sorted(out, key=lambda x: x["item_path"][0]["item"] if x["item_path"] else -1) if x["keyword"] == "CodeValue"] == [
        "113100", "113106", "113109", "113112", "113110"]


def test_lookup_routes_and_first_row(spark):
    header = spark.createDataFrame([("s1", "p1"), ("s2", "p2"), ("s3", ""), ("s4", "p4")], "sop_instance_uid string, patient_id string")
    table = spark.createDataFrame([(2, "p1", "B", "2", 7), (1, "p1", "A", "1", 5), (3, "p4", "C", "4", 40000)], "id int, pid string, prefix string, postfix string, date_shift int")
    rows = {r["sop_instance_uid"]: r for r in D.lookup_pseudonyms(header, table, ["id"]).collect()}
    assert rows["s1"]["pseudonym_pid"] == "A-1" and rows["s1"]["pseudonym_name"] == "A^1" and rows["s1"]["days"] == 5
    assert [rows[s]["error_message"] for s in ("s1", "s2", "s3", "s4")] == [None, "No results found", "PID is not found", "Date shift out of range"]


def test_attribute_checks_in_order(spark):
    rows = [("a", "P", "N", "x"), ("b", " ", "N", "1"), ("c", "P", "N", "36501"), ("d", "P", "N", None), ("e", "P", "N", "-36500")]
    df = spark.createDataFrame(rows, "sop_instance_uid string, pseudonym_pid string, pseudonym_name string, date_shift_text string")
    df = df.withColumn("patient_id", F.lit("1")).withColumn("study_uid", F.lit("1")).withColumn("series_uid", F.lit("1"))
    got = {r["sop_instance_uid"]: r["error_message"] for r in D.attribute_pseudonym_checks(df).collect()}
    assert got == {"a": "Invalid pseudonymization property value", "b": "Missing pseudonym PID or name", "c": "Invalid date shift", "d": "Invalid date shift", "e": None}


def test_no_original_date_survives_a_shift(spark):
    df = elements(spark, SAMPLE)
    header = D.header_of(df).withColumn("days", F.lit(-42))
    after = D.deidentify(df, header)
    assert D.surviving_values(df, after, ["StudyDate", "SeriesDate", "ContentDate", "StudyInstanceUID", "SOPInstanceUID"]).count() == 0


def test_every_entry_of_the_lists(spark):
    """Each entry under each choice of dates, with its own type, an unknown one and none; what no list names stays."""
    from scanloom.functions import actions as A

    names = sorted({e[0] for e in A.named_actions()}) + ["Modality", "ObserverType", "OtherStudyNumbers", "VisitStatusID", "FiducialDescription"]
    rank = "XZDU"
    for dates in ("removed", "modified", "full"):
        plan = D.ActionPlan.default(D.Profile(dates=dates))
        want = {}
        for keyword, action, grp, temporal in A.named_actions():
            stays = grp == "dates" and (dates == "full" or dates == "modified" and temporal)
            if not stays and rank.index(action) < rank.index(want.get(keyword, "U")) + (keyword not in want):
                want[keyword] = action
        for vr in ("DA", "UN", None):
            df = elements(spark, [((), "00081111", n, vr, ["20200101"]) for n in names])
            got = {r["keyword"]: r["action"] for r in D.annotate_actions(df.withColumn("tag", F.lit("00080001")), plan).collect()}
            assert got == {n: want.get(n) for n in names}


def test_key_is_replaced_and_a_leak_is_seen(spark):
    df = elements(spark, SAMPLE)
    header = D.header_of(df).withColumn("days", F.lit(-42))
    after = D.deidentify(df, header)
    mapping = D.result_uids(header).first()
    assert {r["sop_instance_uid"] for r in after.collect()} == {mapping["new_sop_instance_uid"]} != {SOP}
    leaky = after.withColumn("sop_instance_uid", F.lit(SOP))
    assert D.surviving_values(df, leaky, ["SOPInstanceUID"]).count() == 1
    kept = D.deidentify(df, header, retain="SOPInstanceUID")
    assert {r["sop_instance_uid"] for r in kept.collect()} == {SOP}


UNTYPED = [("SeriesDate", "UN", ["20231006"]), ("AcquisitionDate", None, ["20231008"]), ("AcquisitionDateTime", "UN", ["20231008070605-0330"]), ("DateOfLastCalibration", "UN", ["20230101", "20230102"]),
           ("HL7DocumentEffectiveTime", None, ["20231009"]), ("ContentDate", "SH", ["20231010"]), ("IssueDateOfImagingServiceRequest", "UN", ["not a date"])]


@pytest.mark.parametrize("in_bytes", [False, True])
def test_dates_without_type_are_shifted(spark, in_bytes):
    """At the root and inside a sequence, as values or as the bytes of an unknown type."""
    nested = ("00400555", "AcquisitionContext2Sequence", 0)
    df = elements(spark, [*SAMPLE[:4], *[((), f"0040{i:04X}", k, vr, v) for i, (k, vr, v) in enumerate(UNTYPED)],
                          *[((nested,), f"0042{i:04X}", k, vr, v) for i, (k, vr, v) in enumerate(UNTYPED)]])
    if in_bytes:
        dates = F.col("keyword").isin([k for k, *_ in UNTYPED])
        df = df.withColumn("bin", F.when(dates, F.encode(F.concat(F.array_join("values", "\\"), F.lit("\0")), "ISO-8859-1"))).withColumn("values", F.when(dates, F.array().cast("array<string>")).otherwise(F.col("values")))
    header = D.header_of(df).withColumn("days", F.lit(-42))
    rows = D.apply_rules(df, header, D.ActionPlan([])).filter(F.col("keyword").isin([k for k, *_ in UNTYPED])).collect()
    got = {(r["keyword"], len(r["item_path"])): (r["vr"], r["values"], r["bin"]) for r in rows}
    want = {"SeriesDate": ("DA", ["20230825"], None), "AcquisitionDate": ("DA", ["20230827"], None), "AcquisitionDateTime": ("DT", ["20230827070605-0330"], None),
            "DateOfLastCalibration": ("DA", ["20221120", "20221121"], None), "HL7DocumentEffectiveTime": ("DT", ["20230828"], None), "ContentDate": ("DA", ["20230829"], None),
            "IssueDateOfImagingServiceRequest": ("DA", [], None)}
    assert got == {(k, depth): v for k, v in want.items() for depth in (0, 1)}
    leaks = D.surviving_values(df, D.apply_rules(df, header, D.ActionPlan([])), [k for k, *_ in UNTYPED])
    assert leaks.collect() == []


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    from scanloom.sources import instances

    df = elements(spark, SAMPLE)
    for name, rows in (("clustered_elements", df), ("clustered_index", D.header_of(df))):
        instances.write_clustered(rows, name, 4, path=f"{tmp_path}/{name}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = D.anonymise(spark.table("clustered_elements"), spark.table("clustered_index"), issuer="SITE")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and plan.count("clustered_elements") == 1
    assert sorted(map(str, out.collect())) == sorted(map(str, D.anonymise(df, issuer="SITE").collect()))
    for name in ("clustered_elements", "clustered_index"):
        spark.sql(f"DROP TABLE {name}")


def test_header_is_dealt_into_stated_tasks(spark):
    """Instances go to as many tasks as asked for, not to the session's shuffle partitions, with the same rows."""
    df = elements(spark, SAMPLE, "a").unionByName(elements(spark, SAMPLE[1:], "b")).unionByName(elements(spark, SAMPLE[:1], None))
    plain, dealt = D.header_of(df), D.header_of(df, 13)
    assert dealt.rdd.getNumPartitions() == 13
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect())) and dealt.count() == 2


def test_rules_follow_the_tasks_of_the_header(spark):
    header = D.header_of(elements(spark, SAMPLE), 13).withColumn("days", F.lit(None).cast("int"))
    assert D.apply_rules(elements(spark, SAMPLE), header, D.ActionPlan.default()).rdd.getNumPartitions() == 13


def test_tasks_of_registered_queries_grow_with_the_instances(spark, tmp_path, monkeypatch):
    from scanloom.plans import queries_deid, registry

    rows = spark.range(60).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice", "timestamp '2020-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(registry, "INSTANCES_A_TASK", 5)
    header = queries_deid._header(lambda name: registry.table(spark, str(tmp_path), name))
    assert header.rdd.getNumPartitions() == 12 and header.count() == 60
