"""JSON and XML documents, reference repair, clean-pixel marks."""

import json
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F
from test_deid import elements

from scanloom.operators import documents as DOC
from scanloom.operators import masking as M
from scanloom.operators import rtrepair as R

A0, A1 = ("0040A730", "ContentSequence", 0), ("0040A730", "ContentSequence", 1)
B0 = ("0040A043", "ConceptNameCodeSequence", 0)
ROWS = [
    ((), "00080000", None, "UL", ["100"]), ((), "00080016", "SOPClassUID", "UI", ["1.2"]), ((), "00080008", "ImageType", "CS", ["A", "", "B\"q"]),
    ((), "00090010", None, "LO", ["TEST PRIVATE"]), ((), "00091010", None, "LO", ["private"]), ((), "00100010", "PatientName", "PN", ["Test^Patient=X"]),
    ((), "00100040", "PatientSex", "CS", []), ((), "0040A730", "ContentSequence", "SQ", []), ((A0,), "0040A040", "ValueType", "CS", ["TEXT"]),
    ((A0,), "0040A043", "ConceptNameCodeSequence", "SQ", []), ((A0, B0), "00080100", "CodeValue", "SH", ["1"]), ((A0, B0), "00080104", "CodeMeaning", "LO", ["m"]),
    ((A1,), "0040A043", "ConceptNameCodeSequence", "SQ", []), ((), "00081140", "ReferencedImageSequence", "SQ", []),
    ((), "00280010", "Rows", "US", ["512"]), ((), "00200013", "InstanceNumber", "IS", ["7"]), ((), "00180050", "SliceThickness", "DS", ["1.5"]),
    ((), "7FE00010", "PixelData", "OW", []), ((), "00189087", "DiffusionBValue", "FD", ["NaN", "Infinity", "2.5"])]


def test_json_document(spark):
    df = elements(spark, ROWS, binary={"PixelData": bytearray(b"\1\2\3")})
    doc = json.loads(DOC.to_json_documents(df).first()["json"])
    assert "00080000" not in doc and "00091010" not in doc and "00090010" not in doc
    assert doc["ImageType"] == {"vr": "CS", "Value": ["A", None, 'B"q']}
    assert doc["PatientName"]["Value"] == [{"Alphabetic": "Test^Patient", "Ideographic": "X"}]
    assert doc["PatientSex"] == {"vr": "CS"} and doc["ReferencedImageSequence"] == {"vr": "SQ"}
    assert doc["ContentSequence"]["Value"] == [
        {"ValueType": {"vr": "CS", "Value": ["TEXT"]}, "ConceptNameCodeSequence": {"vr": "SQ", "Value": [{"CodeValue": {"vr": "SH", "Value": ["1"]}, "CodeMeaning": {"vr": "LO", "Value": ["m"]}}]}},
        {"ConceptNameCodeSequence": {"vr": "SQ"}}]
    assert doc["Rows"]["Value"] == [512] and doc["InstanceNumber"]["Value"] == ["7"] and doc["SliceThickness"]["Value"] == ["1.5"]
    assert doc["DiffusionBValue"]["Value"] == [None, 1.7976931348623157e308, 2.5]
    assert doc["PixelData"]["BulkDataURI"] == "#7FE00010"
    full = json.loads(DOC.to_json_documents(df, tag_names=False, remove_private=False, numbers=True, bulk="inline").first()["json"])
    assert full["00091010"]["Value"] == ["private"] and full["00200013"]["Value"] == [7] and full["00180050"]["Value"] == [1.5]
    assert full["7FE00010"]["InlineBinary"] == "AQID"
    assert "PixelData" not in json.loads(DOC.to_json_documents(df, bulk="none").first()["json"])


def test_number_policy(spark):
    rows = [("IS", "9007199254740992"), ("IS", "12"), ("IS", "x"), ("DS", "1.25"), ("DS", "bad"), ("SV", "-5"), ("UV", "18446744073709551615"), ("SS", "-3"), ("LO", "5")]
    df = spark.createDataFrame(rows, "vr string, v string")
    got = [r["t"] for r in df.select(DOC.json_number("v", "vr", True).alias("t")).collect()]
    assert got == ['"9007199254740992"', "12", '"x"', "1.25", '"bad"', "-5", '"18446744073709551615"', "-3", '"5"']
    assert df.select(DOC.json_number("v", "vr").alias("t")).collect()[1]["t"] == '"12"'


def test_xml_document(spark):
    df = elements(spark, ROWS, binary={"PixelData": bytearray(b"\1\2\3")})
    root = ET.fromstring(DOC.to_xml_documents(df).first()["xml"].split("?>", 1)[1])
    named = {e.get("keyword") or e.get("tag"): e for e in root}
    assert root.tag == "NativeDicomModel"
    assert [v.get("number") for v in named["ImageType"]] == ["1", "3"]
    assert named["PatientName"].find("PersonName/Alphabetic/GivenName").text == "Patient"
    items = named["ContentSequence"].findall("Item")
    assert [i.get("number") for i in items] == ["1", "2"]
    assert items[0].find("DicomAttribute[@keyword='ConceptNameCodeSequence']/Item/DicomAttribute[@keyword='CodeMeaning']/Value").text == "m"
    assert named["PixelData"].find("BulkData") is not None


def test_reference_repair(spark):
    p = (("30060010", "ReferencedFrameOfReferenceSequence", 0), ("30060012", "RTReferencedStudySequence", 0), ("30060014", "RTReferencedSeriesSequence", 0))
    rows = [((), "00080016", "SOPClassUID", "UI", ["1"]), (p, "0020000E", "SeriesInstanceUID", "UI", ["1.5"]), (p, "00081155", "ReferencedSOPInstanceUID", "UI", ["1.6"])]
    df = elements(spark, rows, "a").unionByName(elements(spark, rows[:1], "b"))
    assert {r["sop_instance_uid"]: r["route"] for r in R.reference_routes(df).collect()} == {"a": "success", "b": "failure"}
    series = spark.createDataFrame([("a", "9.9"), ("b", "9.9")], "sop_instance_uid string, series_uid string")
    out = R.set_reference(df, series)
    assert {r["sop_instance_uid"] for r in out.collect()} == {"a"} and out.count() == 3
    assert out.filter("keyword = 'SeriesInstanceUID'").first()["values"] == ["9.9"]
    assert R.remap_reference(df).filter("keyword = 'SeriesInstanceUID'").first()["values"][0].startswith("2.25.")
    bare = elements(spark, [rows[0], rows[2]], "a")  # the path without the attribute
    added = R.set_reference(bare, series).filter("keyword = 'SeriesInstanceUID'").collect()
    assert [(r["tag"], r["vr"], r["values"], len(r["item_path"])) for r in added] == [("0020000E", "UI", ["9.9"], 3)]
    assert R.set_reference(bare, series).count() == 3 and R.remap_reference(bare).count() == 0


def test_mark_clean_pixels_once(spark):
    df = elements(spark, [((), "00080016", "SOPClassUID", "UI", ["1"]), ((), "00280301", "BurnedInAnnotation", "CS", ["YES"])], "a")
    todo = df.select("sop_instance_uid").distinct()
    once = M.mark_clean_pixels(df, todo)
    twice = M.mark_clean_pixels(once, todo)
    for out in (once, twice):
        assert out.filter("keyword = 'BurnedInAnnotation'").first()["values"] == ["NO"]
        assert out.filter("keyword = 'CodeValue'").count() == 1
    assert twice.count() == once.count() == 6


def test_xml_of_shared_prefix_items(spark):
    """Leaving two levels at once and entering the next item of the outer sequence."""
    deep = [((), "0040A730", "ContentSequence", "SQ", []), ((A0,), "0040A043", "ConceptNameCodeSequence", "SQ", []), ((A0, B0), "00080100", "CodeValue", "SH", ["x"]),
            ((A1,), "0040A043", "ConceptNameCodeSequence", "SQ", []), ((A1, B0), "00080100", "CodeValue", "SH", ["y"]), ((), "0040A732", "Other", "LO", ["z"])]
    doc = json.loads(DOC.to_json_documents(elements(spark, deep)).first()["json"])
    assert [i["ConceptNameCodeSequence"]["Value"][0]["CodeValue"]["Value"] for i in doc["ContentSequence"]["Value"]] == [["x"], ["y"]]
    assert doc["Other"]["Value"] == ["z"] and F is not None


def test_documents_in_stated_tasks(spark):
    rows = [((), "0040A730", "ContentSequence", "SQ", []), ((A0,), "00080100", "CodeValue", "SH", ["x"]), ((A1,), "00080100", "CodeValue", "SH", ["y"]), ((), "0040A732", "Other", "LO", ["z"])]
    df = elements(spark, rows, "a").unionByName(elements(spark, rows[::-1], "b"))
    for build in (DOC.to_json_documents, DOC.to_xml_documents):
        dealt = build(df, tasks=13)
        assert dealt.rdd.getNumPartitions() == 13
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, build(df).collect()))
