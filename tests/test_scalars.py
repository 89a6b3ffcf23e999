"""Scalar goldens: date shifts, remapped UIDs, ids, validators."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from scanloom.functions import dates, identifiers, text

DA = [("20200131", 10, "20200210"), ("20200101", -1, "20191231"), ("20200228", 1, "20200229"), ("20210228", 1, "20210301"), ("20200229", -81, "20191210"), ("2020.01.01", 9, "20200110"),
      (" 20200101 ", 1, "20200102"), ("20200101-20200201", 10, "20200111-20200211"), ("20200101 - 2020.02.01", 10, "20200111-20200211"), ("20200101-", 1, "20200102-"), ("-20200101", 1, "-20200102"),
      ("-", 1, ""), ("--", 1, ""), ("20200101-xx", 1, ""), ("20200230", 1, ""), ("2020", 1, ""), ("2020.1.01", 1, ""), ("abcdefgh", 1, ""), ("20200101\n2", 1, ""), ("99991231", 1, ""), ("00010101", -1, "00001231"),
      ("", 1, ""), (None, 1, "")]
DT = [("20200101233059.123456+0100", -1, "20191231233059.123456+0100"), ("2020010112", 10, "2020011112"), ("20200101-0500", 10, "20200111-0500"), ("20200101", 1, "20200102"), ("2020", 1, ""), ("202003", 1, ""),
      ("2020-01-01", 1, ""), (None, 1, "")]


@pytest.mark.parametrize("fn,cases", [(dates.shift_da, DA), (dates.shift_dt, DT)])
def test_shifts(spark, fn, cases):
    df = spark.createDataFrame(cases, "v string, d int, e string")
    assert [(r["v"], r["o"]) for r in df.withColumn("o", fn("v", F.col("d"))).collect()] == [(v, e) for v, _, e in cases]


def test_shifted_values(spark):
    df = spark.createDataFrame([("DA", ["20200101", "x", None], -42), ("DA", ["x"], 1), ("DA", [], 1), ("TM", ["101500"], 1), ("DA", ["20200101"], 0), ("DT", ["20200101+0100"], 1), ("DA", ["20200101"], None)], "vr string, v array<string>, d int")
    got = [r[0] for r in df.select(dates.shifted_values("v", "vr", F.col("d"))).collect()]
    assert got == [["20191120", None, None], [], [], ["101500"], ["20200101"], ["20200102+0100"], ["20200101"]]


def test_shift_range(spark):
    df = spark.createDataFrame([(36500,), (-36500,), (36501,), (-2147483648,), (None,)], "d int")
    assert [r[0] for r in df.select(dates.shift_in_range("d")).collect()] == [True, True, False, False, False]


def test_remapped_uids_and_ids(spark):
    uids = [f"1.2.3.{i * 7919}" for i in range(500)]
    rows = spark.createDataFrame([(u,) for u in uids], "u string").select("u", identifiers.remap_uid("u").alias("r"), identifiers.name_uuid("u").alias("n"), identifiers.event_id(F.lit(" "), "u").alias("e")).collect()
    for r in rows:
        h = bytearray(hashlib.md5(r["u"].encode()).digest())
        h[6], h[8] = (h[6] & 0x0F) | 0x30, (h[8] & 0x3F) | 0x80
        assert r["r"] == "2.25." + str(int.from_bytes(h, "big")) and len(r["r"]) <= 64
        assert r["n"] == r["e"] == str(uuid.UUID(bytes=bytes(h)))
    assert spark.range(1).select(identifiers.remap_uid(F.lit(None).cast("string")).alias("r")).first()["r"] is None


def test_text_helpers(spark):
    df = spark.createDataFrame([("\t x \r\n",), ("",), (None,)], "v string")
    assert [tuple(r) for r in df.select(text.trimmed("v"), text.is_blank("v"), text.blank_to_null("v")).collect()] == [("x", False, "x"), ("", True, None), (None, True, None)]
    names = spark.createDataFrame([("CON",), ("con.txt",), ("a..b",), ("ok_1",), ("COM10",), ("ok\n",)], "v string")
    assert [r[0] for r in names.select(text.path_segment_ok("v", text.FOLDER_PATTERN)).collect()] == [False, False, False, True, True, False]
    messages = df.select(text.joined_messages(F.col("v"), F.lit(" "), F.lit("b")).alias("a"), text.joined_messages(F.lit(None).cast("string"), default="none").alias("b")).collect()
    assert messages[1]["a"] == "b" and messages[1]["b"] == "none"
