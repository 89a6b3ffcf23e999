"""Mask goldens: bytes, colour spaces, errors, region text, colours, lossy history."""

import pytest
from pyspark.sql import functions as F

from scanloom.functions import pixels as P
from scanloom.operators import masking as M


def frames(spark, *rows):
    data = [(sop, n, r, c, s, b, p, ph, be, bytearray(px)) for sop, n, r, c, s, b, p, ph, be, px in rows]
    return spark.createDataFrame(data, M.FRAME_SCHEMA)


def masked(df, region, colour=0, **kw):
    out = M.mask_frames(df, P.region_list(F.lit(region)), colour, **kw).orderBy("sop_instance_uid", "frame_no").collect()
    return [(list(r["pixels"]), r["route"], r["frame_error"]) for r in out]


def test_grey_frames(spark):
    df = frames(spark, ("a", 0, 2, 3, 1, 8, 0, "MONOCHROME2", False, [10, 11, 12, 13, 14, 15]), ("a", 1, 2, 3, 1, 8, 0, "MONOCHROME2", False, [20, 21, 22, 23, 24, 25, 99]))
    assert [m[0] for m in masked(df, "[1,0,1,1]")] == [[10, 0, 12, 13, 14, 15], [20, 0, 22, 23, 24, 25, 99]]
    assert [m[0] for m in masked(df, "[2,1,-1,1]", 7)] == [[10, 11, 12, 7, 7, 7], [20, 21, 22, 7, 7, 7, 99]]


def test_words_and_colour(spark):
    df = frames(spark, ("a", 0, 1, 2, 1, 16, 0, "MONOCHROME2", False, [1, 2, 3, 4]), ("b", 0, 1, 2, 1, 16, 0, "MONOCHROME2", True, [1, 2, 3, 4]),
                ("c", 0, 1, 2, 3, 8, 0, "RGB", False, [1, 2, 3, 4, 5, 6]), ("d", 0, 1, 2, 3, 8, 1, "RGB", False, [1, 2, 3, 4, 5, 6]),
                ("e", 0, 1, 2, 3, 8, 0, "YBR_FULL", False, [1, 2, 3, 180, 128, 128]))
    got = masked(df, "[1,0,1,1]", 0x0A0B0C)
    assert got[0][0] == [1, 2, 0x0C, 0x0B] and got[1][0] == [1, 2, 0x0B, 0x0C]
    assert got[2][0] == [1, 2, 3, 10, 11, 12] and got[3][0] == [1, 10, 3, 11, 5, 12]
    assert masked(df, "[1,0,1,1]", 0)[4][0] == [1, 2, 3, 0, 128, 128]


def test_errors_fail_the_object(spark):
    df = frames(spark, ("a", 0, 1, 2, 1, 8, 0, "MONOCHROME2", False, [1, 2]), ("a", 1, 1, 2, 1, 8, 0, "MONOCHROME2", False, [1]),
                ("b", 0, 1, 2, 3, 16, 0, "RGB", False, [0] * 12), ("c", 0, 1, 2, 3, 8, 0, "YBR_RCT", False, [0] * 6), ("d", 0, 1, 1, 1, 8, 0, "MONOCHROME2", False, [5]))
    got = masked(df, "[0,0,2,1]")
    assert [g[1] for g in got] == ["failure"] * 5
    assert got[0][0] == [1, 2]
    assert [g[2] for g in got[2:]] == ["colour frames need 8 BitsAllocated", "photometric interpretation not supported: YBR_RCT", "region outside the image"]


@pytest.mark.parametrize("text,count", [("[0,0,-1,80],[112,0,100,200]", 2), ("[1,2,3,4][5,6,7,8]", 2), (" , [ 1 , 2,3,4 ] ,", 1), ("[1,2,0,4]", None), ("[1,2,3,0]", None),
                                        ("[1,2,3]", None), ("[1,2,3,4],,[1,2,3,4]", None), ("x[1,2,3,4]", None), ("", None), ("[1,2,3,99999999999]", None), ("[-1,0,1,1]", None)])
def test_region_text(spark, text, count):
    got = spark.createDataFrame([(text,)], "v string").select(P.region_list("v").alias("r")).first()["r"]
    assert (None if got is None else len(got)) == count


@pytest.mark.parametrize("text,value,octal", [("0", 0, 0), ("16711680", 0xFF0000, 0xFF0000), ("0xff0000", 0xFF0000, 0xFF0000), ("#FF", 255, 255), ("010", 10, 8), ("16777216", None, None),
                                              ("-1", None, None), ("", None, None), ("#", None, None), ("0x1000000", None, None), ("zz", None, None), ("09", 9, None)])
def test_colours(spark, text, value, octal):
    r = spark.createDataFrame([(text,)], "v string").select(P.fill_colour("v").alias("a"), P.fill_colour("v", True).alias("b")).first()
    assert (r["a"], r["b"]) == (value, octal)


def test_lossy_bookkeeping(spark):
    df = spark.createDataFrame([("1.2.840.10008.1.2.4.50", None, None, None), ("1.2.840.10008.1.2.4.91", "01", ["9.00"], ["ISO_15444_1"]), ("1.2.840.10008.1.2.5", None, None, None)],
                               "transfer_syntax_uid string, lossy_flag string, ratios array<string>, methods array<string>")
    got = M.lossy_history(df, F.lit(100), F.lit(8)).collect()
    assert [(r["lossy_flag"], r["ratios"], r["methods"]) for r in got] == [("01", ["12.50"], ["ISO_10918_1"]), ("01", ["9.00"], ["ISO_15444_1"]), (None, None, None)]
    again = M.lossy_history(df, F.lit(100), F.lit(8), F.lit("1.2.840.10008.1.2.4.50"), F.lit(10)).collect()
    assert again[1]["ratios"] == ["9.00", "10.00"] and again[1]["methods"] == ["ISO_15444_1", "ISO_10918_1"]
    out = [r[0] for r in df.select(M.output_syntax(F.col("transfer_syntax_uid"))).collect()]
    assert out == ["1.2.840.10008.1.2.5"] * 3
