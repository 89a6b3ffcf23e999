import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scanloom.llm import lines

COLS = "doc_id long, text string, n_lines int, _doc string"


def brute(rows):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip("\x20\x09\x0a\x0b\x0c\x0d"))

    holders = defaultdict(set)
    number = lambda i: lines.NO_ID if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(number(i))
    out = []
    for i, text in rows:
        keep = [x for x in (text or "").split("\n") if key(x) not in holders or min(holders[key(x)]) == number(i)]
        out.append((i, (text or "").count("\n") + 1, (text or "").count("\n") + 1 - len(keep), "\n".join(keep)))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], COLS)
    got = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    assert got.columns == ["doc_id", "text", "n_lines", "_doc", "n_lines_", "n_dropped"]
    return sorted(((r.doc_id, r.n_lines_, r.n_dropped, r.text or "") for r in got.collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["short", "  A line of Text here\t", "a line of text here", "ÄÖ line of many words", "ÄÖ LINE of many words", "", "x" * 5000, "common line in most of them"]
    rows = [(i, "\n".join(rng.choice(pool + ["common line in most of them"] * 6) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(None, "common line in most of them\nalone in the null one"), (61, None), (62, ""), (3, rows[3][1]), (3, "another text of id three\na line of text here"), (63, "\n\n")]
    assert run(spark, rows) == brute(rows)


def test_line_of_all_documents_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(i, "the line which all have\nown line number %d" % (i % 40)) for i in range(400)]
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty(spark):
    assert run(spark, []) == []
