import numpy as np

from scanloom.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = Q.op10(spark, SF).join(Q.documents(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_measures():
    m = dict(zip(Q.MEASURES, Q.measures(["Ab cd!! ### 12 Ab\nx\nx."]).T[:, 0]))
    assert m["words"] == 7 and m["lines"] == 3 and m["repeated_lines"] == 0
    assert np.isclose(m["loose_marks"], 1 / 7) and np.isclose(m["distinct"], 6 / 7) and np.isclose(m["top_word"], 2 / 7)
    assert np.isclose(m["capitals"], 2 / 8) and np.isclose(m["open_ends"], 2 / 3)
    assert not Q.measures([None, ""]).any()


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a", 1), (None, "", None, 1), (2, "w " * 20000, "a", 1), (2, "w " * 20000, "a", 1), (3, "plain text here.", "b", 1)], "doc_id long, text string, source string, label int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.classify(docs, none, rounds=1).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.keep for r in got)
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert Q.classify(docs, labels, held_out_fold=None, rounds=2).count() == 5
    assert Q.classify(docs.limit(0), labels, rounds=1).count() == 0
