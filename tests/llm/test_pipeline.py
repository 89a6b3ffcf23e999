"""Each stage of the pipeline against a brute-force version on a small table with planted cases, and the edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from scanloom.llm import decontaminate, lines
from tests_llm_helpers import brute_components, brute_lines, library_ids

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(k, n=60):
    return " ".join("w" + hashlib.md5(b"%d %d" % (k, i)).hexdigest()[:5] for i in range(n))


ITEM = prose(900, 30)
SHARED = "a line that several of the documents hold"


def planted():
    texts = {
        1: prose(1), 2: prose(1), 3: prose(1).replace(prose(1).split()[30], "other"), 4: prose(4) + "\n" + SHARED, 5: prose(5) + "\n" + SHARED.upper() + "  ",
        6: prose(6) + " " + ITEM + " " + prose(61, 5), 7: prose(7) + "\n" + ITEM[:-4] + "zz" + ITEM[-2:], 8: prose(8) + " idiot moron trash scum", 9: prose(9) + " 1d10t m0r0n loser trash",
        10: None, 11: "", 12: "one", 13: "one", 14: prose(14, 4000), None: prose(15), 16: prose(16),
    }
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()] + [(16, prose(16), "en", "s", 1)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("in"))
    spark.createDataFrame(planted(), SCHEMA).write.parquet(f"{root}/documents.parquet")
    toxic = ["idiot moron", "trash scum loser", "idiot trash", "moron scum", "loser idiot"]
    rows = [(1000 + i, prose(1000 + i, 20) + (" " + toxic[i % 5] if i % 2 else ""), i % 2) for i in range(120)]
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").write.parquet(f"{root}/more.parquet")
    spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def documents(spark, folder):
    more = spark.read.parquet(f"{folder}/more.parquet").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("t").alias("source"), F.length("text").cast("long").alias("n_chars"))
    return spark.read.parquet(f"{folder}/documents.parquet").union(more)


def test_stages(spark, folder, tmp_path):
    docs = documents(spark, folder)
    for k, (name, stage) in enumerate(P.STAGES):
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = [tuple(r) for r in docs.collect()]
        ids = {r[0] for r in after}
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            assert {1, 2, 10, 11, 12, 14, 16, None} <= ids and not {8, 9} & ids
            assert not any(i in ids for i in range(1001, 1120, 2)) and all(i in ids for i in range(1000, 1120, 2))
        elif name == "line_dedup":
            assert sorted((r[0] is None, r[0], r[1] or "") for r in after) == sorted((i is None, i, t) for i, _, _, t in brute_lines([r[:2] for r in before]))
            assert all(r[4] == (None if r[1] is None else len(r[1])) or r[0] == 16 for r in after)
        elif name == "near_duplicates":
            lead = {c for i, n, c in brute_components([r[:2] for r in before], 5, 80) if n and c is not None}
            keep = [r for r in before if not (r[1] or "").split() or r[0] in lead or r[0] is None]
            assert sorted(map(repr, after)) == sorted(map(repr, keep))
        elif name == "decontamination":
            dirty = [r for r in before if r[1] and ITEM[:40] in r[1]]
            assert sorted(map(repr, after)) == sorted(map(repr, [r for r in before if r not in dirty])) and len(dirty) == 2
        else:
            assert sorted((repr(r[0]), r[4]) for r in after) == sorted((repr(r[0]), library_ids(r[1] or "")) for r in before)


def test_empty_table(spark, folder):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    rows = P.run(spark, sf).collect()
    given = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.4 * given < len(rows) < given and all(r.n_tokens == len(r.ids) for r in rows)


def near(k):
    return prose(k).replace(prose(k).split()[30], "other")


def test_near_duplicates_by_row(spark):
    """Ids that are null or repeated do not take other texts with them; one document of each group stays."""
    rows = [
        (1, prose(1)), (None, near(1)), (None, prose(2)), (None, prose(3)), (None, near(3)), (5, prose(5)), (7, near(5)), (7, prose(7)), (8, near(7)),
        (9, prose(9)), (9, prose(9)), (9, prose(10)), (None, prose(11)), (None, prose(11)), (12, None), (None, ""), (None, ""), (12, " "),
        (20, prose(20)), (20, near(20)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in P.drop_near_duplicates(spark, docs, "").collect()]
    one_of = [r for r in got if r in {(None, prose(3)), (None, near(3))}]
    one_of += [r for r in got if r[0] == 20]
    rest = [(1, prose(1)), (None, prose(2)), (5, prose(5)), (7, prose(7)), (9, prose(9)), (9, prose(9)), (9, prose(10)), (None, prose(11)), (12, None), (None, ""), (None, ""), (12, " ")]
    assert [r[0] for r in one_of] == [None, 20] and sorted(map(repr, got)) == sorted(map(repr, rest + one_of))


def test_encoding_holds_one_worker_for_each_task(spark, folder):
    """Each Python operator of a stage holds a worker of its own for every task, and workers outlive the stage."""
    plan = P.encode(spark, documents(spark, folder), folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
