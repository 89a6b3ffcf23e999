import hashlib
import random

from pyspark.sql import functions as F

from scanloom.llm import fingerprints as X


def rows_of(n=150, seed=3):
    rng = random.Random(seed)
    ids = rng.sample(range(-500, 5000), n) + [2 ** 62, -2 ** 62]
    return [(i, rng.choice(["", " "]) + " ".join("wörd%d" % rng.randrange(500) for _ in range(rng.choice([0, 1, 3, 5, 6, 7, 40, 300])))) for i in ids]


def test_next_text_and_edits(spark, tmp_path):
    rows = rows_of() + [(7000, None), (7001, ""), (None, "x y z")]
    spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, own string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in X.op1(spark, str(tmp_path)).collect()}
    direct = {}
    docs = X.with_next(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    n, k = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    for r in X.with_anchors(docs.withColumn("e", F.concat(F.substring("text", F.lit(1), n - k), F.substring("next_text", F.lit(1), k))), "e", "x").select("doc_id", X.fingerprint(F.col("x")).alias("f"), X.fingerprint(F.col("anchors")).alias("g")).collect():
        direct[r.doc_id] = (r.g, r.f)
    assert {i: (r.fingerprint, r.edited_fingerprint) for i, r in got.items()} == direct
    order = sorted(rows, key=lambda r: -2 ** 63 if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    for (i, t), (_, follow) in zip(order, order[1:] + order[:1]):
        t, follow = t or "", follow or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + follow[:k]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(t.split()) >= 40:
            assert r.near_edited > (0.55 if len(t.split()) >= 300 else 0.35) and r.near_next < 0.2


def test_anchors(spark):
    texts = {1: "", 2: None, 3: "one", 4: "a b c d e f g h i j k l m n o p q r s t", 5: "zz a b c d e f g h i j k l m n o p q r s t", 6: "a  b\nc\td", 7: "a b c d", 8: "a " * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    marked = X.with_anchors(docs, "text").select("doc_id", "anchors", X.fingerprint(F.col("anchors")).alias("f"))
    got = {r.doc_id: r for r in marked.collect()}
    assert got[1].anchors == [] and got[2].f == "" and len(got[3].f) == 8
    assert got[6].f == got[7].f != ""
    four, five = ({a.hash: a.pos for a in got[k].anchors} for k in (4, 5))
    assert four and all(five[h] == p + 1 for h, p in four.items())
    places = sorted(four.values())
    assert all(b - a <= X.K - X.S for a, b in zip([-1, *places], [*places, 16]))
    assert len(got[8].anchors) > 0
    pair = marked.filter("doc_id = 4").select(F.col("anchors").alias("a")).join(marked.filter("doc_id = 5").select(F.col("anchors").alias("b")))
    assert set(pair.select(X.shifts(F.col("a"), F.col("b")).alias("s")).first().s) == {1}


def test_small_tables(spark):
    for rows in ([], [(5, "alone")], [(5, "same"), (5, "same")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert [(r.text, r.next_text) for r in X.with_next(docs).collect()] == [(t, t) for _, t in rows]


def test_plan_has_no_python(spark):
    plan = X.with_anchors(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edit_in_the_sixth_word(spark, tmp_path):
    """A stand-in for six words without a syncmer is not taken over when the sixth is edited."""
    rows = [(i, " ".join(f"{c}{i}" for c in "abcde") + " " + f"f{i}" * 12) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in X.op1(spark, str(tmp_path)).collect()}
    edited = [(i, t[:len(t) - len(t) // 3] + rows[i - 1][1][:len(t) // 3]) for i, t in rows]
    direct = X.with_anchors(spark.createDataFrame(edited, "doc_id long, text string"), "text").select("doc_id", X.fingerprint(F.col("anchors")).alias("f"))
    assert {r.doc_id: r.f for r in direct.collect()} == {i: r.edited_fingerprint for i, r in got.items()}
    wholes = X.with_anchors(spark.createDataFrame(rows, "doc_id long, text string"), "text").select("doc_id", (F.col("anchors")[0]["hash"] == F.xxhash64(X.words_of(F.col("text")))).alias("whole")).filter("whole").collect()
    assert len(wholes) > 5 and all(got[r.doc_id].near_edited == 0 for r in wholes)
