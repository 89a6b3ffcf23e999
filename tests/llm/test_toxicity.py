import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.llm import toxicity as X

SF = "/root/testdata/sf0.01"
DISGUISED = {"1d10t": "idiot", "m0r0n": "moron", "$cum": "scum", "l0$er": "loser", "i d i o t": "idiot", "s.t.u.p.i.d": "stupid", "idiooooot": "idiot", "w0rthl3ss": "worthless"}


@pytest.fixture(scope="module")
def model(spark):
    return X.fit(X.documents(spark, SF), X.documents(spark, SF, "labels"))


def test_channel_restores_known_words(model):
    channel = X.Channel(model.counts, DISGUISED.values())
    assert {k: X.restore(f"you {k}, now", channel) for k in DISGUISED} == {k: f"you {v} now" for k, v in DISGUISED.items()}
    assert X.restore("Plain words, a b line.\nAnd 1234 more", channel) == "plain words, a b line.\nand 1234 more"


def test_block_scores_equal_single_scores(model):
    channel = model.channel()
    texts = [None, "", "you 1d10t", "an idiot and i d i o t", "Éclair ÉÉÉ idiot", "a a a a a a " * 50, "x" * 3000, "m0r0n\nst*pid trash", "сlown here", "plain"]
    assert np.allclose(model.scorer()(texts), [model.score(X.words_of(t, channel)) for t in texts])


def test_held_out_accuracy(spark):
    rows = X.op8(spark, SF).join(X.documents(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert len(rows) > 40
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.93


def test_edge_cases(spark, model):
    docs = spark.createDataFrame([(1, None, 3.0), (None, "", 1.0), (2, "idiot moron trash " * 3000, 2.0), (2, "idiot moron trash " * 3000, 2.0)], "doc_id long, text string, score double")
    got = {(r.doc_id, r.score): r for r in X.score(docs, model).collect()}
    assert got[1, 3.0].predicted == 0 and got[None, 1.0].score_ == got[1, 3.0].score_ and got[2, 2.0].predicted == 1
    none = X.fit(docs.limit(0), X.documents(spark, SF, "labels").limit(0))
    assert [r.predicted for r in X.score(docs.select("doc_id", "text"), none).collect()] == [0, 0, 0, 0]
    assert X.score(docs.limit(0), model).count() == 0


PLACES = {
    "57upid": "stupid", "10ser": "loser", "idio7": "idiot", "worthle$$": "worthless", "a55": "ass", "@$$": "ass", "455": "ass", "!diot": "idiot", "(lown": "clown",
    "(!diot)": "idiot", "\"(lown!\",": "clown", "1d10t!!": "idiot", "m0r0n*": "moron", "a$$$": "ass", "1 d i 0 7": "idiot", "(1own(": "clown",
}


def test_look_alikes_at_any_place(model):
    channel = X.Channel(model.counts, {*PLACES.values()})
    assert {k: v in X.words_of(f"you {k} now", channel) for k, v in PLACES.items()} == dict.fromkeys(PLACES, True)
    assert {k: X.restore(f"you {k}\tnow", channel) for k in PLACES} == {k: f"you {v}\tnow" for k, v in PLACES.items()}
    same = "now! (see that) | 1234 5 6 7\t$100 10% of!! (рука сор) 3.14 !!!"
    assert X.restore(same, channel) == same


def test_look_alikes_in_blocks(model):
    known = X.Model(model.counts, {w: 2.0 for w in PLACES.values()}, -1.0)
    texts = [f"see {k}" for k in PLACES] + ["(!@" * 3000, "!" * 5000, "see 2024"]
    assert np.allclose(known.scorer()(texts), [known.score(X.words_of(t, known.channel())) for t in texts])
