import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scanloom.llm import decontaminate as D


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=12).map(lambda b: bytes(x % 3 + 97 for x in b)), st.binary(max_size=20).map(lambda b: bytes(x % 3 + 97 for x in b)), st.integers(0, 6))
def test_distance(item, text, most):
    got, want = D.distance(item, text, most), plain_distance(item, text)
    assert (got is None) == (want > most)
    if got is not None:
        assert got[0] == want and 0 <= got[1] <= got[2] <= len(text)
        assert plain_distance(item, text[got[1]:got[2]]) == want


def noisy(rng, text, edits):
    t = list(text)
    for _ in range(edits):
        k = rng.randrange(len(t))
        t[k:k + 1] = rng.choice([[], ["z"], [t[k], "y"]])
    return "".join(t)


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(4, 40))) for i in range(25)] + [(100, None), (101, ""), (102, "tiny"), (103, text(20).upper())]
    docs = []
    for d in range(60):
        body = text(rng.randint(0, 60))
        if d % 3 == 0:
            _, item = rng.choice(items[:25])
            body += " " + noisy(rng, item, rng.choice([0, 0, 1, 3, len(item) // 12, len(item) // 5])) + "\n " + text(5)
        docs.append((d, body))
    docs += [(200, None), (201, ""), (None, items[3][1]), (202, items[103 - 103 + 25 + 3][1].lower() * 1), (5, docs[5][1]), (203, text(3000) + items[1][1].replace(" ", "\n  ") + text(3000))]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    want = set()
    for d, body in docs:
        for i, item in items:
            t = D.normal(item)
            if len(t) >= D.LEAST and (x := plain_distance(t, D.normal(body))) <= D.edits_allowed(len(t)):
                want.add((d, i, x))
    frame = spark.createDataFrame([(d, t, "q", 2) for d, t in docs], "doc_id long, text string, hits string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (D.INDEX_BYTES, 700):
        got = D.hits(frame, bench, index_bytes=most)
        assert {(r.doc_id, r.item_id, r.edits) for r in got.collect()} == want
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    dirty = {w[0] for w in want}
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((d or -1) for d, _ in docs if d not in dirty)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(docs, none).count() == 1 and D.hits(docs.limit(0), none).count() == 0
