import math
import random
from collections import Counter

import numpy as np
import pytest

from scanloom.llm import search


def terms(text):
    word, out = "", []
    for c in (text or "") + " ":
        if ord(c) > 127 or c.isascii() and c.isalnum():
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, queries, k):
    """(item, rank, doc_id, score) by scoring every document for every query."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_all, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in dict.fromkeys(queries):
        scores = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * n_all) // total
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


def tables(spark, docs, queries):
    return (spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score int").repartition(3),
            spark.createDataFrame([(i, t, "x") for i, t in queries], "item_id long, text string, rank string"))


@pytest.mark.parametrize("block", [50, 1 << 19])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(search, "QUERY_BLOCK_TERMS", 20)
    rng = random.Random(block)
    vocabulary = ["the"] * 30 + ["word%d" % min(int(rng.expovariate(0.2)), 40) for _ in range(60)] + ["Über", "日本", "x1", "A-b"]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in rng.sample(range(-1000, 1000), 200)]
    docs += [(2001, None), (2002, ""), (2003, "!?"), (None, "the word3 word4"), (docs[0][0], docs[0][1]), (docs[1][0], "word7 word8 the"), (2004, "word5 the " * 3000)]
    queries = [(q, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12)))) for q in range(25)]
    queries += [(25, None), (26, ""), (27, "nowhere"), (None, "word3"), (3, queries[3][1]), (4, "another text of id four: word2"), (28, "THE the")]
    got = search.search(*tables(spark, docs, queries), k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, queries, 7)


def test_ties_and_copies(spark):
    docs = [(i, "same words here") for i in range(60, 0, -1)] + [(100 + i, "other text of its own %d" % i) for i in range(30)]
    got = search.search(*tables(spark, docs, [(1, "words here"), (2, "text")])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, [(1, "words here"), (2, "text")], 10)
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.item_id == 1] == list(range(1, 11))


def test_empty(spark):
    docs, queries = tables(spark, [(1, "a b")], [(1, "a")])
    assert search.search(docs.limit(0), queries).collect() == [] and search.search(docs, queries.limit(0)).collect() == []


def test_reading_stops_at_best_positions():
    """A term that few documents share with a common one: most of the common list is never read, and nothing is lost."""
    rng = np.random.default_rng(1)
    n = 5000
    common = rng.permutation(n)
    term = np.concatenate((np.zeros(n, np.int64), np.ones(40, np.int64)))
    place = np.concatenate((np.arange(n), common[:40]))
    impact = np.concatenate((rng.integers(1, 100, n), rng.integers(5000, 6000, 40)))
    order = np.lexsort((place, term))
    lists = search.ImpactLists(term[order], place[order], impact[order], 2, n)
    docs, scores = lists.best(np.array([0, 1]), 10)
    total = np.bincount(place, impact, n).astype(np.int64)
    assert sorted(scores)[-10:] == sorted(total)[-10:] and (scores == total[docs]).all() and lists.reads < 500
