import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from scanloom.llm import ctw as X

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate({ord(b): " " for b in BLANKS}).split(" ") if w]


def kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


class Tree:
    """The same model node by node."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, {}
        for t in texts:
            for context, prefix, bit in self.steps(t):
                for d in range(depth + 1):
                    self.counts.setdefault((context[depth - d:], prefix), [0, 0])[bit] += 1
        self.children, self.weight = {}, {}
        for context, prefix in self.counts:
            if context:
                self.children.setdefault((context[1:], prefix), []).append((context, prefix))

    def steps(self, text):
        coded = b"\n" * self.depth + " ".join(tokens(text)).encode() + b"\n"
        for i in range(self.depth, len(coded)):
            for j in range(8):
                yield coded[i - self.depth:i], (1 << j) | (coded[i] >> (8 - j)), (coded[i] >> (7 - j)) & 1

    def weighted(self, node):
        if node not in self.weight:
            own = kt(*self.counts[node])
            if len(node[0]) < self.depth:
                own = np.logaddexp(math.log(0.5) + own, math.log(0.5) + sum(self.weighted(c) for c in self.children.get(node, [])))
            self.weight[node] = own
        return self.weight[node]

    def one(self, context, prefix, d=0):
        node = (context[self.depth - d:], prefix)
        if node not in self.counts:
            return None
        zeros, ones = self.counts[node]
        own = (ones + 0.5) / (zeros + ones + 1)
        if d == self.depth:
            return own
        share = math.exp(math.log(0.5) + kt(zeros, ones) - self.weighted(node))
        deeper = self.one(context, prefix, d + 1)
        return share * own + (1 - share) * (own if deeper is None else deeper)

    def score(self, text):
        total = 0.0
        for context, prefix, bit in self.steps(text):
            p = self.one(context, prefix)
            p = 0.5 if p is None else p
            total += math.log10(p if bit else 1 - p)
        return total


def check(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    got = X.score(docs, F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 != 1, **options).collect()
    teaches = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 != 1
    train = [t for i, t in rows if teaches(i)]
    count = Counter(w for t in train for w in [*tokens(t), None])
    n, v, tree = sum(count.values()), len(count), Tree(train, X.DEPTH)
    assert len(got) == len(rows)
    want = sorted(((i, len(ts := [*tokens(t), None]), sum(count[w] > 0 for w in ts), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts), tree.score(t)) for i, t in rows), key=repr)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=repr)
    assert {r.train_tokens for r in got} <= {n}
    for a, b in zip(have, want):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9) and math.isclose(a[4], b[4], rel_tol=1e-7), (a, b)


def test_against_node_by_node(spark):
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "The", "of", "éa", "abra", "cadabra", "x", "qu%d" % rng.randrange(40)])
    rows = [(i, rng.choice([" ", "\n "]).join(word() for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "ab " * 3000), (None, "of the"), (7, rows[7][1]), (7, rows[7][1])]
    check(spark, rows)
    check(spark, rows, block_bytes=500)


def test_small_tables(spark):
    check(spark, [(1, "alone here")])
    assert X.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(True)).count() == 0
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in X.score(docs, F.lit(False)).collect()}
    assert math.isclose(rows[1].score, 24 * math.log10(0.5)) and rows[2].n_tokens == 1 and rows[1].n_known == 0


def test_log_gamma():
    x = np.array([0.5, 1, 2.5, 7, 1000.5, 1e9])
    assert np.allclose(X.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)
