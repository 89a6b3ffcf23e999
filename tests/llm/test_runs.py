import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import Row

from scanloom.llm import runs


def brute_runs(words, least=12):
    """All maximal stretches by trying every period at every place; a stretch belongs to its smallest period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, length, q) for (s, length), q in out.items())


def brute(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences(rng):
    yield from ([], [1], [0] * 40, thue_morse(200), fibonacci(300), [0, 1] * 30 + [0, 0] + [1, 0] * 30)
    for _ in range(300):
        kinds = rng.choice((2, 2, 3, 5, 40))
        words = [rng.randrange(kinds) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(0, 3)):  # nested and neighbouring repeats, some broken by one word
            a = rng.randrange(len(words))
            words[a:a] = words[a:a + rng.randint(1, 20)] * rng.randint(1, 5)
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = 99
        yield words


def test_runs_against_brute_force():
    for words in sequences(random.Random(11)):
        got = [tuple(map(int, r)) for r in runs.find_runs(np.array(words, np.int64))]
        assert got == brute_runs(words), words
    for words in sequences(random.Random(12)):  # no least length
        assert [tuple(map(int, r)) for r in runs.find_runs(np.array(words, np.int64), 1)] == brute_runs(words, 1), words


def test_repeated_texts_do_not_meet(spark):
    text = " ".join("abcdefghijklm")
    rows = [Row(doc_id=i, text=text) for i in range(5)]
    assert [r.runs for r in runs.detect(spark.createDataFrame(rows)).collect()] == [[]] * 5


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, rng.choice(" \t\n\x0b\x0c\r") .join(rng.choice(["Ä", "b", "b c", "d."]) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    rows += [(None, "x " * 50), (150, None), (151, ""), (152, " \n "), (7, rows[7][1]), (153, "a b c " * 3000), (154, "no run in here")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in runs.op11(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((brute(*r) for r in rows), key=repr)
    assert got == want and sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150)) > 5


def test_clashing_columns_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b " * 10, "x", 3)], "n_words int, text string, runs string, collapsed int")
    got = runs.detect(docs)
    assert got.columns == ["n_words", "runs", "collapsed", "n_words_", "runs_", "collapsed_"]
    assert got.first()["runs_"] == [Row(start=0, length=20, period=2)] and got.first()["collapsed_"] == "a b"
    assert runs.detect(docs.limit(0)).collect() == []
