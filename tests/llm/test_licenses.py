import random
import re

from pyspark.sql import functions as F

from scanloom.llm import licenses as L


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, percent=L.THRESHOLD_PERCENT):
    w = words(text)
    at = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    known = [(label, set(words(t))) for label, t in L.TEMPLATES]
    size = max([L.BLOCK_WORDS, *(2 * len(t) for _, t in known)])
    base, labels, best = {l for _, l in at}, set(), 0.0
    blocks = max(-(-len(w) // (size // 2)) - 1, 1)
    for b in range(blocks):
        own = set(w[b * (size // 2):b * (size // 2) + size])
        for label, t in known:
            if 100 * len(own & t) >= percent * len(t):
                labels.add(label)
                best = max(best, len(own & t) / len(t))
    starts = [i for i, _ in at]
    return (len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if at else best)


def test_against_brute_force(spark):
    rng = random.Random(8)
    pool = [t for _, t in L.TEMPLATES] + ["under the MIT license", "cc-by-nc CC by NC cc by", "apache license, version 2", "Version 2 of it", "the quick é word", "license", "x y z", "under the mit licensed", "日本 語"]
    texts = [None, "", " .. ", "under the mit license", "cc by nc cc by nc"] + ["\n".join(rng.choice(pool) + rng.choice(["", ".", " und"]) for _ in range(rng.randint(1, 8))) for _ in range(120)]
    texts += ["filler words here " * 3000 + "Released under the MIT License." + " more of it" * 2000]
    texts += [" ".join(w for w in L.TEMPLATES[k][1].split() if rng.random() > 0.15) for k in range(len(L.TEMPLATES)) for _ in range(5)]
    rows = [(i, t, "q") for i, t in enumerate(texts)] + [(None, texts[3], "q"), (3, texts[3], "q"), (3, "other", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = L.scan(docs)
    assert got.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((tuple(r)[:8] for r in got.collect()), key=repr) == sorted(((i, *brute(t)) for i, t, _ in rows), key=repr)


def test_plan_has_no_python(spark):
    plan = L.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
