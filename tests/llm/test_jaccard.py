import random

import numpy as np
import pytest

from scanloom.llm import jaccard as J
from scanloom.llm.components import components


def shingles(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if x]
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), J.NO_ID), J.NO_ID if d is None else d)
    return sorted(((d, len(sets[i]), None if low[find(i)] == J.NO_ID else low[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, class string, key int")
    got = J.near_components(docs, **kw)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "w%d" % rng.randrange(10 ** 6)
    return words


def corpus(seed, groups, sizes):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = ["w%d" % rng.randrange(50_000) for _ in range(rng.choice(sizes))]
        for _ in range(rng.randint(1, 6)):
            n = rng.choice([0, 0, 1, 2, max(1, len(base) // 40), max(1, len(base) // 25)])
            rows.append((len(rows), " ".join(edited(rng, base, n))))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1, 60, [3, 5, 8, 12, 30, 60, 120, 400])
    rows += [(None, rows[0][1]), (900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "one two"), (7, rows[7][1]), (None, "quite alone here in the void"), (906, "a " * 4000), (907, "A\n" * 3000)]
    assert run(spark, rows) == brute(rows)


def test_chains_that_no_centre_links(spark):
    base = ["w%d" % i for i in range(140)]
    rows = [(i, " ".join(base[i * 5:i * 5 + 100])) for i in range(8)]
    assert run(spark, rows) == brute(rows)


def rarest(own, bands):
    """Keys that stay when the spare ones are left out, by some global order."""
    keys, codes = J.sketch_keys(own, bands)
    out = set()
    for code in set(codes.tolist()):
        mine = sorted(keys[codes == code].tolist())
        out |= set(mine[:len(mine) - code % (1 << 16)])
    return out


def test_keys_reach_every_linked_pair():
    rng, bands, linked = random.Random(5), J.Bands(85), 0
    for size in (1, 2, 4, 6, 7, 8, 10, 13, 20, 33, 60, 200, 900):
        for _ in range(60):
            base = np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)
            n = rng.randint(0, max(1, size // 6))
            x = np.unique(base)
            y = np.unique(np.concatenate([base[rng.randint(0, n):], np.array([rng.getrandbits(64) for _ in range(rng.randint(0, n))], np.uint64)]))
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= 85 * (len(x) + len(y) - both):
                linked += 1
                assert rarest(x, bands) & rarest(y, bands)
    assert linked > 100


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(300, 300)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if x != 300}


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
