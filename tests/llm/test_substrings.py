import random

from scanloom.llm import substrings as S


def brute(rows, window=S.WINDOW):
    number = lambda i: S.NO_ID if i is None else i
    split = [(text or "").encode().split() for _, text in rows]
    owner = {}
    for (i, _), w in zip(rows, split):
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            owner[key] = min(owner.get(key, S.NO_ID), number(i))
    out = []
    for (i, _), w in zip(rows, split):
        gone = {q for p in range(len(w) - window + 1) if owner[tuple(w[p:p + window])] < number(i) for q in range(p, p + window)}
        out.append((i, len(w), len(gone), b" ".join(x for q, x in enumerate(w) if q not in gone).decode()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], "doc_id long, text string, block int, hash string")
    got = S.factors(docs, **kw).collect()
    for r in got:
        covered = {q for f in r.factors for q in range(f.start, f.start + f.words)}
        assert len(covered) == r.n_removed and all(f.words >= S.WINDOW and (r.doc_id is None or f.source < r.doc_id) for f in r.factors)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "be", "Ce"]) + str(rng.randrange(300))
    passages = [[word() for _ in range(n)] for n in (12, 13, 14, 20, 60)]
    rows = []
    for i in range(150):
        body = []
        for _ in range(rng.randint(0, 5)):
            body += rng.choice(passages) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 30))]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(body)))
    rows += [(200, None), (201, ""), (202, "z " * 5000), (203, "z\n" * 100), (None, rows[9][1]), (None, " ".join(passages[4])), (9, rows[9][1]), (9, " ".join(passages[3] + passages[4])), (204, " ".join(passages[4][30:] + passages[3] + passages[4][:30]))]
    want = brute(rows)
    assert sum(w[2] for w in want) > 1000
    assert run(spark, rows) == want
    assert run(spark, rows, block_bytes=2000) == want


def test_empty(spark):
    assert run(spark, []) == []
