import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from scanloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(open(PATH, "rb").read())
REPLAY = bpe.MergeReplay(RANKS)
SPLIT = bpe.splitter(P.PATTERN, bpe.differing())
ORACLE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [None, "", " ", "a", "aaaaaaaaaaaaa", "Hello  world's 12345 ünïcode 日本語 🙂\n\n x", "<|endoftext|>", "word " * 3000, "x" * 20000, "the the the", "²½ Ⅷ_!_ 3_a \x1c b", "ababababab" * 500]


def test_matches_library_and_round_trip(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "null id", 2), (1, "a", 3), (1, "a", 3)], "doc_id long, text string, ids int")
    encoded = bpe.encode(docs, PATH, P.PATTERN, block_bytes=1000)
    rows = bpe.decode(encoded, PATH).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = TEXTS[r.doc_id] if r.doc_id not in (None, 1) else None
        if text is not None:
            assert r.ids == ORACLE.encode_ordinary(text)
            assert bytes(r.decoded) == text.encode()


def test_decoded_in_the_same_task(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (1, "a"), (1, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    apart = bpe.decode(bpe.encode(docs, PATH, P.PATTERN, block_bytes=1000), PATH)
    for block_bytes in (1, 1000, bpe.BLOCK_BYTES):
        whole = bpe.encode(docs, PATH, P.PATTERN, block_bytes=block_bytes, decoded="decoded")
        assert whole.schema == apart.schema
        assert whole.collect() == apart.collect()


def test_words_kept_between_blocks(spark, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    work = bpe._encoder(RANKS, P.PATTERN, bpe.differing())
    for texts in ([None, "", "one two one"], ["two three four", "five"], ["one six two"], [], [None], ["one six two"]):
        assert work(texts).to_pylist() == [ORACLE.encode_ordinary(t or "") for t in texts]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.decode(bpe.encode(docs, PATH, P.PATTERN), PATH)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_block_equals_library(texts):
    import regex

    words = [w for t in texts for w in regex.findall(P.PATTERN, t)]
    assert words == [w for t in texts for w in SPLIT(t)]
    assert ids_of(REPLAY, [w.encode() for w in words]) == [ORACLE.encode_ordinary(w) for w in words]


def ids_of(replay, words):
    flat, counts = replay.encode(words)
    return [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] if words else []


def test_lower_rank_made_by_a_merge():
    ranks = {bytes((b,)): b for b in range(256)} | {b"xab": 300, b"ab": 301, b"abc": 302}
    oracle = tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=ranks | {b"zz%d" % i: i for i in range(256, 300)}, special_tokens={})
    ranks = oracle._mergeable_ranks
    words = [b"xab", b"abxab", b"xabc", b"abcxabab"]
    assert ids_of(bpe.MergeReplay(ranks), words) == [oracle.encode_ordinary(w.decode()) for w in words]
