import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scanloom.llm import sequences

CONTENT = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(CONTENT)
ENCODER = sequences.WordEncoder(CONTENT, [1], most=20_000)  # so small that it forgets now and then


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


_MIXED = st.text(st.sampled_from(list("abZ09 .,;:!?'\"<|>()=\n\t̸́éİΣẞ  \x1cあ\U0001f600 ")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(_MIXED, st.text(max_size=30), st.sampled_from(["it's 3.14, you're; don't!", "<|endoftext|>x", "<|ENDOFTEXT|>", "a<|startoftext|>b."])), max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    ids, counts = ENCODER.encode(texts)
    want = [[*library_ids(t), 1] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def brute(rows):
    """Rows in order of id (rows without id last), their starts and checksums."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*library_ids(t), 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("length", [7, 2048])
def test_round_trip(spark, tmp_path, length):
    rng = random.Random(length)
    rows = [(i, " ".join(rng.choice(["Word", "other", "x1.", "Über"]) for _ in range(rng.randint(0, 60)))) for i in rng.sample(range(-500, 5000), 120)]
    rows += [(9001, None), (9002, ""), (9003, "long text, " * 40000), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, ids int, start string")
    path = f"{tmp_path}/out"
    sequences.write_sequences(docs.repartition(3), path, CONTENT, length=length)
    got = sequences.read_documents(spark, path, ids=True).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r)[:4] for r in got), key=key) == brute(rows)
    texts = dict(rows)
    assert all(list(r.ids) == [*library_ids(texts[r.doc_id]), 1] for r in got)
    table = sequences.read_sequences(spark, path).collect()
    assert {len(r.ids) for r in table} == {len(r.mask) for r in table} == {length}
    stream = [x for r in sorted(table, key=lambda r: r.start) for x, real in zip(r.ids, r.mask) if real]
    assert stream == [x for r in sorted(got, key=lambda r: r.start) for x in r.ids]
    assert sum(len(r.doc_ids) for r in table) == sum(sum(r["last"]) for r in table) == len(rows)


def test_random_access_without_copy(spark, tmp_path):
    path = f"{tmp_path}/out"
    sequences.write_sequences(spark.createDataFrame([(i, f"some words {i}") for i in range(300)], "doc_id long, text string").coalesce(1), path, CONTENT, length=16)
    name = sorted(p for p in (tmp_path / "out").iterdir() if p.suffix == ".arrow")[0]
    with pa.memory_map(str(name)) as source:
        before = pa.total_allocated_bytes()
        batch = pa.ipc.open_file(source).get_batch(0)
        row = batch.column(0)[2].values
        assert len(row) == 16 and row.type == pa.uint16() and pa.total_allocated_bytes() - before < 1024
        del batch, row


def test_repeated_rows_and_empty(spark, tmp_path):
    rows = [(5, "same text here")] * 40 + [(5, "another")] * 3 + [(None, None)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sequences.write_sequences(docs, f"{tmp_path}/a", CONTENT, length=8)
    got = sequences.read_documents(spark, f"{tmp_path}/a").collect()
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert len(got) == 63 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert sorted((r.doc_id is None, r.n_tokens) for r in got) == sorted((i is None, len(library_ids(t)) + 1) for i, t in rows)
    sequences.write_sequences(docs.limit(0), f"{tmp_path}/b", CONTENT)
    assert sequences.read_documents(spark, f"{tmp_path}/b").collect() == []


def test_query(spark, tmp_path):
    rows = [(i * 7 % 101, f"Document number {i}. It's here!\n" * (i % 5)) for i in range(101)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sequences.op13(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
