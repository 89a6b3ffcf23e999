"""Substring dedup by relative Lempel-Ziv parsing.

Documents are dealt into reference blocks. Every block is indexed by the hashes of its windows of WINDOW words, and
each document is parsed greedily against the index of all blocks: a factor is a run of windows that the same earlier
document holds. Windows across the border of two factors are in the index as well, so what they cover is found.

Only windows that can repeat are moved: a window is represented by the smallest hash of its runs of GRAM words, which
equal windows share, and blocks first tell which of these they hold. A block sends each hash once, so a passage found
in a third of all documents makes one row for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm.base import Words, documents, halves, in_blocks, signed, windows

WINDOW, GRAM = 13, 4
NO_ID = (1 << 63) - 1
BLOCK = 4 << 20


def _hashes(texts: list, window: int, gram: int):
    """Words of the texts; starts and hashes of all windows, and the anchor of each."""
    words = Words(texts)
    own = words.hashes() if len(words.starts) else np.zeros(0, np.uint64)
    starts, hashes = windows(own, words.doc, window)
    if not len(starts):
        return words, starts, hashes, hashes
    _, grams = windows(own, np.zeros(len(own), np.int8), gram, second=True)
    span, reach = window - gram + 1, 1  # smallest of ``span`` neighbours, by doubling
    least = grams
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[:len(least) - (span - reach)], least[span - reach:])
    return words, starts, hashes, least[starts]


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in column.to_pylist()], np.int64)


def _low_high(keys: np.ndarray, docs: np.ndarray):
    """Distinct keys with their smallest and largest document."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    last = np.concatenate((first[1:], [len(keys)])) - 1 if len(keys) else first
    return keys[first], docs[first], docs[last]


def _parse(starts: np.ndarray, owner: np.ndarray, window: int) -> list[dict]:
    """Greedy factors from the starts of repeated windows and the documents that hold them first."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (owner[1:] != owner[:-1]))))
    end = np.concatenate((new[1:], [len(starts)])) - 1
    return [{"start": int(starts[i]), "words": int(starts[j] - starts[i] + window), "source": int(owner[i])} for i, j in zip(new, end)]


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK) -> DataFrame:
    """``id_col``, n_words, factors (array of start word, words, source document), n_removed, kept_text, for every row.

    A word is a run of characters other than [\\x20\\x09-\\x0D], unchanged. A factor covers windows of ``window``
    words that begin in a document with a smaller id as well; factors may overlap by less than a window. ``kept_text``
    has the words that no factor covers, with one space between. Null or empty text: no words. Rows that repeat an id
    are the same document and never each other's source; a null id comes after all others. Other columns are ignored.
    """
    blocks = in_blocks(docs, id_col, text_col, block_bytes)
    id_type = docs.schema[id_col].dataType.simpleString()

    def anchors(table: pa.Table) -> pa.Table:
        found = []
        for part in halves(table, 1):
            words, starts, _, anchor = _hashes(part.column(1).to_pylist(), window, gram)
            owner = _ids(part.column(0))[words.doc[starts]]
            found.append(_low_high(anchor, owner))
        keys, low, high = (np.concatenate([f[i] for f in found]) for i in range(3))
        keys, low, high = _merged(keys, low, high)
        block = table.column(2)[0].as_py()
        return pa.table({"anchor": signed(keys), "block": pa.array(np.full(len(keys), block, np.int32)), "several": pa.array(low != high)})

    def _merged(keys, low, high):
        names, a, _ = _low_high(keys, low)
        return names, a, _low_high(keys, high)[2]

    held = blocks.groupBy("block").applyInArrow(anchors, "anchor long, block int, several boolean").filter("anchor is not null").repartition("anchor")
    repeated = held.groupBy("anchor").agg(F.min("block").alias("a"), F.max("block").alias("b"), F.max("several").alias("c")).filter("a < b or c").select("anchor")
    # Both uses of a dealt table need all its columns, so one shuffle serves them.
    told = held.join(repeated, "anchor").select(F.when(F.col("several").isNotNull(), F.col("block")).alias("block"), "anchor")

    def candidates(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(right.column(1).to_numpy().view(np.uint64))
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for part in halves(left, 1):
            words, starts, hashes, anchor = _hashes(part.column(1).to_pylist(), window, gram)
            at = _member(known, anchor)
            found.append(_low_high(hashes[at], _ids(part.column(0))[words.doc[starts[at]]]))
        keys, low, high = _merged(*(np.concatenate([f[i] for f in found]) for i in range(3)))
        block = left.column(2)[0].as_py() if left.num_rows else 0
        return pa.table({"hash": signed(keys), "block": pa.array(np.full(len(keys), block, np.int32)), "low": pa.array(low), "high": pa.array(high)})

    def _member(known: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return np.flatnonzero(known[spot] == values)

    index = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(candidates, "hash long, block int, low long, high long").filter("hash is not null and high is not null").repartition("hash")
    owners = index.groupBy("hash").agg(F.min("low").alias("owner"), F.max("high").alias("last"), F.max("block").alias("any")).filter("owner < last and any is not null").select("hash", "owner")
    answers = index.join(owners, "hash").filter("owner < high").select("block", "hash", F.least("owner", "low").alias("owner"))

    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source", pa.int64())]))

    def parsed(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.column(1).to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, owner_of = known[order], right.column(2).to_numpy()[order]
        out = []
        for part in halves(left, 1):
            words, starts, hashes, _ = _hashes(part.column(1).to_pylist(), window, gram)
            ids = _ids(part.column(0))
            at = _member(known, hashes)
            owner = owner_of[np.searchsorted(known, hashes[at])] if len(at) else np.zeros(0, np.int64)
            starts = starts[at]
            doc = words.doc[starts]
            right_ones = owner < ids[doc]
            starts, owner, doc = starts[right_ones], owner[right_ones], doc[right_ones]
            step = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + window, -1)
            lost = np.cumsum(step)[:-1] > 0
            edges = np.searchsorted(doc, np.arange(part.num_rows + 1))
            spans, removed, kept = [], [], []
            for d, text in enumerate(part.column(1).to_pylist()):
                first, n = int(words.first[d]), int(words.counts[d])
                own = slice(edges[d], edges[d + 1])
                spans.append(_parse(starts[own] - first, owner[own], window))
                left_words = (text or "").encode().split()
                if spans[-1]:
                    gone = lost[first:first + n]
                    removed.append(int(gone.sum()))
                    left_words = [left_words[i] for i in np.flatnonzero(~gone).tolist()]
                else:
                    removed.append(0)
                kept.append(b" ".join(left_words).decode())
            out.append(pa.table({"doc": part.column(0), "n_words": pa.array(words.counts), "factors": pa.array(spans, kind), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())}))
        return pa.concat_tables(out)

    schema = f"doc {id_type}, n_words long, factors array<struct<start:long,words:long,source:long>>, n_removed long, kept_text string"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(parsed, schema).withColumnRenamed("doc", id_col)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = f"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS p, ws FROM w WHERE len(ws) >= {WINDOW}),
k AS (SELECT doc_id, p, array_to_string(ws[p:p + {WINDOW - 1}], ' ') AS win FROM g),
o AS (SELECT win, min(doc_id) AS owner FROM k GROUP BY 1),
h AS (SELECT DISTINCT doc_id, unnest(range(p, p + {WINDOW})) AS p FROM k JOIN o USING (win) WHERE owner < doc_id),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
r AS (SELECT x.doc_id, count(*) AS n, count(h.p) AS gone, string_agg(word, ' ' ORDER BY x.p) FILTER (h.p IS NULL) AS kept FROM x LEFT JOIN h ON h.doc_id = x.doc_id AND h.p = x.p GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN r USING (doc_id)"""
