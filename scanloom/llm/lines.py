"""Line dedup: hashes of lines are range-partitioned with a secondary sort by document and position, first
occurrences are streamed, and the result is one compressed keep bitmap per document that loses lines.

The range partitioning covers (hash, document, position), so a line found in a third of all documents is spread
over as many partitions as its rows need. What such a line's owner is, is handed from partition to partition by a
summary of one row per partition.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import BLANKS, LOWER, UPPER, cut, documents, fresh, lower_ascii, map_texts

LEAST_CHARS = 10
NO_ID = (1 << 63) - 1
_ROW = ["h1", "h2", "doc", "copy", "pos"]


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    """A document is its id; rows that repeat an id with another text stay apart by a hash of the text."""
    return [F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_col).alias("copy")]


def line_rows(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """One row per line whose key has at least ``least`` code points: 128-bit hash, document, position."""
    lines = docs.select(*_keys(docs, id_col, text_col), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    key = lower_ascii(F.btrim("line", F.lit(BLANKS.decode())))
    keyed = lines.select("doc", "copy", "pos", key.alias("key")).filter(F.length("key") >= least)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "copy", "pos")


def _runs(batch: pa.RecordBatch, before: tuple | None):
    """Columns of a batch, the owner of each row, and (hash, hash, owner) at its end."""
    h1, h2, doc = (batch.column(i).to_numpy() for i in range(3))
    start = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    owners = doc[start].copy()
    if before is not None and before[:2] == (h1[0], h2[0]):
        owners[0] = before[2]
    owner = owners[np.cumsum(start) - 1]
    return doc, owner, (h1[-1], h2[-1], owner[-1])


def _edges(batches):
    first, last, whole = None, None, True
    for batch in batches:
        if batch.num_rows:
            _, _, end = _runs(batch, last)
            first = first or (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            last = end
    if last is not None:
        whole = first == (int(last[0]), int(last[1]))
        row = [TaskContext.get().partitionId(), *first, *(int(x) for x in last), whole]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "f1", "f2", "l1", "l2", "owner", "whole"])


def _carried(edges: list) -> dict[int, tuple]:
    """What each partition has to know of those before it: the hash at their end and its owner."""
    out, before = {}, None
    for e in sorted(edges, key=lambda e: e.part):
        if before is not None:
            out[e.part] = before
        same = before is not None and before[:2] == (e.f1, e.f2)
        before = (e.l1, e.l2, before[2] if e.whole and same else e.owner)
    return out


def dropped_lines(rows: DataFrame) -> DataFrame:
    """(doc, copy, pos) of the lines that stand in a document other than the first one with the same hash."""
    ranged = cut(rows.repartitionByRange(*_ROW).sortWithinPartitions(*_ROW))
    edges = ranged.mapInArrow(_edges, "part long, f1 long, f2 long, l1 long, l2 long, owner long, whole boolean")
    carried = _carried(edges.collect())  # a row for each partition

    def stream(batches):
        before = carried.get(TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                doc, owner, before = _runs(batch, before)
                lost = pa.array(doc != owner)
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(lost) for i in (2, 3, 4)], names=["doc", "copy", "pos"])

    return ranged.mapInArrow(stream, "doc long, copy long, pos int")


def _pack(batches):
    for batch in batches:
        maps = []
        for gone in batch.column(2).to_pylist():
            keep = np.ones(max(gone) // 8 * 8 + 8, bool)
            keep[gone] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], names=["doc", "copy", "keep_lines"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: ``doc``, ``copy`` (hash of the text), ``keep_lines``.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of ``least`` code points or more
    lose all lines outside the smallest document id that holds them; repeats inside that document stay. Bit i of
    the unpacked map tells whether line i stays; lines after its end stay. Null text: no lines. A null id is one
    document after all others. Rows with the same id are one document. Empty table: no rows.
    """
    lost = dropped_lines(line_rows(docs, id_col, text_col, least))
    grouped = lost.groupBy("doc", "copy").agg(F.collect_list("pos").alias("gone"))
    return grouped.mapInArrow(_pack, "doc long, copy long, keep_lines binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, plus ``n_lines`` (before) and ``n_dropped``. Null text stays null and
    counts as one line. Rows and other columns stay as they are; a clashing count column gets a trailing "_"."""
    doc, copy, bits, n_lines, n_dropped = fresh(docs, "_doc", "_copy", "_bits", "n_lines", "n_dropped")
    keys = _keys(docs, id_col, text_col)
    left = docs.withColumns({doc: keys[0], copy: keys[1]})
    right = bitmaps.select(F.col("doc").alias(doc), F.col("copy").alias(copy), F.col("keep_lines").alias(bits))
    joined = left.join(right, [doc, copy], "left")
    carry = [c for c in docs.columns if c != text_col]
    fields = [T.StructField(text_col, T.StringType()), T.StructField(n_lines, T.LongType()), T.StructField(n_dropped, T.LongType())]

    def make():
        def work(texts, maps):
            kept, total, gone = [], [], []
            for text, packed in zip(texts, maps):
                n = 1 if text is None else text.count("\n") + 1
                lost = 0
                if packed is not None:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[:n]
                    lost = int(len(keep) - keep.sum())
                    lines = text.split("\n")
                    text = "\n".join([lines[i] for i in np.flatnonzero(keep)] + lines[len(keep):])
                kept.append(text)
                total.append(n)
                gone.append(lost)
            return [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]

        return work

    return map_texts(joined, text_col, carry, fields, make, also=[bits]).select(*docs.columns, n_lines, n_dropped)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def deduped_sql(source: str) -> str:
    """SQL for the documents of ``source`` with what is left of their text, its lines and dropped lines."""
    return f"""WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {source})),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = doc_id), '') AS kept
FROM k LEFT JOIN o USING (key) GROUP BY doc_id"""


OP2_SQL = f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({deduped_sql('documents')})"
