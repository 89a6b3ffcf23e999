"""Ranked lexical search by the Best Position Algorithm.

One map over the documents makes an index: blocks of documents with the postings of all terms that may be asked for.
Collection figures are summed over the blocks, term weights are joined to the queries, and each block answers each
block of queries by itself: impact lists are read in parallel from the top, every new document is looked up in
all lists at once, and each list keeps its best position, up to which every place has been seen by either way.
An unseen document stands behind all best positions, so the impacts there bound its score; reading stops when that bound is
strictly below the kth score, which keeps ties whole. The best of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanloom.llm.base import LOWER, UPPER, bloom, documents, lower_ascii, passes, pieces, scratch

# Fixed value: terms of texts.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
BLOCK_POSTINGS = 1 << 19
QUERY_BLOCK_TERMS = 100_000
FIRST_STEP = 16
NO_ID = (1 << 63) - 1
_INDEX = "block long, documents long, total long, doc_ids array<long>, lengths array<int>, terms array<binary>, sizes array<int>, places array<int>, counts array<int>"


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TERM), F.lit(0)))


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1 … of each of the counted ranges, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


# --- index ------------------------------------------------------------------------------------------


def _passes(terms: list[bytes], bits: np.ndarray) -> np.ndarray:
    return passes(np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms)), bits)


class _Block:
    """Postings of some documents until they are written as one row."""

    def __init__(self):
        self.terms, self.docs, self.lengths, self.postings = {}, [], [], []
        self.documents = self.total = self.size = self.places = 0

    def add(self, ids: pa.Array, texts: list, bits: np.ndarray) -> None:
        words = [(t or "").encode("utf-8").translate(_LETTERS).split() for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        coded = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = np.full(len(distinct), -1, np.int64)
        for k in np.flatnonzero(_passes(distinct, bits)).tolist():
            known[k] = self.terms.setdefault(distinct[k], len(self.terms))
        term = known[coded.indices.to_numpy(zero_copy_only=False)] if distinct else known
        doc = np.repeat(np.arange(len(texts)), n)[term >= 0]
        term = term[term >= 0]
        width = len(self.terms) + 1
        keys, counts = np.unique(doc * width + term, return_counts=True)
        doc, term = keys // width, keys % width
        held, place = np.unique(doc, return_inverse=True)
        self.postings.append((term, place + self.places, counts))
        self.docs.append(ids.take(pa.array(held)))
        self.lengths.append(n[held])
        self.documents += int((n > 0).sum())
        self.total += int(n.sum())
        self.places += len(held)
        self.size += len(keys)

    def row(self, number: int) -> pa.RecordBatch:
        term, place, count = (np.concatenate(x) for x in zip(*self.postings))
        order = np.argsort(term, kind="stable")
        sizes = np.bincount(term, minlength=len(self.terms))
        lists = [pa.concat_arrays(self.docs), pa.array(np.concatenate(self.lengths), pa.int32()), pa.array(list(self.terms), pa.binary()), pa.array(sizes, pa.int32()), pa.array(place[order], pa.int32()), pa.array(count[order], pa.int32())]
        wrapped = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (number, self.documents, self.total)] + wrapped, names=[c.split(" ")[0] for c in _INDEX.split(", ")])


def build_index(docs: DataFrame, bits: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """One row per block of documents: their number and total terms, and postings of the terms that pass the filter.

    A block ends at ``BLOCK_POSTINGS`` or with its task; a longer document is a block of its own at most."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for piece in pieces(batch, 1):
                block.add(piece.column(0), piece.column(1).to_pylist(), shared.value)
                if block.size >= BLOCK_POSTINGS:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.postings:
            yield block.row(number)

    return docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _INDEX)


# --- answers ----------------------------------------------------------------------------------------


class ImpactLists:
    """Impact lists of a block: by list in order of impact, and by document for direct access."""

    def __init__(self, term: np.ndarray, place: np.ndarray, impact: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((place, -impact, term))
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.places, self.impacts = place[order], impact[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - self.starts[term[order]]
        by_doc = np.argsort(place, kind="stable")
        self.doc_starts = np.searchsorted(place[by_doc], np.arange(n_docs + 1))
        self.doc_terms, self.doc_impacts, self.doc_ranks = term[by_doc], impact[by_doc], rank[by_doc]
        self.n_terms, self.n_docs, self.reads = n_terms, n_docs, 0

    def best(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents seen and their scores; whatever is not among them scores strictly below the kth of them."""
        low, sizes = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        slot = np.full(self.n_terms, -1, np.int64)
        slot[terms] = np.arange(len(terms))
        seen, met = np.zeros(offsets[-1], bool), np.zeros(self.n_docs, bool)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_STEP
        while depth < sizes.max(initial=0):
            reads = np.clip(sizes - depth, 0, step)
            new = self.places[_ragged(low + depth, reads)]
            self.reads += len(new)
            new = np.unique(new[~met[new]])
            met[new] = True
            counts = self.doc_starts[new + 1] - self.doc_starts[new]
            at = _ragged(self.doc_starts[new], counts)
            own = slot[self.doc_terms[at]]
            asked = own >= 0
            seen[offsets[own[asked]] + self.doc_ranks[at[asked]]] = True
            if len(new):
                docs = np.concatenate((docs, new))
                scores = np.concatenate((scores, np.add.reduceat(np.where(asked, self.doc_impacts[at], 0), np.cumsum(counts) - counts)))
            depth, step = depth + step, 2 * step
            if len(scores) >= k and self._bound(seen, offsets, low) < np.partition(scores, -k)[-k]:
                break
        return docs, scores

    def _bound(self, seen: np.ndarray, offsets: np.ndarray, low: np.ndarray) -> int:
        """Sum of the impacts at the best positions; a list that has been seen whole adds nothing."""
        gaps = np.append(np.flatnonzero(~seen), offsets[-1])
        first = gaps[np.searchsorted(gaps, offsets[:-1])]
        open_lists = first < offsets[1:]
        return int(self.impacts[(low + first - offsets[:-1] - 1)[open_lists]].sum())


def _answers(row: dict, k: int, n_all: int, total: int) -> list[pa.Array]:
    """Number of the query within its block, document id and score: the best of each query in one block of documents."""
    lengths, sizes, place, count, weights, n_terms = (row[n].to_numpy().astype(np.int64) for n in ("lengths", "sizes", "places", "counts", "weights", "n_terms"))
    of_query = pc.index_in(row["asked"], value_set=row["terms"]).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    weight = np.zeros(len(sizes), np.int64)
    weight[of_query[of_query >= 0]] = weights[of_query >= 0]
    term = np.repeat(np.arange(len(sizes)), sizes)
    m = 10 + 90 * lengths * n_all // max(total, 1)
    wanted = weight[term] > 0
    term, place, count = term[wanted], place[wanted], count[wanted]
    impact = weight[term] * (1_000_000_000 * count // (1000 * count + 8 * m[place]))
    some = impact > 0
    lists = ImpactLists(term[some], place[some], impact[some], len(sizes), len(m))
    ids = row["doc_ids"]
    null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(NO_ID).to_numpy()
    none = np.zeros(0, np.int64)
    at, docs, scores = [none], [none], [none]
    edges = np.concatenate(([0], np.cumsum(n_terms)))
    for item, (a, b) in enumerate(zip(edges, edges[1:])):
        own = of_query[a:b]
        found, score = lists.best(own[own >= 0], k)
        top = np.lexsort((ids[found], null[found], -score))[:k]
        at.append(np.full(len(top), item))
        docs.append(found[top])
        scores.append(score[top])
    docs = np.concatenate(docs)
    return [pa.array(np.concatenate(at)), pa.array(ids[docs], mask=null[docs]), pa.array(np.concatenate(scores))]


def _upto(n: int) -> Column:
    """Whole numbers from 0 to n - 1."""
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """``query_id``, rank (from 1), doc_id and score of the ``k`` best documents of each query, those with a score above 0.

    Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased. A term that df of N
    documents hold weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); N counts the documents with a term. A document of n terms,
    with tf of this one, gets w * (10^9 tf div (1000 tf + 8 m)), m = 10 + 90 n N div L, L being the terms of all documents.
    Each query term counts once. Equal scores go by ascending id, rows without id last.

    Null and empty texts have no terms: such documents are never found and count in no figure, such queries have no rows. Every row of
    ``docs`` is a document of its own, also where ids or texts repeat. Query rows that repeat id and text are one query; a null id is an id.
    Other columns are ignored. The index of the asked terms is written to the shared folder.
    """
    spark = docs.sparkSession
    asked = queries.select(F.col(query_id).alias("item"), F.col(query_text).cast("string").alias("text")).distinct()
    words = asked.select("item", F.md5(F.coalesce("text", F.lit(""))).alias("copy"), F.explode(terms_of(F.col("text"))).alias("term"))
    path = scratch(spark, "search-index")
    build_index(docs, bloom(words.select(F.xxhash64("term"))), id_col, text_col).write.parquet(path)
    index = spark.read.schema(_INDEX).parquet(path)
    blocks, n_all, total = index.agg(F.count("*"), F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()

    held = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy(F.col("t.terms").cast("string").alias("term")).agg(F.sum("t.sizes").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_all) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighed = words.join(held.select("term", weight.alias("weight")), "term").groupBy("item", "copy").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    queries_path = scratch(spark, "search-queries")
    weighed.write.parquet(queries_path)
    weighed = spark.read.parquet(queries_path)
    query_blocks = (weighed.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0] // QUERY_BLOCK_TERMS) + 1
    dealt = F.pmod(F.xxhash64("item", "copy"), F.lit(query_blocks)).alias("part")
    grouped = weighed.groupBy(dealt).agg(F.collect_list(F.struct("item", "copy", "terms")).alias("queries"))

    # Each block of documents meets each block of queries; queries are copied to as many keys as there are blocks. The
    # copies are never broadcast: their size grows with the index.
    keys = max(blocks, 1)
    left = index.select("*", F.pmod(F.xxhash64("block"), F.lit(keys)).alias("key"), F.explode(_upto(query_blocks)).alias("part"))
    flat = lambda name: F.flatten(F.transform("queries", lambda q: q["terms"][name]))
    right = grouped.select(
        "part", F.explode(_upto(keys)).alias("key"), flat("term").cast("array<binary>").alias("asked"), flat("weight").alias("weights"),
        F.transform("queries", lambda q: F.size(q["terms"])).alias("n_terms"), F.col("queries.item").alias("items"), F.col("queries.copy").alias("copies"))
    names = ["doc_ids", "lengths", "terms", "sizes", "places", "counts", "asked", "weights", "n_terms", "items", "copies"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].values for j, n in enumerate(names)}
                at, ids, scores = _answers(row, k, n_all, total)
                yield pa.RecordBatch.from_arrays([row["items"].take(at), row["copies"].take(at), ids, scores], names=["item", "copy", "doc_id", "score"])

    kind = words.schema["item"].dataType.simpleString()
    found = left.hint("merge").join(right, ["key", "part"]).select(*names).mapInArrow(run, f"item {kind}, copy string, doc_id long, score long")
    best = Window.partitionBy("item", "copy").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(F.col("item").alias(query_id), "rank", "doc_id", "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def _terms_sql(table: str, key: str) -> str:
    return f"SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM {table}"


OP12_SQL = f"""WITH t AS ({_terms_sql('documents', 'doc_id')}), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term), d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS total FROM d), m AS (SELECT doc_id, 100 - 90 + ((90 * n * n_all) // total) AS m FROM d, s),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
q AS (SELECT DISTINCT item_id, term FROM ({_terms_sql('benchmark', 'item_id')})),
r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10"""
