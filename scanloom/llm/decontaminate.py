"""Benchmark decontamination by q-gram lemma filtering.

An item that occurs in a text within k edits shares at least (m - q + 1) - k * q of its q-grams with the place where
it occurs, on diagonals that are at most k apart. Shared q-grams are counted in overlapping bands of diagonals; bands
that reach the bound are verified by banded alignment. The index is built over items in blocks of bounded size;
documents are scanned by whole blocks of texts, and only q-grams that some item has are looked at further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import LOWERED, documents, fresh, give_back, pieces, spans_hash

# Parameters: q, edits per code unit of an item in hundredths, shortest item that can be looked for, and the most
# bytes of items that one scan of the documents carries to the tasks; more items are dealt into more scans.
Q = 8
EDIT_PERCENT = 10
LEAST = 24
PIECE_BYTES = 512 << 10
INDEX_BYTES = 8 << 20
_PLAIN = bytes(32 if b < 32 else LOWERED[b] for b in range(256))


def normal(text: str | None) -> bytes:
    """A-Z lower-cased, runs of blanks and control characters as one space, UTF-8."""
    return b" ".join((text or "").encode().translate(_PLAIN).split())


def grams(text: bytes, q: int) -> np.ndarray:
    """The q-gram at each place as a number: its bytes where they fit into one, else a hash."""
    n = len(text) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q > 8:
        at = np.arange(n)
        return spans_hash(np.frombuffer(text, np.uint8).astype(np.uint64), at, at + q, 0x9E3779B97F4A7C15)
    room = text + bytes(8)
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        part = out[k::8]
        part[:] = np.frombuffer(room, "<u8", len(part), k)
    return out & np.uint64((1 << 8 * q) - 1)


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def edits_allowed(m: int, q: int = Q, percent: int = EDIT_PERCENT) -> int:
    """Edit budget of an item of ``m`` bytes; small enough that at least one q-gram must be shared."""
    return max(0, min(m * percent // 100, (m - q) // q))


def distance(item: bytes, text: bytes, most: int) -> tuple[int, int, int] | None:
    """Fewest edits of ``item`` against a part of ``text``, and its bounds, if at most ``most`` (banded rows)."""
    exact = text.find(item)
    if exact >= 0:
        return 0, exact, exact + len(item)
    n, far = len(text), most + 1
    letters = np.frombuffer(text, np.uint8)
    cost = np.zeros(n + 1, np.int32)      # the part may begin anywhere
    origin = np.arange(n + 1)
    steps = np.arange(n + 1, dtype=np.int32)
    for i, c in enumerate(item, 1):
        # A place of column j after i letters began at about j - i; all that is further off than the budget is dead.
        replace = cost[:-1] + (letters != c)
        delete = cost + 1
        best = delete.copy()
        came = origin.copy()
        better = replace < best[1:]
        best[1:][better] = replace[better]
        came[1:][better] = origin[:-1][better]
        least = np.minimum.accumulate(best - steps)   # insertions: best[j] = min over k <= j of best[k] + j - k
        inserted = least + steps
        where = np.maximum.accumulate(np.where(best - steps == least, steps, 0))
        came = np.where(inserted < best, came[where], came)
        cost, origin = np.minimum(best, inserted), came
        if cost.min() >= far:
            return None
    end = int(np.argmin(cost))
    return (int(cost[end]), int(origin[end]), end) if cost[end] <= most else None


class Index:
    """q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int, percent: int, least: int):
        self.q = q
        self.items = [(i, t) for i, text in items if len(t := normal(text)) >= least]
        held, owners, offsets = [], [], []
        for k, (_, t) in enumerate(self.items):
            held.append(grams(t, q))
            owners.append(np.full(len(held[-1]), k))
            offsets.append(np.arange(len(held[-1])))
        none = np.zeros(0, np.int64)
        keys = np.concatenate([*held, none.astype(np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.offset = keys[order], np.concatenate([*owners, none])[order], np.concatenate([*offsets, none])[order]
        self.bits = np.zeros(1 << 24, bool)
        self.bits[_slot(self.keys)] = True
        sizes = np.array([len(t) for _, t in self.items], np.int64)
        self.budget = np.array([edits_allowed(m, q, percent) for m in sizes.tolist()], np.int64)
        self.bound = np.maximum(sizes - q + 1 - self.budget * q, 1)
        self.sizes = sizes

    def hits(self, texts: list) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, edits, start, end) of every item found in a block of texts; bounds are bytes of the
        normalised text."""
        plain = [normal(t) for t in texts]
        joined = b"\x00".join([*plain, b""])  # a separator that no normalised text has
        if not self.items or len(joined) <= self.q:
            return []
        starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in plain])))
        here = grams(joined, self.q)
        at = np.flatnonzero(self.bits[_slot(here)])
        low, high = (np.searchsorted(self.keys, here[at], side) for side in ("left", "right"))
        n = high - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        if not len(at):
            return []
        entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        place = np.repeat(at, n)
        item = self.owner[entry]
        text = np.searchsorted(starts, place, "right") - 1
        diagonal = place - self.offset[entry]
        return self._bands(plain, starts, text, item, diagonal)

    def _bands(self, plain, starts, text, item, diagonal):
        """Count by (text, item, band): bands are 2 * width long and begin every ``width`` diagonals, so each range
        of ``width`` diagonals lies in one of them."""
        width = self.budget[item] + 1
        band = diagonal // width
        pair = (text * len(self.items) + item).astype(np.uint64) << np.uint64(31)
        shift = 1 - min(int(band.min()), 0)  # bands count from -1 on; an item may begin before its text does
        low = (band + shift).astype(np.uint64)
        keys = np.sort(np.concatenate([pair + low, pair + low - np.uint64(1)]))
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts, keys = np.diff(np.append(first, len(keys))), keys[first]
        pair, band = (keys >> np.uint64(31)).astype(np.int64), (keys & np.uint64((1 << 31) - 1)).astype(np.int64) - shift
        rows = np.stack([pair // len(self.items), pair % len(self.items), band], 1)
        rows = rows[counts >= self.bound[rows[:, 1]]]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        for d, k, b in rows.tolist():
            m, budget = int(self.sizes[k]), int(self.budget[k])
            if found.get((d, k), (1,))[0] == 0:
                continue
            begin = max(b * (budget + 1) - budget - int(starts[d]), 0)
            part = plain[d][begin:max((b + 2) * (budget + 1) + m + budget - int(starts[d]), 0)]
            got = distance(self.items[k][1], part, budget)
            if got is not None and got[0] < found.get((d, k), (budget + 1,))[0]:
                found[d, k] = got[0], begin + got[1], begin + got[2]
        return [(d, self.items[k][0], *x) for (d, k), x in sorted(found.items())]


_HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("start_byte", T.IntegerType()), T.StructField("end_byte", T.IntegerType())]))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int):
    """Items in blocks of at most ``most`` bytes (a longer item is a block of its own), one at a time."""
    block, size = [], 0
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(item_col, text_col).orderBy(item_col, text_col)
    for i, text in rows.toLocalIterator():
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append((i, text))
        size += len(text)
    yield block


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", q: int = Q, percent: int = EDIT_PERCENT, least: int = LEAST, index_bytes: int = INDEX_BYTES, into: str = "hits") -> DataFrame:
    """``docs`` with a column ``into``: the items found in the text, each with its edits and bounds (bytes of the
    normalised text), best place first found. Empty where there are none, also for null and empty texts.

    Items under ``least`` bytes (normalised) and null items are not looked for. Repeated rows are judged each. Items
    are carried to the tasks in blocks of at most ``index_bytes``, whatever their number: one scan for each block.
    A clashing column name gets a trailing "_".
    """
    (name,) = fresh(docs, into)
    schema = T.StructType([*docs.schema, T.StructField(name, _HIT)])
    context = docs.sparkSession.sparkContext
    text_at = docs.columns.index(text_col)
    out = docs.withColumn(name, F.array().cast(_HIT))
    for block in _blocks(benchmark, item_col, "text", index_bytes):
        items = context.broadcast(block)  # at most index_bytes

        def run(batches, items=items):
            index = Index(items.value, q, percent, least)
            for batch in batches:
                for piece in pieces(batch, text_at, PIECE_BYTES):
                    earlier = piece.column(piece.num_columns - 1).to_pylist()
                    for d, i, edits, start, end in index.hits(piece.column(text_at).to_pylist()):
                        earlier[d] = [*(earlier[d] or []), {"item_id": i, "edits": edits, "start_byte": start, "end_byte": end}]
                    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start_byte", pa.int32()), ("end_byte", pa.int32())]))
                    yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(earlier, kind)], names=[f.name for f in schema])
            give_back()

        out = out.mapInArrow(run, schema)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and item: ``id_col``, item_id, edits, start_byte, end_byte."""
    marked = mark(docs.select(id_col, text_col), benchmark, text_col, **options)
    return marked.select(id_col, F.explode(marked.columns[-1]).alias("hit")).select(id_col, "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any item, with their columns."""
    marked = mark(docs, benchmark, **options)
    return marked.filter(F.size(marked.columns[-1]) == 0).select(*docs.columns)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
