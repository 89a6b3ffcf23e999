"""Shared helpers of the text operators: Arrow batches by size, hashing of words, unused column names."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.session import checkpoint_root

# White space of word and line rules, [\x20\x09-\x0D].
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLOCK_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; registers it for ``checkpoint()`` where the session has none yet."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_root(spark))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def pieces(batch: pa.RecordBatch, column: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes.astype(np.int64)) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def give_back() -> None:
    """Worker processes live on after a task; what they have freed goes back to the system, where that is possible."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(df: DataFrame, text_col: str, carry: Sequence[str], fields: Sequence[T.StructField], make: Callable[[], Callable[..., list]], most: int = BLOCK_BYTES, also: Sequence[str] = ()) -> DataFrame:
    """Arrow map over blocks of texts: ``make()`` runs once in a task and gives a function from a list of texts
    (None for null), and one list for each column in ``also``, to one Arrow array per field. Columns ``carry``
    pass through; all other columns are dropped."""
    n, m = len(carry), len(carry) + len(also)
    source = df.select(*carry, *also, *([] if text_col in carry else [text_col]))
    if text_col in carry:
        m = list(carry).index(text_col)
    given_at = range(n, n + len(also))
    schema = T.StructType([*(source.schema[c] for c in carry), *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch, m, most):
                columns = [piece.column(i) for i in range(n)]
                given = [piece.column(i).to_pylist() for i in (m, *given_at)]
                yield pa.RecordBatch.from_arrays([*columns, *work(*given)], names=[f.name for f in schema])
        give_back()

    return source.mapInArrow(run, schema)


# --- words and their hashes, by whole blocks of texts ------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        room = np.full(max(n, 1024), base, np.uint64)
        room[0] = 1
        got = np.cumprod(room, dtype=np.uint64)
        if n <= 2 * BLOCK_BYTES:
            _POWERS[base] = got
    return got[:n]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of values[start:end], equal for equal runs wherever they stand."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * _powers(base, len(values)), out=total[1:])
    inverse = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression by Newton steps."""
    design = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


class Words:
    """Words of a block of texts: ``starts``/``ends`` in ``data`` (bytes), ``doc`` of each word, ``first`` word of each text."""

    def __init__(self, texts: list, lower: bool = False, between: np.ndarray = _BLANK):
        raw = [(t or "").encode("utf-8") for t in texts]
        joined = b"\n".join([*raw, b""])
        self.data = joined.translate(LOWERED) if lower else joined
        codes = np.frombuffer(self.data, np.uint8)
        blank = between[codes] if len(codes) else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.codes = codes
        self.offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in raw]))).astype(np.int64)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, second: bool = False) -> np.ndarray:
        return spans_hash(self.codes.astype(np.uint64), self.starts, self.ends, _Q if second else _P)


def windows(hashes: np.ndarray, doc: np.ndarray, size: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Start indices and hashes of all runs of ``size`` words within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(doc[:n] == doc[size - 1:])
    return starts, spans_hash(hashes, starts, starts + size, _P if second else _Q)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow lists from their values one after another and their lengths."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat, kind))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a written table: below ``spark.checkpoint.dir``, or a local one where that is unset (tests)."""
    root = shared_folder(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def in_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, *extra: Column) -> DataFrame:
    """(doc, text, block, extra): rows dealt by a hash of id and text into blocks of about ``block_bytes`` of text."""
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = total // block_bytes + 1
    return docs.select(
        F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"), *extra)


def halves(table: pa.Table, text: int, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """A group's rows in slices of about ``most`` bytes of text."""
    for batch in table.combine_chunks().to_batches():
        yield from pieces(batch, text, most)


# --- filters of fixed size ----------------------------------------------------------------------------

FILTER_BITS = 1 << 23


def _filter_words(hashes: DataFrame) -> DataFrame:
    """(word, bits) of a Bloom filter of the 64-bit hashes in the only column: at most FILTER_BITS / 64 rows, however
    many hashes there are; more of them only let more pass."""
    h = F.col(hashes.columns[0])
    bits = hashes.select(F.explode(F.array(h, F.shiftrightunsigned(h, 32))).alias("h")).select(F.col("h").bitwiseAND(FILTER_BITS - 1).alias("bit"))
    return bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))


def bloom(hashes: DataFrame) -> np.ndarray:
    """The filter as numbers, for tasks in Python."""
    words = _filter_words(hashes).collect()  # at most FILTER_BITS / 64
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[[w["word"] for w in words]] = [w["bits"] for w in words]
    return out.view(np.uint64)


def may_hold(hashes: DataFrame, hashed: Column) -> Column:
    """Whether a 64-bit hash may be among ``hashes``: the filter, a value of 1 MB, is a scalar subquery."""
    words = hashes.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "word").join(_filter_words(hashes), "word", "left")
    dense = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    table = words.agg(dense.alias("words")).select(F.col("words.bits")).scalar()

    def one(h: Column) -> Column:
        at = h.bitwiseAND(FILTER_BITS - 1)
        word = F.get(table, F.shiftright(at, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    return one(hashed) & one(F.shiftrightunsigned(hashed, 32))


def passes(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the hashes (unsigned) may be in the filter."""
    good = np.ones(len(hashes), bool)
    for x in (hashes, hashes >> np.uint64(32)):
        at = x & np.uint64(FILTER_BITS - 1)
        good &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return good
