"""Periodic run detection: maximal repetitions of words, found with a dictionary of basic factors.

Level k names every factor of 2^k words by the pair of names of its halves; a factor that stands once in its text has
no name. Occurrences of a factor L = 2^k within 2L of each other form arithmetic progressions, one for each stretch that
repeats the factor's own period. A run with period q, L <= q < 2L, repeats the factor at its start q words later, in
another progression. It is met either between the last occurrence of the first progression and one of the
second, or between one of the first and the first of the second, and at most three progressions lie in reach. These
pairs propose the periods; the same dictionary extends them to both sides, and equal stretches keep their smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import BLANKS, documents, fresh, map_texts

LEAST_WORDS = 12
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _named(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Names of the factors that begin at ``at``; -1 where a key occurs once. One place more than there are words."""
    names = np.full(n + 1, -1, np.int64)
    _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
    more = count[name] > 1
    names[at[more]] = name[more]
    return names


def basic_factors(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Names of all factors of 1, 2, 4 … words, as long as any occurs twice."""
    n, size = len(codes), 1
    names = _named(codes, np.arange(n), n)
    while True:
        at = np.flatnonzero(names >= 0)
        if not len(at):
            return
        yield names
        at = at[(at + size < n) & (names[np.minimum(at + size, n)] >= 0)]
        names = _named(names[at] * (n + 1) + names[at + size], at, n)
        size *= 2


def _proposed(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods, size <= period < 2 * size, that the progressions of equal factors of ``size`` words propose."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name = names[at]
    begins = np.concatenate(([True], (name[1:] != name[:-1]) | (2 * np.diff(at) > size)))
    chain = np.cumsum(begins) - 1
    heads = np.flatnonzero(begins)
    first, last, of = at[heads], at[np.append(heads[1:], len(at)) - 1], name[heads]
    places, periods = [], []
    for step in (1, 2, 3):
        near = np.zeros(len(heads), bool)
        near[:-step] = (of[step:] == of[:-step]) & (first[step:] - last[:-step] < 2 * size)
        mine = np.flatnonzero(near[chain])  # elements of the earlier progression, to the first of the later one
        gap = first[chain[mine] + step] - at[mine]
        good = (gap >= size) & (gap < 2 * size)
        places.append(at[mine[good]])
        periods.append(gap[good])
        back = np.zeros(len(heads), bool)
        back[step:] = near[:-step]
        theirs = np.flatnonzero(back[chain])  # the last of the earlier one, to elements of the later one
        source = last[chain[theirs] - step]
        gap = at[theirs] - source
        good = (gap >= size) & (gap < 2 * size)
        places.append(source[good])
        periods.append(gap[good])
    return np.concatenate(places), np.concatenate(periods)


def find_runs(codes: np.ndarray, least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs with length >= max(least, 2 * period), by start, then period.

    ``codes``: a number for each word, equal for equal words of one text and different in different texts."""
    levels = list(basic_factors(codes))
    found = [_proposed(names, 1 << k) for k, names in enumerate(levels)]
    if not found:
        return np.zeros((0, 3), np.int64)
    at, period = (np.concatenate(x) for x in zip(*found))
    ahead, behind = np.zeros_like(at), np.zeros_like(at)
    for k in reversed(range(len(levels))):
        names, size = levels[k], 1 << k
        name = names[at + ahead]
        ahead += size * ((name >= 0) & (name == names[at + ahead + period]))
        before = at - behind - size
        name = names[np.maximum(before, 0)]
        behind += size * ((before >= 0) & (name >= 0) & (name == names[np.maximum(before, 0) + period]))
    start, length = at - behind, ahead + behind + period
    good = length >= np.maximum(least, 2 * period)
    start, length, period = start[good], length[good], period[good]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh_stretch = np.ones(len(start), bool)
    fresh_stretch[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    rows = np.column_stack((start, length, period))[fresh_stretch]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _block(texts: list, least: int) -> list:
    words = [(t or "").encode("utf-8").split() for t in texts]  # bytes are split at [\x20\x09-\x0D] alone
    counts = np.array([len(w) for w in words], np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(texts)), counts)
    word = pa.array([w for ws in words for w in ws], pa.binary()).dictionary_encode()
    rows = find_runs(doc * (len(word.dictionary) + 1) + word.indices.to_numpy(zero_copy_only=False), least)
    start, length, period = rows.T
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    keep = np.cumsum(cover[:-1]) == 0
    kept = [" ".join(w.decode("utf-8") for w in (ws if keep[a:b].all() else compress(ws, keep[a:b]))) for ws, a, b in zip(words, first, first[1:])]
    owner = doc[start] if len(rows) else np.zeros(0, np.int64)
    edges = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
    parts = [pa.array(x) for x in (start - first[owner], length, period)]
    runs = pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
    return [pa.array(counts), runs, pa.array(kept, pa.string())]


def detect(docs: DataFrame, text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without ``text_col``, plus n_words, runs and collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds (start, length, period) of every stretch of words that repeats its
    smallest period, spans at least ``least`` words and two periods, and cannot be extended; by start, then period.
    ``collapsed`` has the words left, joined by one space, when each run keeps its first period alone. Null and empty
    texts have no words, no runs and an empty ``collapsed``. Every row is judged by itself: repeated rows and null ids stay as they
    are, an empty table gives none. A new column whose name is taken gets a trailing "_". A text is worked on whole, with
    some 100 bytes of memory a word.
    """
    carry = [c for c in docs.columns if c != text_col]
    names = fresh(docs.select(carry), "n_words", "runs", "collapsed")
    kinds = [T.LongType(), T.ArrayType(_RUN), T.StringType()]

    def make():
        return lambda texts: _block(texts, least)

    return map_texts(docs, text_col, carry, [T.StructField(n, k) for n, k in zip(names, kinds)], make)


def with_planted_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which a tenth of the texts, chosen by crc32 of the id, repeat a stretch of their words to the end.

    With h = crc32(id as text), g = h div 10: where h is a multiple of 10, words from a = g mod n on become word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Null and empty texts, texts without words and rows
    without id stay as they are."""
    kept = [c for c in docs.columns if c != text_col]
    h, words, n, a, p = fresh(docs, "_h", "_words", "_n", "_a", "_p")
    g = F.floor(F.col(h) / 10)
    rows = docs.withColumn(h, F.crc32(F.col(id_col).cast("string")))
    split = F.array_remove(F.split(F.translate(text_col, BLANKS.decode(), " " * len(BLANKS)), " "), "")
    rows = rows.withColumn(words, F.when(F.col(h) % 10 == 0, split)).withColumn(n, F.size(words)).withColumn(a, F.when(F.col(n) > 0, (g % F.col(n)).cast("int")))
    rows = rows.withColumn(p, (1 + F.floor((F.col(n) - F.col(a)) / (3 + g % 8))).cast("int"))
    tail = F.col(n) - F.col(a)
    whole = F.flatten(F.array_repeat(F.slice(words, F.col(a) + 1, F.col(p)), F.ceil(tail / F.col(p)).cast("int")))
    text = F.array_join(F.concat(F.slice(words, 1, F.col(a)), F.slice(whole, 1, tail)), " ")
    return rows.select(*kept, F.when(F.col(n) > 0, text).otherwise(F.col(text_col)).alias(text_col))


def _longest(runs: Column) -> Column:
    """The run with the greatest length; ties: smallest start, then smallest period."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(with_planted_repeats(documents(spark, sf_dir).select("doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), _longest(F.col("runs")).alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return best.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
