"""Quality by co-training two views: what a text looks like, and what its metadata and layout say.

Each view is a naive Bayes classifier over binned features. In every round each view labels the documents it is
sure of, and the other view learns from them as well. Counts of features are aggregated over all documents; only
tables of (feature, bin, label) counts reach the driver, whose size depends on the features alone. At the end both
views are calibrated on labelled documents and combined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import Words, crc_fold, documents, fresh, map_texts, scratch

# Parameters: rounds, how sure a view must be to label for the other, weight of such labels, bins of sources.
ROUNDS = 3
SURE = 0.97
PSEUDO_WEIGHT = 0.3
SOURCES = 64
HELD_OUT = 0

# Upper ends of the bins of each measure; values above the last one have a bin of their own.
CONTENT = {
    "marks": (0.0, 0.01, 0.03, 0.05, 0.08, 0.15, 0.3),      # share of bytes that are ASCII marks
    "capitals": (0.0, 0.01, 0.03, 0.06, 0.2, 0.5, 0.8),     # share of capitals among letters
    "digits": (0.0, 0.002, 0.01, 0.03, 0.1),                # share of digits
    "word_bytes": (2.5, 3.5, 4.5, 5.5, 6.5, 8.0, 12.0),     # mean bytes of a word
    "short_words": (0.02, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7),    # share of words of at most three bytes
    "marked_words": (0.0, 0.05, 0.1, 0.2, 0.4, 0.7),        # share of words that end in a mark
    "loose_marks": (0.0, 0.02, 0.1, 0.3),                   # share of words that are marks alone
    "distinct": (0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95),     # distinct words to words
    "top_word": (0.03, 0.06, 0.1, 0.2, 0.4),                # share of the most frequent word
}
META = {
    "words": (1, 5, 20, 50, 100, 200, 400, 800, 2000, 8000),
    "lines": (1, 2, 3, 5, 10, 20, 50, 200),
    "line_bytes": (5, 20, 50, 100, 200, 400, 1000),
    "repeated_lines": (0.0, 0.05, 0.2, 0.5),                # share of lines that occurred before in the text
    "open_ends": (0.0, 0.1, 0.3, 0.6, 0.9),                 # share of lines without a full stop at the end
}
MEASURES = {**CONTENT, **META}


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int8)  # 0 blank, 1 mark, 2 digit, 3 capital, 4 small letter or beyond ASCII
    kind[33:127], kind[48:58], kind[65:91], kind[97:123], kind[128:] = 1, 2, 3, 4, 4
    return kind


def measures(texts: list) -> np.ndarray:
    """One row per text, one column per entry of ``MEASURES``; shares of nothing are 0."""
    words = Words(texts)
    n = len(texts)
    kind = _kinds()[words.codes]
    doc_of = np.repeat(np.arange(n), np.diff(words.offsets))

    def per_doc(mask):
        return np.bincount(doc_of[mask], minlength=n).astype(float)

    size = np.diff(words.offsets) - 1.0
    marks, digits, capitals, small = (per_doc(kind == k) for k in (1, 2, 3, 4))
    count = words.counts.astype(float)
    length = (words.ends - words.starts).astype(float)
    last = kind[words.ends - 1] if len(length) else kind[:0]

    def word_share(mask):
        return np.bincount(words.doc[mask], minlength=n) / np.maximum(count, 1)

    inside = np.concatenate(([0], np.cumsum(kind > 1)))
    loose = inside[words.ends] == inside[words.starts]
    hashes = words.hashes() if len(length) else np.zeros(0, np.uint64)
    order = np.lexsort((hashes, words.doc))
    h, d = hashes[order], words.doc[order]
    first = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))) if len(h) else np.zeros(0, np.int64)
    runs = np.diff(np.append(first, len(h)))
    distinct = np.bincount(d[first], minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, d[first], runs)
    lines = [t.split("\n") if t else [] for t in texts]
    n_lines = np.array([len(x) for x in lines], float)
    again = np.array([len(x) - len(set(x)) for x in lines], float)
    open_ = np.array([sum(1 for y in x if y and y[-1] not in ".!?") for x in lines], float)
    some = np.maximum(count, 1)
    columns = [
        marks / np.maximum(size, 1), capitals / np.maximum(capitals + small, 1), digits / np.maximum(size, 1),
        np.bincount(words.doc, length, minlength=n) / some, word_share(length <= 3), word_share(last == 1), word_share(loose),
        distinct / some, top / some,
        count, n_lines, size / np.maximum(n_lines, 1), again / np.maximum(n_lines, 1), open_ / np.maximum(n_lines, 1),
    ]
    return np.stack(columns, 1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc, content array<int>, meta array<int>) for every row: numbers of bins. Language and source are one bin of a
    hash each; null is a bin of its own. Null and empty texts have all measures 0."""
    def bins(name: str) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(F.col(name)), F.lit(SOURCES)).cast("int"), F.lit(0)) if name in docs.columns else F.lit(0)

    lang, source = fresh(docs, "_lang", "_source")
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), bins(lang_col).alias(lang), bins(source_col).alias(source))

    def make():
        edges = [np.array(e, float) for e in MEASURES.values()]

        def work(texts, langs, sources):
            values = measures(texts)
            binned = np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(edges)], 1).astype(np.int32)
            content = binned[:, :len(CONTENT)]
            meta = np.column_stack([binned[:, len(CONTENT):], np.array(langs, np.int32), np.array(sources, np.int32)])
            return [pa.array(list(content), pa.list_(pa.int32())), pa.array(list(meta.astype(np.int32)), pa.list_(pa.int32()))]

        return work

    kind = T.ArrayType(T.IntegerType())
    return map_texts(rows, "text", ["doc"], [T.StructField("content", kind), T.StructField("meta", kind)], make, also=[lang, source])


@dataclass
class View:
    """Naive Bayes over one array of bins, and its calibration."""
    column: str
    weights: dict[int, dict[int, float]] = field(default_factory=dict)  # place in the array -> bin -> log odds
    prior: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def learn(column: str, counts: list, totals: tuple[float, float]) -> View:
        """``counts``: rows of (place, bin, bad, good); ``totals``: weight of bad and good documents."""
        bad, good = totals
        view = View(column, prior=float(np.log((good + 1) / (bad + 1))))
        for place, bin_, n_bad, n_good in counts:
            odds = np.log((n_good + 0.5) / (good + 5)) - np.log((n_bad + 0.5) / (bad + 5))
            view.weights.setdefault(place, {})[bin_] = float(odds)
        return view

    def raw(self) -> Column:
        """Log odds that a document is good."""
        total = F.lit(self.prior)
        for place, bins in sorted(self.weights.items()):
            table = F.create_map(*[x for b, w in sorted(bins.items()) for x in (F.lit(b), F.lit(w))])
            total = total + F.coalesce(F.try_element_at(table, F.col(self.column)[place]), F.lit(0.0))
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-(self.raw() * self.slope + self.shift)))


def _learn(rows: DataFrame, column: str) -> View:
    """View fitted on rows of (column, label 0 or 1, weight); the aggregates have one row for each bin."""
    bad, good = (F.sum(F.when(F.col("label") == k, F.col("weight")).otherwise(0.0)) for k in (0, 1))
    exploded = rows.select(F.posexplode(column).alias("place", "bin"), "label", "weight")
    counts = exploded.groupBy("place", "bin").agg(bad.alias("bad"), good.alias("good")).collect()
    totals = rows.agg(bad, good).first()
    return View.learn(column, [tuple(r) for r in sorted(counts)], (totals[0] or 0.0, totals[1] or 0.0))


def _calibrate(view: View, labelled: DataFrame) -> None:
    """Slope and shift of the log odds, fitted on counts of labels by rounded log odds (at most 401 rows)."""
    level = F.round(F.greatest(F.least(view.raw(), F.lit(20.0)), F.lit(-20.0)) * 10).cast("int")
    rows = labelled.groupBy(level.alias("level")).agg(F.sum(F.col("label").cast("double")).alias("good"), F.count("*").alias("n")).collect()
    if len(rows) > 1:
        x = np.array([[r.level / 10] for r in rows for _ in (0, 1)])
        weight = np.array([w for r in rows for w in (r.n - r.good, r.good)])
        y = np.array([0.0, 1.0] * len(rows))
        scale = max(weight.sum(), 1.0)
        if 0 < (weight * y).sum() < scale:
            w, b = weighted_logistic(x, y, weight)
            view.slope, view.shift = max(float(w), 0.0), b


def weighted_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    design = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (weight * (p - y)) + ridge * w
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        w -= np.linalg.solve(curve, slope)
    return float(w[0]), float(w[1])


def co_train(rows: DataFrame, rounds: int = ROUNDS, sure: float = SURE, pseudo_weight: float = PSEUDO_WEIGHT) -> tuple[View, View]:
    """Both views, from rows of (content, meta, label or null, learn). Rows with ``learn`` and a label teach; all rows
    without one are labelled by a view that is sure of them, for the other view, anew in each round."""
    labelled = rows.filter("learn and label is not null").withColumn("weight", F.lit(1.0))
    unlabelled = rows.filter("label is null")
    views = [_learn(labelled, c) for c in ("content", "meta")]
    for view in views:
        _calibrate(view, labelled)
    for _ in range(rounds):
        taught = []
        for view, other in zip(views, reversed(views)):
            p = other.probability()
            guesses = unlabelled.withColumn("p", p).filter((F.col("p") >= sure) | (F.col("p") <= 1 - sure)).withColumn("label", (F.col("p") >= 0.5).cast("int"))
            both = labelled.select(view.column, "label", "weight").union(guesses.select(view.column, "label", F.lit(pseudo_weight)))
            taught.append(_learn(both, view.column))
        views = taught
        for view in views:
            _calibrate(view, labelled)
    return views[0], views[1]


def combined(content: View, meta: View, rows: DataFrame) -> Column:
    """Probability from both calibrated views; their weights come from labelled rows by counts of rounded log odds
    (at most 41 * 41 rows)."""
    def level(view):
        return F.round(F.greatest(F.least(view.raw() * view.slope + view.shift, F.lit(10.0)), F.lit(-10.0)) * 2).cast("int")

    table = rows.filter("learn and label is not null").groupBy(level(content).alias("a"), level(meta).alias("b"), "label").count().collect()
    weights, bias = np.array([0.5, 0.5]), 0.0
    if len({r.label for r in table}) == 2:
        x = np.array([[r.a / 2, r.b / 2] for r in table], float)
        y = np.array([float(r.label) for r in table])
        n = np.array([float(r["count"]) for r in table])
        w = np.zeros(3)
        design = np.column_stack([x, np.ones(len(x))])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            curve = (design * (n * p * (1 - p))[:, None]).T @ design + np.eye(3)
            w -= np.linalg.solve(curve, design.T @ (n * (p - y)) + w)
        weights, bias = w[:2], float(w[2])
    parts = [(v.raw() * v.slope + v.shift) * float(k) for v, k in zip((content, meta), weights)]
    return 1 / (1 + F.exp(-(parts[0] + parts[1] + bias)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_fold: int | None = HELD_OUT, **options) -> DataFrame:
    """``id_col``, score (probability of good quality), content_score, meta_score, keep (score >= 0.5), for every row.

    ``labels`` (doc_id, quality 0 or 1) teach unless crc32 of the id, modulo 5, is ``held_out_fold``; null labels and
    ids are left out, of several labels of an id the largest counts. Without labels all scores are 0.5 and all rows
    are kept. Features are written once to the shared folder. Repeated rows are scored each; other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch(spark, "features")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    binned = features(docs, id_col, text_col)
    learn = F.lit(True) if held_out_fold is None else crc_fold(F.col("doc")) != held_out_fold
    shown = F.when(learn, F.col("label"))
    binned.join(known, F.col("doc") == F.col("doc_id"), "left").select("doc", "content", "meta", shown.alias("label"), learn.alias("learn")).write.parquet(path)
    rows = spark.read.parquet(path)
    content, meta = co_train(rows, **options)
    score = combined(content, meta, rows)
    scored = rows.select(F.col("doc").alias(id_col), score.alias("score"), content.probability().alias("content_score"), meta.probability().alias("meta_score"))
    return scored.withColumn("keep", F.col("score") >= 0.5)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "content_score", "meta_score", F.col("keep").cast("int").alias("predicted"))
