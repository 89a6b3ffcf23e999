"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is coded as its words with one space between and a line feed as end. The tree has one node for every context
of up to DEPTH bytes and every prefix of the next byte's bits. A node mixes its own Krichevsky-Trofimov estimate with
the nodes of longer contexts, by the weights of the context-tree recursion, so all depths take part in each
prediction. Counts come from all training documents. The tree is built in groups of contexts that end alike and never
stands in one place; only depths 0 and 1, at most 256 * 255 nodes, pass the driver.

Documents are scored in blocks. A block asks once for each of its words and byte sequences, so a word that stands in
every document makes one row for each block; a word found in one block only needs no answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm.base import LOWERED, Words, crc_fold, documents, halves, in_blocks, pieces, scratch, signed

DEPTH = 4
BLOCK = 8 << 20
HELD_OUT = 1
TOKENS, GRAMS = 0, 1
LOG_HALF = np.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x >= 0.5, by Stirling's series after six steps of the recurrence."""
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    z = x + 6
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7) - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives to so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def grams(texts: list, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that each text is coded as, with their ``depth`` bytes before, latest lowest, as numbers; and the text of
    each. Before a text stand line feeds."""
    parts = [b" ".join((t or "").encode().translate(LOWERED).split()) + b"\n" for t in texts]
    codes = np.frombuffer(b"".join(b"\n" * depth + p for p in parts), np.uint8).astype(np.uint64)
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes + depth) - sizes - depth
    out = codes.copy()
    for back in range(1, depth + 1):
        out[back:] |= codes[:-back] << np.uint64(8 * back)
    real = np.ones(len(codes), bool)
    for back in range(depth):
        real[starts + back] = False
    return out[real], np.repeat(np.arange(len(texts)), sizes)


def tally(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their summed weights (or numbers)."""
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values, kind="stable")
        values, weights = values[order], weights[order]
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values))) if weights is None else np.add.reduceat(weights, first)


class Places:
    """Places of values in sorted keys that hold them, by a table of hash slots."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.shift = np.uint64(64 - max(16, int(4 * len(keys)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.zeros(0, np.int64)
        at = self.table[self._slot(values)]
        other = np.flatnonzero(self.keys[at] != values)  # another key has the slot
        at[other] = np.searchsorted(self.keys, values[other])
        return at


def _tokens(texts: list) -> tuple[Words, np.ndarray]:
    words = Words(texts, lower=True)
    return words, words.hashes() if len(words.starts) else np.zeros(0, np.uint64)


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """One (keys, numbers) from several."""
    return tally(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))


def _tallies(texts: list, train: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By kind: all words and byte sequences of the texts, and how often they occur in texts that teach."""
    words, hashes = _tokens(texts)
    found, doc = grams(texts, depth)
    out = {}
    for kind, values, teaches in ((TOKENS, hashes, train[words.doc]), (GRAMS, found, train[doc])):
        rest, _ = tally(values[~teaches])
        out[kind] = _summed([tally(values[teaches]), (rest, np.zeros(len(rest), np.int64))])
    return out


def _rows(tallies: dict[int, tuple[np.ndarray, np.ndarray]], **constant: int) -> pa.Table:
    keys, n = (np.concatenate([t[i] for t in tallies.values()]) for i in (0, 1))
    kinds = np.concatenate([np.full(len(t[0]), kind, np.int32) for kind, t in tallies.items()])
    same = {name: pa.array(np.full(len(keys), x, np.int32)) for name, x in constant.items()}
    return pa.table({"kind": pa.array(kinds), "key": signed(keys.astype(np.uint64)), "n": pa.array(n.astype(np.int64)), **same})


def _counts(docs: DataFrame, text_col: str, train: Column, depth: int) -> DataFrame:
    """(kind, key, n): occurrences in training documents, 0 for what only other documents have."""
    def run(batches):
        held: dict[int, list] = {TOKENS: [], GRAMS: []}
        for batch in batches:
            for piece in pieces(batch, 0):
                for kind, t in _tallies(piece.column(0).to_pylist(), np.array(piece.column(1).to_pylist(), bool), depth).items():
                    held[kind].append(t)
                    if len(held[kind]) > 8:
                        held[kind] = [_summed(held[kind])]
        yield from _rows({kind: _summed(parts) for kind, parts in held.items() if parts} or {TOKENS: (np.zeros(0), np.zeros(0))}).to_batches(100_000)

    source = docs.select(F.col(text_col).cast("string").alias("text"), train.alias("train"))
    return source.mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Level:
    """Nodes of one depth in a group: counts, log KT, weighted log probability."""

    def __init__(self, ids: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: tuple[np.ndarray, np.ndarray] | None):
        self.ids, first, self.inverse = np.unique(ids, return_index=True, return_inverse=True)
        size = len(self.ids)
        self.first = first
        self.zeros, self.ones = np.bincount(self.inverse, zeros, size), np.bincount(self.inverse, ones, size)
        own = log_kt(self.zeros, self.ones)
        if children is None:
            self.weighted = own
        else:
            below = np.bincount(children[0], children[1], size)
            self.weighted = np.logaddexp(LOG_HALF + own, LOG_HALF + below)
        self.share = np.exp(np.minimum(LOG_HALF + own - self.weighted, 0)) if children is not None else np.ones(size)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)

    @property
    def seen(self) -> np.ndarray:
        return self.zeros + self.ones > 0


def levels(keys: np.ndarray, n: np.ndarray, depth: int, least: int) -> tuple[np.ndarray, dict[int, Level]]:
    """Bits of all byte sequences (eight each, one after another) and the nodes of depths ``least`` to ``depth``."""
    symbol = (keys & np.uint64(255)).astype(np.int64)
    place = np.arange(8)
    prefix = ((1 << place) | (symbol[:, None] >> (8 - place))).ravel()
    bit = ((symbol[:, None] >> (7 - place)) & 1).ravel()
    weight = np.repeat(n.astype(float), 8)
    zeros, ones = weight * (bit == 0), weight * bit
    out: dict[int, Level] = {}
    children = None
    for d in range(depth, least - 1, -1):
        context = ((keys >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)).astype(np.int64)
        ids = np.repeat(context << 8, 8) | prefix
        if d < depth:
            below = out[d + 1]
            order = np.unique(ids, return_inverse=True)[1]
            children = order[below.first], below.weighted * below.seen
        out[d] = Level(ids, zeros, ones, children)
    return bit, out


def mixed(one: np.ndarray, seen: np.ndarray, share: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Probability of a one: own estimate and that of longer contexts; contexts never seen say nothing."""
    return np.where(seen, share * one + (1 - share) * deeper, np.nan)


def _predict(bit: np.ndarray, tree: dict[int, Level], top: dict[int, dict[str, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """log10 probability of the byte of each sequence. ``top``: tables of depths 0 and 1, by node number."""
    deeper = None
    depths = sorted(tree, reverse=True)
    prefix = tree[depths[-1]].ids[tree[depths[-1]].inverse] & 255
    last = np.repeat(((keys >> np.uint64(8)) & np.uint64(255)).astype(np.int64), 8)
    for d in depths:
        level = tree[d]
        one, seen, share = (x[level.inverse] for x in (level.one, level.seen, level.share))
        deeper = mixed(one, seen, share, one if deeper is None else np.where(np.isnan(deeper), one, deeper))
    for d, at in ((1, last << 8 | prefix), (0, prefix)):
        one, seen, share = (top[d][x][at] for x in ("one", "seen", "share"))
        deeper = mixed(one, seen, share, np.where(np.isnan(deeper), one, deeper))
    one = np.where(np.isnan(deeper), 0.5, deeper)
    return np.log10(np.where(bit == 1, one, 1 - one)).reshape(-1, 8).sum(1)


def _top(nodes: list) -> dict[int, dict[str, np.ndarray]]:
    """Tables of depths 1 and 0 from (c1, prefix, zeros, ones, log probability of what lies below)."""
    out = {}
    size = 1 << 16
    zeros, ones, below = np.zeros(size), np.zeros(size), np.zeros(size)
    for c, b, z, o, w in nodes:
        zeros[c << 8 | b], ones[c << 8 | b], below[c << 8 | b] = z, o, w
    for d in (1, 0):
        own = log_kt(zeros, ones)
        weighted = np.where(zeros + ones > 0, np.logaddexp(LOG_HALF + own, LOG_HALF + below), 0.0)
        out[d] = {"one": (ones + 0.5) / (zeros + ones + 1), "seen": zeros + ones > 0, "share": np.exp(np.minimum(LOG_HALF + own - weighted, 0))}
        if d:
            zeros, ones, below = (x.reshape(256, 256).sum(0) for x in (zeros, ones, weighted))
    return out


def _model(counts: DataFrame, depth: int) -> DataFrame:
    """(key, value): log10 probability of each byte sequence in ``counts`` (key, n)."""
    groups = counts.withColumn("ending", F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)))

    def low(table: pa.Table) -> pa.Table:
        keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
        node = levels(keys, n, depth, 2)[1][2]
        held = node.seen
        last = (node.ids >> 8) & 255
        return pa.table({"c": pa.array(last[held]), "b": pa.array((node.ids & 255)[held]), "zeros": pa.array(node.zeros[held]), "ones": pa.array(node.ones[held]), "below": pa.array(node.weighted[held])})

    nodes = groups.groupBy("ending").applyInArrow(low, "c long, b long, zeros double, ones double, below double")
    rows = nodes.groupBy("c", "b").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).collect()  # at most 256 * 255
    top = counts.sparkSession.sparkContext.broadcast(_top([tuple(r) for r in rows]))

    def predict(table: pa.Table) -> pa.Table:
        keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
        bit, tree = levels(keys, n, depth, 2)
        return pa.table({"key": signed(keys), "value": pa.array(_predict(bit, tree, top.value, keys))})

    return groups.groupBy("ending").applyInArrow(predict, "key long, value double")


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK) -> DataFrame:
    """``id_col``, n_bytes, bits_per_byte, n_tokens, n_known, train_tokens, base_score, score, for every row.

    ``train`` says which rows teach. A-Z are lower-cased; tokens are the words and one end. ``base_score`` is the
    log10 probability under smoothed token counts, ``score`` under the context tree; n_bytes are those it codes. Null and empty texts have the end only. Repeated rows teach and are scored each.
    Without training rows all bits are even. Other columns are ignored. Empty table: no rows.
    """
    spark = docs.sparkSession
    path = scratch(spark, "ctw")
    _counts(docs, text_col, train, depth).write.parquet(f"{path}/counts")
    counts = spark.read.schema("kind int, key long, n long").parquet(f"{path}/counts")
    sums = counts.filter(F.col("kind") == TOKENS).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_end = docs.filter(train).count()
    total, distinct = (sums.n or 0) + n_end, sums.v + (n_end > 0)
    _model(counts.filter(F.col("kind") == GRAMS).select("key", "n"), depth).write.parquet(f"{path}/model")
    model = spark.read.schema("key long, value double").parquet(f"{path}/model")
    answers = counts.filter(F.col("kind") == TOKENS).select("kind", "key", F.col("n").cast("double").alias("value")).union(model.select(F.lit(GRAMS).alias("kind"), "key", "value"))

    blocks = in_blocks(docs, id_col, text_col, block_bytes, train.alias("train"))

    def ask(table: pa.Table) -> pa.Table:
        held: dict[int, list] = {TOKENS: [], GRAMS: []}
        for part in halves(table, 1):
            for kind, t in _tallies(part.column(1).to_pylist(), np.array(part.column(3).to_pylist(), bool), depth).items():
                held[kind].append(t)
        return _rows({kind: _summed(parts) for kind, parts in held.items()}, block=table.column(2)[0].as_py())

    asked = blocks.groupBy("block").applyInArrow(ask, "kind int, key long, n long, block int")
    news = (F.col("kind") == GRAMS) | (F.col("value") != F.col("n"))
    told = asked.join(answers.hint("merge"), ["kind", "key"]).filter(news).select("block", "kind", "key", F.col("value").cast("double").alias("value"))
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, keys, values = right.column(1).to_numpy(), right.column(2).to_numpy().view(np.uint64), right.column(3).to_numpy()

        def table(kind):
            own = kinds == kind
            order = np.argsort(keys[own])
            return keys[own][order], values[own][order]

        (names, numbers), (sequences, chances) = table(TOKENS), table(GRAMS)
        parts = list(halves(left, 1))
        own = []
        for part in parts:
            words, hashes = _tokens(part.column(1).to_pylist())
            teaches = np.array(part.column(3).to_pylist(), bool)[words.doc]
            rest, _ = tally(hashes[~teaches])
            own += [tally(hashes[teaches]), (rest, np.zeros(len(rest), np.int64))]
        here, count_here = _summed(own) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        count_here = count_here.astype(float)
        count_here[np.searchsorted(here, names)] = numbers
        word_place, byte_place = Places(here), Places(sequences)
        out = []
        for part in parts:
            texts = part.column(1).to_pylist()
            n = len(texts)
            words, hashes = _tokens(texts)
            c = count_here[word_place.of(hashes)]
            found, doc = grams(texts, depth)
            chance = chances[byte_place.of(found)]
            n_tokens = words.counts + 1
            base = np.bincount(words.doc, np.log10(c + 0.5), minlength=n) + np.log10(n_end + 0.5) - n_tokens * norm
            known = np.bincount(words.doc[c > 0], minlength=n) + int(n_end > 0)
            score, size = np.bincount(doc, chance, minlength=n), np.bincount(doc, minlength=n)
            out.append(pa.table({
                "doc": part.column(0), "n_bytes": pa.array(size), "bits_per_byte": pa.array(-score / np.log10(2) / size), "n_tokens": pa.array(n_tokens),
                "n_known": pa.array(known), "train_tokens": pa.array(np.full(n, total, np.int64)), "base_score": pa.array(base), "score": pa.array(score)}))
        return pa.concat_tables(out)

    schema = f"doc {id_type}, n_bytes long, bits_per_byte double, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(scored, schema).withColumnRenamed("doc", id_col)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_fold(F.col("doc_id")) == HELD_OUT
    scored = score(documents(spark, sf_dir), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")
