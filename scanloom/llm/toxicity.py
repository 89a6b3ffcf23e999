"""Toxicity through a noisy channel: disguised spellings are decoded before the text is scored.

The channel turns letters into look-alikes, stretches them, or puts separators between them. Every suspicious span
is a lattice of possible letters; Viterbi decoding under a character trigram model of the whole corpus finds the
likeliest source. A logistic model over words, fitted on a bounded sample of labelled rows, scores the restored text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm.base import Words, crc_fold, documents, fresh, give_back, logistic, pieces, sigmoid

# Parameters of the fit. The sample of labelled rows is bounded by SAMPLE_ROWS.
SAMPLE_ROWS = 5_000
FEATURES = 300
LEAST_DOCS = 5
# Memory of a worker: spans it remembers, and text it looks at in one go.
CACHE_BYTES = 16 << 20
SCORE_BYTES = 512 << 10

# What a written character may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
}
HIDDEN = "​‌‍⁠﻿"
SEPARATORS = " \t._-*|/,~"
SUBSTITUTED, SKIPPED, STRETCHED, SPLIT = -1.5, -0.4, -0.3, -2.5

# Marks that may stand around a word, and those of them that may as well be its first or last letters.
PUNCTUATION = ",.;:!?\"'()#%&"
MARKS = PUNCTUATION + "".join(c for c in LOOKS if not c.isalnum() and c not in PUNCTUATION)
# Up to so many marks on one side of a word are tried one by one as letters; of longer runs also all.
MARKS_TRIED = 6

_LEET = re.escape("".join(LOOKS))
_SINGLE = "a-z" + re.escape("".join(c for c in LOOKS if c not in SEPARATORS))
_SUSPICIOUS = re.compile(
    f"(?<![^\\W_])[{_SINGLE}](?:[ \\t._\\-*|/,~]{{1,3}}[{_SINGLE}](?![{_SINGLE}])){{2,}}"  # i d 1 o t
    # a token with a look-alike anywhere: m0ron, $cum, idio7; or of look-alikes alone: @$$
    f"|(?<!\\S)(?=\\S*?[{_LEET}])(?:[^\\sa-z]*[a-z]\\S*|[{_LEET}{re.escape(MARKS + SEPARATORS.strip())}{HIDDEN}]+(?!\\S))"
    r"|([a-z])\1\1"                                             # idiooot
    f"|[{HIDDEN}]")
_LETTER = re.compile("[a-z]")
_OUTSIDE = "".join(c for c in PUNCTUATION if c not in LOOKS)
_BLANK = re.compile(r"\s")
_STRETCH = re.compile(r"(.)\1\1+", re.S)
# A word is a run of a-z and of characters beyond ASCII.
_WORD = re.compile("[a-z\x80-\U0010ffff]+")
_BETWEEN = np.ones(256, bool)
_BETWEEN[97:123] = _BETWEEN[128:] = False
_LEET_BYTES = np.zeros(256, bool)
_LEET_BYTES[[ord(c) for c in LOOKS if c < "\x80"]] = True
# First bytes in UTF-8 of the look-alikes and hidden characters beyond ASCII.
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[0xC2, 0xD0, 0xD1, 0xE2, 0xEF]] = True


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 0


_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[97:123] = np.arange(1, 27)
_SYMBOLS[65:91] = np.arange(1, 27)


def char_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams (a-z, all else one blank) over all texts: 27 * 27 * 27 numbers."""
    def run(batches):
        total = np.zeros(27 ** 3, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                text = " ".join(t or "" for t in batch.column(0).slice(start, 256).to_pylist())
                s = _SYMBOLS[np.frombuffer(f"  {text} ".encode(), np.uint8)]
                total += np.bincount((s[:-2] * 27 + s[1:-1]) * 27 + s[2:], minlength=27 ** 3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["gram", "n"])
        give_back()

    rows = docs.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(27 ** 3)
    for r in rows:
        counts[r.gram] = r.n
    return counts


class Channel:
    """Viterbi decoder over character lattices."""

    def __init__(self, counts: np.ndarray, expected: Iterable[str] = ()):
        grams = counts.reshape(27, 27, 27).copy()
        expected = [w for w in expected if re.fullmatch("[a-z]+", w)]
        self.expected = set(expected)
        weight = max(grams.sum(), 1) / (200 * max(len(expected), 1))
        for word in expected:  # words that the channel is known to disguise
            s = [0, 0, *map(_symbol, word), 0]
            for a, b, c in zip(s, s[1:], s[2:]):
                grams[a, b, c] += weight
        two, one = grams.sum(0), grams.sum((0, 1))
        p1 = (one + 1) / (one.sum() + 27)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        p3 = (grams + 20 * p2[None]) / (grams.sum(2, keepdims=True) + 20)
        self.log = np.log(p3).tolist()
        self.known: dict[str, str] = {}
        self.sets: dict[str, set[str]] = {}
        self.held = 0

    def _hold(self, span: str) -> None:
        """Both caches start anew when their spans and results fill some ``CACHE_BYTES``."""
        self.held += 300 + 4 * len(span)
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.sets.clear()
            self.held = 0

    def decode(self, span: str) -> str:
        """Likeliest source of a span, words parted by one space."""
        got = self.known.get(span)
        if got is None:
            self._hold(span)
            got = self.known[span] = self._viterbi(span)
        return got

    def words(self, span: str) -> set[str]:
        """Words of all readings of a span. A single look-alike is no word."""
        got = self.sets.get(span)
        if got is None:
            self._hold(span)
            got = self.sets[span] = {w for r in _readings(span) if len(r) > 1 or _LETTER.match(r) for w in self.decode(r).split()}
        return got

    def source(self, span: str) -> str:
        """The source of a span: the first reading with an expected word, else the one without punctuation. What
        nothing disguises stays as written, and so do numbers and marks in which no expected word is found."""
        readings = _readings(span)
        for reading in readings:
            decoded = self.decode(reading)
            if not self.expected.isdisjoint(decoded.split()):
                return span if decoded == reading else decoded
        if not readings or not _LETTER.search(span) or self.decode(readings[0]) == readings[0]:
            return span
        return self.decode(readings[0])

    def _viterbi(self, span: str) -> str:
        log = self.log
        states = {(0, 0): (0.0, None)}  # last two symbols -> score, path
        stretched = {i for m in _STRETCH.finditer(span) for i in range(m.start() + 1, m.end())}
        for i, c in enumerate(span):
            moves = []  # symbol (None: nothing is written), cost
            if "a" <= c <= "z":
                moves.append((_symbol(c), 0.0))
                if i in stretched:
                    moves.append((None, STRETCHED))
            elif c in HIDDEN:
                moves.append((None, 0.0))
            else:
                moves += [(_symbol(x), SUBSTITUTED) for x in LOOKS.get(c, "")]
                if c in SEPARATORS:
                    moves += [(None, SKIPPED), (0, SPLIT)]
                elif i in stretched:
                    moves.append((None, STRETCHED))
                elif c not in LOOKS:
                    moves.append((0, 0.0))
            following: dict = {}
            for (a, b), (score, path) in states.items():
                for symbol, cost in moves:
                    if symbol is None:
                        key, total, new = (a, b), score + cost, path
                    else:
                        if symbol == 0 and b == 0:
                            key, total, new = (a, b), score + cost, path
                        else:
                            key, total, new = (b, symbol), score + cost + log[a][b][symbol], (symbol, path)
                    if key not in following or following[key][0] < total:
                        following[key] = (total, new)
            states = following
        _, path = max(((score + log[a][b][0], path) for (a, b), (score, path) in states.items()), key=lambda x: x[0])
        out = []
        while path is not None:
            out.append(" " if path[0] == 0 else chr(96 + path[0]))
            path = path[1]
        return "".join(reversed(out)).strip()


def _spans(text: str) -> Iterable[tuple[int, int]]:
    """Suspicious spans of a lower-cased text, widened to whole words."""
    end = 0
    for m in _SUSPICIOUS.finditer(text):
        if m.end() <= end:
            continue
        left = max(*(text.rfind(c, end, m.start()) for c in " \n\t\r"), end - 1) + 1
        stop = _BLANK.search(text, m.end())
        end = stop.start() if stop else len(text)
        yield left, end


def _cuts(n: int) -> list[int]:
    return [*range(min(n, MARKS_TRIED) + 1), *([n] if n > MARKS_TRIED else [])]


def _readings(span: str) -> list[str]:
    """What may be the written word in a span: first the span without punctuation, then with any number of the marks
    on both sides as letters ("(lown!" is lown, clown, clowni, lowni). A mark repeated there counts twice at most."""
    body = span.strip(MARKS)
    head, tail = span, ""
    if body:
        begin = len(span) - len(span.lstrip(MARKS))
        head, tail = span[:begin], span[begin + len(body):]
    head, tail = _STRETCH.sub(r"\1\1", head), _STRETCH.sub(r"\1\1", tail)
    out = [span.strip(PUNCTUATION)]
    for i in _cuts(len(head)):
        first = head[len(head) - i:]
        ends = tail if body else first
        out += [((first + body + ends[:j]) if body else ends[:j]).strip(_OUTSIDE) for j in _cuts(len(ends))]
    return [r for r in dict.fromkeys(out) if r]


def restore(text: str, channel: Channel) -> str:
    """The lower-cased text with every suspicious span replaced by its decoded source."""
    text = text.lower()
    out, at = [], 0
    for start, end in _spans(text):
        out += [text[at:start], channel.source(text[start:end])]
        at = end
    return "".join([*out, text[at:]])


def words_of(text: str | None, channel: Channel) -> set[str]:
    """Words of the text as written and as restored."""
    if not text:
        return set()
    lower = text.lower()
    words = set(_WORD.findall(lower))
    for start, end in _spans(lower):
        words |= channel.words(lower[start:end])
    return words


def _ahead(mask: np.ndarray, *steps: int) -> np.ndarray:
    """Whether the mask holds at one of the places that many steps ahead."""
    out = np.zeros(len(mask), bool)
    for step in steps:
        out[:-step] |= mask[step:]
    return out


def suspects(words: Words) -> np.ndarray:
    """Texts of a block that may have suspicious spans; those without are not looked at letter by letter."""
    codes = words.codes
    letter = (codes >= 97) & (codes <= 122)
    one = letter & ~_ahead(letter, 1)
    one[1:] &= ~letter[:-1]
    near = one & _ahead(one, 2, 3, 4)
    same = letter[:-1] & (codes[1:] == codes[:-1])
    hit = _LEET_BYTES[codes] | (near & _ahead(near, 2, 3, 4)) | _FOREIGN[codes]
    hit[:-2] |= same[:-1] & same[1:]
    return np.unique(np.searchsorted(words.offsets, np.flatnonzero(hit), "right") - 1)


@dataclass
class Model:
    counts: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def channel(self) -> Channel:
        return Channel(self.counts, [w for w, x in self.weights.items() if x > 1])

    def score(self, words: set[str]) -> float:
        return sigmoid(self.bias + sum(self.weights[w] for w in words & self.weights.keys()))

    def scorer(self):
        """Scores of a block of texts, as ``score`` of ``words_of`` gives them."""
        channel = self.channel()
        names = sorted(self.weights)
        values = np.array([self.weights[w] for w in names])
        own = Words(names, between=_BETWEEN).hashes()
        order = np.argsort(own)
        own, values = own[order], values[order]
        place = {names[k]: i for i, k in enumerate(order)}
        few = np.zeros(1 << 16, bool)
        few[(own >> np.uint64(48)).astype(np.int64)] = True

        def work(texts):
            lower = [t.lower() if t else "" for t in texts]
            words = Words(lower, between=_BETWEEN)
            hashes = words.hashes() if len(words.starts) else np.zeros(0, np.uint64)
            at = np.flatnonzero(few[(hashes >> np.uint64(48)).astype(np.int64)])
            spot = np.minimum(np.searchsorted(own, hashes[at]), max(len(own) - 1, 0))
            right = own[spot] == hashes[at] if len(own) else np.zeros(0, bool)
            found = [np.stack([words.doc[at[right]], spot[right]], 1).astype(np.int64)]
            for d in suspects(words).tolist():
                extra = {w for a, b in _spans(lower[d]) for w in channel.words(lower[d][a:b])}
                found += [np.array([[d, place[w]]]) for w in extra if w in place]
            pairs = np.unique(np.concatenate(found), axis=0)
            total = np.bincount(pairs[:, 0], values[pairs[:, 1]], minlength=len(texts)) if len(pairs) else np.zeros(len(texts))
            return 1 / (1 + np.exp(-np.clip(total + self.bias, -700, 700)))

        return work


def fit(docs: DataFrame, labels: DataFrame, held_out_fold: int | None = 0, sample_rows: int = SAMPLE_ROWS, label_col: str = "toxic") -> Model:
    """Character model over all documents; words weighted on at most ``sample_rows`` labelled rows, taken in the
    order of a hash of the id, none from fold ``held_out_fold`` (crc32 of the id, modulo 5). Rows without label
    are left out; of several labels of one id the largest counts. Without rows of both labels no word counts."""
    model = Model(char_counts(docs))
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    if held_out_fold is not None:
        known = known.filter(crc_fold(F.col("doc_id")) != held_out_fold)
    sample = known.groupBy("doc_id").agg(F.max(label_col).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label").collect()  # bounded by sample_rows
    plain = Channel(model.counts)
    found = [words_of(r.text, plain) for r in rows]
    y = np.array([float(r.label) for r in rows])
    positive = y.sum()
    prior = (positive + 0.5) / (len(y) + 2)
    model.bias = math.log(prior / (1 - prior))
    if 0 < positive < len(y):
        with_, without = Counter(), Counter()
        for words, label in zip(found, y):
            (with_ if label else without).update(words)
        def distance(w):
            a, b = with_[w], without[w]
            n, m = positive, len(y) - positive
            gap = math.log((a + 0.5) / (n - a + 0.5)) - math.log((b + 0.5) / (m - b + 0.5))
            return abs(gap) / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) * math.sqrt(a / n + b / m)
        common = [w for w in with_.keys() | without.keys() if with_[w] + without[w] >= LEAST_DOCS]
        chosen = sorted(common, key=lambda w: (-distance(w), w))[:FEATURES]
        place = {w: i for i, w in enumerate(chosen)}
        x = np.zeros((len(found), len(chosen)))
        for i, words in enumerate(found):
            x[i, [place[w] for w in words & place.keys()]] = 1
        weights, model.bias = logistic(x, y, ridge=0.1)
        model.weights = {w: float(v) for w, v in zip(chosen, weights)}
    del rows, found, plain
    give_back()
    return model


def score(docs: DataFrame, model: Model, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """Columns ``carry`` (all by default) plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for every row.
    Null and empty texts get the score of a text without known words; a clashing name gets a trailing "_"."""
    carry = list(docs.columns) if carry is None else carry
    names = fresh(docs.select(*carry), "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 27^3 counts and FEATURES words

    @F.arrow_udf("double")  # a column function: rows stay in the JVM, texts alone go to Python
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = shared.value.scorer()
        for array in texts:
            batch = pa.RecordBatch.from_arrays([array], names=["text"])
            parts = [scorer(piece.column(0).to_pylist()) for piece in pieces(batch, 0, SCORE_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *parts]))
        give_back()

    scored = docs.select(*carry, scores(F.col(text_col).cast("string")).alias(names[0]))
    return scored.withColumn(names[1], (F.col(names[0]) >= 0.5).cast("int"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, documents(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
