"""Byte-level BPE by corpus-level merge replay.

A block of documents is cut into pre-tokens; its distinct words are laid out in one linked sequence of symbols.
An inverted index leads from each mergeable pair to all places where it stands, and merges are applied in rank
order to the whole block at once; a merge touches only the two neighbours of its place. Blocks are bounded by
bytes and need nothing of each other, so the work is one scan without a shuffle.
"""

from __future__ import annotations

import base64
import heapq
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import BLOCK_BYTES, give_back, lists, map_texts

KEPT_WORDS = 200_000
_NONE = np.zeros(0, np.int64)


# Fixed value: the pre-token pattern of the byte-level vocabularies, and the same for Python's own engine, which is
# faster and differs from it only on the characters that ``differing`` gives.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
QUICK = r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"


def differing() -> str:
    """Characters that the two engines put into different classes."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s"))
    return "".join(sorted(set().union(*(set(regex.findall(a, every)) ^ set(re.findall(b, every)) for a, b in classes))))


def splitter(pattern: str, odd: str):
    """Function from a text to its matches of the pattern."""
    import regex

    exact = regex.compile(pattern).findall
    if pattern != PATTERN:
        return exact
    quick, rare, control = re.compile(QUICK).findall, set(odd), [c for c in odd if c.isascii()]

    def split(text: str) -> list[str]:
        same = not any(c in text for c in control) if text.isascii() else rare.isdisjoint(text)
        return quick(text) if same else exact(text)

    return split


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


class MergeReplay:
    """Encoder for one rank table (token bytes to rank)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes((b,))] for b in range(256)])
        self.wide = max(ranks.values()) + 1
        pairs = {}
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.wide + right] = r
        self.pairs = pairs
        self.byte_pairs = np.array([[pairs.get(int(a) * self.wide + int(b), -1) for b in self.of_byte] for a in self.of_byte], np.int64)
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def rank(self, a: int, b: int) -> int:
        """Rank of the token that two neighbours give, -1 if there is none."""
        return self.pairs.get(a * self.wide + b, -1)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.wide + b
        spot = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[spot] == keys, self.pair_ranks[spot], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words one after another, and their number for each word. A word that is a token
        itself stays whole."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        codes = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.of_byte[codes]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[sizes > 0] - 1] = -1
        before[starts[sizes > 0]] = -1
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        has = whole >= 0
        inside = np.repeat(~has, sizes) if n else np.zeros(0, bool)
        symbols[starts[has]] = whole[has]
        rest = ~inside
        rest[starts[has]] = False
        symbols[rest] = -1

        pair_rank = np.full(n, -1, np.int64)  # of the pair that starts at a place
        open_ = np.flatnonzero(inside & (after >= 0))
        pair_rank[open_] = self.byte_pairs[codes[open_], codes[open_ + 1]]
        places: dict[int, list[np.ndarray]] = {}  # inverted index: rank of a pair -> where it stands
        queue: list[int] = []

        def enter(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            edges = np.flatnonzero(np.diff(ranks, prepend=-1, append=-1))
            for i, j in zip(edges.tolist(), edges[1:].tolist()):
                r = int(ranks[i])
                if r in places:
                    places[r].append(at[i:j])
                else:
                    places[r] = [at[i:j]]
                    heapq.heappush(queue, r)

        found = open_[pair_rank[open_] >= 0]
        if len(found):
            enter(found, pair_rank[found])
        redo: list[np.ndarray] = []
        while queue:
            r = heapq.heappop(queue)
            at = distinct(np.concatenate(places.pop(r)))
            at = at[pair_rank[at] == r]
            if (after[at[:-1]] == at[1:]).any():  # overlapping places: leftmost first
                taken: set[int] = set()
                for p in at.tolist():
                    if before[p] not in taken:
                        taken.add(p)
                at = np.array(sorted(taken))
            if not len(at):
                continue
            gone = after[at]
            right = after[gone]
            symbols[at], symbols[gone] = r, -1
            pair_rank[gone] = -1
            after[at] = right
            more = right >= 0
            before[right[more]] = at[more]
            pair_rank[at] = -1
            left = before[at]
            left = left[left >= 0]
            touched = distinct(np.concatenate([left, at[more]]))
            if not len(touched):
                continue
            new = self._ranks(symbols[touched], symbols[after[touched]])
            pair_rank[touched] = new
            if (early := (new >= 0) & (new < r)).any():  # would come before other places of this rank in its word
                redo.append(touched[early])
            if (later := new >= r).any():
                enter(touched[later], new[later])
        alive = symbols >= 0
        counts = np.add.reduceat(np.append(alive, False).astype(np.int64), np.minimum(starts, n))
        counts[sizes == 0] = 0
        if redo:
            again = np.unique(np.searchsorted(ends, np.concatenate(redo), "right"))
            parts = np.split(symbols[alive], np.cumsum(counts)[:-1])
            for w in again.tolist():
                parts[w] = np.array(self.one(words[w]))
            return np.concatenate(parts), np.array([len(p) for p in parts])
        return symbols[alive], counts

    def one(self, word: bytes) -> list[int]:
        """The same for a single word, strictly merge by merge: lowest rank first, leftmost place first."""
        symbols = self.of_byte[list(word)].tolist()
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        queue = [(r, p) for p in range(len(symbols) - 1) if (r := self.rank(symbols[p], symbols[p + 1])) >= 0]
        heapq.heapify(queue)
        while queue:
            r, p = heapq.heappop(queue)
            q = after[p]
            if symbols[p] < 0 or q < 0 or self.rank(symbols[p], symbols[q]) != r:
                continue
            symbols[p], symbols[q] = r, -1
            nxt = after[p] = after[q]
            if nxt >= 0:
                before[nxt] = p
            for left, right in ((before[p], p), (p, nxt)):
                if left >= 0 and right >= 0 and (new := self.rank(symbols[left], symbols[right])) >= 0:
                    heapq.heappush(queue, (new, left))
        return [s for s in symbols if s >= 0]


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(r) for token, r in (line.split() for line in raw.splitlines() if line)}


def _encoder(ranks: dict[bytes, int], pattern: str, odd: str):
    """Function from a list of texts (None for null) to an Arrow array of their ids."""
    find = splitter(pattern, odd)
    replay = MergeReplay(ranks)
    known: dict[str, int] = {}
    kept = pa.array([], pa.list_(pa.int32()))

    def work(texts):
        nonlocal known, kept
        if len(known) > KEPT_WORDS:
            known, kept = {}, kept[:0]
        before = len(known)
        # Words become numbers text by text, so that a block's words are not all held at once.
        numbers = [np.array([known.setdefault(w, len(known)) for w in find(t)], np.int64) if t else _NONE for t in texts]
        new = list(islice(known, before, None))
        if new:
            flat, counts = replay.encode([w.encode("utf-8") for w in new])
            kept = pa.concat_arrays([kept, lists(flat.astype(np.int32), counts, pa.int32())])
        ids = kept.take(pa.array(np.concatenate([_NONE, *numbers])))
        ends = np.concatenate(([0], np.cumsum([len(x) for x in numbers], dtype=np.int64)))
        return pa.ListArray.from_arrays(ids.offsets.take(pa.array(ends)), ids.values)

    return work


def _decoder(ranks: dict[bytes, int]):
    """Function from an Arrow array of ids to one of their bytes."""
    of = [None] * (max(ranks.values()) + 1)
    for token, r in ranks.items():
        of[r] = token
    of = pa.array(of, pa.binary())

    def work(ids):
        tokens = of.take(ids.flatten())
        if tokens.null_count:
            raise ValueError("ids that the rank file does not have")
        ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))))
        offsets = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:][ends] if len(tokens) else np.zeros(len(ends), np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets.astype(np.int32)), tokens.buffers()[2] or pa.py_buffer(b"")])

    return work


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES, decoded: str | None = None) -> DataFrame:
    """Token ids (``ids`` array<int>) of each text, next to ``id_col`` and the columns ``keep``.

    ``ranks_path`` is a rank file (base64 token and rank per line), read once by the driver; its size does not
    depend on the corpus. Each match of ``pattern`` is encoded by itself; special tokens are ordinary text.
    Null or empty text: no ids. Repeated rows are encoded each. Other columns are ignored.
    ``decoded`` names a column with what ``decode`` gives for the ids, made in the same task: a second operator would
    hold a second Python worker for each task, and workers stay.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        table = spark.sparkContext.broadcast(f.read())

    odd = differing() if pattern == PATTERN else ""

    def make():
        ranks = read_ranks(table.value)
        to_ids = _encoder(ranks, pattern, odd)
        to_bytes = _decoder(ranks) if decoded else None

        def work(texts):
            ids = to_ids(texts)
            return [ids, to_bytes(ids)] if to_bytes else [ids]

        return work

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.BinaryType())] if decoded else [])]
    return map_texts(docs, text_col, [id_col, *keep], fields, make, block_bytes)


def decode(encoded: DataFrame, ranks_path: str, keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """Bytes (``decoded`` binary) of the token ids in ``ids``; null or no ids: empty. Unknown ids are an error."""
    with open(ranks_path, "rb") as f:
        table = encoded.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*(encoded.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())])
    place = list(keep).index("ids")

    def run(batches):
        to_bytes = _decoder(read_ranks(table.value))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, to_bytes(batch.column(place))], names=[f.name for f in schema])
        give_back()

    return encoded.select(*keep).mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return decoded.select(
        "doc_id", F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, tokenizers.PATTERN)
    return digests(decode(encoded, path))
