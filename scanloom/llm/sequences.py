"""Token ids as Arrow files of equal-length sequences: the data source ``token_sequences``.

Documents are put in ascending order of their id by one range shuffle; each partition becomes one Arrow IPC file, the
stream format with a footer, so any batch is found without reading those before it. A row is a sequence of a fixed number of ids
(FixedSizeList), stored uncompressed: a memory map gives row r of a batch as a slice, without a copy. Two masks of the
same length tell ids from padding and mark the last id of each document; padding stands only at the end of a file.
Tasks write files under names of their own, and the manifest, written at the end, names those of the attempts that
counted, so a task that runs again leaves nothing to be read twice.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from scanloom.llm.base import BLANKS, LOWERED, documents, fresh, map_texts, pieces, scratch

LENGTH = 2048
BATCH_ROWS = 64
CACHE_BYTES = 40 << 20
MANIFEST = "_manifest.json"
_BLANKS, _ENDS, _MARKS = (np.isin(np.arange(256), list(x)) for x in (BLANKS, b"abcdefghijklmnopqrstuvwxyz0123456789", b".,;:!?"))
_TOGETHER = 50


# --- encoding ---------------------------------------------------------------------------------------


def _words(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Starts and bytes of the words of lower-cased text, marks after letters and digits being words of their own."""
    codes = np.frombuffer(data, np.uint8)
    ink = ~_BLANKS[codes]
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | (_ENDS[codes[:-1]] & _MARKS[codes[1:]])
    starts = np.flatnonzero(begins)
    edges = np.append(np.cumsum(ink)[starts] - 1, np.count_nonzero(ink)).astype(np.int32) if len(starts) else np.zeros(1, np.int32)
    return starts, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(codes[ink])])


def _pylist(words: pa.Array) -> list[bytes]:
    _, edges, data = words.buffers()
    edges, data = np.frombuffer(edges, np.int32)[words.offset:words.offset + len(words) + 1].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(edges, edges[1:])]


class _Ids:
    """Ids of words, one after another; word 0 is the end of a document."""

    def __init__(self, end: list[int]):
        self.slots, self.bytes, self.parts, self.sizes, self.n = {}, 0, [np.array(end, np.uint32)], [np.array([len(end)])], 1

    def add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.slots.update(zip(words, range(self.n, self.n + len(words))))
        self.parts.append(ids)
        self.sizes.append(sizes)
        self.n += len(words)
        self.bytes += sum(map(len, words)) + 200 * len(words) + 4 * len(ids)

    def get(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in ``slots`` and their sizes."""
        self.parts, self.sizes = [np.concatenate(self.parts)], [np.concatenate(self.sizes)]
        sizes = self.sizes[0]
        start, size = (np.cumsum(sizes) - sizes)[slots], sizes[slots]
        total = np.cumsum(size)
        return self.parts[0][np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)], size


class WordEncoder:
    """Ids of texts by the tokenizers library, which sees a word again only after the cache has forgotten it.

    For tokenizers that drop white space and split runs of letters, of digits and of other marks from each other (checked
    against whole texts in the tests): a text is its words, also with a space between a letter or digit and one of
    ``.,;:!?``, and A-Z count as a-z. Texts with ``<|``, which may begin a special token, go to the library whole.
    Words are kept in two generations of about ``most`` bytes; those in use move on to the younger one.
    """

    def __init__(self, tokenizer: str, end: list[int], most: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.library, self.end, self.most = Tokenizer.from_str(tokenizer), end, most
        special = [(i, t.content) for i, t in self.library.get_added_tokens_decoder().items() if t.content.startswith("<|")]
        if not special:
            raise ValueError("the tokenizer has no special token that begins with <|")
        self.mark_id, self.mark = min(special)
        self.young, self.old = _Ids(end), _Ids(end)

    def _library(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """New words, ``_TOGETHER`` at a time with a special token after each; those with ``<|`` one by one."""
        alone = [w for w in words if b"<|" in w]
        plain = [w for w in words if b"<|" not in w] if alone else words
        mark = self.mark.encode()
        joined = [(mark.join(plain[i:i + _TOGETHER]) + mark).decode("utf-8") for i in range(0, len(plain), _TOGETHER)]
        ids = np.array(list(chain.from_iterable(e.ids for e in self.library.encode_batch_fast(joined, add_special_tokens=False))), np.uint32)
        marks = np.flatnonzero(ids == self.mark_id)
        parts = [np.array(self.library.encode(w.decode("utf-8"), add_special_tokens=False).ids, np.uint32) for w in alone]
        return plain + alone, np.concatenate([np.delete(ids, marks), *parts]), np.concatenate((np.diff(marks, prepend=-1) - 1, np.array([len(x) for x in parts], np.int64)))

    def _slots(self, words: list[bytes]) -> np.ndarray:
        """Places of distinct words in the younger generation, which learns those it does not know."""
        known, old = self.young.slots, self.old.slots
        new = [w for w in words if w not in known]
        if moved := [w for w in new if w in old]:
            self.young.add(moved, *self.old.get(np.array([old[w] for w in moved])))
        if len(moved) < len(new):
            self.young.add(*self._library([w for w in new if w not in old] if moved else new))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with the end, and how many each has. Null counts as empty."""
        raw = [(t or "").encode("utf-8") for t in texts]
        whole = [i for i, x in enumerate(raw) if b"<|" in x]
        rest = raw.copy()
        for i in whole:
            rest[i] = b""
        starts, words = _words(b"\n".join([*rest, b""]).translate(LOWERED))
        if self.young.bytes > self.most:
            self.old, self.young = self.young, _Ids(self.end)
        coded = words.dictionary_encode()
        slots = self._slots(_pylist(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
        last = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in rest]))
        at, ends = last, np.zeros(len(texts), np.int64)
        if whole:  # a text as one word, before its end
            at = np.insert(last, whole, last[whole])
            ends = np.insert(ends, whole, self._slots([raw[i] for i in whole]))
        ids, sizes = self.young.get(np.insert(slots, at, ends))
        total = np.concatenate(([0], np.cumsum(sizes)))
        per_text = np.ones(len(texts), np.int64)
        per_text[whole] = 2
        return ids, np.diff(total[np.concatenate(([0], last + np.cumsum(per_text)))])


def _encoder(tokenizer: Broadcast, end: list[int]) -> WordEncoder:
    """The encoder of this worker process; later tasks go on with its words."""
    kept = sys.modules.setdefault("_token_sequences_worker", ModuleType("_token_sequences_worker")).__dict__
    key = (zlib.crc32(tokenizer.value.encode()), len(tokenizer.value), tuple(end))
    if kept.get("key") != key:
        kept.update(key=key, encoder=WordEncoder(tokenizer.value, end))
    return kept["encoder"]


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", end_id: int | None = 1) -> DataFrame:
    """``docs`` without ``text_col``, plus ``ids``: little-endian unsigned 32-bit integers of the whole text.

    ``tokenizer`` is the content of a tokenizers file; special tokens are not added, ``end_id`` ends each document. Null and empty
    texts have the end alone. Rows and other columns stay as they are; where ``ids`` is taken, the new column gets a trailing "_"."""
    carry = [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # a vocabulary file, some MB

    end = [] if end_id is None else [end_id]

    def make():
        encoder = _encoder(shared, end)

        def work(texts):
            ids, counts = encoder.encode(texts)
            edges = np.concatenate(([0], np.cumsum(counts)))
            return [pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(edges, edges[1:])], pa.binary())]

        return work

    name = fresh(docs.select(carry), "ids")[0]
    return map_texts(docs, text_col, carry, [T.StructField(name, T.BinaryType())], make)


# --- files ------------------------------------------------------------------------------------------


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if re.match(r"\w+:/", uri) else f"file://{uri}")


class _Sequences:
    """Documents one after another, cut into record batches of equal-length rows (ids, mask, last, doc_ids)."""

    def __init__(self, length: int, kind: pa.DataType):
        sized = lambda kind: pa.list_(kind, length)
        self.schema = pa.schema([("ids", sized(kind)), ("mask", sized(pa.bool_())), ("last", sized(pa.bool_())), ("doc_ids", pa.list_(pa.int64()))])
        self.length, self.kind = length, kind.to_pandas_dtype()
        self.ids, self.ends, self.owners = np.zeros(0, self.kind), np.zeros(0, np.int64), pa.array([], pa.int64())

    def add(self, docs: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.ends = np.concatenate((self.ends, len(self.ids) + np.cumsum(counts) - 1))
        self.ids = np.concatenate((self.ids, ids.astype(self.kind)))
        self.owners = pa.concat_arrays([self.owners, docs])
        room = self.length * BATCH_ROWS
        while len(self.ids) >= room:
            yield self.cut(room)

    def cut(self, size: int) -> pa.RecordBatch:
        """The first ``size`` ids as whole sequences; the last of them may be padded."""
        n = -(-size // self.length)
        ids, mask, last = np.zeros(n * self.length, self.kind), np.zeros(n * self.length, bool), np.zeros(n * self.length, bool)
        ids[:size], mask[:size] = self.ids[:size], True
        edges = np.searchsorted(self.ends, np.minimum(np.arange(n + 1) * self.length, size))
        last[self.ends[:edges[-1]]] = True
        docs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), self.owners.slice(0, edges[-1]))
        self.ids, self.ends, self.owners = self.ids[size:], self.ends[edges[-1]:] - size, self.owners.slice(edges[-1])
        sized = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x), self.length)
        return pa.RecordBatch.from_arrays([sized(ids), sized(mask), sized(last), docs], schema=self.schema)


def _write_files(ordered: DataFrame, path: str, tokenizer: str, end_id: int, length: int, kind: pa.DataType) -> DataFrame:
    """Writes one file per partition of (doc_id, text); gives part, name, documents and tokens of each."""
    shared = ordered.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        name, encoder, rows, documents, tokens = f"part-{uuid.uuid4().hex}.arrow", _encoder(shared, [end_id]), _Sequences(length, kind), 0, 0
        with store.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, rows.schema) as file:
            for batch in batches:
                for piece in pieces(batch, 1):
                    ids, counts = encoder.encode(piece.column(1).to_pylist())
                    documents, tokens = documents + piece.num_rows, tokens + len(ids)
                    for written in rows.add(piece.column(0), ids, counts):
                        file.write(written)
            if len(rows.ids):
                file.write(rows.cut(len(rows.ids)))
        columns = (TaskContext.get().partitionId(), name, documents, tokens)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in columns], names=["part", "name", "documents", "tokens"])

    return ordered.mapInArrow(run, "part long, name string, documents long, tokens long")


class _File(InputPartition):
    def __init__(self, path: str, first: int):
        self.path, self.first = path, first


class SequenceReader(DataSourceReader):
    """Documents or, with ``rows=sequences``, the sequences themselves."""

    def __init__(self, options: dict):
        self.uri, self.ids, self.sequences = options["path"], options.get("ids") == "true", options.get("rows") == "sequences"

    def partitions(self):
        store, root = _store(self.uri)
        with store.open_input_stream(f"{root}/{MANIFEST}") as file:
            files = json.loads(file.read())["files"]
        return [_File(f"{root}/{f['name']}", f["first"]) for f in files] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = _store(self.uri)
        local = isinstance(store, fs.LocalFileSystem)
        with pa.memory_map(partition.path) if local else store.open_input_file(partition.path) as source:
            file = pa.ipc.open_file(source)
            batches = (file.get_batch(i) for i in range(file.num_record_batches))
            yield from self.of_sequences(batches, partition.first) if self.sequences else self.of_documents(batches, partition.first)

    def of_sequences(self, batches, first: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i).cast(pa.list_(kind)) for i, kind in enumerate((pa.int32(), pa.bool_(), pa.bool_()))]
            size = batch.schema.field(0).type.list_size
            starts = pa.array(first + size * np.arange(batch.num_rows))
            first += size * batch.num_rows
            yield pa.RecordBatch.from_arrays([starts, *lists, batch.column(3)], names=["start", "ids", "mask", "last", "doc_ids"])

    def of_documents(self, batches, start: int) -> Iterator[pa.RecordBatch]:
        crc, size, parts = 0, 0, []  # of the document that goes on
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy().astype("<u4")
            ends = np.flatnonzero(batch.column(2).flatten().to_numpy(zero_copy_only=False))
            rows, at = [], 0
            for doc, end in zip(batch.column(3).flatten().to_pylist(), (ends + 1).tolist()):
                own = ids[at:end]
                size += end - at
                rows.append((doc, start, size, zlib.crc32(own, crc), np.concatenate([*parts, own]).view("<i4") if self.ids else None))
                start, at, crc, size, parts = start + size, end, 0, 0, []
            rest = ids[at:int(batch.column(1).flatten().true_count)]
            crc, size, parts = zlib.crc32(rest, crc), size + len(rest), [*parts, rest] if self.ids else parts
            columns = [pa.array(x, k) for x, k in zip(zip(*rows), [pa.int64()] * 4)] if rows else [pa.array([], pa.int64())] * 4
            if self.ids:
                columns.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])


class SequenceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_sequences"

    def schema(self) -> str:
        if self.options.get("rows") == "sequences":
            return "start long, ids array<int>, mask array<boolean>, last array<boolean>, doc_ids array<long>"
        return "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if self.options.get("ids") == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return SequenceReader(dict(self.options))


def write_sequences(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 1) -> None:
    """Encode ``docs`` and write them to a new folder as sequences of ``length`` ids, ascending by ``id_col``.

    Rows without id come last; rows that repeat an id follow one another, by a hash of their text, and are spread over
    partitions like all others. Other columns are ignored. Null and empty texts are documents of the end id alone. An empty table
    gives a manifest without files."""
    from tokenizers import Tokenizer

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tied = rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})  # equal rows are told apart by where they were read
    keys = [F.col("doc_id").asc_nulls_last(), F.col("_text"), F.col("_row")]
    ordered = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ids = max(Tokenizer.from_str(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    parts = _write_files(ordered, path, tokenizer, end_id, length, pa.uint16() if ids <= 1 << 16 else pa.uint32()).collect()  # a row for each partition
    files, first = [], 0
    for part in sorted(parts):
        if part["documents"]:
            files.append({"name": part["name"], "first": first, "documents": part["documents"], "tokens": part["tokens"]})
        first += part["tokens"]
    store, root = _store(path)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps({"length": length, "files": files}).encode())


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, the ids of each document."""
    spark.dataSource.register(SequenceSource)
    return spark.read.format("token_sequences").option("ids", str(ids).lower()).load(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Equal-length sequences: start (of its first id, padding of earlier files left out), ids, mask (false: padding), last
    (true: end of a document), doc_ids (of the documents that end in it)."""
    spark.dataSource.register(SequenceSource)
    return spark.read.format("token_sequences").option("rows", "sequences").load(path)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-sequences")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        write_sequences(documents(spark, sf_dir), path, file.read())
    return read_documents(spark, path)
