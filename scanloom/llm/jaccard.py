"""N-gram Jaccard join by parity sketches.

Every shingle flips one bit of a sketch, so the Hamming distance of two sketches is at most the symmetric difference
of their sets. Sets that reach the threshold differ in at most D shingles; of the B blocks of their sketches at least
B - D agree. Sketches are built for bands of set sizes, each with its own D, and joined on (band, block, content).

Each set needs only its D + 1 rarest keys, in one global order: two sets that agree in B - D of B keys share one of
these. Blocks without shingles come last in that order. So contents that many strangers share (a common passage, an
empty block) make no candidates, and what is left is verified on the sets themselves.

Rows move as classes of equal sets, each with a parity sketch of 512 bits. Of the pairs that share a key, those whose
sketches lie farther apart than linked sets can differ are rejected by that Hamming distance, before any text is read.
Every class is first compared with the centre it shares most keys with, then every component that this leaves with the first one of
its buckets; whatever is still apart is compared within its buckets. So no link is lost, and groups of near copies
cost a few comparisons for each member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanloom.llm.base import LOWER, UPPER, Words, cut, documents, fresh, give_back, lists, map_texts, may_hold, mix, pieces, scratch, signed, spans_hash, windows
from scanloom.llm.components import components

NO_ID = (1 << 63) - 1
_BIT = np.uint64(0xFFFF)
SKETCH_WORDS = 8
PIECE_BYTES = 512 << 10


def sets_of(texts: list, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``size`` words, the whole sequence where there are fewer."""
    words = Words(texts, lower=True)
    hashes = words.hashes() if len(words.starts) else np.zeros(0, np.uint64)
    at, grams = windows(hashes, words.doc, size)
    edges = np.searchsorted(at, words.first)
    out = []
    for d in range(len(texts)):
        first, n = words.first[d], words.counts[d]
        if n >= size:
            own = np.sort(grams[edges[d]:edges[d + 1]])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            out.append(spans_hash(hashes[first:first + n], np.array([0]), np.array([n]), 0xC2B2AE3D27D4EB4F))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_hash(own: np.ndarray) -> int:
    """Hash of a set of hashes, as a signed number."""
    return int(mix(np.array([np.bitwise_xor.reduce(mix(own + np.uint64(77))) + np.uint64(len(own))], np.uint64)).view(np.int64)[0])


def sketch(own: np.ndarray) -> np.ndarray:
    """Parity sketch: every shingle flips one of 64 * SKETCH_WORDS bits."""
    at = ((own >> np.uint64(20)) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * SKETCH_WORDS) & 1).astype(bool)).view(np.int64)


class Bands:
    """Bands of set sizes for a threshold of ``percent``: linked sets lie in the same band or in neighbours."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def of(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def budget(self, band: int) -> int:
        """Most shingles in which linked sets of sizes below the end of the band differ."""
        self.of(1 if band < len(self.edges) - 1 else self.edges[-1])
        return (100 - self.percent) * 2 * (self.edges[band + 1] - 1) // (100 + self.percent)

    def blocks(self, band: int) -> int:
        """Half as many again as the budget: a third of the keys of a set, the most frequent ones, may be left out."""
        most = self.budget(band)
        return most + 5 + most // 2 if most else 1


def sketch_keys(own: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of one set, for its band and the next: one per block of its parity sketch. Next to each key
    band * 2^16 + spare, where ``spare`` is the number of keys that may be left out."""
    own_band = bands.of(len(own))
    keys, codes = [], []
    for band in (own_band, own_band + 1):
        blocks, budget = bands.blocks(band), bands.budget(band)
        block = ((own >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)  # ascending, as the hashes are
        begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        content = np.bitwise_xor.reduceat(mix((own & _BIT) + np.uint64(1)), begins)  # parity of 2^16 bits, as one number
        filled = block[begins]
        keys.append(mix(content ^ mix(filled + np.uint64(band << 40))))
        spare = max(len(filled) - budget - 1, 0)
        if len(filled) <= budget:  # empty blocks are the last in order; here some are needed
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), filled)
            keys.append(mix(mix(empty + np.uint64(band << 40)) ^ np.uint64(0x5555)))
        codes.append(np.full(len(filled) if spare or len(filled) > budget else blocks, (band << 16) + spare, np.int32))
    return np.concatenate(keys), np.concatenate(codes)


def _members(docs: DataFrame, id_col: str, text_col: str, size: int, keep: tuple[str, ...] = ()) -> DataFrame:
    def make():
        def work(texts):
            own = sets_of(texts, size)
            sketches = np.concatenate([np.zeros(0, np.int64), *(sketch(s) for s in own)])
            return [pa.array([len(s) for s in own], pa.int64()), pa.array([class_hash(s) if len(s) else None for s in own], pa.int64()), lists(sketches, np.full(len(own), SKETCH_WORDS), pa.int64())]

        return work

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("class", T.LongType()), T.StructField("sketch", T.ArrayType(T.LongType()))]
    return map_texts(docs, text_col, [id_col, *keep], fields, make, PIECE_BYTES)


def _keys(docs: DataFrame, text_col: str, size: int, percent: int) -> DataFrame:
    """(key, class, code) once for each class and task."""
    def run(batches):
        bands, seen = Bands(percent), set()
        for batch in batches:
            for piece in pieces(batch, 0, PIECE_BYTES):
                keys, classes, codes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
                for own in sets_of(piece.column(0).to_pylist(), size):
                    if len(own) and (name := class_hash(own)) not in seen:
                        seen.add(name)
                        for held, new in zip((keys, codes), sketch_keys(own, bands)):
                            held.append(new)
                        classes.append(np.full(len(keys[-1]), name))
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(keys)), *(pa.array(np.concatenate(x)) for x in (classes, codes))], names=["key", "class", "code"])
        give_back()

    return docs.select(text_col).mapInArrow(run, "key long, class long, code int")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, class, text), once for each (node, class) in ``wanted``. A filter of fixed size keeps other texts from being moved."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 1, PIECE_BYTES):
                names = [class_hash(s) if len(s) else None for s in sets_of(piece.column(1).to_pylist(), size)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(names, pa.int64()), piece.column(1)], names=["node", "class", "text"])
        give_back()

    node = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    chosen = docs.select(node.alias("node"), F.col(text_col).cast("string").alias("text")).filter(may_hold(wanted.select(F.xxhash64("node")), F.xxhash64("node")))
    found = chosen.mapInArrow(run, "node long, class long, text string")
    return found.join(wanted, ["node", "class"], "left_semi").dropDuplicates(["node", "class"])


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Of pairs (a, x, b, y) of documents and classes, those (a, b) whose sets reach the threshold. Texts are moved,
    which compress, and not their hashes."""
    wanted = cut(pairs.select(F.col("a").alias("node"), F.col("x").alias("class")).union(pairs.select("b", "y")).distinct())
    texts = _texts(docs, wanted, id_col, text_col, size)
    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("class").alias("x"), F.col("text").alias("first")).hint("merge"), ["a", "x"])
    two = one.hint("merge").join(texts.select(F.col("node").alias("b"), F.col("class").alias("y"), F.col("text").alias("second")), ["b", "y"]).select("a", "b", "first", "second")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 3, PIECE_BYTES):
                n = piece.num_rows
                both_sides = piece.column(2).to_pylist() + piece.column(3).to_pylist()
                distinct = list(dict.fromkeys(both_sides))
                own = dict(zip(distinct, sets_of(distinct, size)))
                keep = np.zeros(n, bool)
                for i in range(n):
                    x, y = own[both_sides[i]], own[both_sides[n + i]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
                yield pa.RecordBatch.from_arrays([piece.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])
        give_back()

    return two.mapInArrow(run, "a long, b long")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85, keep: tuple[str, ...] = (), class_name: str | None = None) -> DataFrame:
    """``id_col``, columns ``keep``, ``n_shingles``, ``component_id`` for every row: the smallest id reachable by links.

    Two documents link when their sets of ``size``-word shingles (A-Z lower-cased) have 100 * intersection >=
    ``percent`` * union. A text with fewer words is one shingle; a null text or one without words has none and links
    with nothing. Copies are one class and need no pairs. Rows that repeat an id are one document. Rows without id
    count as one document after all others; a component of such rows alone has a null id. Empty table: no rows.
    ``class_name`` adds a hash of the set, equal for equal sets, null for none.
    """
    spark = docs.sparkSession
    node = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    members = cut(_members(docs, id_col, text_col, size, keep).withColumn("node", node))
    classes = members.filter("n_shingles > 0").groupBy("class").agg(F.min("node").alias("first"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = cut(classes)

    keys = _keys(docs, text_col, size, percent).filter("key is not null and class is not null and code is not null").repartition("key")
    # Both uses of the dealt keys need all their columns and no null, so one shuffle serves them.
    common = keys.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"), F.max("code").alias("any")).filter("low < high and any is not null").select("key", "n")
    shared = keys.join(common, "key").distinct()
    often = Window.partitionBy("class", "code").orderBy(F.desc("n"), F.desc("key"))
    needed = shared.withColumn("place", F.row_number().over(often)).filter(F.col("place") > F.col("code") % (1 << 16))
    path = scratch(spark, "buckets")
    needed.select("key", "class").write.parquet(path)
    buckets = spark.read.schema("key long, class long").parquet(path)
    centres = buckets.groupBy("key").agg(F.min("class").alias("centre"))
    best = buckets.join(centres, "key").filter("class <> centre").groupBy("class", "centre").count().groupBy("class").agg(F.max(F.struct("count", "centre")).alias("most"))

    def near(x: str, y: str) -> Column:
        """What sizes and sketches of linked sets satisfy: |x ^ y| * (100 + percent) <= (100 - percent) * (|x| + |y|)."""
        n = F.col(f"n_{x}") + F.col(f"n_{y}")
        fits = F.least(f"n_{x}", f"n_{y}") * 100 >= F.greatest(f"n_{x}", f"n_{y}") * percent
        apart = sum((F.bit_count(F.get(f"sketch_{x}", F.lit(i)).bitwiseXOR(F.get(f"sketch_{y}", F.lit(i)))) for i in range(SKETCH_WORDS)), F.lit(0))
        return fits & (apart * (100 + percent) <= n * (100 - percent))

    def side(x: str, *more: str) -> list[Column]:
        return [F.col("class").alias(x), F.col("first").alias(f"first_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in more)]

    def ordered(pairs: DataFrame) -> DataFrame:
        """(a, x, b, y): the documents and classes of pairs that sizes and sketches leave, the smaller id first."""
        ends = F.array_sort(F.array(F.struct(F.col("first_x").alias("n"), F.col("x").alias("c")), F.struct(F.col("first_y").alias("n"), F.col("y").alias("c"))))
        apart = pairs.filter("first_x <> first_y").select(ends.alias("e")).distinct()
        return apart.select(F.col("e")[0]["n"].alias("a"), F.col("e")[0]["c"].alias("x"), F.col("e")[1]["n"].alias("b"), F.col("e")[1]["c"].alias("y"))

    def named(pairs: DataFrame) -> DataFrame:
        """Pairs (x, y) of classes with what their documents, sizes and sketches are."""
        return ordered(pairs.join(classes.select(side("x")), "x").join(classes.select(side("y")), "y").filter(near("x", "y")))

    def placed(links: DataFrame) -> DataFrame:
        """(key, class, component) of buckets that still hold several components."""
        of_class = classes.join(components(links), F.col("first") == F.col("node"), "left").select("class", F.coalesce("component", "first").alias("comp"))
        rows = buckets.join(of_class, "class").select("key", "class", "comp")
        parted = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key", "low")
        return rows.join(parted, "key")

    starred = cut(named(best.select(F.col("most.centre").alias("x"), F.col("class").alias("y"))))
    texts = members.join(classes, "class").select("node", "first").distinct()
    lowest = texts.groupBy("node").agg(F.min("first").alias("low"), F.max("first").alias("high")).filter("low < high")
    same = texts.join(lowest, "node").filter("first <> low").select(F.col("low").alias("a"), F.col("first").alias("b"))  # ids with several texts
    links = cut(_verified(starred, docs, id_col, text_col, size, percent).union(same))
    # Components meet the first one of their buckets, by one class each.
    agents = placed(links).groupBy("key", "comp", "low").agg(F.min("class").alias("y"))
    firsts = agents.filter("comp = low").select("key", F.col("y").alias("x"))
    second = cut(named(agents.filter("comp <> low").join(firsts, "key").select("x", "y").distinct()).join(starred, ["a", "x", "b", "y"], "left_anti"))
    links = cut(links.union(_verified(second, docs, id_col, text_col, size, percent)))
    opened = cut(placed(links))
    open_ = opened.join(classes, "class")
    rest = open_.select("key", *side("x", "comp")).join(open_.select("key", *side("y", "comp")), "key").filter((F.col("x") < F.col("y")) & (F.col("comp_x") != F.col("comp_y")) & near("x", "y"))
    remaining = cut(ordered(rest).join(starred, ["a", "x", "b", "y"], "left_anti").join(second, ["a", "x", "b", "y"], "left_anti"))
    if not remaining.isEmpty():
        links = links.union(_verified(remaining, docs, id_col, text_col, size, percent))
    found = components(links)
    joined = members.join(classes.select("class", "first"), "class", "left").join(found.withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce("component", "first", "node")
    own = [F.col("class").alias(class_name)] if class_name else []
    return joined.select(id_col, *keep, *own, "n_shingles", F.when(component != NO_ID, component).alias("component_id"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group that links make, the one with the smallest id (null ids last), and all rows without
    words. A document is the rows of one id with equal sets, all of which stay or go; a row without id is one by itself.

    Ids do not link: unlike texts under one id, or without id, are apart. For the links, rows are named by a 64-bit hash
    of all columns; of rows without id that agree in all columns, one stays."""
    row, class_, copies = fresh(docs, "row", "class", "copies")
    named = docs.withColumn(row, F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns)))
    groups = near_components(named, row, text_col, size, percent, keep=(id_col,), class_name=class_)
    rows = cut(groups.groupBy(row, id_col, class_, "component_id").agg(F.count("*").alias(copies)))
    nameless = F.col(id_col).isNull()
    first = F.min(F.struct(nameless.alias("last"), id_col, class_, F.when(nameless, F.col(row)).alias(row), F.when(nameless, F.col(copies)).alias(copies)))
    leads = cut(rows.filter(F.col(class_).isNotNull()).groupBy("component_id").agg(first.alias("lead")).select("lead.*"))
    kept = rows.filter(F.col(class_).isNull()).select(row).union(
        rows.join(leads.filter(~nameless).select(id_col, class_), [id_col, class_], "left_semi").select(row)).union(
        leads.filter(F.col(copies) == 1).select(row))
    out = named.join(kept, row, "left_semi")
    several = leads.filter(F.col(copies) > 1).select(row)
    if not several.isEmpty():
        out = out.unionByName(named.join(several, row, "left_semi").dropDuplicates([row]))
    return out.select(*docs.columns)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


def _sql() -> str:
    words = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    grams = "CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {words} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest({grams}) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.c)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.c AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m USING (doc_id)"""


OP3_SQL = _sql()
