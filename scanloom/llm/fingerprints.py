"""Document fingerprints from closed syncmers, in DataFrame operations only.

A k-mer is K consecutive words; it is an anchor when the smallest of its inner runs of S words stands first or last.
Whether it is one depends on the k-mer alone, so the same passage gives the same anchors in any text, and two anchors
of unlike texts can be matched by hash and position. Every K - S consecutive k-mers hold an anchor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanloom.llm.base import BLANKS, cut, documents, fresh

K, S = 5, 2
BLOCK_BITS = 6
NO_ID_BLOCK = -(1 << 60)


def words_of(text: Column) -> Column:
    """Words of a text, parted by [\\x20\\x09-\\x0D]; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS.decode()))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def with_syncmers(df: DataFrame, words: Column, into: str) -> DataFrame:
    """``df`` with the closed syncmers of a sequence of words: ``into``, array of position and 64-bit hash. Nothing
    stands in for a sequence without any."""
    h, g, p = fresh(df, "_h", "_g", "_p")

    def inner(hashes):  # order of the run of two words that begins at each place
        return F.transform(hashes, lambda x, i: x.bitwiseXOR(F.shiftleft(F.get(hashes, i + 1), 1)))

    def places(order):
        edge = lambda i: F.least(F.get(order, i), F.get(order, i + (K - S))) <= F.least(*[F.get(order, i + j) for j in range(1, K - S)])
        return F.when(F.size(order) >= K, F.filter(F.sequence(F.lit(0), F.size(order) - K), edge)).otherwise(F.array().cast("array<int>"))

    def hashed(hashes, places):
        return F.transform(places, lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get(hashes, i + j) for j in range(K)]).alias("hash")))

    out = df.withColumn(h, F.transform(words, lambda x: F.xxhash64(x)))
    out = out.withColumn(g, inner(F.col(h)))
    out = out.withColumn(p, places(F.col(g)))
    return out.withColumn(into, hashed(F.col(h), F.col(p))).drop(h, g, p)


def or_whole(syncmers: Column, words: Column) -> Column:
    """Anchors: the syncmers, or the hash of the whole sequence at position 0 where there is none."""
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(words).alias("hash")))
    return F.when((F.size(syncmers) > 0) | (F.size(words) == 0), syncmers).otherwise(whole)


def with_anchors(df: DataFrame, text: Column | str, into: str = "anchors") -> DataFrame:
    """``df`` with the anchors of a text: array of position and 64-bit hash, by position. A text with too few words
    for an anchor has one, the hash of the whole sequence; a text without words or null has none. Repeats stay."""
    w, s = fresh(df, "_w", "_s")
    out = df.withColumn(w, words_of(F.col(text) if isinstance(text, str) else text))
    out = with_syncmers(out, F.col(w), s)
    return out.withColumn(into, or_whole(F.col(s), F.col(w))).drop(w, s)


def with_edited_anchors(df: DataFrame, anchors: str, kept: Column, edited: Column, into: str) -> DataFrame:
    """Anchors of a text that shares its first ``kept`` words with one whose ``anchors`` are known. Those of k-mers
    inside the shared words are the same; only what follows is computed. A stand-in for the whole sequence is none."""
    w, s, k = fresh(df, "_w", "_s", "_k")
    out = df.withColumns({w: words_of(edited), k: F.greatest(kept - (K - 1), F.lit(0))})
    out = with_syncmers(out, F.slice(w, F.col(k) + 1, F.greatest(F.size(w) - F.col(k), F.lit(0))), s)
    begin = F.xxhash64(*[F.xxhash64(F.get(w, F.lit(j))) for j in range(K)])  # shared where anything is taken over
    same = F.when(F.col(k) > 0, F.filter(anchors, lambda a: (a["pos"] < F.col(k)) & ((a["pos"] > 0) | (a["hash"] == begin)))).otherwise(F.slice(anchors, 1, 0))
    moved = F.transform(s, lambda a: F.struct((a["pos"] + F.col(k)).alias("pos"), a["hash"].alias("hash")))
    return out.withColumn(s, F.concat(same, moved)).withColumn(into, or_whole(F.col(s), F.col(w))).drop(w, s, k)


def fingerprint(anchors: Column) -> Column:
    """Anchors in their order, 8 hex digits each."""
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.hex(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors (Dice, distinct hashes): 1 for two empty fingerprints, 0 if only one is empty."""
    sides = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(sides == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / sides)


def shifts(a: Column, b: Column) -> Column:
    """Positional matching: distances (position in ``b`` minus position in ``a``) of anchors that both hold, by the
    first place of each hash in ``b``. A shared passage shows as a run of one distance."""
    where = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.transform(b, lambda x: x["hash"]))), lambda h: F.struct(h, F.filter(b, lambda y: y["hash"] == h)[0]["pos"])))
    both = F.filter(a, lambda x: F.map_contains_key(where, x["hash"]))
    return F.transform(both, lambda x: F.element_at(where, x["hash"]) - x["pos"])


def _following_blocks(blocks: DataFrame) -> DataFrame:
    """(block, following): the next smaller block; the largest after the smallest. Ranges of blocks are dealt out
    and each is put in order by itself; only one row per range meets the others."""
    dealt = cut(blocks.distinct().repartitionByRange("block").select("block", F.spark_partition_id().alias("part")))
    inside = F.lead("block").over(Window.partitionBy("part").orderBy(F.desc("block")))
    tops = dealt.groupBy("part").agg(F.max("block").alias("top"))
    order = Window.orderBy(F.desc("part"))  # a row for each partition
    beyond = tops.select("part", F.coalesce(F.lead("top").over(order), F.max("top").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("beyond"))
    return dealt.withColumn("inside", inside).join(beyond, "part").select("block", F.coalesce("inside", "beyond").alias("following"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``text`` (null: empty), its ``anchors``, and ``next_text`` and ``next_anchors`` of the document next
    in descending order of ids; the first one's for the last. Rows of one id follow each other by text; rows
    without id come last.

    Texts are shuffled once, in blocks of 2 ** BLOCK_BITS ids; only the first text of a block goes on to another.
    """
    block = F.coalesce(F.shiftright(F.col(id_col).cast("bigint"), BLOCK_BITS), F.lit(NO_ID_BLOCK))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), block.alias("block"))
    order = Window.partitionBy("block").orderBy(F.desc_nulls_last("id"), "text")
    placed = rows.withColumns({"next_text": F.lead("text").over(order), "head": F.lag(F.lit(1)).over(order).isNull()})
    inside = with_anchors(placed, "text").withColumn("next_anchors", F.lead("anchors").over(order)).filter("next_text is not null")
    ends = placed.filter("next_text is null").select("id", "text", "block")
    heads = placed.filter("head").select(F.col("block").alias("following"), F.col("text").alias("next_text"))
    linked = ends.join(_following_blocks(rows.select("block")), "block").join(heads, "following")
    linked = with_anchors(with_anchors(linked, "text"), "next_text", "next_anchors")
    wanted = ["id", "text", "anchors", "next_text", "next_anchors"]
    return inside.select(wanted).union(linked.select(wanted)).withColumnRenamed("id", id_col)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir))
    n = F.length("text")
    cut_off = F.floor(n / 3).cast("int")
    start = F.substring("text", F.lit(1), n - cut_off)
    rows = rows.withColumns({"n_chars": n.cast("bigint"), "start": start, "edited": F.concat(start, F.substring("next_text", F.lit(1), cut_off))})
    whole_words = F.greatest(F.size(words_of(F.col("start"))) - 1, F.lit(0))  # the last one may be cut
    marked = with_edited_anchors(rows, "anchors", whole_words, F.col("edited"), "changed")
    hashes = [F.transform(c, lambda a: a["hash"]).alias(c) for c in ("anchors", "changed", "next_anchors")]
    small = marked.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("anchors")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"), *hashes)
    return small.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("anchors"), F.col("changed")).alias("near_edited"), likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
