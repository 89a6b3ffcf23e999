"""From raw documents to token ids: toxicity, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents,
but for the last, which returns token ids. ``run`` writes each stage as Parquet and gives it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.llm import base, bpe, decontaminate, jaccard, lines, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labels of all folds."""
    model = toxicity.fit(docs, base.documents(spark, sf_dir, "labels"), held_out_fold=None)
    scored = toxicity.score(docs, model)
    return scored.filter(F.col(scored.columns[-1]) == 0).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds; ``n_chars`` follows the text."""
    kept = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col(kept.columns[-1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group: sets of five-word shingles, similarity of 0.8 or more.

    Rows without words are in no group and stay. Ids do not link: rows without id, and unlike texts under one id, are
    documents of their own. Rows that repeat id and set of a kept document all stay."""
    return jaccard.drop_copies(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.clean(docs, base.documents(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each document; decoding them must give the text back."""
    import public_tokenizers as tokenizers

    path = tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.encode(docs, path, tokenizers.PATTERN, keep=("lang", "source", "text"), decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("token ids do not give the text back")))
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), ids.alias("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

# Toxicity scores, alignments and merges have no SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = base.documents(spark, sf_dir)
    for name, stage in STAGES:
        path = base.scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
