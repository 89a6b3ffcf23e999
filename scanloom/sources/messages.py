"""HL7 message files and lookup tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, col
from scanloom.operators.hl7 import message_key

# Character set names of MSH-18 and what they decode with.
CHARSETS = {"UTF-8": ["UNICODE UTF-8", "UTF-8"], "ISO-8859-1": ["8859/1", "ISO-8859-1", "ISO_IR 100"], "UTF-16": ["UNICODE UTF-16", "UTF-16"],
            "UTF-32": ["UNICODE UTF-32", "UTF-32"], "US-ASCII": ["ASCII", "US-ASCII"]}


def declared_charset(content: ColumnOrName, default: str = "UTF-8") -> Column:
    """MSH-18, found by a byte-safe single-byte reading, wins over the configured default."""
    header = F.split(F.decode(col(content), "ISO-8859-1"), r"[\r\n]", 2)[0]
    name = F.upper(F.trim(F.get(F.split(F.get(F.split(header, r"\|"), F.lit(17)), "~"), F.lit(0))))
    out = None
    for charset, names in CHARSETS.items():
        out = F.when(name.isin(names), charset) if out is None else out.when(name.isin(names), charset)
    return out.otherwise(default)


def decoded(content: ColumnOrName, charset: Column) -> Column:
    """Message text; malformed UTF-8 and non-ASCII bytes become replacement characters."""
    c = col(content)
    ascii_only = F.regexp_replace(F.decode(c, "ISO-8859-1"), r"[^\x00-\x7f]", "�")
    return (F.when(charset == "ISO-8859-1", F.decode(c, "ISO-8859-1")).when(charset == "US-ASCII", ascii_only)
            .when(charset == "UTF-16", F.decode(c, "UTF-16")).when(charset == "UTF-32", F.decode(c, "UTF-32"))
            .otherwise(F.make_valid_utf8(c.cast("string"))))


def _messages(files: DataFrame, default: str) -> DataFrame:
    raw = decoded("content", declared_charset("content", default))
    return (files.select(raw.alias("raw"), F.col("path"), F.col("modificationTime").alias("received_at"))
            .withColumn("msg_id", message_key(F.concat("path", "raw"))))


def read_messages(spark: SparkSession, path: str, default_charset: str = "UTF-8") -> DataFrame:
    return _messages(spark.read.format("binaryFile").load(path), default_charset)


def stream_messages(spark: SparkSession, path: str, default_charset: str = "UTF-8", max_files: int = 10_000) -> DataFrame:
    """Messages of a landing folder as a stream; the checkpoint records which files are taken."""
    return _messages(spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files).load(path), default_charset)


def read_lookup(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None,
                partitions: int = 16, **properties: str) -> DataFrame:
    """Pseudonym table over JDBC, read once and in parallel instead of one query per record."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column and bounds:
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.load()


def copy_records(spark: SparkSession, source: str, source_format: str, target: str, target_format: str, schema: str, **options: str) -> None:
    """Copy records from one format to another under a stated schema."""
    spark.read.schema(schema).format(source_format).options(**options).load(source).write.format(target_format).mode("errorifexists").save(target)


def json_array_rows(df: DataFrame, column: str, row_schema: str) -> DataFrame:
    """One row per element of a JSON array text, its members as columns."""
    items = F.from_json(column, f"array<struct<{row_schema}>>")
    return df.select(F.explode(items).alias("_r")).select("_r.*")


def insert_rows(rows: DataFrame, table: str) -> None:
    """Append rows to a table by column name."""
    rows.writeTo(table).append()
