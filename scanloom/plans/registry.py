"""Registry of runnable queries and their SQL counterparts over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanloom.operators.keyed import dealt

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DERIVED: dict[str, tuple[str, str]] = {}


def derive(name: str, sql: str, spark_sql: str | None = None) -> None:
    """A table derived from the given ones; one text serves both engines unless Spark has its own."""
    DERIVED[name] = (sql, spark_sql or sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DERIVED:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql, bases = _inlined(DERIVED[name][1])
    frames = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in bases}
    if name in WIDE:
        frames = {b: spread(df) for b, df in frames.items()}
    return spark.sql(sql, **frames)


# Derived tables whose rows take much work: the files and row groups of an input say little about it.
WIDE = ("elements", "loose_elements", "orm", "adt", "oru")
ROWS_A_TASK = 20_000
# Instances that one task sorts, with all their attribute rows (some 600 MB), after a shuffle by instance.
INSTANCES_A_TASK = 50_000


def tasks_for(df: DataFrame, rows: int) -> int:
    """Tasks of at most about ``rows`` rows each, one a core at least; the count of a given table reads file footers only."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def instance_tasks(t) -> int:
    """Tasks of a shuffle of attribute rows by their instance."""
    return tasks_for(t("inst"), INSTANCES_A_TASK)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows of an input evenly, so that its tasks grow in number and not in size (:func:`dealt`)."""
    return dealt(df, tasks_for(df, rows or ROWS_A_TASK))


def _inlined(sql: str) -> tuple[str, set[str]]:
    """Text with derived tables inlined and given tables as ``{name}``, and the given names."""
    bases: set[str] = set()

    def place(match: re.Match) -> str:
        name = match.group(2)
        if name in DERIVED:
            inner, used = _inlined(DERIVED[name][1])
            bases.update(used)
            return f"{match.group(1)} ({inner}) AS {name}"
        if name not in TABLES:
            return match.group(0)
        bases.add(name)
        return f"{match.group(1)} {{{name}}} AS {name}"

    return re.sub(r"\b(FROM|JOIN)\s+([a-z_]+)\b", place, sql), bases


def _with_derived(sql: str) -> str:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)\b", text):
            if name in DERIVED and name not in order:
                visit(DERIVED[name][0])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    shared = ", ".join(f"{n} AS ({DERIVED[n][0]})" for n in order)
    rest = sql.strip()
    return f"WITH {shared}, {rest[5:]}" if rest[:5].upper() == "WITH " else f"WITH {shared} {rest}"


def query(name: str, sql: str | None = None):
    """Register ``fn(t)`` where ``t(table_name)`` gives a table of the chosen folder."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda n: table(spark, sf_dir, n))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = _with_derived(sql)
        return fn

    return add
