"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, col


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], spread: ColumnOrName, how: str = "left", salts: int = 16) -> DataFrame:
    """Equi-join of a large, possibly skewed left side with a per-key right side.

    Each left row takes one of ``salts`` slots from ``spread`` (a column that varies within a
    key, such as the instance UID); each right row is offered in every slot. A hot key is thus
    spread over ``salts`` tasks. Spark still turns this into a broadcast join by itself when the
    right side with all its copies is under the broadcast threshold: the copies come from a cross join,
    which the size estimate counts, as it does not count those of an explode. Exact for inner, left,
    left_semi and left_anti joins.
    """
    slotted = left.withColumn("_slot", F.pmod(F.xxhash64(col(spread)), F.lit(salts)).cast("int"))
    slots = right.sparkSession.range(salts).select(F.col("id").cast("int").alias("_slot"))
    offered = right.crossJoin(F.broadcast(slots))
    return slotted.join(offered, [*on, "_slot"], how).drop("_slot")


def in_tasks(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Deal the rows by key into a stated number of tasks, so that a task does not grow with the table; the groupings and
    joins by the key that follow need no other shuffle. Without a number the rows stay where they are."""
    return df if tasks is None else df.repartition(tasks, *keys)


# Up to so many parts a shuffle is written row by row (Spark's spark.shuffle.sort.bypassMergeThreshold); for more parts a
# task holds all the rows that it has to deal.
DEALT_DIRECTLY = 200


def dealt(df: DataFrame, tasks: int) -> DataFrame:
    """The rows in ``tasks`` even parts, whatever the keys and however few tasks read them (a file may be one row group).

    A task that reads much must not hold it: rows go by their place in the input, which needs no sort of what a task reads, and
    into at most ``DEALT_DIRECTLY`` parts at first; each of these is dealt on where more are wanted."""
    rows = df.withColumn("_place", F.monotonically_increasing_id()).repartition(min(tasks, DEALT_DIRECTLY), "_place")
    if tasks > DEALT_DIRECTLY:
        rows = rows.withColumn("_place", F.xxhash64("_place")).repartition(tasks, "_place")
    return rows.drop("_place")


def small_join(left: DataFrame, right: DataFrame, on: list[str], spread: ColumnOrName, how: str = "left", limit: int = 10_000) -> DataFrame:
    """Join a wide left side with a rule table: broadcast when a count proves the table small,
    the salted join otherwise. A broadcast leaves the left rows (pixels, attributes) in place."""
    if right.limit(limit + 1).count() <= limit:
        return left.join(F.broadcast(right), on, how)
    return lookup_join(left, right, on, spread, how)


def first_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest in ``order``.

    Written as an aggregation (not a window), so a hot key is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    picked = df.groupBy(*keys).agg(F.min(ranked).alias("_first"))
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in rest])


def numbered(df: DataFrame, group: list[str], tie: ColumnOrName, index: str = "row_index", total: str | None = None, digits: int = 3) -> DataFrame:
    """0-based, gapless number of each row within its group; optionally the group size.

    The order is that of the MD5 of ``tie`` (then ``tie``), which is arbitrary but repeatable; rows without a tie
    come first, as a range of their own.
    Because leading MD5 digits are an even, order-preserving split, a group is cut into
    16**digits ranges: sizes per range are pre-aggregated, turned into offsets, and each range is
    numbered on its own. No task sees more than one range of a group.
    """
    keyed = (df.withColumn("_tie", col(tie).cast("string")).withColumn("_hash", F.coalesce(F.md5("_tie"), F.lit("")))
             .withColumn("_range", F.substring("_hash", 1, digits)))
    sizes = keyed.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    per_group = Window.partitionBy(*group)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_r"),
        (F.sum("_n").over(per_group.orderBy("_range")) - F.col("_n")).alias("_offset"),
        F.sum("_n").over(per_group).alias("_total"))
    match = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)], F.col("_range") == F.col("_r"))
    in_range = Window.partitionBy(*group, "_range").orderBy("_hash", "_tie")
    out = (keyed.withColumn("_pos", F.row_number().over(in_range)).join(offsets, match)
           .withColumn(index, F.col("_offset") + F.col("_pos") - 1))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*df.columns, index, *([total] if total else []))


def batched(df: DataFrame, group: list[str], tie: ColumnOrName, size: int, batch: str = "batch_no") -> DataFrame:
    """Batches of at most ``size`` rows within a group, filled in the order of :func:`numbered`."""
    if size < 1:
        raise ValueError("batch size must be positive")
    return (numbered(df, group, tie, "_row").withColumn(batch, F.floor(F.col("_row") / size).cast("bigint")).drop("_row"))


def smallest_per_group(df: DataFrame, group: list[str], value: str, limit: int, out: str) -> DataFrame:
    """The ``limit`` smallest values per group as a sorted array.

    The rank filter is pushed below the shuffle by Spark, so each map task sends at most
    ``limit`` rows per group.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(value))).filter(F.col("_rank") <= limit)
    return ranked.groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias(out))


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)
