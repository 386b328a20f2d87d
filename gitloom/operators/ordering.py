"""Ranks and running totals for keys of any size.

A window partitioned by the key would put a hot key into one task. Here rows are
range-partitioned by (key, order), so a hot key spreads over many partitions;
each partition numbers its own rows and starts from the totals before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gitloom.session import cut


def _join_back(ranged: DataFrame, starts: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """``ranged`` with the columns of ``starts``; null keys meet null keys."""
    named = {k: f"__k{i}" for i, k in enumerate(keys)} | {part: "__p"}
    other = starts.withColumnsRenamed(named)
    same = F.col(part) == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(named[k]))
    return ranged.join(other, same).drop(*named.values())


def ordered_prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: Column | None = None,
    rank_col: str = "rn",
    total_col: str = "running",
) -> DataFrame:
    """Add the 1-based rank within ``keys`` and the running total of ``amount``."""
    amount = F.lit(1).cast("long") if amount is None else amount.cast("long")
    part = "__part"
    ranged = cut(
        df.withColumn("__amount", amount)
        .repartitionByRange(*keys, *order)
        .withColumn(part, F.spark_partition_id()),
        "ranged",
    )
    # One row per (key, partition): bounded by the number of partitions.
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, part)
        .agg(F.count("*").alias("__n"), F.sum("__amount").alias("__sum"))
        .select(
            *keys,
            part,
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__rows_before"),
            F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__sum_before"),
        )
    )
    within = Window.partitionBy(*keys, part).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        _join_back(ranged, starts, keys, part)
        .withColumn(rank_col, F.row_number().over(within) + F.col("__rows_before"))
        .withColumn(total_col, F.sum("__amount").over(upto) + F.col("__sum_before"))
        .drop(part, "__amount", "__rows_before", "__sum_before")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in ``order``.

    ``min_by`` combines before the shuffle, so a key with many copies is cheap;
    ``dropDuplicates`` would keep an arbitrary row.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = F.struct(*order)
    # Where the order is all there is to a row, it is carried once.
    picked = F.min(ordered) if set(rest) == set(order) else F.min_by(F.struct(*rest), ordered)
    picked = picked.alias("__row")
    return df.groupBy(*keys).agg(picked).select(
        *[f"__row.{c}" if c in rest else c for c in df.columns]
    )


def preceding_marked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], mark: Column, value: Column, out: str
) -> DataFrame:
    """Add ``value`` of the nearest earlier row of the key that satisfies ``mark`` (or null).

    Works like :func:`ordered_prefix`: rows look inside their own range partition, and
    the last marked value of each partition is handed on to the partitions after it.
    """
    part = "__part"
    ranged = cut(
        df.withColumn("__value", F.when(mark, value))
        .repartitionByRange(*keys, *order)
        .withColumn(part, F.spark_partition_id()),
        "ranged",
    )
    within = Window.partitionBy(*keys, part).orderBy(*order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # Every (key, partition) has a row, to receive what earlier partitions hand on.
    starts = (
        ranged.groupBy(*keys, part)
        .agg(
            F.max_by(
                F.struct("__value"), F.when(F.col("__value").isNotNull(), F.struct(*order))
            ).alias("__last")
        )
        .select(
            *keys, part, F.last("__last.__value", ignorenulls=True).over(earlier).alias("__carry")
        )
    )
    return (
        _join_back(ranged, starts, keys, part)
        .withColumn(
            out, F.coalesce(F.last("__value", ignorenulls=True).over(before), F.col("__carry"))
        )
        .drop(part, "__value", "__carry")
    )
