"""A blocked Bloom filter as a small table, built and asked without user functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block is four 64-bit words and a key sets one bit in each.
WORDS = 4
#: Keys of a block on average: of unlisted keys about one in 3,000 passes.
KEYS_PER_BLOCK = 8
#: Most blocks of a filter. It is broadcast, with at most 40 bytes a block (40 MB); a filter of
#: more than 8 million keys lets more false positives through (about 4 % at 40 million).
MAX_BLOCKS = 1 << 20


def blocks_for(keys: int) -> int:
    """Blocks of a filter of ``keys`` keys."""
    return min(max(keys // KEYS_PER_BLOCK, 1), MAX_BLOCKS)


def _masks(key: Column) -> list[Column]:
    """One bit in each word of the block."""
    h = F.xxhash64(F.lit(1), key)
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"),
        )
        for i in range(WORDS)
    ]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def build_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``__block`` and its words; a block without keys has no row. Null keys are left out."""
    masks = {f"__m{i}": m for i, m in enumerate(_masks(F.col(key)))}
    words = [F.bit_or(f"__m{i}").alias(f"__w{i}") for i in range(WORDS)]
    marked = keys.where(F.col(key).isNotNull()).select(
        _block(F.col(key), blocks).alias("__block"), *[m.alias(n) for n, m in masks.items()]
    )
    return marked.groupBy("__block").agg(*words)


def possible_hits(
    df: DataFrame, key: str, built: DataFrame, blocks: int, to: str = "__possible"
) -> DataFrame:
    """Add ``to``: false for keys that are surely not listed (and for null keys)."""
    held = df.withColumn("__block", _block(F.col(key), blocks))
    joined = held.join(F.broadcast(built), "__block", "left")
    bits = [F.col(f"__w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))]
    hit = F.coalesce(reduce(Column.__and__, bits), F.lit(False)) & F.col(key).isNotNull()
    dropped = ["__block", *[f"__w{i}" for i in range(WORDS)]]
    return joined.withColumn(to, hit).drop(*dropped)
