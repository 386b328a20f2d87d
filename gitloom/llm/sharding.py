"""Shards by jump consistent hashing.

A stable key picks its shard without a table of the ring: a generator seeded with the
key jumps from shard to shard, and the last jump below the number of shards is the home.
When shards are appended a key stays, or jumps into one of the new ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, with_columns, without
from gitloom.operators.ordering import ordered_prefix
from gitloom.session import cut

# --- fixed values: the published generator ---
MULTIPLIER = 2862933555777941757
# --- end of fixed values ---


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The home of each unsigned 64-bit key among ``shards``."""
    state = keys.astype(np.uint64)
    home = np.zeros(len(state), np.int64)
    landed = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while moving.size:  # each jump goes up, so at most ``shards`` rounds
        home[moving] = landed[moving]
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        stretch = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(float) + 1.0)
        landed[moving] = ((home[moving] + 1) * stretch).astype(np.int64)
        moving = moving[landed[moving] < shards]
    return home


def with_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (with one shard more), both int.

    The key, cast to text, decides alone: rows of equal keys share a shard, null counts
    as the empty text, and columns of the added names are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    source = without(df, "shard", "grown_shard")
    seed = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 16)
    keyed = source.withColumn("__seed", F.unhex(seed))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = b"".join(batch.column("__seed").to_pylist())
            keys = np.frombuffer(seeds, ">u8").astype(np.uint64)
            yield with_columns(
                batch,
                shard=pa.array(jump(keys, shards), pa.int32()),
                grown_shard=pa.array(jump(keys, shards + 1), pa.int32()),
            )

    schema = extended(keyed.schema, shard=T.IntegerType(), grown_shard=T.IntegerType())
    return keyed.mapInArrow(place, schema).drop("__seed")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus 16 and ``text_crc32`` the unsigned
    checksum of it; a null text counts as empty for both. ``slot`` numbers the rows of a
    shard from 0 by doc_id, size and checksum; rows equal in all three get consecutive
    slots in either order. Shards are numbered over range partitions, so a shard or a
    repeated doc_id with a third of the rows is no single task. An empty table gives none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # The row number tells equal rows apart; it is stored, as it may differ in a second run.
    placed = cut(
        with_shards(narrow, "doc_id", shards).withColumn("__row", F.monotonically_increasing_id()),
        "shards",
    )
    order = ["doc_id", "size", "text_crc32", "__row"]
    ranked = ordered_prefix(placed, ["shard"], order, rank_col="__rank", total_col="__total")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("__rank") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
