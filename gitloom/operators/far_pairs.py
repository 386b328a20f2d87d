"""The most distant pairs of all texts, by their bigram sets.

Ranking every pair needs n^2 rows. The report wants the first k, so documents are packed
into blocks and each pair of blocks reports its own first k: nothing larger is stored or
shuffled. A first strip (one block against all) sets the bar, and pairs of blocks whose
best possible distance stays below it are never formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.functions.text import bigram_set
from gitloom.operators.disagreement import TOP_PAIRS
from gitloom.operators.neighbours import TILE_BLOCKS, small_arrow_batches, tiled
from gitloom.operators.ordering import ordered_prefix
from gitloom.session import cut

BLOCK_DOCS = 256
BLOCK_BIGRAMS = 1 << 18
COLUMNS_AT_ONCE = 4096

_PAIR = "i long, j long, distance double"


def _shared_counts(na: int, a_doc, a_code, nb: int, b_doc, b_code) -> np.ndarray:
    """Number of shared codes for every pair of documents, a slice of the codes at a time."""
    shared = np.intersect1d(a_code, b_code)
    keep_a, keep_b = np.isin(a_code, shared), np.isin(b_code, shared)
    a_doc, a_col = a_doc[keep_a], np.searchsorted(shared, a_code[keep_a])
    b_doc, b_col = b_doc[keep_b], np.searchsorted(shared, b_code[keep_b])
    counts = np.zeros((na, nb))
    for start in range(0, len(shared), COLUMNS_AT_ONCE):
        stop = start + COLUMNS_AT_ONCE
        left = np.zeros((na, COLUMNS_AT_ONCE), dtype=np.float32)
        right = np.zeros((nb, COLUMNS_AT_ONCE), dtype=np.float32)
        in_a, in_b = (a_col >= start) & (a_col < stop), (b_col >= start) & (b_col < stop)
        left[a_doc[in_a], a_col[in_a] - start] = 1
        right[b_doc[in_b], b_col[in_b] - start] = 1
        counts += left @ right.T
    return counts


def _first_pairs(a, b, metric: str, k: int) -> pd.DataFrame:
    """The first k pairs i < j between two blocks, by distance descending, then i, j."""
    a_ids, a_size, b_ids, b_size = (np.asarray(v) for v in (a[0], a[1], b[0], b[1]))
    a_doc, b_doc = np.repeat(np.arange(len(a_ids)), a_size), np.repeat(np.arange(len(b_ids)), b_size)
    shared = _shared_counts(len(a_ids), a_doc, np.asarray(a[2]), len(b_ids), b_doc, np.asarray(b[2]))
    if metric == "cosine":
        scale = np.sqrt(a_size[:, None] * b_size[None, :].astype(np.float64))
        distance = np.where(scale > 0, 1 - shared / np.where(scale > 0, scale, 1), -np.inf)
    else:
        distance = np.sqrt(a_size[:, None] + b_size[None, :] - 2 * shared)
    low = np.minimum(a_ids[:, None], b_ids[None, :])
    high = np.maximum(a_ids[:, None], b_ids[None, :])
    # Inside one block each pair appears twice: keep the upper half.
    usable = (a_ids[:, None] < b_ids[None, :]) if a_ids[0] == b_ids[0] else (low != high)
    distance = np.where(usable, distance, -np.inf)
    flat = distance.ravel()
    bar = np.partition(flat, -k)[-k] if len(flat) > k else -np.inf
    pick = np.nonzero((flat >= bar) & np.isfinite(flat))[0]
    out = pd.DataFrame({"i": low.ravel()[pick], "j": high.ravel()[pick], "distance": flat[pick]})
    return out.sort_values(["distance", "i", "j"], ascending=[False, True, True]).head(k)


def far_pairs(
    df: DataFrame,
    id_col: str,
    text_col: str,
    metric: str = "cosine",
    k: int = TOP_PAIRS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``i, j, distance`` of the k most distant pairs, ``i < j``, ties by ``i, j``.

    ``id_col`` is a whole number. For ``cosine`` a text without bigrams has no distance.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric: {metric}")
    spark = df.sparkSession
    sets = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(bigram_set(F.col(text_col)), lambda b: F.xxhash64(b)).alias("codes"),
    ).withColumn("size", F.size("codes"))
    # Euclidean distance grows with the sets: put the largest texts together and first.
    sets = sets.withColumn("lead", F.lit(0) if metric == "cosine" else -F.col("size"))
    ranked = ordered_prefix(sets.withColumn("__all", F.lit(0)), ["__all"], ["lead", "id"], F.col("size"))
    # A block ends after block_docs texts or a fixed number of bigrams, whichever is first.
    block = F.greatest(
        F.lit(0), F.floor((F.col("rn") - 1) / block_docs)
    ) + F.floor(F.col("running") / BLOCK_BIGRAMS)
    blocks = cut(
        ranked.withColumn("blk", block)
        .groupBy("blk")
        .agg(F.sort_array(F.collect_list(F.struct("rn", "id", "size", "codes"))).alias("r"))
        .select(
            "blk", F.col("r.id").alias("ids"), F.col("r.size").alias("sizes"),
            F.flatten("r.codes").alias("codes"), F.array_max("r.size").alias("largest"),
            F.array_min("r.id").alias("lowest"),
        ),
        "text-blocks",
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                yield _first_pairs(
                    (r.a_ids, r.a_sizes, r.a_codes), (r.ids, r.sizes, r.codes), metric, k
                )

    def report(rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.desc("distance"), "i", "j").limit(k)

    columns = ["ids", "sizes", "codes"]
    lead = blocks.orderBy("blk").limit(1).select(F.struct("blk", *columns).alias("lead")).scalar()
    strip = blocks.withColumn("lead", lead).select(
        *columns, *[F.col(f"lead.{c}").alias(f"a_{c}") for c in columns]
    )
    with small_arrow_batches(spark):
        first = cut(report(strip.mapInPandas(compare, _PAIR)), "strip")
    found = first.collect()  # at most k rows
    bar = found[-1]["distance"] if len(found) == k else float("-inf")
    shape = blocks.where(F.col("blk") > blocks.select(F.min("blk")).scalar()).select("blk", "largest")
    shape = cut(shape, "shape")
    if metric == "cosine":
        # Blocks follow the ids and 1 is the largest distance: at that bar the later
        # blocks can only tie, with larger ids.
        open_blocks = shape.where(F.lit(bar) < 1.0)
    else:
        top = shape.select(F.max("largest")).scalar()
        open_blocks = shape.where(F.sqrt(F.col("largest") + top) >= bar)
    open_blocks = cut(open_blocks, "open-blocks")
    if open_blocks.isEmpty():
        return first
    # Later blocks b for each a, as far as their best case reaches the bar.
    ids = open_blocks.select(F.max("blk")).scalar()
    pairs = open_blocks.select(
        F.col("blk").alias("a"), F.col("largest").alias("la"),
        F.explode(F.sequence("blk", ids)).alias("b"),
    ).join(open_blocks.select(F.col("blk").alias("b"), F.col("largest").alias("lb")), "b")
    if metric == "euclidean":
        pairs = pairs.where(F.sqrt(F.col("la") + F.col("lb")) >= bar)
    a_side = blocks.select(F.col("blk").alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b_side = blocks.select(F.col("blk").alias("b"), *columns)

    def compare_tile(asks, gives):
        held = {r.b: r for r in gives.itertuples()}
        found = [
            _first_pairs((r.a_ids, r.a_sizes, r.a_codes), (o.ids, o.sizes, o.codes), metric, k)
            for r in asks.itertuples()
            for o in map(held.__getitem__, r.bs)
        ]
        ordered = pd.concat(found).sort_values(["distance", "i", "j"], ascending=[False, True, True])
        return ordered.head(k)

    tiles = max(1, math.ceil(blocks.count() / TILE_BLOCKS))
    work = tiled(tiles, pairs.select("a", "b"), a_side, b_side, compare_tile, _PAIR)
    rest = cut(report(work), "pairs")
    return report(first.unionByName(rest))
