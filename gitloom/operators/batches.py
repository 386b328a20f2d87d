"""Group similar summaries into batches for category discovery.

K-means as Spark jobs: copies are one weighted point, points stay in blocks, the centres of
all restarts are a table, and one iteration serves all restarts. Starts come from
oversampling (:mod:`gitloom.operators.seeding`), and a block meets only centres that bounds
leave open (:mod:`gitloom.operators.nearest`). Neither points nor centres pass the driver,
so the number of batches has no bound and the method is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gitloom.operators.nearest import assign, in_cells, ranges, reached, unpack, values
from gitloom.operators.neighbours import BLOCK_ROWS, Space, build_space, small_arrow_batches
from gitloom.operators.ordering import ordered_prefix
from gitloom.operators.seeding import starts
from gitloom.session import cut

# --- fixed values ---
RESTARTS = 10
FIRST_SEED = 42
MAX_ITERATIONS = 300
TOLERANCE = 1e-4
SUMMARIES_PER_BATCH = 20
# --- end of fixed values ---


def batch_count(n: int, per_batch: int = SUMMARIES_PER_BATCH) -> int:
    return max(1, math.ceil(n / per_batch))


def batch_count_column(df: DataFrame, per_batch: int = SUMMARIES_PER_BATCH) -> DataFrame:
    return df.agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / per_batch)).cast("long").alias("k")
    )


def _moved(space: Space, near: DataFrame, centres: DataFrame) -> DataFrame:
    """``seed, c, vec, cost, shift``: the means of the points nearest to each centre, the sum
    of squared distances to them (from sums of squares, so with their rounding) and how far
    the centre has moved; a centre without points has no row."""
    dim = space.dim

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                w = values(batch.column("mult"), i).astype(float)
                x = values(batch.column("flat"), i).reshape(-1, dim)
                names, at = np.unique(unpack(batch.column("c"), i, "<i8"), return_inverse=True)
                n = np.bincount(at, w, len(names))
                sums = np.zeros((len(names), dim))
                np.add.at(sums, at, x * w[:, None])
                inner = np.bincount(at, w * (x * x).sum(1), len(names))
                # One row at a time, and straight from NumPy: as lists, sums take many times their size.
                ends = pa.array(np.arange(len(names) + 1, dtype=np.int32) * dim)
                means = pa.ListArray.from_arrays(ends, pa.array((sums / n[:, None]).ravel()))
                seed = pa.array(np.full(len(names), batch.column("seed")[i].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [seed, pa.array(names, pa.int64()), means, pa.array(n), pa.array(inner)],
                    names=["seed", "c", "vec", "n", "inner"],
                )

    rows = near.select("blk", "seed", "c").join(space.blocks.select("blk", "mult", "flat"), "blk")
    parts = rows.select("seed", "c", "mult", "flat").mapInArrow(
        add_up, "seed long, c long, vec array<double>, n double, inner double"
    )
    # A mean without weight is an error in Spark: the old centres join what has points.
    mean = Summarizer.mean(array_to_vector("vec"), F.col("n"))
    sums = parts.groupBy("seed", "c").agg(
        vector_to_array(mean).alias("vec"), F.sum("n").alias("n"), F.sum("inner").alias("inner")
    )
    found = sums.join(centres.select("seed", "c", F.col("vec").alias("old")), ["seed", "c"])
    none = F.lit(0.0)
    length = F.aggregate("vec", none, lambda total, x: total + x * x)
    return found.select(
        "seed", "c", "vec",
        F.greatest(F.col("inner") - F.col("n") * length, none).alias("cost"),
        F.sqrt(_gap("vec", "old")).alias("shift"),
    )


def _gap(a, b):
    """Squared distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _best_labels(space: Space, k: int, restarts: int) -> DataFrame:
    """``idx, batch, d`` of the restart with the lowest cost; centres that lost all their
    points have no rows."""
    seeds = [FIRST_SEED + i for i in range(restarts)]
    with small_arrow_batches(space.blocks.sparkSession, 64):
        centres = cut(in_cells(starts(space, k, seeds), space), "centres")
        at, near, moved, settled, costs = reached(centres, space), None, {}, [], {}
        for number in range(1, MAX_ITERATIONS + 1):
            near = assign(space, centres, at, near, moved)
            after = cut(in_cells(_moved(space, near, centres), space), "centres")
            found = after.groupBy("seed", "cell").agg(
                F.min("reach").alias("low"), F.max("reach").alias("high"),
                F.max("shift").alias("shift"), F.sum("cost").alias("cost"),
            ).collect()  # at most MAX_PIVOTS rows a seed
            at, moved, cost = ranges(found, space), {}, {}
            for r in found:
                moved[r["seed"]] = max(moved.get(r["seed"], 0.0), r["shift"])
                cost[r["seed"]] = cost.get(r["seed"], 0.0) + r["cost"]
            done = [s for s, shift in moved.items() if shift <= TOLERANCE or number == MAX_ITERATIONS]
            if done:
                settled.append(after.where(F.col("seed").isin(*done)))
                costs |= {s: cost[s] for s in done}
                at = {s: r for s, r in at.items() if s not in costs}
                near = near.where(F.col("seed").isin(*at))
            centres = after.where(F.col("seed").isin(*at))
            if not at:
                break
        best = min(costs, key=lambda s: (costs[s], s))
        final = next(t for t in (t.where(F.col("seed") == best) for t in settled) if not t.isEmpty())
        near = assign(space, final, reached(final, space))

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    c, d = unpack(batch.column("c"), i, "<i8"), unpack(batch.column("near"), i, "<f8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values(batch.column("ids"), i)), pa.array(c), pa.array(d)],
                        names=["idx", "batch", "d"],
                    )

        rows = near.select("blk", "c", "near").join(space.blocks.select("blk", "ids"), "blk")
        return cut(
            rows.select("ids", "c", "near").mapInArrow(label, "idx long, batch long, d double"), "labels"
        )


def _fill_empty(space: Space, labels: DataFrame, k: int) -> DataFrame:
    """Give every batch without points one vector: the farthest from their centres.

    One vector of each batch is kept out of it, so that no batch is emptied; the others
    are enough, as there are at least ``k`` distinct vectors.
    """
    used = labels.select("batch").distinct()
    lacking = k - used.count()
    if lacking == 0:
        return labels
    kept = labels.groupBy("batch").agg(F.min(F.struct("d", "idx")).alias("m")).select("m.idx")
    free = labels.join(kept, "idx", "left_anti")
    keyed = free.select(F.lit(0).alias("all"), (-F.col("d")).alias("far"), "idx")
    ranked = ordered_prefix(keyed, ["all"], ["far", "idx"], None, "place")
    names = space.blocks.sparkSession.range(1, k + 1).withColumnRenamed("id", "batch").join(used, "batch", "left_anti")
    named = ordered_prefix(names.withColumn("all", F.lit(0)), ["all"], ["batch"], None, "place")
    changed = ranked.where(F.col("place") <= lacking).select("place", "idx").join(
        named.select("place", F.col("batch").alias("new")), "place"
    )
    return labels.join(changed.select("idx", "new"), "idx", "left").select(
        "idx", F.coalesce("new", "batch").alias("batch")
    )


def kmeans_batches(
    df: DataFrame,
    per_batch: int = SUMMARIES_PER_BATCH,
    id_col: str = "id",
    vec_col: str = "embedding",
    restarts: int = RESTARTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id, batch``: k-means with a batch for every ``per_batch`` rows; every row gets one.

    There are as many batches as that, or as distinct vectors if they are fewer, and none
    is empty. The lowest cost over ``restarts`` seeds wins.
    """
    points = cut(
        df.select(
            F.col(id_col).alias("id"),
            F.col(vec_col).cast("array<double>").alias("vec"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "points",
    )
    k = batch_count(points.count(), per_batch)
    if k > 1:
        space = build_space(points, "row", "vec", block_rows, listed=False)
        k = min(k, space.n)
    if k <= 1:
        return points.select("id", F.lit(0).cast("long").alias("batch"))
    labels = _fill_empty(space, _best_labels(space, k, restarts), k)
    numbered = space.members.join(labels, "idx").select(F.col("id").cast("long").alias("row"), "batch")
    return cut(
        points.select("id", "row").join(numbered, "row").select("id", (F.col("batch") - 1).alias("batch")), "batches"
    )
